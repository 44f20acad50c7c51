"""Harmonic packing of encoded documents into sequences of a fixed capacity.

A length belongs to class k when k texts of that length, and no more, fit into one sequence: class k holds the
lengths in (capacity / (k + 1), capacity / k]. Every worker keeps one open bin a class and closes it when it
holds k texts, so workers never ask one another for room. A text longer than the capacity gives whole
sequences first; its rest has a class.

A closed bin of class k has less than capacity / (k + 1) room left. The next text of the same worker gives
its first tokens to that room, so a bin waits for one text at most. What is open when a worker ends is chained and cut
at the capacity; the tail is cut into sequences whose lengths are powers of two, which need no padding.
Every sequence is thus full or a power of two.

A worker holds less than ``capacity`` tokens a class, and there are about 2 * sqrt(capacity) classes that a length
can have. Texts are not shuffled.

The pieces that the vocabulary cuts plain text into are found for a slice of texts at once. Each distinct one is encoded once a
worker and remembered, about ``REMEMBERED`` of them in two generations: the older goes when the younger holds half of that,
and what is met again moves to the younger. The vocabulary drops white space and merges nothing across pieces, so the ids are those
of the whole text. Words with other characters are encoded whole.

Defined results: a null or blank text is the end id alone; repeated rows are packed each; an empty table has no
pieces; columns besides those named are ignored. Which texts share a sequence follows from the input's
partitions and their order.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from itertools import chain, compress, pairwise
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm import texts

VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
CAPACITY = 2048
END_ID = 1
#: Pieces whose ids a worker remembers, unless one slice has more.
REMEMBERED = 1_000_000
#: Bytes of text that are cut at once, unless a single text is longer.
SLICE_BYTES = 8 << 20
#: Rows of one batch that is handed on.
BATCH_ROWS = 4096

#: Fixed value: what ends the last token of a piece.
WORD_END = "</w>"
#: Pieces that are encoded in one call.
TOGETHER = 64
_BLANK = re.compile(r"[ \t\n\r\x0b\x0c]+")
#: What no normalisation but lower-casing changes: visible ASCII, the letters U+00C0 to U+00FF, white space.
_SIMPLE = re.compile(r"[\x21-\x7EÀ-ÖØ-öø-ÿ \t\n\r\x0b\x0c]+")
#: Fixed value: how this vocabulary cuts such text, lower-cased, before pairs are merged.
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ \t\n\r\x0b\x0c]+")
_PLAIN = re.compile(r"[a-zß-öø-ÿ]+")
#: What bytes of simple text, lower-cased, are to these pieces.
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_KINDS = np.array([_SPACE if c in b"\0 \t\n\r\x0b\x0c" else _LETTER if 97 <= c <= 122 or c >= 128 else _DIGIT if 48 <= c <= 57
                   else _OTHER for c in range(256)], np.uint8)

#: (document, its ids, first id, ids in the piece)
Piece = tuple[int, np.ndarray, int, int]


def encoder(vocabulary: bytes) -> Callable[[list[str | None]], list[bytes]]:
    """Ids of texts, as little-endian 32-bit numbers, under a vocabulary file of the tokenizers library."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(vocabulary.decode())
    last = np.zeros(tokenizer.get_vocab_size(), bool)
    last[[i for token, i in tokenizer.get_vocab().items() if token.endswith(WORD_END)]] = True
    known: dict[str, bytes] = {}
    older: dict[str, bytes] = {}

    def learn(new: list[str]) -> None:
        """Add the ids of pieces; plain ones go together, since their last ids tell them apart."""
        plain = list(filter(_PLAIN.fullmatch, new))
        groups = [plain[k : k + TOGETHER] for k in range(0, len(plain), TOGETHER)]
        for group, found in zip(groups, tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(found.ids, "<u4")
            ends = ((np.flatnonzero(last[ids]) + 1) * 4).tolist()
            data = ids.tobytes()
            known.update(zip(group, [data[a:b] for a, b in pairwise([0, *ends])], strict=True))
        other = [p for p in new if p not in known]
        found = tokenizer.encode_batch_fast(other, add_special_tokens=False)
        known.update((p, np.array(e.ids, "<u4").tobytes()) for p, e in zip(other, found, strict=True))

    def ids_of(used: list[str]) -> list[bytes]:
        """The ids of each of these pieces; what is only in ``older`` moves to ``known``."""
        nonlocal known, older
        if len(known) > REMEMBERED // 2:
            known, older = {}, known
        found = list(map(known.get, used))
        unknown = [k for k, ids in enumerate(found) if ids is None]
        missing = [used[k] for k in unknown]
        known.update((p, ids) for p, ids in zip(missing, map(older.get, missing), strict=True) if ids is not None)
        learn([p for p in missing if p not in known])
        for k in unknown:
            found[k] = known[used[k]]
        return found

    def encode(group: list[str | None]) -> list[bytes]:
        # Simple texts are cut together, the others one by one behind them.
        simple = [_simple(t or "") for t in group]
        order = [*compress(range(len(group)), simple), *(k for k, s in enumerate(simple) if not s)]
        cut, counts = cut_simple([t or "" for t in compress(group, simple)])
        rest = [pieces(group[k]) for k in order[len(counts):]]
        if rest:
            cut = pa.concat_arrays([cut, pa.array(chain.from_iterable(rest), pa.string())])
            counts = np.r_[counts, [len(p) for p in rest]]
        coded = cut.dictionary_encode()
        found = ids_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        place = coded.indices.to_numpy()
        n = sizes[place]
        ends = np.cumsum(n)
        at = np.repeat((np.cumsum(sizes) - sizes)[place] - ends + n, n) + np.arange(n.sum())
        data = np.frombuffer(b"".join(found), "<u4")[at].tobytes()
        bounds = (4 * np.r_[0, ends][np.r_[0, np.cumsum(counts)]]).tolist()
        out = [b""] * len(group)
        for k, (a, b) in zip(order, pairwise(bounds), strict=True):
            out[k] = data[a:b]
        return out

    return encode


def _simple(text: str) -> bool:
    return "<|" not in text and (not text or _SIMPLE.fullmatch(text) is not None)


def cut_simple(group: list[str]) -> tuple[pa.StringArray, np.ndarray]:
    """The pieces of simple texts, as ``pieces`` cuts each, and how many each has."""
    # A zero byte ends every text; beyond ASCII only letters are simple.
    data = np.frombuffer("".join(f"{t}\0" for t in group).lower().encode() + b"\0\0", np.uint8)
    kind = _KINDS[data]
    start = (kind != _SPACE) & ((kind == _DIGIT) | (kind != np.r_[np.uint8(_SPACE), kind[:-1]]))
    # An apostrophe that begins a piece takes some letters with it, and what follows them is a new piece.
    at = np.flatnonzero(start[:-2] & (data[:-2] == ord("'")))
    one, two = data[at + 1], data[at + 2]
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long = (one == ord("r")) & (two == ord("e")) | (one == ord("v")) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    start[at[short | long] + 1] = False
    after = np.r_[at[short] + 2, at[long] + 3]
    start[after[kind[after] != _SPACE]] = True
    kept = kind != _SPACE
    text = data[kept]
    bounds = np.r_[np.flatnonzero(start[kept]), len(text)].astype(np.int32)
    found = pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(text))
    before = np.searchsorted(np.flatnonzero(start), np.flatnonzero(data[:-2] == 0))
    return found, np.diff(before, prepend=0)


def pieces(text: str) -> list[str]:
    """Pieces of a text that can be encoded one by one; words that are not plain stay whole."""
    if _simple(text):
        return _PIECE.findall(text.lower())
    found: list[str] = []
    for word in filter(None, _BLANK.split(text)):
        found += _PIECE.findall(word.lower()) if _simple(word) else [word]
    return found


class Bins:
    """The open bins of one worker; methods yield whole sequences, as lists of pieces."""

    def __init__(self, capacity: int = CAPACITY):
        self.capacity = capacity
        self.open: dict[int, list[Piece]] = {}
        self.waiting: list[Piece] = []
        self.room = 0

    def add(self, document: int, ids: np.ndarray) -> Iterator[list[Piece]]:
        at, n = 0, len(ids)
        if self.waiting:
            at = min(self.room, n)
            self.waiting.append((document, ids, 0, at))
            self.room -= at
            if self.room:
                return
            yield self.waiting
            self.waiting = []
        while n - at >= self.capacity:
            yield [(document, ids, at, self.capacity)]
            at += self.capacity
        if at == n:
            return
        texts_in_bin = self.capacity // (n - at)
        bin_ = self.open.setdefault(texts_in_bin, [])
        bin_.append((document, ids, at, n - at))
        if len(bin_) == texts_in_bin:
            del self.open[texts_in_bin]
            self.room = self.capacity - sum(p[3] for p in bin_)
            if self.room:
                self.waiting = bin_
            else:
                yield bin_

    def end(self) -> Iterator[list[Piece]]:
        """What is still open, cut at the capacity and, at last, at powers of two."""
        left = self.waiting + [p for k in sorted(self.open) for p in self.open[k]]
        self.open, self.waiting, self.room = {}, [], 0
        total = sum(p[3] for p in left)
        sizes = [self.capacity] * (total // self.capacity)
        tail = total % self.capacity
        sizes += [1 << b for b in reversed(range(tail.bit_length())) if tail >> b & 1]
        pieces = iter(left)
        piece = None
        for size in sizes:
            sequence = []
            while size:
                document, ids, at, n = piece or next(pieces)
                taken = min(n, size)
                sequence.append((document, ids, at, taken))
                size -= taken
                piece = (document, ids, at + taken, n - taken) if taken < n else None
            yield sequence


def pack(docs: DataFrame, keep: list[str], vocabulary: str = VOCABULARY, capacity: int = CAPACITY,
         end_id: int = END_ID, text: str = "text") -> DataFrame:
    """Columns ``keep`` with start, length, ids, doc_tokens, sequence_id and offset of every piece.

    ``ids`` are little-endian unsigned 32-bit numbers. The vocabulary is read here and sent along.
    """
    # A worker keeps its copy from task to task, and with it the encoder and what that remembers.
    shared = docs.sparkSession.sparkContext.broadcast({"vocabulary": Path(vocabulary).read_bytes()})
    source = texts.with_id(docs, **{f"k{i}": c for i, c in enumerate(keep)}, _text=text)
    fields = [T.StructField(name, kind) for name, kind in (
        ("start", T.LongType()), ("length", T.LongType()), ("ids", T.BinaryType()), ("doc_tokens", T.LongType()),
        ("sequence_id", T.LongType()), ("offset", T.LongType()))]
    schema = T.StructType([*source.schema.fields[:-1], *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        if "encode" not in own:
            own["encode"] = encoder(own["vocabulary"])
        encode, bins, end = own["encode"], Bins(capacity), end_id.to_bytes(4, "little")
        place = TaskContext.get().partitionId() << 33
        kinds, rows = None, []
        keys: dict[int, tuple] = {}

        def batch() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            made = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(made, schema.names)

        def take(sequences: Iterator[list[Piece]]) -> None:
            nonlocal place
            for sequence in sequences:
                offset = 0
                for document, ids, at, n in sequence:
                    rows.append((*keys[document], at, n, ids[at : at + n].tobytes(), len(ids), place, offset))
                    offset += n
                    if at + n == len(ids):
                        del keys[document]
                place += 1

        document = 0
        for part in texts.slices(batches, "_text", SLICE_BYTES):
            if kinds is None:
                kinds = [*part.schema.types[:-1], pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            kept = list(zip(*(c.to_pylist() for c in part.columns[:-1]), strict=True)) or [()] * part.num_rows
            for key, ids in zip(kept, encode(part.columns[-1].to_pylist()), strict=True):
                keys[document] = key
                take(bins.add(document, np.frombuffer(ids + end, "<u4")))
                document += 1
                if len(rows) >= BATCH_ROWS:
                    yield batch()
        take(bins.end())
        if rows:
            yield batch()

    packed = source.mapInArrow(run, schema)
    return packed.toDF(*keep, *[f.name for f in fields])


def padded(total: Column | str, capacity: int = CAPACITY) -> Column:
    """Room that a sequence of ``total`` ids takes: its own length at a power of two, else the capacity."""
    total = F.col(total) if isinstance(total, str) else total
    return F.when(F.bit_count(total) == 1, total).otherwise(F.lit(capacity))
