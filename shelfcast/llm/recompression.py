"""Removal of repeated passages found by recompression.

Words become symbols. A first round names every maximal run of one symbol; each further round splits the
symbols by a bit of their digest into left and right ones and names every adjacent pair of a left and a
right symbol. A name is a digest of what it stands for, so all tasks give equal parts equal names without
asking one another, and equal passages get equal symbols except for a few at their ends. For every window
of ``window`` words the safe symbols, those that do not depend on the words around the window, are known
exactly. The window's anchor is its first safe symbol on the highest level that starts early enough; its
key digests the ``KEY_WORDS`` words from there. Equal windows have equal anchors, and many windows share
one, so only a fraction of the places is compared:

1. every group of documents reports its keys; those of two or more documents are shared;
2. windows with a shared key report a 96-bit digest and the smallest doc_id in their group;
3. a window whose digest has a smaller doc_id elsewhere is covered and its words are removed.

Documents are shuffled by group once and that exchange serves all three steps. A key or window that
very many documents hold is reported once per group, not per document.

Defined results: a null text has no words; a text of fewer words than a window loses nothing; rows with
equal doc_id are one document, so nothing in them is removed for one another's sake; a row without doc_id
comes after all others. Other columns are handed on untouched.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm import texts

WINDOW = 13
#: Words that a key digests; fewer make keys meet by chance, more leave windows without a late anchor.
KEY_WORDS = 6
ROUNDS = 4
#: Groups of documents per shuffle partition.
GROUPS_PER_PARTITION = 4
LAST = (1 << 63) - 1
PLAIN_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_ODD = [np.uint64(x) for x in texts.odd_numbers(8, 11)]


class Sequence:
    """The words of several documents, a separator of its own after each."""

    def __init__(self, documents: list[list[bytes]]):
        sizes = np.array([len(w) for w in documents], np.int64)
        self.ends = np.cumsum(sizes + 1) - 1  # places of the separators
        self.starts = self.ends - sizes
        self.symbols = np.zeros(int(sizes.sum()) + len(sizes), np.uint64)
        inner = np.ones(len(self.symbols), bool)
        inner[self.ends] = False
        self.symbols[inner] = texts.word_digests([w for words in documents for w in words])
        self.separator = ~inner
        self.symbols[self.separator] = texts.mix(np.arange(len(sizes), dtype=np.uint64) + _ODD[0])
        self.owner = np.repeat(np.arange(len(sizes)), sizes + 1)

    def windows(self, size: int) -> np.ndarray:
        """Places where ``size`` words of one document start."""
        room = np.repeat(self.ends, self.ends - self.starts + 1) - np.arange(len(self.symbols))
        return np.flatnonzero(room >= size)

    def digests(self, size: int, seed: int) -> np.ndarray:
        """Digests of the ``size`` symbols from each place, as differences of a running sum."""
        n = len(self.symbols)
        if n < size:
            return np.empty(0, np.uint64)
        base, inverse = _base(seed)
        up, down = np.full(n, base, np.uint64), np.full(n - size + 1, inverse, np.uint64)
        up[0] = down[0] = 1
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(texts.mix(self.symbols ^ base) * np.cumprod(up), out=sums[1:])
        return texts.mix((sums[size:] - sums[:-size]) * np.cumprod(down))


def _base(seed: int) -> tuple[np.uint64, np.uint64]:
    base = int(texts.odd_numbers(1, seed)[0])
    return np.uint64(base), np.uint64(pow(base, -1, 1 << 64))


def anchors(seq: Sequence, places: np.ndarray, window: int = WINDOW, rounds: int = ROUNDS) -> np.ndarray:
    """For the windows that start at ``places``: the place of their anchor, a function of their words."""
    latest = window - KEY_WORDS
    first = np.r_[True, seq.symbols[1:] != seq.symbols[:-1]]
    index = np.cumsum(first) - 1
    start = np.flatnonzero(first)
    length = np.diff(np.r_[start, len(seq.symbols)]).astype(np.uint64)
    name, closed = seq.symbols[start], seq.separator[start]
    name = np.where(length > 1, texts.mix(name + length * _ODD[1]), name)
    # The run at either end of a window may go on outside it.
    low, high = index[places] + 1, index[places + window - 1] - 1
    anchor, alive = places.copy(), np.ones(len(places), bool)
    for level in range(rounds + 1):
        if level:
            right = (texts.mix(name + _ODD[2] * np.full(1, level, np.uint64)) & np.uint64(1)).astype(bool)
            right[closed] = False
            joined = np.r_[~right[:-1] & ~closed[:-1] & right[1:], False]
            first = np.r_[True, ~joined[:-1]]
            index = np.cumsum(first) - 1
            # A right symbol at the lower end may belong to a pair that starts outside; so a left one at the upper.
            low, high = index[low + right[low]], index[high - ~right[high]]
            keep = np.flatnonzero(first)
            pair = joined[keep]
            after = name[np.minimum(keep + 1, len(name) - 1)]
            name = np.where(pair, texts.mix(name[keep] * _ODD[3] + texts.mix(after + _ODD[4])), name[keep])
            start, closed = start[keep], closed[keep]
        alive &= low <= high
        low, high = np.where(alive, low, 0), np.where(alive, high, 0)
        here = start[low]
        anchor = np.where(alive & (here - places <= latest), here, anchor)
    return anchor


def _words(table: pa.Table):
    """Slices of a group with their words, doc_ids and sequence."""
    for batch in texts.slices(table.to_batches(), "text"):
        words = [texts.plain_words(t) for t in texts.as_bytes(batch.column("text"))]
        doc_id = batch.column("doc_id").fill_null(LAST).to_numpy(zero_copy_only=False).astype(np.int64)
        yield batch, words, doc_id, Sequence(words)


def _cut(order_by: np.ndarray, parts: int) -> Iterator[tuple[int, slice]]:
    """Slices of equal values of an array sorted by part."""
    bounds = np.searchsorted(order_by, np.arange(parts + 1))
    for part in np.flatnonzero(bounds[1:] > bounds[:-1]):
        yield int(part), slice(bounds[part], bounds[part + 1])


def _group_keys(parts: int, window: int) -> Callable[[pa.Table], pa.Table]:
    schema = pa.schema([("part", pa.int32()), ("grp", pa.int32()), ("one", pa.binary()), ("more", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        keys, docs = [], []
        for _, _, doc_id, seq in _words(table):
            anchor = np.unique(anchors(seq, seq.windows(window), window))
            keys.append(seq.digests(KEY_WORDS, 21)[anchor])
            docs.append(doc_id[seq.owner[anchor]])
        key, doc = np.concatenate(keys), np.concatenate(docs)
        order = np.lexsort((doc, key))
        key, doc = key[order], doc[order]
        if not len(key):
            return _table([], schema)
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        last = np.r_[first[1:], len(key)] - 1
        several, key = doc[first] != doc[last], key[first]
        part = (key % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        key, several, part = key[order], several[order], part[order]
        grp = table.column("grp")[0].as_py()
        rows = [(p, grp, key[s][~several[s]].tobytes(), key[s][several[s]].tobytes()) for p, s in _cut(part, parts)]
        return _table(rows, schema)

    return run


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


def _pieces(column: list[bytes], kind) -> tuple[np.ndarray, np.ndarray]:
    """All values of the packed column and the bounds of its rows."""
    arrays = [np.frombuffer(x, kind) for x in column]
    return (np.concatenate(arrays) if arrays else np.empty(0, kind)), np.cumsum([0, *map(len, arrays)])


def _shared_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [r for b in batches for r in zip(*[b.column(c).to_pylist() for c in ("grp", "one", "more")], strict=True)]
    if not rows:
        return
    one, bounds = _pieces([r[1] for r in rows], np.uint64)
    more, more_bounds = _pieces([r[2] for r in rows], np.uint64)
    seen = np.sort(np.concatenate([one, np.unique(more), np.unique(more)]))
    shared = np.unique(seen[1:][seen[1:] == seen[:-1]])
    for k in range(len(rows)):
        own = one[bounds[k] : bounds[k + 1]]
        own = np.concatenate([own[_within(own, shared)], more[more_bounds[k] : more_bounds[k + 1]]])
        if len(own):
            yield pa.RecordBatch.from_pydict(
                {"grp": pa.array([rows[k][0]], pa.int32()), "keys": pa.array([own.tobytes()], pa.binary())})


def _within(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _group_windows(parts: int, window: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    schema = pa.schema([("part", pa.int32()), ("grp", pa.int32()), ("a", pa.binary()), ("b", pa.binary()),
                        ("doc", pa.binary()), ("several", pa.binary())])

    def run(table: pa.Table, reply: pa.Table) -> pa.Table:
        if not (table.num_rows and reply.num_rows):
            return _table([], schema)
        shared = np.unique(_pieces(reply.column("keys").to_pylist(), np.uint64)[0])
        found = []
        for _, _, doc_id, seq in _words(table):
            places = seq.windows(window)
            hit = _within(seq.digests(KEY_WORDS, 21)[anchors(seq, places, window)], shared)
            places = places[hit]
            found.append((seq.digests(window, 31)[places], (seq.digests(window, 41)[places] >> np.uint64(32)).astype(np.uint32),
                          doc_id[seq.owner[places]]))
        a, b, doc = (np.concatenate(x) for x in zip(*found, strict=True))
        place = np.arange(len(a))
        order = np.lexsort((place, doc, b, a))
        a, b, doc = a[order], b[order], doc[order]
        if not len(a):
            return _table([], schema)
        first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        last = np.r_[first[1:], len(a)] - 1
        several, a, b, doc, place = doc[first] != doc[last], a[first], b[first], doc[first], order[first]
        part = ((a ^ b) % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((place, part))  # in the order of the text, doc_ids pack well
        a, b, doc, several, part = a[order], b[order], doc[order], several[order].astype(np.uint8), part[order]
        grp = table.column("grp")[0].as_py()
        rows = [(p, grp, a[s].tobytes(), b[s].tobytes(), doc[s].tobytes(), several[s].tobytes()) for p, s in _cut(part, parts)]
        return _table(rows, schema)

    return run


def _first_owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("grp", "a", "b", "doc", "several")
    rows = [r for x in batches for r in zip(*[x.column(c).to_pylist() for c in names], strict=True)]
    if not rows:
        return
    a, bounds = _pieces([r[1] for r in rows], np.uint64)
    b = _pieces([r[2] for r in rows], np.uint32)[0]
    doc = _pieces([r[3] for r in rows], np.int64)[0]
    several = _pieces([r[4] for r in rows], np.uint8)[0].astype(bool)
    order = np.lexsort((b, a))
    new = np.r_[True, (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])]
    owner = np.empty(len(a), np.int64)
    owner[order] = np.minimum.reduceat(doc[order], np.flatnonzero(new))[np.cumsum(new) - 1]
    needed = (owner < doc) | several
    for k in range(len(rows)):
        s = slice(bounds[k], bounds[k + 1])
        own = needed[s]
        if own.any():
            yield pa.RecordBatch.from_pydict({
                "grp": pa.array([rows[k][0]], pa.int32()), "a": pa.array([a[s][own].tobytes()], pa.binary()),
                "b": pa.array([b[s][own].tobytes()], pa.binary()), "owner": pa.array([owner[s][own].tobytes()], pa.binary())})


class _Owners:
    """Smallest doc_id by window digest."""

    def __init__(self, reply: pa.Table):
        a = _pieces(reply.column("a").to_pylist(), np.uint64)[0]
        b = _pieces(reply.column("b").to_pylist(), np.uint32)[0]
        owner = _pieces(reply.column("owner").to_pylist(), np.int64)[0]
        order = np.lexsort((b, a))
        self.a, self.b, self.owner = a[order], b[order], owner[order]
        # How many digests agree in their first 64 bits with the one before; practically none.
        self.ties = int(np.max(np.unique(self.a, return_counts=True)[1], initial=0))

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        owner = np.full(len(a), LAST, np.int64)
        at = np.searchsorted(self.a, a)
        for k in range(self.ties):
            here = np.minimum(at + k, len(self.a) - 1)
            owner = np.where((self.a[here] == a) & (self.b[here] == b), self.owner[here], owner)
        return owner


def _covered(seq: Sequence, doc_id: np.ndarray, owners: _Owners, window: int) -> np.ndarray:
    """Which places lie in a window that a document with a smaller doc_id holds too."""
    places = seq.windows(window)
    a = seq.digests(window, 31)[places]
    b = (seq.digests(window, 41)[places] >> np.uint64(32)).astype(np.uint32)
    places = places[owners.of(a, b) < doc_id[seq.owner[places]]]
    steps = np.zeros(len(seq.symbols) + 1, np.int64)
    steps[places] += 1
    np.subtract.at(steps, places + window, 1)
    return np.cumsum(steps)[:-1] > 0


def _judge(window: int, finish: Callable[[pa.RecordBatch, list[list[bytes]], list[np.ndarray | None]], pa.RecordBatch],
           schema: pa.Schema) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(table: pa.Table, reply: pa.Table) -> pa.Table:
        owners = _Owners(reply) if reply.num_rows else None
        out = []
        for batch in texts.slices(table.to_batches(), "text"):
            words = [texts.plain_words(t) for t in texts.as_bytes(batch.column("text"))]
            gone: list[np.ndarray | None] = [None] * len(words)
            if owners:
                doc_id = batch.column("doc_id").fill_null(LAST).to_numpy(zero_copy_only=False).astype(np.int64)
                seq = Sequence(words)
                covered = _covered(seq, doc_id, owners, window)
                for k in np.unique(seq.owner[covered]):
                    gone[k] = covered[seq.starts[k] : seq.ends[k]]
            out.append(finish(batch, words, gone))
        return pa.Table.from_batches(out, schema=schema)

    return run


def _repeats(docs: DataFrame, finish, result: T.StructType, window: int) -> DataFrame:
    """Group the documents, agree on shared keys and windows, and finish every group with its verdicts."""
    from pyspark.sql.pandas.types import to_arrow_schema

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = GROUPS_PER_PARTITION * parts
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    packed = F.struct(*rest) if rest else F.struct(F.lit(0).alias("none"))
    dealt = docs.select(F.pmod(F.xxhash64("doc_id"), F.lit(groups)).cast("int").alias("grp"), "doc_id", "text", packed.alias("rest"))
    dealt = dealt.repartition(parts, "grp")
    keys = dealt.groupBy("grp").applyInArrow(_group_keys(parts, window), "part int, grp int, one binary, more binary")
    shared = keys.repartitionById(parts, "part").mapInArrow(_shared_keys, "grp int, keys binary")
    windows = dealt.groupBy("grp").cogroup(shared.groupBy("grp")).applyInArrow(
        _group_windows(parts, window), "part int, grp int, a binary, b binary, doc binary, several binary")
    owners = windows.repartitionById(parts, "part").mapInArrow(_first_owners, "grp int, a binary, b binary, owner binary")
    return dealt.groupBy("grp").cogroup(owners.groupBy("grp")).applyInArrow(
        _judge(window, finish, to_arrow_schema(result)), result)


def repeat_counts(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and the digest of the kept words of every row."""
    result = T.StructType.fromDDL("doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")

    def finish(batch, words, gone):
        kept = [w if g is None else [x for x, out in zip(w, g.tolist(), strict=True) if not out]
                for w, g in zip(words, gone, strict=True)]
        return pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array([len(w) for w in words], pa.int64()),
            pa.array([len(w) - len(k) for w, k in zip(words, kept, strict=True)], pa.int64()),
            pa.array([sha256(b" ".join(k)).hexdigest() for k in kept])], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return _repeats(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), finish, result, window)


def _without(text: str, gone: np.ndarray) -> str:
    """``text`` without the marked words and the white space between them; the rest as it was."""
    places = [m.span() for m in PLAIN_WORD.finditer(text)]
    edges = np.flatnonzero(np.diff(np.r_[0, gone.astype(np.int8), 0]))
    pieces, at = [], 0
    for start, end in zip(edges[::2], edges[1::2], strict=True):
        pieces.append(text[at : places[start][0]])
        at = places[end - 1][1]
    return " ".join(p for p in (x.strip() for x in [*pieces, text[at:]]) if p)


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without words that repeat an earlier document; n_chars follows; rows left empty by it go."""
    result = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("text", T.StringType()),
                           T.StructField("rest", docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")] or [F.lit(0).alias("none")]).alias("rest")).schema[0].dataType),
                           T.StructField("new_size", T.LongType())])

    def finish(batch, words, gone):
        column = batch.column("text").to_pylist()
        size: list[int | None] = [None] * len(column)
        for k, marks in enumerate(gone):
            if marks is not None:
                column[k] = _without(column[k], marks)
                size[k] = len(column[k])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(column, pa.string()), batch.column("rest"), pa.array(size, pa.int64())],
            ["doc_id", "text", "rest", "new_size"])

    left = _repeats(docs, finish, result, window).where("new_size IS NULL OR new_size > 0")
    sized = {"n_chars": F.coalesce(F.col("new_size").cast(docs.schema["n_chars"].dataType), F.col("rest.n_chars"))} if "n_chars" in docs.columns else {}
    return left.select(*[
        F.col(c) if c in ("doc_id", "text") else sized.get(c, F.col(f"rest.`{c}`")).alias(c) for c in docs.columns])
