"""Document fingerprints from prefix polynomial hashes.

For a text of code points c_0 .. c_(n-1), H[k] is the sum of c_i * B^i over i < k, modulo two primes below
2^31. The prefix array answers whether any two spans of any texts are equal (a span's hash is a difference
of two entries, scaled by a power of B), and a binary search over span lengths locates the longest common
extension of two places. Concatenations need no new pass: H of ``a + b`` follows from those of a and b.

A fingerprint keeps the length, the whole hash, the hashes of the prefixes and of the suffixes whose
lengths are multiples of a power of two, at most ``CELLS`` of each, and length and hash of every span of the
text between content-defined cuts, so it grows with the text. A cut lies before each window of ``WINDOW``
characters whose hash is the least of those that start up to ``REACH`` places before and after it; it
depends on nothing else, so an edit moves only the cuts close to it. Two fingerprints are compared at the
coarser of their steps: binary searches find the longest common prefix and suffix on that grid. Between
them, spans that both texts have, wherever they stand, add their lengths. The likeness is the sum as a share
of the longer text. Equal texts have equal fingerprints and likeness 1; two empty texts have likeness 1, an
empty and another one 0.

Defined results: null texts are empty; rows are ordered by descending doc_id, then by text, null doc_ids
last; repeated rows follow one another; a single row is its own next document; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import cached_property
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm import texts

PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 747796405)
CELLS = 32
#: Characters of a window, and places on each side of one that begins a span; a power of two.
WINDOW, REACH = 16, 32
#: A longer span, as periodic text has without a least window, is cut every so many characters.
LONGEST = 1 << 10
#: Hex digits of a grid cell, and of a span's length before its own.
_DIGITS, _LENGTH = 11, 3
_BLOCK = 1 << 18


class Powers:
    """Powers of the bases and of their inverses, extended on demand."""

    def __init__(self):
        self.up = [np.ones(1, np.uint64) for _ in PRIMES]
        self.down = [np.ones(1, np.uint64) for _ in PRIMES]

    def reach(self, n: int) -> None:
        for table, bases in ((self.up, BASES), (self.down, [pow(b, -1, p) for b, p in zip(BASES, PRIMES, strict=True)])):
            for k, (base, prime) in enumerate(zip(bases, PRIMES, strict=True)):
                while len(table[k]) <= n:
                    step = np.uint64(pow(base, len(table[k]), prime))
                    table[k] = np.concatenate([table[k], table[k] * step % np.uint64(prime)])


class PrefixHashes:
    """The prefix arrays of one text; spans are half open ranges of code points."""

    def __init__(self, text: str, powers: Powers):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.n, self.powers, self.h = len(codes), powers, []
        powers.reach(max(self.n, 1))
        for prime, up in zip(PRIMES, powers.up, strict=True):
            h = np.zeros(self.n + 1, np.uint64)
            for start in range(0, self.n, _BLOCK):
                end = min(start + _BLOCK, self.n)
                terms = (codes[start:end] + np.uint64(1)) * up[start:end] % np.uint64(prime)
                h[start + 1 : end + 1] = (np.cumsum(terms, dtype=np.uint64) + h[start]) % np.uint64(prime)
            self.h.append(h)

    def spans(self, start, length) -> np.ndarray:
        """62-bit hashes of the spans from ``start`` of the given lengths; arrays broadcast."""
        start, length = np.broadcast_arrays(np.asarray(start, np.int64), np.asarray(length, np.int64))
        parts = []
        for prime, h, down in zip(PRIMES, self.h, self.powers.down, strict=True):
            p = np.uint64(prime)
            parts.append((h[start + length] + p - h[start]) % p * down[start] % p)
        return (parts[0] << np.uint64(31)) | parts[1]

    @cached_property
    def windows(self) -> np.ndarray:
        """Hashes of all windows by their start."""
        return self.spans(np.arange(max(0, self.n - WINDOW + 1)), WINDOW)

    def equal(self, start: int, other: PrefixHashes, other_start: int, length: int) -> bool:
        return bool(self.spans(start, length) == other.spans(other_start, length))

    def extension(self, start: int, other: PrefixHashes, other_start: int) -> int:
        """Length of the longest common extension of two places, by binary search."""
        low, high = 0, min(self.n - start, other.n - other_start)
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if self.equal(start, other, other_start, middle) else (low, middle - 1)
        return low


class Joined:
    """``left[:m] + right[:j]`` without a new pass over either."""

    def __init__(self, left: PrefixHashes, m: int, right: PrefixHashes, j: int):
        self.left, self.m, self.right, self.n = left, m, right, m + j

    def spans(self, start, length) -> np.ndarray:
        start, length = np.broadcast_arrays(np.asarray(start, np.int64), np.asarray(length, np.int64))
        up = self.left.powers
        up.reach(self.n + 1)
        parts = []
        for k, prime in enumerate(PRIMES):
            p = np.uint64(prime)
            both = []
            for end in (start, start + length):
                inside, beyond = np.minimum(end, self.m), np.maximum(end - self.m, 0)
                both.append((self.left.h[k][inside] + up.up[k][self.m] * self.right.h[k][beyond]) % p)
            parts.append((both[1] + p - both[0]) % p * up.down[k][start] % p)
        return (parts[0] << np.uint64(31)) | parts[1]

    @property
    def windows(self) -> np.ndarray:
        """As of one text; only those across the seam are new."""
        m, j = self.m, self.n - self.m
        inside, beyond = max(0, m - WINDOW + 1), max(0, j - WINDOW + 1)
        seam = np.arange(inside, max(inside, min(m, self.n - WINDOW + 1)))
        return np.concatenate([self.left.windows[:inside], self.spans(seam, WINDOW), self.right.windows[:beyond]])


def content_spans(hashes: PrefixHashes | Joined) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the spans between content-defined cuts; together they are the whole text."""
    windows, cuts = hashes.windows, np.zeros(0, np.int64)
    if len(windows) > 2 * REACH:
        least, width = windows, 1
        while width < REACH:
            least, width = np.minimum(least[:-width], least[width:]), 2 * width
        own = windows[REACH : len(windows) - REACH]
        first = (own < least[: len(own)]) & (own <= least[REACH + 1 : REACH + 1 + len(own)])
        cuts = np.flatnonzero(first) + REACH
    starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [hashes.n]])
    pieces = -(-(ends - starts) // LONGEST)
    piece = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = np.repeat(starts, pieces) + piece * LONGEST
    return starts, np.minimum(np.repeat(ends, pieces) - starts, LONGEST)


def step_of(n: int) -> int:
    """The least power of two of which at most ``CELLS`` multiples are within ``n``."""
    return 1 << max(0, ((n + CELLS - 1) // CELLS - 1).bit_length())


def fingerprint(hashes: PrefixHashes | Joined) -> str:
    """``length.whole.prefixes.suffixes.spans`` in hex."""
    n = hashes.n
    lengths = np.arange(1, n // step_of(n) + 1) * step_of(n)
    cells = np.concatenate([hashes.spans(np.zeros(len(lengths), np.int64), lengths), hashes.spans(n - lengths, lengths)])
    digits = [f"{x:016x}"[-_DIGITS:] for x in texts.mix(cells).tolist()]
    half = len(lengths)
    starts, sizes = content_spans(hashes)
    named = texts.mix(hashes.spans(starts, sizes)).tolist()
    spans = "".join([f"{size:0{_LENGTH}x}" + f"{x:016x}"[-_DIGITS:] for size, x in zip(sizes.tolist(), named, strict=True)])
    return f"{n:x}.{int(hashes.spans(0, n)):016x}.{''.join(digits[:half])}.{''.join(digits[half:])}.{spans}"


def _cells(text: str, width: int = _DIGITS) -> list[str]:
    return [text[k : k + width] for k in range(0, len(text), width)]


def _inside(spans: list[str], start: int, end: int) -> Counter[str]:
    """The spans that lie between two places."""
    found, at = [], 0
    for span in spans:
        size = int(span[:_LENGTH], 16)
        if at >= start and at + size <= end:
            found.append(span)
        at += size
    return Counter(found)


def _common(a: list[str], b: list[str], step_a: int, step_b: int) -> int:
    """Longest common length on the coarser grid: once cells differ, all longer ones do."""
    step = max(step_a, step_b)
    a, b = a[step // step_a - 1 :: step // step_a], b[step // step_b - 1 :: step // step_b]
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[middle - 1] == b[middle - 1] else (low, middle - 1)
    return low * step


def likeness(a: str, b: str) -> float:
    """From 0 to 1, from two fingerprints alone."""
    if a == b:
        return 1.0
    (na, _, pa_, sa, ca), (nb, _, pb, sb, cb) = a.split("."), b.split(".")
    na, nb = int(na, 16), int(nb, 16)
    if min(na, nb) == 0:
        return 0.0
    steps = step_of(na), step_of(nb)
    prefix, suffix = _common(_cells(pa_), _cells(pb), *steps), _common(_cells(sa), _cells(sb), *steps)
    width = _LENGTH + _DIGITS
    both = _inside(_cells(ca, width), prefix, na - suffix) & _inside(_cells(cb, width), prefix, nb - suffix)
    between = sum(int(span[:_LENGTH], 16) * times for span, times in both.items())
    return min(prefix + suffix + between, na, nb) / max(na, nb)


def _range_splitters(ids: DataFrame, parts: int) -> list[int]:
    """At most ``parts - 1`` doc_ids that cut the rows into ranges of like size."""
    shares = [k / parts for k in range(1, parts)]
    return sorted(set(ids.approxQuantile("doc_id", shares, 0.2 / parts))) if shares else []


def neighbours(docs: DataFrame) -> DataFrame:
    """Rows (part, doc_id, text, guest), dealt so that each part holds a range of doc_ids.

    A part also has, as guests, the rows with the largest doc_id of the range below (the lowest range has
    those of the highest), so each row and its next one are together. The text is shuffled once.
    """
    rows = texts.with_id(docs, doc_id="doc_id", text=F.coalesce("text", F.lit("")))
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = rows.select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc_id"))
    cuts = [int(x) for x in _range_splitters(ids, parts)]
    order = F.coalesce("doc_id", F.lit(-(1 << 63)))
    part = _place(order, cuts)
    tops = {r["part"]: r["top"] for r in ids.groupBy(_place(F.col("doc_id"), cuts).alias("part")).agg(F.max("doc_id").alias("top")).collect()}
    filled = sorted(tops)
    above = {p: filled[(k + 1) % len(filled)] for k, p in enumerate(filled)}
    top_of = F.array(*[F.lit(tops.get(p)).cast("long") for p in range(len(cuts) + 1)])
    above_of = F.array(*[F.lit(above.get(p)).cast("int") for p in range(len(cuts) + 1)])
    is_top = F.get(top_of, part) == order
    places = F.when(is_top, F.array(F.struct(part.alias("part"), F.lit(False).alias("guest")),
                                    F.struct(F.get(above_of, part).alias("part"), F.lit(True).alias("guest"))))
    places = places.otherwise(F.array(F.struct(part.alias("part"), F.lit(False).alias("guest"))))
    dealt = rows.select("doc_id", "text", F.explode(places).alias("at")).select("at.part", "doc_id", "text", "at.guest")
    return dealt.repartitionById(len(cuts) + 1, "part").sortWithinPartitions(
        "guest", F.desc_nulls_last("doc_id"), "text")


def _place(value: Column, cuts: list[int]) -> Column:
    """How many of the sorted ``cuts`` are at most ``value``."""
    if not cuts:
        return F.lit(0)
    bounds = F.array(*[F.lit(c).cast("long") for c in cuts])
    return F.size(F.filter(bounds, lambda c: c <= value))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likenesses.

    The edited text ends in the beginning of the next document, as much of it as a third of the text.
    """
    fields = "doc_id:bigint n_chars:bigint edited_sha256:string fingerprint:string edited_fingerprint:string near_edited:double near_next:double"
    schema = T.StructType.fromDDL(", ".join(f.replace(":", " ") for f in fields.split()))
    names = schema.names

    def rows_of(batches: Iterator[pa.RecordBatch]):
        for part in texts.slices(batches, "text"):
            yield from zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(),
                           part.column("guest").to_pylist(), strict=True)

    def judged(doc_id, text, own, own_print, next_text, following, next_print):
        cut = own.n // 3
        fill = min(cut, following.n)
        edited = text[: own.n - cut] + next_text[:fill]
        edited_print = fingerprint(Joined(own, own.n - cut, following, fill)) if cut else own_print
        return (doc_id, own.n, sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), own_print, edited_print,
                likeness(own_print, edited_print), likeness(own_print, next_print))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, out, last = Powers(), [], None
        for doc_id, text, guest in rows_of(batches):
            own = PrefixHashes(text, powers)
            here = (text, own, fingerprint(own))
            if last is not None:
                out.append(judged(*last, *here))
            last = None if guest else (doc_id, *here)
            if guest:
                break
            if len(out) >= 512:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], arrow)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], arrow)

    kinds = {"bigint": pa.int64(), "string": pa.string(), "double": pa.float64()}
    arrow = pa.schema([(n, kinds[k]) for n, k in (f.split(":") for f in fields.split())])
    return neighbours(docs).select("doc_id", "text", "guest").mapInArrow(run, schema)
