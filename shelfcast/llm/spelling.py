"""Spelling variants: words one edit apart, each led to its most frequent form.

Two words are near if one inserted, deleted or replaced code point turns one into the other. That is so exactly
when their common prefix and their common suffix together reach the longer length minus one. Words are compared in
tiles: two blocks of words become padded matrices of code points, and one comparison a column gives the common
prefixes of all pairs of the blocks, and from the other end the common suffixes.

Which blocks meet: of two near words whose shorter one has m code points, either the first m // 2 code points
agree or the last m - m // 2 do. Words therefore gather by (m, prefix) and by (m, suffix), for m their own length
and one less. A gathering of more than ``BLOCK`` words is dealt into blocks, and every pair of blocks is a tile of
its own, so a gathering that holds a third of all words is spread over many tasks. Tiles give near pairs only; a
pair that both gatherings would show is taken from the prefix.

Counting is one narrow pass: a task adds up its own words and hands sums on, so frequent words
arrive once a task. Forms lead to ever more frequent words, at least doubling, so a root is found in as many
rounds of pointer doubling as the logarithm of the longest such chain has bits; joins on forms, which many words
share, are salted.

Words are runs of ASCII letters and U+00C0 to U+00FF, one byte a code point.

Defined results: a null or empty text has no words; a null doc_id is an empty string; repeated rows count each; an
empty table has no words; columns besides those named are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.workspace import materialize
from shelfcast.llm import texts

LEAST_LENGTH, LEAST_COUNT = 5, 3
#: One in so many occurrences loses a code point; 0 leaves all as they are.
DAMAGE = 97
#: Distinct words a task holds before it hands its sums on.
HELD = 200_000
#: Words of a gathering that are compared within one task.
BLOCK = 2048
#: Rows and columns of a comparison that is in memory at once.
SIDE = 256
SALTS = 16

#: By Latin-1 byte: A-Z lower-cased, other letters of a run as they are, everything else a blank.
_RUNS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def runs(text: str | None) -> list[bytes]:
    """Lower-cased runs of a text in Latin-1; what Latin-1 lacks separates runs."""
    return text.encode("latin-1", "replace").translate(_RUNS).split() if text else []


def damaged(word: bytes, prefix: int, damage: int = DAMAGE) -> bytes:
    """The word, without one code point if its hash after ``prefix`` (a running crc32) says so."""
    h = crc32(word if word.isascii() else word.decode("latin-1").encode(), prefix)
    if not damage or h % damage:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least_length: int = LEAST_LENGTH,
                least_count: int = LEAST_COUNT, damage: int = DAMAGE) -> DataFrame:
    """(word, n) of all words of at least so many code points and occurrences."""
    source = texts.with_id(docs, _id=doc_id, _text=text).select(F.col("_id").cast("string").alias("_id"), "_text")

    def batch(counts: Counter) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in counts], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(counts.values(), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for part in texts.slices(batches, "_text"):
            for key, body in zip(part.column("_id").to_pylist(), part.column("_text").to_pylist(), strict=True):
                prefix = crc32(f"{key or ''}:".encode())
                for word, n in Counter(runs(body)).items():
                    if len(word) >= least_length:
                        word = damaged(word, prefix, damage)
                        if len(word) >= least_length:
                            counts[word] += n
            if len(counts) > HELD:
                yield batch(counts)
                counts.clear()
        yield batch(counts)

    summed = source.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return summed.where(F.col("n") >= least_count)


# Tiles ----------------------------------------------------------------------------------------------


def padded(words: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of words from the left and, reversed, from the right, zeros behind; and their lengths."""
    left = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
    right = np.frombuffer(b"".join(w[::-1].ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
    return left, right, np.array([len(w) for w in words])


def _common(a: np.ndarray, b: np.ndarray, columns: int) -> np.ndarray:
    """Leading columns in which each row of ``a`` agrees with each row of ``b``."""
    run = np.ones((len(a), len(b)), bool)
    length = np.zeros((len(a), len(b)), np.int32)
    for k in range(columns):
        run &= a[:, k, None] == b[None, :, k]
        if not run.any():
            break
        length += run
    return length


def near_pairs(words: list[bytes], blocks: np.ndarray, m: int, prefix: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of near words of a gathering, the shorter of which has m code points.

    ``blocks`` tells the two blocks of a tile apart; with one block only, all its words meet one another.
    """
    left, right, length = padded(words, m + 1)
    rows = np.flatnonzero(blocks == blocks.min())
    within = len(rows) == len(words)
    columns = rows if within else np.flatnonzero(blocks != blocks.min())
    for r in range(0, len(rows), SIDE):
        a = rows[r : r + SIDE]
        for c in range(r if within else 0, len(columns), SIDE):
            b = columns[c : c + SIDE]
            ahead = _common(left[a], left[b], m)
            behind = _common(right[a], right[b], m)
            longer = np.maximum(length[a][:, None], length[b][None, :])
            shorter = np.minimum(length[a][:, None], length[b][None, :])
            near = (ahead + behind >= longer - 1) & (shorter == m)
            if not prefix:
                near &= ahead < m // 2
            if within:
                near &= a[:, None] < b[None, :]
            i, j = np.nonzero(near)
            if len(i):
                yield a[i], b[j]


def gatherings(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(side, m, part, i, j, b, word, n): every word once in each tile it takes part in."""
    size = F.length("word")

    def at(m: Column) -> list[Column]:
        half = F.floor(m / 2).cast("int")
        return [F.struct(F.lit(True).alias("prefix"), m.alias("m"), F.substring("word", F.lit(1), half).alias("part")),
                F.struct(F.lit(False).alias("prefix"), m.alias("m"), F.right("word", m - half).alias("part"))]

    keyed = words.select("word", "n", F.explode(F.array(*at(size), *at(size - 1))).alias("key")).select("key.*", "word", "n")
    key = ["prefix", "m", "part"]
    large = keyed.groupBy(*key).count().where(F.col("count") > block)
    blocks = F.ceil(F.col("count") / block).cast("int")
    salted = large.select(*key, blocks.alias("blocks"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salt = F.pmod(F.xxhash64("word"), F.lit(SALTS)).cast("int")
    dealt = keyed.withColumn("salt", salt).join(salted, [*key, "salt"], "left").withColumn(
        "blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64(F.lit("block"), "word"), F.col("blocks")).cast("int")
    return dealt.withColumn("b", own).select(
        *key, "word", "n", "b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o")
    ).select(*key, F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), "b", "word", "n")


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, other, other_n): every near pair of ``words`` (word, n) once in each direction."""
    key = ["prefix", "m", "part", "i", "j"]
    tiles = gatherings(words, block).repartition(*key).sortWithinPartitions(*key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, table in _tiles(batches, key):
            body = [w.encode("latin-1") for w in table.column("word").to_pylist()]
            n, own = table.column("n"), table.column("word")
            blocks = table.column("b").to_numpy()
            if names[3] != names[4] and len(set(blocks)) < 2:
                continue
            for a, b in near_pairs(body, blocks, names[1], names[0]):
                first, second = pa.array(np.r_[a, b]), pa.array(np.r_[b, a])
                yield pa.RecordBatch.from_arrays(
                    [c.combine_chunks() for c in (own.take(first), own.take(second), n.take(second))], ["word", "other", "other_n"])

    return tiles.mapInArrow(run, "word string, other string, other_n long")


def _tiles(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Consecutive rows with one key, of two or more rows each; a tile may go on over several batches."""
    held: list[pa.RecordBatch] = []
    current = None

    def closed():
        if sum(b.num_rows for b in held) > 1:
            yield current, pa.Table.from_batches(held)

    for batch in batches:
        names = list(zip(*(batch.column(k).to_pylist() for k in key), strict=True))
        start = 0
        for at in [k for k in range(1, len(names)) if names[k] != names[k - 1]] + [len(names)]:
            if at == start:
                continue
            if names[start] != current:
                yield from closed()
                held, current = [], names[start]
            held.append(batch.slice(start, at - start))
            start = at
    yield from closed()


# Forms and roots ------------------------------------------------------------------------------------


def forms(words: DataFrame, pairs: DataFrame, share: float = 2.0) -> DataFrame:
    """(word, n, form, n_near, form_n): the most frequent near word, if at least ``share`` times as frequent."""
    best = F.min(F.struct((-F.col("other_n")).alias("rank"), F.col("other"))).alias("best")
    found = pairs.groupBy("word").agg(F.count("*").alias("n_near"), best)
    joined = words.join(found, "word", "left")
    top = -F.col("best.rank")
    leads = F.coalesce(top >= F.col("n") * share, F.lit(False))
    return joined.select(
        "word", "n", F.when(leads, F.col("best.other")).alias("form"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(leads, top).alias("form_n"))


def roots(formed: DataFrame) -> DataFrame:
    """(word, root) of every word with a form: the last word that its forms lead to.

    Every round replaces a word's goal by its goal's goal. The join side that is met holds each word once and in
    every salt, so a goal that many words share is met in many tasks.
    """
    state = materialize(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "spelling-roots")
    salt = F.pmod(F.xxhash64("word"), F.lit(SALTS)).cast("int")
    while not state.where("moved").isEmpty():
        onward = state.select(F.col("word").alias("root"), F.col("root").alias("next"),
                              F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        met = state.withColumn("salt", salt).join(onward, ["root", "salt"], "left")
        state = materialize(met.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
    return state.select("word", "root")


def variants(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least_length: int = LEAST_LENGTH,
             least_count: int = LEAST_COUNT, damage: int = DAMAGE, share: float = 2.0, block: int = BLOCK) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of ``docs``."""
    words = materialize(word_counts(docs, text, doc_id, least_length, least_count, damage), "spelling-words")
    formed = materialize(forms(words, near_words(words, block), share), "spelling-forms")
    return formed.join(roots(formed), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
