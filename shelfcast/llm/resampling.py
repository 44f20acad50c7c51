"""Importance resampling of raw text towards a target.

Words and word pairs are hashed into buckets. One generative model counts the buckets over all raw texts,
another over the target texts; a text's log weight is the difference of its log probabilities under the
two. Gumbel noise, drawn from a hash of the row, is added, and the rows with the greatest sums are the
sample, which is drawing without replacement in proportion to the weights.

Where the sample ends is found from counts by the leading bits of the ordered keys, a few thousand numbers
per job, so nothing is sorted. Rows that share the last key are all taken.

Defined results: a null or wordless text has log weight 0; repeated rows share one key; without target rows
both models are the smoothed uniform or raw one and noise decides; an empty table has no rows; a sample of
share 0 is empty, of share 1 whole; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.workspace import materialize
from shelfcast.llm import texts

BUCKETS = 1 << 14
#: Ids of target rows that are broadcast at once, about; more are counted in as many passes as they need.
BLOCK_IDS = 1_000_000
#: Bits of the ordered key that one counting job settles.
BITS = 12


def _buckets(words: np.ndarray) -> np.ndarray:
    """Buckets of all words and adjacent pairs."""
    pairs = texts.sequence_digests(words, 2, 61)
    return (np.concatenate([texts.mix(words), pairs]) & np.uint64(BUCKETS - 1)).astype(np.int64)


def bucket_counts(docs: DataFrame) -> np.ndarray:
    """How often each bucket occurs in all texts; tasks add up before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for part in texts.slices(batches, "text"):
            for text in texts.as_bytes(part.column("text")):
                counts += np.bincount(_buckets(texts.word_digests(texts.plain_words(text))), minlength=BUCKETS)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used])], ["bucket", "n"])

    rows = texts.with_id(docs, text="text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(BUCKETS, np.int64)
    for row in rows.collect():
        counts[row["bucket"]] = row["n"]
    return counts


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Log of the target's over the raw text's probability of each bucket, both smoothed by one."""
    return np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))


def noise(hashes: np.ndarray) -> np.ndarray:
    """Gumbel noise from 64-bit hashes."""
    uniform = ((texts.mix(hashes.astype(np.int64).view(np.uint64)) >> np.uint64(12)).astype(np.float64) + 0.5) / 2**52
    return -np.log(-np.log(uniform))


def _ordered(key: np.ndarray) -> np.ndarray:
    """64-bit integers in the order of the doubles."""
    bits = (key + 0.0).view(np.int64)
    return np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)


def scores(docs: DataFrame, ratio: np.ndarray, seed: int = 5) -> DataFrame:
    """doc_id, log_weight, gumbel_key and its integer form of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = shared.value
        for part in texts.slices(batches, "text"):
            sums = np.array([weight[_buckets(texts.word_digests(texts.plain_words(t)))].sum() for t in texts.as_bytes(part.column("text"))])
            key = sums + noise(part.column("draw").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sums), pa.array(key), pa.array(_ordered(key))],
                ["doc_id", "log_weight", "gumbel_key", "ordered"])

    source = texts.with_id(docs, doc_id="doc_id", text="text", draw=F.xxhash64(F.lit(seed), "doc_id", F.xxhash64("text")))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, log_weight double, gumbel_key double, ordered long")


def last_key(scored: DataFrame, k: int) -> int | None:
    """The greatest ``ordered`` that at least ``k`` rows reach; None for k under 1."""
    if k < 1:
        return None
    prefix, bits = 0, 0
    while bits < 64:
        step = min(BITS, 64 - bits)
        shift = 64 - bits - step
        digit = F.shiftright("ordered", shift)
        inside = scored if bits == 0 else scored.where(F.shiftright("ordered", 64 - bits) == prefix)
        found = sorted(map(tuple, inside.groupBy(digit.alias("digit")).count().collect()), reverse=True)
        for value, n in found:
            if k <= n:
                break
            k -= n
        prefix, bits = value, bits + step
    return prefix


def target_counts(docs: DataFrame, ids: DataFrame, block_ids: int = BLOCK_IDS) -> np.ndarray:
    """Bucket counts of all documents whose doc_id is in ``ids``.

    The ids are dealt by hash into blocks of about ``block_ids`` and each block is broadcast in turn, so
    every target text counts and none is shuffled.
    """
    ids = materialize(ids.where("doc_id IS NOT NULL").select("doc_id").distinct(), "target-ids")
    blocks = max(1, -(-ids.count() // block_ids))
    block = F.pmod(F.xxhash64(F.lit("target"), "doc_id"), F.lit(blocks))
    source = docs.select("doc_id", "text")
    return sum(
        bucket_counts(source.join(F.broadcast(ids.where(block == b)), "doc_id", "left_semi")) for b in range(blocks))


def resample(docs: DataFrame, target: DataFrame, share: float, seed: int = 5) -> DataFrame:
    """doc_id, log_weight, gumbel_key and sampled of every row; ``target`` has the texts to be like."""
    return resample_to_counts(docs, bucket_counts(target), share, seed)


def resample_to_counts(docs: DataFrame, target: np.ndarray, share: float, seed: int = 5) -> DataFrame:
    """As ``resample``, with the target given by its bucket counts."""
    ratio = log_ratio(target, bucket_counts(docs))
    scored = materialize(scores(docs, ratio, seed), "scores")
    k = round(share * scored.count())
    least = last_key(scored, k)
    sampled = F.col("ordered") >= F.lit(least) if least is not None else F.lit(False)
    return scored.select("doc_id", "log_weight", "gumbel_key", sampled.alias("sampled"))


def resample_like_labelled(docs: DataFrame, labels: DataFrame, seed: int = 5, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Resample towards the documents labelled good and not toxic; the share is that of good ones among the labelled.

    A document under several labels is in the target if one of them is good and not toxic; documents
    and labels without a doc_id are in no target.
    """
    marks = labels.select("doc_id", "quality", F.coalesce("toxic", F.lit(0)).alias("toxic")).where("quality IS NOT NULL")
    target = target_counts(docs, marks.where("quality = 1 AND toxic = 0"), block_ids)
    share = marks.agg(F.avg(F.expr("quality = 1").cast("double"))).first()[0]
    return resample_to_counts(docs, target, 1.0 if share is None else share, seed)
