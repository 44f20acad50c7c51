"""Exact token statistics from a histogram of encoded lengths.

Every text is encoded whole with a byte-pair vocabulary. Tasks count their lengths before the shuffle, so
a length that a third of all texts have arrives as one row per task. Suffix sums over the distinct lengths
then answer, for every context limit, how many texts are at least as long, how many tokens they hold and
how many tokens remain when all texts are cut at the limit; quantiles follow from the same sums.

The sums run over two digits of the length and what is above them, so no window holds more than
``WIDTH`` rows for lengths under WIDTH^3.

Defined results: a null or empty text has no tokens and counts as a text of length 0; repeated rows count
each; an empty table has no rows; columns besides the text are ignored.
"""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.workspace import materialize
from shelfcast.llm import texts

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how this vocabulary's texts are cut before pairs are merged.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WIDTH = 1024


def encoder(vocabulary: bytes, pattern: str = PATTERN):
    """A tokenizer from the lines ``base64 rank`` of a vocabulary file."""
    import tiktoken

    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def length_histogram(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """(n_tokens, n_docs) of all texts, written once, so that no later branch encodes again.

    The vocabulary is read here and sent along, so only the driver needs it.
    """
    data = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, lengths = encoder(data.value, pattern).encode_ordinary, Counter()
        for part in texts.slices(batches, "text"):
            lengths.update(len(encode(t)) if t else 0 for t in part.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays(
            [pa.array(lengths.keys(), pa.int64()), pa.array(lengths.values(), pa.int64())], ["n_tokens", "n_docs"])

    counted = texts.with_id(docs, text="text").mapInArrow(run, "n_tokens long, n_docs long")
    return materialize(counted.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs")), "lengths")


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """Adds docs_at_least, tokens_at_least and the tokens left when texts are cut at n_tokens."""
    digits = histogram.select(
        "n_tokens", "n_docs", (F.col("n_tokens") * F.col("n_docs")).alias("tokens"),
        F.floor(F.col("n_tokens") / WIDTH**2).alias("d0"), F.floor(F.col("n_tokens") / WIDTH).alias("d1"))
    after = {"docs": "n_docs", "tokens": "tokens"}
    middle = digits.groupBy("d0", "d1").agg(*[F.sum(c).alias(n) for n, c in after.items()])
    top = middle.groupBy("d0").agg(*[F.sum(n).alias(n) for n in after])

    def above(df: DataFrame, group: list[str], at: str, prefix: str) -> DataFrame:
        beyond = Window.partitionBy(*group).orderBy(F.desc(at)).rowsBetween(Window.unboundedPreceding, -1)
        return df.select("*", *[F.coalesce(F.sum(n).over(beyond), F.lit(0)).alias(f"{prefix}_{n}") for n in after]).drop(*after)

    tops = above(top, [], "d0", "top")
    middles = above(middle, ["d0"], "d1", "middle").join(tops, "d0")
    within = Window.partitionBy("d1").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = digits.select(
        "d1", "n_tokens", "n_docs", F.sum("n_docs").over(within).alias("docs"), F.sum("tokens").over(within).alias("tokens")
    ).join(middles, "d1")
    total = histogram.agg(F.sum("n_docs").alias("all_docs"), F.sum(F.col("n_tokens") * F.col("n_docs")).alias("all_tokens"))
    docs_at_least = F.col("docs") + F.col("middle_docs") + F.col("top_docs")
    tokens_at_least = F.col("tokens") + F.col("middle_tokens") + F.col("top_tokens")
    sums = summed.select("n_tokens", "n_docs", docs_at_least.alias("docs_at_least"), tokens_at_least.alias("tokens_at_least"))
    all_tokens, all_docs = total.select("all_tokens").scalar(), total.select("all_docs").scalar()
    return sums.select(
        "n_tokens", "n_docs", "docs_at_least", "tokens_at_least",
        (all_tokens - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")).alias("truncated_tokens"),
        ((all_docs - F.col("docs_at_least") + F.col("n_docs")) / all_docs).alias("share_at_most"))


def truncated_total(sums: DataFrame, limit: int) -> int:
    """Tokens of all texts, each cut at ``limit``; exact for every limit, in the table or not."""
    row = sums.where(F.col("n_tokens") >= limit).orderBy("n_tokens").first()
    if row is None:
        top = sums.orderBy(F.desc("n_tokens")).first()
        return top["truncated_tokens"] if top else 0
    return row["truncated_tokens"] - (row["n_tokens"] - limit) * row["docs_at_least"]


def quantile(sums: DataFrame, share: float) -> int | None:
    """The least length that at least this share of the texts does not exceed."""
    row = sums.where(F.col("share_at_most") >= share).orderBy("n_tokens").first()
    return row["n_tokens"] if row else None
