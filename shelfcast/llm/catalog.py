"""The registered queries of this package and, where SQL can say the same, their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import (
    contamination,
    html_blocks,
    language_id,
    minhash_join,
    mixing,
    packing,
    prefix_hash,
    recompression,
    resampling,
    spelling,
    token_counts,
    url_filter,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def registered(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[query.__name__] = query
    return query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@registered
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents that are not held out."""
    documents = table(spark, sf_dir, "documents")
    model = language_id.train(documents)
    flagged = documents.select("doc_id", language_id.is_held_out(F.col("doc_id")).alias("held_out"), "text")
    return language_id.identify(flagged, model, ["doc_id", "held_out"])


@registered
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in every document."""
    found = contamination.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    return contamination.digest_columns(found)


#: Strings are compared as sequences of words joined by a blank, which no word holds.
ORACLE_SQL["op4_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
wins AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM wins),
hits AS (
  SELECT doc_id, i, n, item
  FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
        FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n))
  JOIN wins USING (n, win)),
hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN found USING (doc_id)
"""


@registered
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix-hash fingerprints of every document and of its edited text."""
    return prefix_hash.fingerprints(table(spark, sf_dir, "documents"))


@registered
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that do not repeat a passage of an earlier one."""
    return recompression.repeat_counts(table(spark, sf_dir, "documents"))


ORACLE_SQL["op6_substring_dedup"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
wins AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS win
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM d WHERE len(w) >= 13)),
owners AS (SELECT win, min(doc_id) AS owner FROM wins GROUP BY win),
gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(i, i + 12)) AS i
  FROM wins JOIN owners USING (win) WHERE owner < doc_id),
words AS (SELECT doc_id, unnest(generate_series(1, len(w))) AS i, unnest(w) AS word FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


@registered
def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class, links and copies of every document under five-word Jaccard similarity of at least 0.8."""
    return minhash_join.similar_documents(table(spark, sf_dir, "documents")).drop("text_hash", "first")


#: Even enough that no source rules, with every document used once at least and four times at most.
MIX = mixing.Target(entropy=0.95, max_repeats=4.0)


@registered
def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every use of a document in the mix of sources."""
    return mixing.mixed_ids(table(spark, sf_dir, "documents"), MIX)


@registered
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every encoded length: documents and tokens at least as long, and tokens left when cut there."""
    return token_counts.suffix_sums(token_counts.length_histogram(table(spark, sf_dir, "documents")))


@registered
def op3_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance weight of every document and whether it is in the sample."""
    return resampling.resample_like_labelled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


RULES = [
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
]


@registered
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's url."""
    return url_filter.judge(table(spark, sf_dir, "pages"), RULES)


@registered
def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    labeller = html_blocks.train(html_blocks.training_pages(pages))
    return html_blocks.extract(pages, labeller, ["page_id", "url"])


@registered
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, form and root of every word."""
    return spelling.variants(table(spark, sf_dir, "documents"))


@registered
def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every encoded document with their place in a sequence."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), ["doc_id"])
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@registered
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened leading components of every embedding."""
    return whitening.whitened(table(spark, sf_dir, "embeddings"), ["vec_id"])
