"""Similarity self-join of word n-gram sets with MinHash banding.

Texts become sets of digests of ``N`` consecutive normalised words (a text of fewer words is one n-gram).
Texts with equal sets are one class member. Band and row counts follow from a target recall at the
threshold; texts that share all minima of a band meet on the band's hash. Meeting texts are merged into
candidate clusters by connected components, and within a cluster every pair is verified on the full sets.
A large cluster is dealt into blocks and each pair of blocks is one task, so no group is gathered whole,
and only counts and a spanning forest leave a task, never the pairs.

Results have one row per document: the class is a connected component of verified links, named by its
least doc_id. Links are counted between different sets; texts with one set are counted as copies.

Defined results: a text without words (or null) is a class of its own without links or copies; a row
without doc_id comes after all others; repeated rows are copies of one another; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.workspace import materialize
from shelfcast.llm import texts
from shelfcast.llm.components import components

N = 5
THRESHOLD = Fraction(4, 5)
#: Minima in a band, and the share of pairs at the threshold that must meet in some band.
ROWS, RECALL = 6, 0.999
#: Sets in a block of a large cluster.
BLOCK = 256
LAST = (1 << 63) - 1
_COLUMNS = 8192


def bands_for(threshold: Fraction = THRESHOLD, rows: int = ROWS, recall: float = RECALL) -> int:
    """The least number of bands with which pairs at the threshold meet with the wanted probability."""
    return math.ceil(math.log(1 - recall) / math.log(1 - float(threshold) ** rows))


def ngram_set(words: np.ndarray, n: int = N) -> np.ndarray:
    """Sorted distinct digests of all n-grams of word digests."""
    return np.unique(texts.sequence_digests(words, min(n, len(words)), n)) if len(words) else words


def _signed(batches: Iterator[pa.RecordBatch], bands: int, rows: int, n: int) -> Iterator[pa.RecordBatch]:
    factors = texts.odd_numbers(bands * rows, 51)
    for part in texts.slices(batches, "text", texts.SLICE_BYTES // 2):
        sets = [ngram_set(texts.word_digests(texts.normal_words(t)), n) for t in texts.as_bytes(part.column("text"))]
        filled = [s for s in sets if len(s)]
        keys = np.zeros((bands, len(filled)), np.uint64)
        if filled:
            grams = np.concatenate(filled)
            starts = np.cumsum([0, *map(len, filled[:-1])])
            for k, factor in enumerate(factors):
                least = np.minimum.reduceat(grams * factor, starts)
                keys[k // rows] = texts.mix(keys[k // rows] * factor + least)
        keys, at = keys.astype(np.int64).T, 0
        node, size, band = [], [], []
        for s in sets:
            node.append(blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
            size.append(len(s))
            band.append(keys[at].tolist() if len(s) else [])
            at += len(s) > 0
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("text_hash"), pa.array(node, pa.binary()), pa.array(size, pa.int64()),
             pa.array(band, pa.list_(pa.int64()))], ["doc_id", "text_hash", "node", "n_grams", "bands"])


def signatures(docs: DataFrame, n: int = N, threshold: Fraction = THRESHOLD, rows: int = ROWS, recall: float = RECALL) -> DataFrame:
    """doc_id, text_hash, node (digest of the set), n_grams and band hashes of every row."""
    bands = bands_for(threshold, rows, recall)
    source = texts.with_id(docs, doc_id=F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)), text_hash=F.xxhash64("text"), text="text")
    return source.mapInArrow(lambda batches: _signed(batches, bands, rows, n),
                             "doc_id long, text_hash long, node binary, n_grams long, bands array<long>")


def _verify_block(left: dict[bytes, np.ndarray], right: dict[bytes, np.ndarray] | None, threshold: Fraction):
    """(node, least linked node, links) for all pairs within ``left``, or between ``left`` and ``right``."""
    names = [*left, *(right or {})]
    sets = [*left.values(), *(right or {}).values()]
    sizes = np.array([len(s) for s in sets], np.int64)
    ids, place = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    # N-grams of one set alone are in no intersection.
    common = np.flatnonzero(np.bincount(place, minlength=len(ids)) > 1)
    column = np.full(len(ids), -1, np.int64)
    column[common] = np.arange(len(common))
    place = column[place]
    owner, place = owner[place >= 0], place[place >= 0]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    shared = np.zeros((len(sets), len(sets)), np.float32)
    for first in range(0, len(common), _COLUMNS):
        a, b = np.searchsorted(place, [first, first + _COLUMNS])
        dense = np.zeros((len(sets), min(_COLUMNS, len(common) - first)), np.float32)
        dense[owner[a:b], place[a:b] - first] = 1
        shared += dense @ dense.T
    p, q = threshold.numerator, threshold.denominator
    linked = shared.astype(np.int64) * (p + q) >= p * (sizes[:, None] + sizes[None, :])
    np.fill_diagonal(linked, False)
    if right is not None:
        side = np.arange(len(sets)) < len(left)
        linked &= side[:, None] != side[None, :]
    label = np.arange(len(sets))
    while True:
        least = np.minimum(label, np.where(linked, label[None, :], len(sets)).min(1))
        if (least == label).all():
            break
        label = least
    return [(names[k], names[label[k]], int(linked[k].sum())) for k in range(len(sets))]


def _verifier(n: int, threshold: Fraction):
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("links", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        clusters: dict = {}
        for batch in table.to_batches():
            for root, node, block, text in zip(batch.column("root").to_pylist(), batch.column("node").to_pylist(),
                                               batch.column("block").to_pylist(), texts.as_bytes(batch.column("text")), strict=True):
                own = clusters.setdefault(root, {}).setdefault(block, {})
                if node not in own:
                    own[node] = ngram_set(texts.word_digests(texts.normal_words(text)), n)
        out = []
        first, second = table.column("first")[0].as_py(), table.column("second")[0].as_py()
        for blocks in clusters.values():
            if first == second:
                out += _verify_block(blocks[first], None, threshold)
            elif first in blocks and second in blocks:
                out += _verify_block(blocks[first], blocks[second], threshold)
        return pa.Table.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(schema)], schema=schema)

    return run


def _verified(docs: DataFrame, nodes: DataFrame, clusters: DataFrame, n: int, threshold: Fraction, block: int) -> DataFrame:
    """(a, b, links): links of a found in one task, b a node of the same class."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sized = clusters.join(clusters.groupBy("root").agg(F.ceil(F.count("*") / block).alias("blocks")), "root")
    members = sized.join(nodes, "node").select(
        "root", "node", F.col("rep.doc_id").alias("doc_id"), F.col("rep.text_hash").alias("text_hash"), "blocks",
        F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("block"))
    source = texts.with_id(docs, doc_id=F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)), text_hash=F.xxhash64("text"), text="text")
    read = source.join(members, ["doc_id", "text_hash"])
    pairs = F.transform(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int")),
                        lambda other: F.struct(F.least("block", other).alias("first"), F.greatest("block", other).alias("second")))
    small = F.col("blocks") == 1
    unit = F.when(small, F.pmod(F.xxhash64("root"), F.lit(4 * parts))).otherwise(F.xxhash64("root"))
    dealt = read.select("root", "node", "text", "block", "blocks", unit.alias("unit"), F.explode(pairs).alias("pair"))
    return dealt.select("root", "node", "text", "block", (F.col("blocks") == 1).alias("small"), "unit", "pair.first", "pair.second").groupBy(
        "small", "unit", "first", "second").applyInArrow(_verifier(n, threshold), "a binary, b binary, links long")


def similar_documents(docs: DataFrame, n: int = N, threshold: Fraction = THRESHOLD, rows: int = ROWS,
                      recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """doc_id, text_hash, class_id, n_links, n_copies and n_grams of every row of ``docs``."""
    signed = materialize(signatures(docs, n, threshold, rows, recall), "signatures")
    filled = signed.where("node IS NOT NULL")
    nodes = materialize(filled.groupBy("node").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("rep"), F.count("*").alias("members"), F.first("bands").alias("bands")), "nodes")
    met = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    heads = met.groupBy("band", "key").agg(F.min("node").alias("head"), F.count("*").alias("size")).where("size > 1")
    edges = met.join(heads, ["band", "key"]).select(F.col("node").alias("a"), F.col("head").alias("b"))
    clusters = components(edges, "clusters")
    verdicts = materialize(_verified(docs, nodes.select("node", "rep"), clusters, n, threshold, block), "verdicts")
    classes = components(verdicts.select("a", "b"), "classes")
    links = verdicts.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    known = nodes.select("node", "rep", "members").join(links, "node", "left").join(classes, "node", "left").select(
        "node", "members", "rep", F.coalesce("links", F.lit(0)).alias("n_links"), F.coalesce("root", "node").alias("root"))
    named = known.groupBy("root").agg(F.min("rep").alias("least"))
    classed = known.join(named, "root").select("node", F.col("least.doc_id").alias("class_id"), "least", "n_links", (F.col("members") - 1).alias("n_copies"))
    whole = signed.select("doc_id", "text_hash", "node", "n_grams").join(classed, "node", "left")
    shown = lambda c: F.when(F.col(c) != LAST, F.col(c))
    return whole.select(
        shown("doc_id").alias("doc_id"), "text_hash",
        F.coalesce(shown("class_id"), shown("doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("n_copies", F.lit(0)).alias("n_copies"), "n_grams",
        ((F.struct("doc_id", "text_hash") == F.col("least")) | F.col("node").isNull()).alias("first"))


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """One row of every class: that with the least doc_id, then text_hash, null doc_ids last; rows of texts without words all stay."""
    judged = materialize(similar_documents(docs, **options).select("doc_id", "text_hash", "first"), "judged")
    later = judged.where(~F.col("first")).select("doc_id", "text_hash").distinct()
    repeated = judged.where("first").groupBy("doc_id", "text_hash").agg(F.count("*").alias("rows")).where("rows > 1")
    left = _matching(docs, later, "left_anti")
    if repeated.isEmpty():
        return left
    single = _matching(left, repeated, "left_semi").dropDuplicates(["doc_id", "text"])
    return _matching(left, repeated, "left_anti").unionByName(single)


def _matching(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    same = docs["doc_id"].eqNullSafe(keys["doc_id"]) & (F.xxhash64(docs["text"]) == keys["text_hash"])
    return docs.join(keys, same, how)
