"""Weights against a plain bisection, uses against a plain walk through each source's order."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import pytest
from plans import planned
from pyspark.sql import functions as F

from shelfcast.llm import catalog, mixing


def plain_alpha(shares, target, total):
    def weights(alpha):
        powers = [p**alpha for p in shares]
        return [x / sum(powers) for x in powers]

    def entropy(alpha):
        return -sum(w * math.log(w) for w in weights(alpha))

    def repeats(alpha):
        use = [w / p for w, p in zip(weights(alpha), shares)]
        return max(use) / min(use) if target.budget is None else max(use) * target.budget / total

    def bisect(good_low, low, high):
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if good_low(mid) else (low, mid)
        return low

    alpha = 0.0 if target.max_repeats else 1.0
    if target.entropy and entropy(1.0) < target.entropy * math.log(len(shares)):
        alpha = bisect(lambda a: entropy(a) >= target.entropy * math.log(len(shares)), 0.0, 1.0)
    elif target.entropy:
        alpha = 1.0
    if target.max_repeats and repeats(alpha) > target.max_repeats:
        alpha = bisect(lambda a: repeats(a) > target.max_repeats, alpha, 1.0)
    return alpha


def check(docs, target):
    mix = mixing.plan(docs, target)
    rows = mix.keyed.collect()
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += r["tokens"]
    total = sum(sizes.values())
    full = {s: n for s, n in sizes.items() if n}
    alpha = plain_alpha([n / total for n in full.values()], target, total)
    assert mix.alpha == pytest.approx(alpha, abs=1e-6)
    norm = sum((n / total) ** mix.alpha for n in full.values())
    weight = {s: (n / total) ** mix.alpha / norm if n else 0 for s, n in sizes.items()}
    got_weight = {r["source"]: r["weight"] for r in mix.sources.collect()}
    assert got_weight == pytest.approx(weight)
    budget = target.budget or max(n / weight[s] for s, n in full.items())
    want = Counter()
    by_source = defaultdict(list)
    for r in rows:
        by_source[r["source"]].append(r)
    for s, own in by_source.items():
        times = weight[s] * budget / sizes[s] if sizes[s] else 1
        passes, left = int(times + 1e-9), (times - int(times + 1e-9)) * sizes[s]
        keys, run, inside = Counter(), 0, set()
        for r in own:
            keys[r["key"]] += r["tokens"]
        for key in sorted(keys):
            run += keys[key]
            if run > left or left <= sizes[s] * 1e-9:
                break
            inside.add(key)
        for r in own:
            want[(s, r["doc_id"], r["key"])] += passes + (r["key"] in inside)
    uses = mixing.realise(mix.keyed, mix, target).collect()
    got = Counter((r["source"], r["doc_id"], r["key"]) for r in uses)
    assert got == +want
    return mix, uses


TARGETS = [mixing.Target(entropy=0.95), mixing.Target(max_repeats=1.5), mixing.Target(0.99, 2.0), mixing.Target(0.9, None, 5000.0),
           mixing.Target(max_repeats=3.0, budget=9000.0), mixing.Target(entropy=0.1)]


@pytest.mark.parametrize("target", TARGETS)
def test_uses_equal_a_plain_walk(spark, target):
    rows = [(k, " ".join(["w"] * (1 + k * 7 % 23)), "a" if k % 3 else "bcd"[k % 7 % 3]) for k in range(400)]
    rows += [(900, "x " * 50, None), (901, None, "e"), (902, "", "e"), (1, "w", "a"), (903, "same text", "f"), (903, "same text", "f"), (None, "y", "f")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, key int, id int")
    check(docs, target)


def test_blocks_are_refined(spark, monkeypatch):
    """With two-bit digits many rows share a block and the end is found among its rows."""
    monkeypatch.setattr(mixing, "BITS", 2)
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 9).cast("int")).alias("text"),
                                    F.when(F.col("id") % 10 < 7, "big").otherwise(F.concat(F.lit("s"), F.col("id") % 3)).alias("source"))
    check(docs, mixing.Target(entropy=0.97))


def test_documents_keep_their_columns(spark):
    docs = spark.createDataFrame([(1, "a b c", "s", 5, 6), (2, "a", "t", 5, 6)], "doc_id long, text string, source string, weight int, row int")
    out = mixing.mixed_documents(docs, mixing.Target(max_repeats=2.0))
    assert out.columns == [*docs.columns, "mix_weight", "mix_pass", "mix_block", "mix_slot"]
    assert Counter(r["doc_id"] for r in out.collect()) == {1: 1, 2: 2}
    assert mixing.mixed_documents(docs.limit(0), mixing.Target(entropy=0.9)).collect() == []
    blank = docs.withColumn("text", F.lit(None).cast("string"))
    assert [(r["mix_weight"], r["mix_pass"]) for r in mixing.mixed_documents(blank, mixing.Target(entropy=0.9)).collect()] == [(0.0, 1)] * 2


def test_query_runs_without_python_rows_and_uses_every_document(spark, folder):
    docs = catalog.table(spark, folder, "documents")
    mix, uses = check(docs, catalog.MIX)
    df = catalog.QUERIES["op9_source_mixing"](spark, folder)
    assert {r["doc_id"] for r in df.collect()} == {r["doc_id"] for r in docs.collect()}
    assert "Python" not in planned(df) and "Arrow" not in planned(df) and "Pandas" not in planned(df)
