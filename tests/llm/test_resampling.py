"""Weights against plain counting, the cut against sorting, and separation of labelled documents."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import catalog, texts
from shelfcast.llm import resampling as R


def plain_counts(rows):
    counts = np.zeros(R.BUCKETS, np.int64)
    for text in rows:
        words = texts.plain_words(text.encode()) if text else []
        hashed = texts.word_digests(words)
        for k in range(len(words)):
            counts[int(texts.mix(hashed[k : k + 1])[0]) % R.BUCKETS] += 1
            if k:
                counts[int(texts.sequence_digests(hashed[k - 1 : k + 1], 2, 61)[0]) % R.BUCKETS] += 1
    return counts


def test_weights_and_cut_equal_plain_ones(spark):
    rows = [(k, f"good {'words ' * (k % 5)}" if k % 2 else f"bad noise {k % 3}") for k in range(200)] + [(900, None), (901, ""), (902, "good words"), (902, "good words"), (None, "bad")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, draw int")
    target = docs.where("text LIKE 'good%'")
    raw, good = plain_counts([t for _, t in rows]), plain_counts([t for _, t in rows if (t or "").startswith("good")])
    assert (R.bucket_counts(docs) == raw).all()
    ratio = R.log_ratio(good, raw)
    for share in (0.0, 0.3, 0.77, 1.0):
        got = R.resample(docs, target, share).collect()
        assert len(got) == len(rows)
        for r in got:
            text = dict(rows)[r["doc_id"]]
            assert r["log_weight"] == pytest.approx(float((plain_counts([text]) * ratio).sum()))
        keys = sorted((r["gumbel_key"] for r in got), reverse=True)
        k = round(share * len(rows))
        assert sorted((r["gumbel_key"] for r in got if r["sampled"]), reverse=True) == [x for x in keys if k and x >= keys[k - 1]]
    assert R.resample(docs.limit(0), target, 0.5).collect() == []
    assert R.resample(docs, target.limit(0), 0.5).where("sampled").count() >= round(0.5 * len(rows))


def test_keys_keep_their_order():
    x = np.array([-np.inf, -1e300, -2.5, -0.0, 0.0, 1e-300, 3.0, np.inf])
    o = R._ordered(x)
    assert (np.diff(o) >= 0).all() and o[3] == o[4]


def test_noise_is_gumbel():
    draws = R.noise(np.arange(100_000, dtype=np.int64) * 7919)
    assert abs(draws.mean() - 0.5772) < 0.02 and abs(draws.var() - np.pi**2 / 6) < 0.05


def test_labelled_documents_come_apart(spark, folder):
    got = catalog.QUERIES["op3_quality_resampling"](spark, folder)
    labels = catalog.table(spark, folder, "labels").where("toxic = 0")
    rate = dict(map(tuple, got.join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("sampled").cast("int"))).collect()))
    assert rate[1] > 0.9 and rate[1] - rate[0] > 0.4


@pytest.mark.parametrize("block_ids", [1, 7, R.BLOCK_IDS])
def test_every_good_document_teaches_the_target(spark, block_ids):
    rows = [(k, f"alpha {'beta ' * (k % 3)}{k % 7}") for k in range(40)] + [(3, "again three"), (None, "no id"), (41, None)]
    marks = [(k, k % 2, int(k % 5 == 0)) for k in range(0, 30)] + [(3, 1, None), (3, 1, 0), (None, 1, 0), (41, 1, None), (5, None, 0), (99, 1, 0)]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, quality int")
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    good = {i for i, q, x in marks if q == 1 and not x and i is not None}
    ratio = R.log_ratio(plain_counts([t for i, t in rows if i in good]), plain_counts([t for _, t in rows]))
    got = R.resample_like_labelled(docs, labels, block_ids=block_ids).collect()
    plain = sorted(float((plain_counts([t]) * ratio).sum()) for _, t in rows)
    assert sorted(r["log_weight"] for r in got) == pytest.approx(plain)
    judged = [q for _, q, _ in marks if q is not None]
    assert sum(r["sampled"] for r in got) == round(sum(judged) / len(judged) * len(rows))
