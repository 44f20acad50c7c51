"""Codewords, held-out accuracy, and the odd inputs."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import catalog
from shelfcast.llm import language_id as L


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 12, 40])
def test_codewords_tell_languages_apart(n):
    code = L.codewords(n)
    assert code.shape[0] == n and set(np.unique(code)) <= {-1, 1}
    for i in range(n):
        for j in range(i):
            assert (code[i] != code[j]).sum() >= (1 if n == 2 else 2)
    assert all(abs(int(c.sum())) < n for c in code.T)


def test_query_on_held_out_documents(spark, folder):
    docs = catalog.table(spark, folder, "documents")
    rows = catalog.QUERIES["op2_language_id"](spark, folder).collect()
    assert len(rows) == docs.count()
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert np.mean([truth[r["doc_id"]] == r["lang_pred"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_labels_of_held_out_documents_do_not_matter(spark, folder):
    docs = catalog.table(spark, folder, "documents")
    changed = docs.withColumn("lang", F.when(L.is_held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    one, two = (L.train(d) for d in (docs, changed.withColumn("source", F.lit("z"))))
    assert one.languages == two.languages and np.array_equal(one.weights, two.weights)


def plain_judgement(model, text):
    """Grams counted one by one, one logistic loss a bit and language, the least loss chosen."""
    lowered = (text or "").lower()
    if not any(c.isalpha() for c in lowered):
        return "und", 0.0, False
    kept = "".join(c if "a" <= c <= "z" or ord(c) >= 128 else " " for c in lowered)
    data = (" " + " ".join(w for w in kept.split(" ") if w) + " ").encode()
    counts = {}
    for n in range(1, L.LONGEST_GRAM + 1):
        for i in range(len(data) - n + 1):
            number = 0
            for byte in data[i : i + n]:
                number = (number * 257 + byte + 1) % 2**32
            bucket = number * 2654435761 % 2**32 >> 20
            counts[bucket] = counts.get(bucket, 0) + 1
    total = sum(counts.values())
    losses = []
    for k in range(len(model.languages)):
        loss = 0.0
        for bit in range(model.code.shape[1]):
            output = float(model.offsets[bit]) + sum((c / total) ** 0.5 * float(model.weights[g, bit]) for g, c in counts.items())
            loss += float(model.reliability[k, bit]) * np.log1p(np.exp(-output * int(model.code[k, bit])))
        losses.append(loss)
    one, two = sorted(losses)[:2]
    odds = [np.exp(-(x - one) * model.code.shape[1]) for x in losses]
    return model.languages[losses.index(one)], 1 / sum(odds), two - one < L.AMBIGUOUS_GAP * two


def test_query_equals_a_plain_decoder(spark, folder):
    docs = catalog.table(spark, folder, "documents")
    model = L.train(docs)
    plain = {r["doc_id"]: plain_judgement(model, r["text"]) for r in docs.collect() if len(r["text"] or "") < 4000}
    assert len(plain) > 100
    for r in catalog.QUERIES["op2_language_id"](spark, folder).collect():
        if r["doc_id"] in plain:
            lang, score, ambiguous = plain[r["doc_id"]]
            assert (r["lang_pred"], r["ambiguous"]) == (lang, ambiguous) and r["score"] == pytest.approx(score, abs=1e-3)


def test_classifiers_reach_the_least_loss():
    rng = np.random.default_rng(4)
    x = rng.random((80, 6)).astype(np.float32)
    sides = np.sign(x @ rng.normal(size=(6, 2)) - 0.1 + rng.normal(0, 0.4, (80, 2))).astype(np.float32)
    weight = np.ones((80, 1), np.float32)

    def loss(w, b):
        return np.logaddexp(0, -sides * (x @ w + b)).mean(0)

    w, b = np.zeros((6, 2)), np.zeros(2)
    for _ in range(30_000):
        pull = -sides / (1 + np.exp(sides * (x @ w + b))) / len(x)
        w, b = w - 0.5 * x.T @ pull, b - 0.5 * pull.sum(0)
    assert (loss(*L._logistic(x, sides, weight)) <= loss(w, b) + 0.01).all()


def test_odd_inputs(spark, folder):
    docs = catalog.table(spark, folder, "documents")
    model = L.train(docs)
    rows = [(1, None), (2, ""), (3, "123 !?"), (4, "the and of this that " * 100_000), (4, "der die und nicht mit auf"), (None, "los ciónes que las asóga por una ciónado las ción")]
    df = spark.createDataFrame([(i, t, "x", 0.5, "y") for i, t in rows], "doc_id long, text string, lang_pred string, score double, lang string")
    got = {(r["doc_id"], r["lang_pred"]) for r in L.identify(df, model, ["doc_id"]).collect()}
    assert got == {(1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "de"), (None, "es")}
    kept = L.keep_known(df, model)
    assert kept.columns == df.columns and kept.count() == 3
    assert L.identify(df.limit(0), model, ["doc_id"]).collect() == []


def test_without_and_with_one_language(spark):
    df = spark.createDataFrame([(k, f"words {k}", "en" if k % 2 else None) for k in range(40)], "doc_id long, text string, lang string")
    one = L.train(df)
    assert one.languages == ["en"]
    assert {r["lang_pred"] for r in L.identify(df, one, ["doc_id"]).collect()} == {"en"}
    none = L.train(df.withColumn("lang", F.lit(None).cast("string")))
    assert {(r["lang_pred"], r["score"]) for r in L.identify(df, none, ["doc_id"]).collect()} == {("und", 0.0)}
