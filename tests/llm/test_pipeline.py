"""The stages against a plain walk over a small table, and what must hold on the driver tables."""

from __future__ import annotations

import re
from collections import Counter

import corpus_pipeline as pipeline
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import catalog, language_id, texts

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def shingles(text):
    w = texts.normal_words(text.encode())
    n = min(5, len(w))
    return frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if w else None


def cut(text, word, gone):
    places = [m.span() for m in re.finditer(word, text)]
    pieces, at, k = [], 0, 0
    while k < len(places):
        if k in gone:
            end = k
            while end + 1 in gone:
                end += 1
            pieces.append(text[at : places[k][0]])
            at, k = places[end][1], end
        k += 1
    return " ".join(p for p in (x.strip() for x in [*pieces, text[at:]]) if p) if gone else text


def plain(rows, known, items):
    """doc_id to text after language, near copies, repeats and benchmark."""
    rows = {i: t for i, t in sorted(rows.items()) if i in known}
    sets = {i: shingles(t) for i, t in rows.items()}
    kept, todo = [], list(rows)
    while todo:
        group, todo = [todo[0]], todo[1:]
        for i in group:
            near = [j for j in todo if sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
            group += near
            todo = [j for j in todo if j not in near]
        kept.append(group[0])
    rows = {i: rows[i] for i in sorted(kept)}
    first, out = {}, {}
    for i, t in rows.items():
        w = t.split()
        wins = [tuple(w[k : k + 13]) for k in range(len(w) - 12)]
        gone = {p for k, x in enumerate(wins) if first.get(x, i) < i for p in range(k, k + 13)}
        for x in wins:
            first.setdefault(x, i)
        text = cut(t, r"[^\x20\x09-\x0D]+", gone)
        if text or not gone:
            out[i] = text
    rows, out = out, {}
    word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    wins = {}
    for item in items:
        w = texts.normal_words(item.encode())
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            wins.setdefault(n, set()).add(tuple(w[k : k + n]))
    for i, t in rows.items():
        w = texts.normal_words(t.encode())
        gone = {p for n, own in wins.items() for k in range(len(w) - n + 1) if tuple(w[k : k + n]) in own for p in range(k, k + n)}
        if len(gone) <= 0.5 * len(w):
            out[i] = cut(t, word, gone)
    return out


@pytest.fixture(scope="module")
def result(spark, folder):
    return pipeline.run(spark, folder).collect()


def test_stages_equal_a_plain_walk(spark, folder, result):
    docs = catalog.table(spark, folder, "documents")
    judged = language_id.identify(docs, language_id.train(docs), ["doc_id"]).collect()
    known = {r["doc_id"] for r in judged if r["lang_pred"] != "und" and not (r["ambiguous"] and r["score"] < 0.5)}
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    items = [r["text"] for r in catalog.table(spark, folder, "benchmark").collect()]
    want = plain(rows, known, items)
    got = {r["doc_id"]: r["text"] for r in result}
    assert got == want
    assert all(r["n_chars"] == len(r["text"]) for r in result if r["text"] != rows[r["doc_id"]])


def test_mix_uses_every_document(result):
    uses = Counter(r["doc_id"] for r in result)
    assert set(uses.values()) <= {1, 2, 3} and len({(r["doc_id"], r["mix_pass"]) for r in result}) == len(result)


def test_stages_keep_columns_and_take_odd_tables(spark, folder):
    docs = catalog.table(spark, folder, "documents")
    odd = docs.limit(40).unionByName(spark.createDataFrame(
        [(1, None, None, None, None), (None, "?", "en", "s", 1), (None, "", None, "s", 0), (7, "x " * 30_000, "en", None, 60_000)], docs.schema))
    for table in (odd, docs.limit(0)):
        for _, stage in pipeline.STAGES[:-1]:
            table = stage(spark, table, folder)
            assert table.columns == COLUMNS
        final = pipeline.STAGES[-1][1](spark, table, folder)
        assert final.columns[:5] == COLUMNS
        final.agg(F.count("*")).collect()


def test_stages_hand_on_extra_columns(spark, folder):
    docs = catalog.table(spark, folder, "documents").limit(60).select(
        "*", F.lit(1).alias("grp"), F.lit(2).alias("part"), F.lit("x").alias("rest"), F.lit(3).alias("key"), F.lit(4).alias("node"),
        F.lit(5).alias("first"), F.lit(6).alias("spans"), F.lit(7).alias("n_words"), F.lit(8).alias("_text"), F.lit(9).alias("a.b"))
    table = docs
    for _, stage in pipeline.STAGES:
        table = stage(spark, table, folder)
        assert table.columns[: len(docs.columns)] == docs.columns
    row = table.first()
    assert row["grp"] == 1 and row["rest"] == "x" and row["spans"] == 6 and row["_text"] == 8 and row["a.b"] == 9
