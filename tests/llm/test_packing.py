"""Pieces against the ids of whole texts, and sequences against the rules they must keep."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfcast.llm import catalog
from shelfcast.llm import packing as P


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(P.VOCABULARY)
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, P.END_ID]


def check(pieces, expected: dict, capacity: int) -> None:
    """Every id in one piece, offsets without gaps, sequences full or a power of two."""
    documents, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        documents[p["doc_id"]].append(p)
        sequences[p["sequence_id"]].append(p)
    assert set(documents) == set(expected)
    for key, parts in documents.items():
        parts.sort(key=lambda p: p["start"])
        ids = [i for p in parts for i in np.frombuffer(p["ids"], "<u4").tolist()]
        assert ids == expected[key]
        assert [p["start"] for p in parts] == np.cumsum([0, *[p["length"] for p in parts[:-1]]]).tolist()
        assert all(p["doc_tokens"] == len(ids) and len(p["ids"]) == 4 * p["length"] for p in parts)
    for parts in sequences.values():
        parts.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in parts] == np.cumsum([0, *[p["length"] for p in parts[:-1]]]).tolist()
        total = sum(p["length"] for p in parts)
        assert total == capacity or (total < capacity and total.bit_count() == 1)


ODD = [None, "", " \n\t\x0b\x0c ", "a", "Hello  WORLD", "word " * 3000, "<|endoftext|> x<|startoftext|>", "café é İIΣ Σ",
       "　a b c", "it's they'll 123 45", "\U0001f600́ ́x", "x" * 5000, "\x1c \x85 end", "ÀÉß×÷ÿ ...'s!'S 'RE've x'sand don't' ''d 1a2 <|", "straße ﬁ ½ ²x ªº µm Ÿ", "i\u0307 e\u0301t\u00e9 \x7f\x00x"]


def test_odd_texts_and_clashing_columns(spark, whole):
    docs = spark.createDataFrame(
        [(k, t, 1, 2, 3) for k, t in enumerate(ODD)], "doc_id int, text string, start int, ids int, k0 int").repartition(3)
    got = P.pack(docs, ["doc_id"]).collect()
    check(got, {k: whole(t) for k, t in enumerate(ODD)}, P.CAPACITY)
    assert P.pack(docs.limit(0), ["doc_id"]).collect() == []


SIMPLE = st.text(st.sampled_from("abdelmrstv'ABDELMRSTVÀéßÿ1.<| \n\t"), max_size=30).filter(lambda t: "<|" not in t)


@settings(max_examples=500, deadline=None)
@given(st.lists(SIMPLE, max_size=6))
def test_texts_are_cut_together_as_one_by_one(group):
    found, counts = P.cut_simple(group)
    assert found.to_pylist() == [p for t in group for p in P.pieces(t)]
    assert counts.tolist() == [len(P.pieces(t)) for t in group]


def test_forgotten_pieces_and_groups_without_any(whole, monkeypatch):
    monkeypatch.setattr(P, "REMEMBERED", 8)
    with open(P.VOCABULARY, "rb") as file:
        encode = P.encoder(file.read())
    for group in ([None], ["", None, " "], ODD, ["one two three", None, "caf\u00e9\u3000x"], ODD[::-1], [t for t in ODD if t] * 3):
        assert [np.frombuffer(ids, "<u4").tolist() for ids in encode(group)] == [whole(t)[:-1] for t in group]


def test_repeated_rows_and_null_keys(spark, whole):
    docs = spark.createDataFrame([(None, "one two")] * 3, "doc_id int, text string")
    got = P.pack(docs, ["doc_id"], capacity=8).collect()
    assert sum(p["length"] for p in got) == 3 * len(whole("one two")) and {p["doc_id"] for p in got} == {None}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 90), max_size=60), st.sampled_from([1, 8, 16, 24]))
def test_bins_keep_every_id(lengths, capacity):
    bins = P.Bins(capacity)
    texts = {k: np.arange(n, dtype="<u4") for k, n in enumerate(lengths)}
    rows, number = [], 0

    def take(sequences):
        nonlocal number
        for sequence in sequences:
            offset = 0
            for document, ids, at, n in sequence:
                rows.append({"doc_id": document, "start": at, "length": n, "ids": ids[at : at + n].tobytes(),
                             "doc_tokens": len(ids), "sequence_id": number, "offset": offset})
                offset += n
            number += 1

    for k, ids in texts.items():
        take(bins.add(k, ids))
        assert all(len(b) < c for c, b in bins.open.items())
    take(bins.end())
    check(rows, {k: ids.tolist() for k, ids in texts.items()}, capacity)


def test_class_bins_hold_a_fixed_number_of_whole_texts():
    bins = P.Bins(100)
    closed = [s for k in range(9) for s in bins.add(k, np.zeros(30, "<u4"))]
    # Three texts of class 3 and the head of the next text that comes.
    assert [len(s) for s in closed] == [4, 4] and [[p[3] for p in s] for s in closed] == [[30, 30, 30, 10]] * 2


def test_padded_room(spark):
    rows = spark.createDataFrame([(1,), (3,), (1024,), (2047,), (2048,)], "n int").select(P.padded("n").alias("room"))
    assert [r[0] for r in rows.collect()] == [1, 2048, 1024, 2048, 2048]


def test_query_covers_every_document(spark, folder, whole):
    expected = {r["doc_id"]: whole(r["text"]) for r in catalog.table(spark, folder, "documents").collect()}
    got = catalog.QUERIES["op12_packing"](spark, folder)
    for p in got.collect():
        part = np.array(expected[p["doc_id"]][p["start"] : p["start"] + p["length"]], "<u4")
        assert p["ids_crc32"] == zlib.crc32(part.tobytes()) and p["doc_tokens"] == len(expected[p["doc_id"]])
    totals = got.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert totals.where(P.padded("n") != F.col("n")).isEmpty()
    assert got.agg(F.sum("length")).first()[0] == sum(map(len, expected.values()))
