"""The automaton against plain window search, blocks against one automaton, and the odd inputs."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from shelfcast.llm import contamination as C
from shelfcast.llm import texts


def brute(doc, items, window):
    hit, found = set(), set()
    for name, words in items:
        n = min(window, len(words))
        wins = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()
        for i in range(len(doc) - n + 1 if n else 0):
            if tuple(doc[i : i + n]) in wins:
                hit |= set(range(i, i + n))
                found.add(name)
    return hit, found


@pytest.mark.parametrize("seed", range(40))
def test_automaton_finds_what_plain_search_finds(seed):
    rng = random.Random(seed)
    letters = [b"a", b"b", b"c"][: rng.randint(1, 3)]
    items = [(str(k), rng.choices(letters, k=rng.randint(0, 14))) for k in range(rng.randint(1, 6))]
    window = rng.randint(2, 6)
    automaton = C.SuffixAutomaton(items, window)
    for _ in range(10):
        doc = rng.choices([*letters, b"z"], k=rng.randint(0, 40))
        spans, found = automaton.matches(doc)
        hit, names = brute(doc, items, window)
        assert {p for a, b in spans for p in range(a, b)} == hit
        assert {automaton.names[k] for k in found} == names


PASSAGE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame(
        [(1, f"Before! {PASSAGE.upper()}, after that some clean words and many more of them to keep", "en", 7),
         (2, "nothing to see", "en", 8), (3, None, None, None), (4, "", "en", 0), (5, "Short ITEM", "en", 9),
         (6, PASSAGE, "en", 1), (6, PASSAGE, "en", 1), (None, "?!", "en", 2)],
        "doc_id long, text string, item string, n_chars long")
    bench = spark.createDataFrame(
        [(10, PASSAGE), (11, PASSAGE), (2, "short item"), (3, None), (4, "..."), (None, "never there at all")],
        "item_id long, text string")
    return docs, bench


def test_odd_inputs_and_clashing_columns(tables):
    docs, bench = tables
    rows = C.digest_columns(C.overlaps(docs, bench, ["doc_id"])).collect()
    got = {(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in rows}
    assert got == {(1, 24, 11, 2, True), (2, 3, 0, 0, False), (3, 0, 0, 0, False), (4, 0, 0, 0, False),
                   (5, 2, 2, 1, True), (6, 11, 11, 2, True), (None, 0, 0, 0, False)}
    assert len(rows) == 8
    sha = {r["doc_id"]: r["items_sha256"] for r in rows}
    assert sha[1] == hashlib.sha256(b"10,11").hexdigest() and sha[2] == hashlib.sha256(b"").hexdigest()


def test_blocks_give_what_one_automaton_gives(tables):
    docs, bench = tables
    one = C.digest_columns(C.overlaps(docs, bench, ["doc_id"]))
    many = C.digest_columns(C.overlaps(docs, bench, ["doc_id"], block_words=5))
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))


def test_passages_go_and_the_rest_stays(tables):
    docs, bench = tables
    rows = C.remove_passages(docs, bench).orderBy("doc_id").collect()
    assert docs.columns == list(rows[0].asDict()) and [r["doc_id"] for r in rows] == [None, 1, 2, 3, 4]
    text = rows[1]["text"]
    assert text == "Before! , after that some clean words and many more of them to keep" and rows[1]["n_chars"] == len(text)
    assert rows[2]["text"] == "nothing to see" and rows[2]["n_chars"] == 8


def test_empty_tables(tables):
    docs, bench = tables
    assert C.overlaps(docs.limit(0), bench, ["doc_id"]).count() == 0
    assert C.overlaps(docs, bench.limit(0), ["doc_id"]).where(F.size("spans") > 0).count() == 0


def test_words_follow_the_stated_pattern():
    text = "Ab-9 ÉÀ\x7fx y".encode()
    assert texts.normal_words(text) == ["ab".encode(), b"9", "ÉÀ".encode(), "x y".encode()]
