"""Counts, near words, forms and roots against a plain comparison of all pairs."""

from __future__ import annotations

import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfcast.llm import catalog
from shelfcast.llm import spelling as S

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain_counts(rows, least_length=5, least_count=3):
    counts: Counter = Counter()
    for key, text in rows:
        for run in RUN.findall(text or ""):
            word = run.translate(LOWER)
            h = crc32(f"{'' if key is None else key}:{word}".encode())
            if h % 97 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}


def edits(word: str, alphabet: str) -> set[str]:
    cuts = [(word[:k], word[k:]) for k in range(len(word) + 1)]
    found = {a + b[1:] for a, b in cuts if b} | {a + c + b for a, b in cuts for c in alphabet}
    return (found | {a + c + b[1:] for a, b in cuts if b for c in alphabet}) - {word}


def plain(counts):
    alphabet = "".join(sorted({c for w in counts for c in w}))
    near = {w: sorted(edits(w, alphabet) & counts.keys()) for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    rows = set()
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return rows




def same(df, rows):
    got = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(got) == len(set(got)) and set(got) == plain(plain_counts(rows))


def texts_of(words: dict[str, int]) -> list[tuple[int, str]]:
    return [(k, " ".join([w] * n)) for k, (w, n) in enumerate(words.items())]


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, n int, word int")


def test_odd_texts(spark):
    rows = [(1, None), (2, ""), (None, "WordsOne wordsone Àéÿ×÷x " * 4), (3, "straÃŸe Āabcdefİghijk " * 3), (3, "wordsone wordsonex wordson " * 3),
            (4, "longest" * 40 + " "), (5, ("longest" * 40 + " ") * 3), (6, "ab中cdefgh cdefgh CDEFGH 12cdefgh"), (7, "aaaaa aaaaaa aaaaaaa " * 5)]
    rows += rows[3:6]
    same(S.variants(docs_of(spark, rows).repartition(3)), rows)
    assert S.variants(docs_of(spark, rows).limit(0)).collect() == []


def test_ties_chains_and_damage(spark):
    words = {"stone": 100, "stond": 40, "stnd": 9, "stondx": 12, "stondxy": 5, "stonf": 40, "shone": 100, "phone": 100, "phonem": 3}
    rows = texts_of(words)
    same(S.variants(docs_of(spark, rows)), rows)


def test_long_chains_reach_their_root(spark):
    words = {"abcdefghijklmnop"[: 5 + k]: 3 * 2 ** (9 - k) for k in range(10)}
    rows = texts_of(words)
    same(S.variants(docs_of(spark, rows)), rows)


def test_large_gatherings_are_tiled(spark):
    random = np.random.default_rng(1)
    words = {"pre" + "".join(random.choice(list("abé"), 4)): 3 for _ in range(60)} | {"x" * 9: 7, "x" * 10: 3}
    counts = spark.createDataFrame(list(words.items()), "word string, n long")
    for block in (7, 2048):
        got = {(r["word"], r["other"], r["other_n"]) for r in S.near_words(counts, block).collect()}
        assert got == {(w, o, words[o]) for w in words for o in edits(w, "prexabé") & words.keys()}
        assert S.near_words(counts, block).count() == len(got)


@settings(max_examples=150, deadline=None)
@given(st.sets(st.text("ab", min_size=4, max_size=7), min_size=2, max_size=40), st.integers(4, 6))
def test_tiles_equal_all_pairs(words, m):
    body = sorted(w.encode() for w in words if m <= len(w) <= m + 1)
    if len(body) < 2:
        return
    for blocks in (np.zeros(len(body), int), np.arange(len(body)) % 2):
        got = [frozenset((body[i], body[j])) for a, b in S.near_pairs(body, blocks, m, True) for i, j in zip(a, b)]
        expected = {frozenset((v.encode(), w)) for w in body for v in edits(w.decode(), "ab") if v.encode() in body and min(len(v), len(w)) == m}
        if blocks.any():
            expected = {p for p in expected if len({int(blocks[body.index(w)]) for w in p}) == 2}
        assert len(got) == len(set(got)) and set(got) == expected


def test_query_equals_plain_comparison(spark, folder):
    rows = [(r["doc_id"], r["text"]) for r in catalog.table(spark, folder, "documents").collect()]
    same(catalog.QUERIES["op11_spelling_variants"](spark, folder), rows)
