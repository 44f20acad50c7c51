"""Anchors of equal windows, and removal against plain search over all windows."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from shelfcast.llm import recompression as R


@pytest.mark.parametrize("seed", range(30))
def test_equal_windows_have_equal_anchors(seed):
    rng = random.Random(seed)
    letters = [bytes([97 + k]) for k in range(rng.randint(1, 6))]
    passage = rng.choices(letters, k=40)
    docs = [rng.choices(letters, k=rng.randint(0, 30)) + passage + rng.choices(letters, k=rng.randint(0, 30)) for _ in range(20)]
    seq = R.Sequence([*docs, []])
    places = seq.windows(R.WINDOW)
    offset = R.anchors(seq, places) - places
    assert offset.min() >= 0 and offset.max() <= R.WINDOW - R.KEY_WORDS
    seen = {}
    for place, off in zip(places.tolist(), offset.tolist()):
        assert seen.setdefault(seq.symbols[place : place + R.WINDOW].tobytes(), off) == off


def test_symbols_make_anchors_sparse():
    rng = random.Random(0)
    seq = R.Sequence([[b"%d" % rng.randint(0, 10**6) for _ in range(50_000)]])
    places = seq.windows(R.WINDOW)
    assert len(np.unique(R.anchors(seq, places))) < 0.45 * len(places)


def plain(rows, window):
    first = {}
    words = [(i, (t or "").split()) for i, t in rows]
    key = lambda i: R.LAST if i is None else i
    for i, w in words:
        for k in range(len(w) - window + 1):
            at = tuple(w[k : k + window])
            first[at] = min(first.get(at, R.LAST), key(i))
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < key(i):
                gone |= set(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def test_removal_equals_plain_search(spark):
    rng = random.Random(5)
    passages = [" ".join(rng.choices(["uno", "dos", "tres", "ñandú"], k=rng.randint(10, 60))) for _ in range(6)]
    rows = [(1000 - k, " ".join([str(k), rng.choice(passages), f"x{k} y{k}", rng.choice(passages), "z"])) for k in range(60)]
    rows += [(3, None), (4, ""), (5, "a " * 40), (6, "b " + "a " * 50 + "c"), (7, "a " * 13), (8, "ab ab " * 30), (9, "ab " * 70)]
    rows += [(700, rows[0][1]), (700, rows[0][1]), (None, rows[3][1]), (None, "only here"), (2, "a \t\n\x0b" * 12)]
    docs = spark.createDataFrame([(i, t, 5, 6) for i, t in rows], "doc_id long, text string, grp int, part int")
    assert sorted(map(tuple, R.repeat_counts(docs).collect()), key=str) == plain(rows, R.WINDOW)
    assert R.repeat_counts(docs.limit(0)).collect() == []


def test_documents_keep_their_columns_and_clean_text(spark):
    passage = " ".join(f"w{k}" for k in range(30))
    rows = [(1, f"Start  here\n{passage}\nend", "s", 60), (2, f"Other\n\n{passage}   tail  stays", "t", 70), (3, passage, "u", 1), (4, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rest string, n_chars long")
    got = {r["doc_id"]: r for r in R.remove_repeats(docs).collect()}
    assert sorted(got) == [1, 2, 4] and tuple(got[1]) == rows[0] and tuple(got[4]) == rows[3]
    assert tuple(got[2]) == (2, "Other tail  stays", "t", 17)
