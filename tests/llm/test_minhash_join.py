"""Classes and links against all pairs of small tables, in one block and in several."""

from __future__ import annotations

import random

import pytest

from shelfcast.llm import catalog, texts
from shelfcast.llm import minhash_join as M
from shelfcast.llm.components import components


def plain(rows):
    """Classes and links by comparing all pairs of sets."""
    sets = []
    for _, text in rows:
        w = texts.normal_words(text.encode() if text is not None else None)
        n = min(5, len(w))
        sets.append(frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if w else None)
    distinct = [s for s in dict.fromkeys(sets) if s]
    near = {s: {t for t in distinct if t != s and 5 * len(s & t) >= 4 * len(s | t)} for s in distinct}
    group = {}
    for s in distinct:
        todo, seen = [s], {s}
        while todo and s not in group:
            for t in near[todo.pop()] - seen:
                seen.add(t)
                todo.append(t)
        for t in seen:
            group.setdefault(t, min(map(str, map(sorted, seen))))
    order = lambda i: M.LAST if i is None else i
    first = {}
    for (i, _), s in zip(rows, sets):
        if s:
            first[group[s]] = min(first.get(group[s], M.LAST), order(i))
    return sorted(((i, (None if first[group[s]] == M.LAST else first[group[s]]) if s else i,
                    len(near[s]) if s else 0, sets.count(s) - 1 if s else 0, len(s or ())) for (i, _), s in zip(rows, sets)), key=str)


def result(df):
    return sorted(((r["doc_id"], r["class_id"], r["n_links"], r["n_copies"], r["n_grams"]) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    out = [(5000 + k, " ".join(word() for _ in range(rng.randint(1, 80)))) for k in range(60)]
    base = [word() for _ in range(300)]
    for k in range(120):  # one large group of near copies
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(300)] = word()
        out.append((100 + k, " ".join(copy).upper() if k % 2 else ", ".join(copy)))
    chain = [word() for _ in range(200)]
    for k in range(12):  # neighbours are alike, the ends are not
        chain = chain[8:] + [word() for _ in range(8)]
        out.append((900 + k, " ".join(chain)))
    out += [(1, None), (2, ""), (3, "?!"), (4, "one two"), (5, "One, two!"), (6, "one two three"), (None, out[70][1]), (7, "one two"), (7, "one two")]
    rng.shuffle(out)
    return out


def test_classes_links_and_copies_equal_all_pairs(spark, rows):
    docs = spark.createDataFrame([(i, t, b"x", 1) for i, t in rows], "doc_id long, text string, node binary, root int")
    want = plain(rows)
    assert result(M.similar_documents(docs)) == want
    assert result(M.similar_documents(docs, block=16)) == want
    assert M.similar_documents(docs.limit(0)).collect() == []


def test_one_document_of_each_class_stays(spark, rows):
    docs = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, first string")
    kept = M.keep_first(docs)
    assert kept.columns == docs.columns
    want = sorted({str(i) for i, c, *_ in plain(rows) if i == c})
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == want


def test_one_near_copy_stays_without_doc_ids_and_under_a_repeated_one(spark):
    base = [" ".join(f"{c}{k}" for k in range(120)) for c in "abc"]
    rows = [(doc_id, text + end) for doc_id, text in zip((None, 7, None), base, strict=True) for end in ("", " x", " y", " y")]
    rows.append((3, base[2] + " z"))
    kept = M.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["text"][0], r["doc_id"] or 0) for r in kept) == [("a", 0), ("b", 7), ("c", 3)]


def test_bands_reach_the_recall():
    bands = M.bands_for()
    assert 1 - (1 - 0.8**M.ROWS) ** bands >= M.RECALL > 1 - (1 - 0.8**M.ROWS) ** (bands - 1)


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (200, 201), (201, 202), (202, 200)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = dict(map(tuple, components(df).collect()))
    assert got == {**{k: 0 for k in range(41)}, **{100 + k: 100 for k in range(30)}, 200: 200, 201: 200, 202: 200}
    assert components(df.limit(0)).collect() == []


def test_query_equals_all_pairs(spark, folder):
    rows = [(r["doc_id"], r["text"]) for r in catalog.table(spark, folder, "documents").collect()]
    assert result(catalog.QUERIES["op8_ngram_jaccard_join"](spark, folder)) == plain(rows)
