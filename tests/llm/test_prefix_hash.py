"""Span equality and extensions against plain strings; the query against a plain walk over the table."""

from __future__ import annotations

import hashlib
import random

from shelfcast.llm import catalog
from shelfcast.llm import prefix_hash as P


def test_spans_and_extensions_equal_plain_strings():
    rng, powers = random.Random(1), P.Powers()
    for _ in range(60):
        a = "".join(rng.choices("abé\U0001f600", k=rng.randint(1, 60)))
        b = "".join(rng.choices("abé\U0001f600", k=rng.randint(1, 60)))
        ha, hb = P.PrefixHashes(a, powers), P.PrefixHashes(b, powers)
        i, j = rng.randint(0, len(a)), rng.randint(0, len(b))
        n = rng.randint(0, min(len(a) - i, len(b) - j))
        assert ha.equal(i, hb, j, n) == (a[i : i + n] == b[j : j + n])
        common = 0
        while i + common < len(a) and j + common < len(b) and a[i + common] == b[j + common]:
            common += 1
        assert ha.extension(i, hb, j) == common
        m, k = rng.randint(0, len(a)), rng.randint(0, len(b))
        whole = P.PrefixHashes(a[:m] + b[:k], powers)
        assert P.fingerprint(P.Joined(ha, m, hb, k)) == P.fingerprint(whole)


def test_long_texts_are_hashed_in_blocks():
    powers, text = P.Powers(), "xyz" * 300_000
    h = P.PrefixHashes(text, powers)
    assert h.n == 900_000 and h.equal(0, h, 3, 899_997) and not h.equal(0, h, 1, 899_990)
    assert h.extension(0, P.PrefixHashes(text[:500_001] + "!", powers), 0) == 500_001


def test_likeness():
    powers = P.Powers()
    mark = lambda t: P.fingerprint(P.PrefixHashes(t, powers))
    text = "".join(random.Random(3).choices("abcdefgh", k=3000))
    assert P.likeness(mark(text), mark(text)) == 1 and P.likeness(mark(""), mark("")) == 1
    assert P.likeness(mark(text), mark("")) == 0
    assert P.likeness(mark(text), mark(text[:2000] + "?" * 1000)) > 0.6
    assert P.likeness(mark(text), mark("?" * 900 + text[900:])) > 0.6
    assert P.likeness(mark(text), mark("".join(random.Random(4).choices("abcdefgh", k=3000)))) < 0.05


def test_scattered_edits_cost_only_their_own_spans():
    rng, powers = random.Random(6), P.Powers()
    mark = lambda t: P.fingerprint(P.PrefixHashes(t, powers))
    text = "".join(rng.choices("abcdefgh ", k=100_000))
    ends = text[:500] + "?" + text[500:-500] + "!" + text[-500:]
    assert P.likeness(mark(text), mark(ends)) > 0.95
    parts = [text[k : k + 5000] for k in range(0, len(text), 5000)]
    assert P.likeness(mark(text), mark("".join("new" + p[7:] for p in parts))) > 0.9
    assert P.likeness(mark(text), mark("".join(rng.choices("abcdefgh ", k=100_000)))) < 0.05


def test_spans_cover_the_text_also_across_a_seam():
    rng, powers = random.Random(7), P.Powers()
    for k in range(40):
        a, b = ("".join(rng.choices("abé", k=rng.randint(0, 400))) * (k % 3 + 1) + "x" * rng.choice([0, 3000]) for _ in range(2))
        m, j = rng.randint(0, len(a)), rng.randint(0, min(len(b), rng.choice([5, 4000])))
        both = P.Joined(P.PrefixHashes(a, powers), m, P.PrefixHashes(b, powers), j)
        whole = P.PrefixHashes(a[:m] + b[:j], powers)
        assert P.fingerprint(both) == P.fingerprint(whole)
        starts, sizes = P.content_spans(whole)
        assert sizes.sum() == whole.n and list(starts[1:]) == list((starts + sizes)[:-1])
        assert all(0 < n <= P.LONGEST for n in sizes)


def plain(rows):
    """(doc_id, text) in the order of the contract, each with its edited text and the next text."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    out = []
    for k, (doc_id, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        cut = len(text) // 3
        out.append((doc_id, len(text), text[: len(text) - cut] + after[:cut], text, after))
    return out


def check(df, rows):
    powers = P.Powers()
    mark = lambda t: P.fingerprint(P.PrefixHashes(t, powers))
    want = sorted((str(i), n, hashlib.sha256(e.encode()).hexdigest(), mark(t), mark(e),
                   P.likeness(mark(t), mark(e)), P.likeness(mark(t), mark(a))) for i, n, e, t, a in plain(rows))
    got = sorted((str(r[0]), *r[1:]) for r in map(tuple, df.collect()))
    assert got == want


def test_odd_rows(spark):
    rows = [(5, "fünf fünf"), (1, None), (9, "neun" * 40), (9, "neun" * 40), (9, "andere"), (None, "kein"), (3, ""), (12, "x")]
    docs = spark.createDataFrame([(i, t, "a", "b") for i, t in rows], "doc_id long, text string, part string, guest string")
    check(P.fingerprints(docs), rows)
    check(P.fingerprints(docs.repartition(3)), rows)
    check(P.fingerprints(docs.where("doc_id = 12")), [(12, "x")])
    assert P.fingerprints(docs.limit(0)).collect() == []


def test_query_equals_a_plain_walk(spark, folder):
    rows = [(r["doc_id"], r["text"]) for r in catalog.table(spark, folder, "documents").collect()]
    check(catalog.QUERIES["op7_fingerprints"](spark, folder), rows)
