"""Rules against stated cases, scores and threshold against a plain model with the same buckets."""

from __future__ import annotations

import math
import random
import struct
from collections import Counter

import pytest
import xxhash
from plans import planned

from shelfcast.llm import catalog
from shelfcast.llm import url_filter as U


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def bucket(order, parts):
    seed = xxhash.xxh64_intdigest(struct.pack("<i", order), seed=42)
    for part in parts:
        seed = xxhash.xxh64_intdigest(part.encode(), seed=seed)
    return signed(seed) % U.BUCKETS


def grams(url):
    c = [""] * U.ORDER + list((url or "").translate(str.maketrans(U.UPPER, U.LOWER)))
    for at in range(U.ORDER, len(c)):
        yield [(k, bucket(k, c[at - k : at]), bucket(k, c[at - k : at + 1])) for k in range(U.ORDER + 1)]


class Plain:
    def __init__(self, urls):
        seen = Counter(g for url in urls for place in grams(url) for g in place)
        self.gram, self.total, self.kinds = Counter(), Counter(), Counter()
        for (k, context, gram), n in seen.items():
            self.gram[k, gram] += n
            self.total[k, context] += n
            self.kinds[k, context] += 1

    def log_likelihood(self, url):
        out = 0.0
        for place in grams(url):
            p = 1 / U.ALPHABET
            for k, context, gram in place:
                kinds = max(self.kinds[k, context], 1e-9)
                p = (self.gram[k, gram] + kinds * p) / (self.total[k, context] + kinds)
            out += math.log(p)
        return out


def check(rows, got):
    """``rows``: page_id to (url, rule's verdict)."""
    kept = {u: signed(xxhash.xxh64_intdigest((u or "").encode(), seed=xxhash.xxh64_intdigest(b"calibration", seed=42))) % 5 == 0
            for u, _ in rows.values()}
    sides = {s: [u for u, v in rows.values() if v == s] for s in ("allow", "block")}
    models = {s: Plain([u for u in urls if not kept[u]]) for s, urls in sides.items()}
    score = lambda u: (models["allow"].log_likelihood(u) - models["block"].log_likelihood(u)) / max(len(u or ""), 1)
    for r in got:
        assert r["score"] == pytest.approx(score(rows[r["page_id"]][0]), abs=1e-9)
    held = {s: [math.floor(score(u) / U.STEP) for u in urls if kept[u]] for s, urls in sides.items()}
    cut = 0.0
    if held["allow"] and held["block"]:
        bins, losses = sorted({*held["allow"], *held["block"]}), []
        for k, b in enumerate(bins):
            lost = sum(x < b for x in held["allow"]) / len(held["allow"]) + sum(x >= b for x in held["block"]) / len(held["block"])
            middle = (b + (bins[k - 1] + 1 if k else b)) * U.STEP / 2
            losses.append((round(lost, 9), abs(middle), middle))
        cut = min(losses)[2]
    for r in got:
        ruled = rows[r["page_id"]][1]
        assert r["verdict"] == (ruled or ("allow" if r["score"] >= cut else "block"))


CASES = [
    ("https://a.example.org/x", "a.example.org", "/x", "org/", "allow"),
    ("https://EXAMPLE.org/es/1?q", "example.org", "/es/1", "example.org/es/", "block"),
    ("http://m.example.org/en/17#t", "m.example.org", "/en/17", "example.org/en/1", "block"),
    ("http://example.org/en/27", "example.org", "/en/27", "org/", "allow"),
    ("http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
    ("http://x.com/fr/9", "x.com", "/fr/9", "com/fr/", "allow"),
    ("http://x.com/de/", "x.com", "/de/", "com/de/", "block"),
    ("http://x.com/de", "x.com", "/de", None, None),
    ("http://x.org?a=/es/", "x.org", "", None, None),
    ("//x.org/", "", "", None, None), (None, "", "", None, None), ("", "", "", None, None),
    ("a://b://c.org/", "b:", "//c.org/", None, None), ("http://xorg/", "xorg", "/", None, None),
    ("http://é.ORG/Ö?", "é.org", "/Ö", "org/", "allow"), ("http://x.net/" + "ab/" * 3000, "x.net", "/" + "ab/" * 3000, None, None),
]


def test_rules(spark):
    pages = spark.createDataFrame([(k, c[0], "h", "r") for k, c in enumerate(CASES)], "page_id long, url string, host string, rule string")
    got = {r["page_id"]: r for r in U.judge(pages, catalog.RULES).collect()}
    for k, (url, host, path, rule, verdict) in enumerate(CASES):
        assert (got[k]["host"], got[k]["path"], got[k]["rule"]) == (host, path, rule), url
        assert got[k]["verdict"] == verdict if verdict else got[k]["verdict"] in ("allow", "block")
    check({k: (c[0], c[4]) for k, c in enumerate(CASES)}, got.values())


def test_without_ruled_urls_all_pass(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x"), (1, "http://a.net/x"), (2, None)], "page_id long, url string")
    assert [(r["verdict"], r["score"]) for r in U.judge(pages, catalog.RULES).collect()] == [("allow", 0.0)] * 3
    assert U.judge(pages.limit(0), catalog.RULES).collect() == []


def test_query_equals_a_plain_model(spark, folder):
    pages = catalog.table(spark, folder, "pages")
    rows = {r["page_id"]: (r["url"], r["ruled"]) for r in U.ruled(pages, catalog.RULES).collect()}
    df = catalog.QUERIES["op1_url_filter"](spark, folder)
    check(rows, df.collect())
    assert "Python" not in planned(df) and "Arrow" not in planned(df)


def test_models_tell_hosts_apart(spark):
    rows = [(k, f"http://{'good' if k % 2 else 'spam'}{k % 7}.{'org/en/2' if k % 2 else 'com/de/3'}{k}") for k in range(400)]
    rows += [(900, "http://good3.net/en/2444"), (901, "http://spam5.net/de/3222")]
    got = {r["page_id"]: r["verdict"] for r in U.judge(spark.createDataFrame(rows, "page_id long, url string"), catalog.RULES).collect()}
    assert got[900] == "allow" and got[901] == "block"


def test_many_grams_stay_apart(spark):
    """More grams than 32,768, counted under their own strings; whether broadcast or shuffled."""
    rng = random.Random(5)
    urls = {"".join(rng.choices("abcdefghij/é", k=rng.randint(1, 60))): side for side in ("allow", "block") for _ in range(1500)}
    rows = [(k % (1 << 31), k >> 31, u, int(s == "allow"), int(s == "block")) for k, (u, s) in enumerate(urls.items())]
    table = spark.createDataFrame(rows, "h1 long, h2 long, url string, allow long, block long")
    counts = {}
    places = lambda u: [[(k, c[at - k : at], c[at]) for k in range(U.ORDER + 1)] for c in [("",) * U.ORDER + tuple(u)]
                        for at in range(U.ORDER, len(c))]
    for side in ("allow", "block"):
        n = Counter(g for u, s in urls.items() if s == side for place in places(u) for g in place)
        total, kinds = Counter(), Counter()
        for (k, context, _), x in n.items():
            total[k, context] += x
            kinds[k, context] += 1
        counts[side] = n, total, kinds
    assert len({g for n, _, _ in counts.values() for g in n if g[0] == U.ORDER}) > 1 << 15

    def score(u):
        out = 0.0
        for place in places(u):
            p = dict.fromkeys(counts, 1 / U.ALPHABET)
            for k, context, own in place:
                for side, (n, total, kinds) in counts.items():
                    b = max(kinds[k, context], 1e-9)
                    p[side] = (n[k, context, own] + b * p[side]) / (total[k, context] + b)
            out += math.log(p["allow"]) - math.log(p["block"])
        return out / len(u)

    want = {k: score(r[2]) for k, r in enumerate(rows)}
    ratios = U.log_ratios(U.count_grams(table))
    for limit in (U.BROADCAST, 100):
        got = {r["h1"]: r["score"] for r in U.scores(table, ratios, limit).collect()}
        assert got == pytest.approx(want, abs=1e-9)
