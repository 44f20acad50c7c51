"""Leaf blocks of odd pages, gradients against differences, and held-out layouts."""

from __future__ import annotations

import numpy as np
import pytest

from shelfcast.llm import catalog
from shelfcast.llm import html_blocks as H


def texts_of(page):
    return [b.text for b in H.leaves(page)]


def test_blocks_of_odd_pages():
    assert texts_of("") == [] and texts_of("<p></p><div> \n</div>") == []
    assert texts_of("just  text\n&amp; more &lt;3 &#233;&nbsp;x") == ["just text & more <3 é x"]
    assert texts_of("<p>a<b>b</b>c<br>d<p>e<i>f") == ["abc d", "ef"]
    assert texts_of("<script>var x='</p>';</script><style>p{}</style><!-- c --><p>x</p><!-- open") == ["x"]
    assert texts_of("<head><title>T & </title><meta x></head><body><p>x</body>") == ["x"]
    assert texts_of("<title>T<p>x") == [] and texts_of("<script>never closed") == []
    assert texts_of("1 < 2 and <p class='a>b'>x</p> <notclosed") == ["1 < 2 and", "x", "<notclosed"]
    assert texts_of("<ul><li>a<li>b<ul><li>c</ul><li>d</ul></ul></div>e") == ["a", "b", "c", "d", "e"]
    assert texts_of("<svg><p>no</p></svg><select><option>no</select><button>no</button><P>Yes") == ["Yes"]
    leaf = H.leaves("<div id='Main-Box' class=\"Side bar\"><p role=note>x <a href=1>yy</a></p></div>")[0]
    assert leaf.path == ("div", ".main", ".box", ".side", ".bar", "p", ".note") and leaf.linked == pytest.approx(0.5)


@pytest.mark.parametrize(("page", "blocks"), [
    ("<head><title>x</title><p>text</p>", ["text"]),
    ("<html><head><meta charset=x><link href=y><title>t</title>\n<!-- c -->\n<h1>a</h1><p>b", ["a", "b"]),
    ("<head><style>p{}</style> words <p>b", ["words", "b"]),
    ("<head><noscript><p>no</p></noscript><script>no</script></head><p>b", ["b"]),
    ("<head><noscript>no<body><p>b", ["b"]),
    ("<p>a <button>b<p>rest</p>", ["a", "rest"]),
    ("<p>a <button>b</p><p>rest <button>no</button></p>", ["a", "rest"]),
    ("<div><button><p>no</p><p>no<p>no</div></button> a</div>", ["a"]),
    ("<p>a</p><svg><p>rest</p>", ["a", "rest"]),
    ("<p>a</p><svg><svg><p>no</svg>no</svg><p>rest</p>", ["a", "rest"]),
    ("<td>a <select><option>no<option>no<hr>no<tr><td>b", ["a", "b"]),
    ("<div>a <noscript>no</div><p>rest", ["a", "rest"]),
    ("<p>x <math><mi>y</mi></math> z <object>o</object><canvas>c</canvas></p>", ["x y z oc"]),
    ("<div>a " * 3 + "<svg>" * 3 + "</div>b", ["a", "a", "a", "b"]),
])
def test_what_is_left_open_hides_no_text(page, blocks):
    assert texts_of(page) == blocks


def plain_scores(p, blocks):
    """The labeller as loops over blocks, gates and inputs."""
    def sigmoid(z):
        return 1 / (1 + np.exp(-z))

    rows = []
    for k, b in enumerate(blocks):
        words = b.text.lower().split()
        names = [sum(p["names"][H._hash(x)][d] for x in b.path) for d in range(H.PATH_SIZE)]
        word = [sum(p["words"][H._hash(w)][d] for w in words) / max(1, len(words)) for d in range(H.WORD_SIZE)]
        n = max(1, len(blocks) - 1)
        rows.append([*names, *word, np.log1p(len(b.text)) / 6, b.linked, k / n, float(k == 0), float(k == n),
                     float(k > 0 and blocks[k - 1].path == b.path), float(b.text[-1:] in ".!?:;…"), min(len(b.path), 20) / 10])
    states = {}
    for way, order in (("forth", range(len(rows))), ("back", reversed(range(len(rows))))):
        w, bias, h, c = p[f"{way}_w"], p[f"{way}_b"], [0.0] * H.HIDDEN, [0.0] * H.HIDDEN
        for t in order:
            given = [*rows[t], *h]
            z = [bias[g] + sum(given[d] * w[d][g] for d in range(len(given))) for g in range(4 * H.HIDDEN)]
            i, f, o, fresh = (z[g * H.HIDDEN : (g + 1) * H.HIDDEN] for g in range(4))
            c = [sigmoid(f[u]) * c[u] + sigmoid(i[u]) * np.tanh(fresh[u]) for u in range(H.HIDDEN)]
            h = [sigmoid(o[u]) * np.tanh(c[u]) for u in range(H.HIDDEN)]
            states[way, t] = h
    return [sum(a * x for a, x in zip([*states["forth", t], *states["back", t]], p["out"])) + p["bias"][0] for t in range(len(rows))]


def test_extraction_equals_a_plain_labeller(spark, folder):
    pages = catalog.table(spark, folder, "pages")
    labeller = H.Labeller(11)
    some = pages.orderBy("page_id").limit(6)
    odd = spark.createDataFrame([(-1, "u", None), (-2, "u", ""), (-3, "u", "<ul><li>a b<li>c.</ul><p>d"), (-3, "u", "no markup")], some.schema)
    both = some.unionByName(odd)
    plain = {k: v.astype(np.float64).tolist() for k, v in labeller.p.items()}
    expected = []
    for r in both.collect():
        blocks = H.leaves(r["html"] or "")
        scores = plain_scores(plain, blocks) if blocks else []
        assert all(abs(x) > 1e-5 for x in scores)
        expected.append((r["page_id"], " ".join(b.text for b, x in zip(blocks, scores) if x > 0)))
    got = [(r["page_id"], r["text"]) for r in H.extract(both, labeller, ["page_id", "url"]).collect()]
    assert sorted(got) == sorted(expected) and any(t for _, t in got)


def test_a_long_page_is_read_whole():
    page = "<article>" + "<p>Some words.</p>" * 20_000 + "<p>" + "x " * 200_000 + "</p></article>"
    blocks = H.leaves(page)
    assert len(blocks) == 20_001 and len(blocks[-1].text) == 399_999
    assert H.Labeller().label([blocks, []])[0].shape == (20_001,)


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    labeller = H.Labeller()
    labeller.p = {k: v.astype(np.float64) for k, v in labeller.p.items()}
    pages = [H.leaves("<nav><a>m n</a></nav><article><h1>a b</h1><p>c d e.</p></article><footer>f</footer>"), H.leaves("<p>x</p><div class=ad>y z</div>")]
    batch = [(H.Features(b), rng.random(len(b)) > 0.5) for b in pages]
    _, g = labeller.gradients(batch)
    for name, own in labeller.p.items():
        flat = own.reshape(-1)
        for k in rng.choice(np.flatnonzero(np.abs(g[name].reshape(-1)) > 1e-7), 5):
            kept = flat[k]
            flat[k] = kept + 1e-3
            up = labeller.gradients(batch)[0]
            flat[k] = kept - 1e-3
            down = labeller.gradients(batch)[0]
            flat[k] = kept
            assert (up - down) / 2e-3 == pytest.approx(g[name].reshape(-1)[k], rel=0.05, abs=1e-5)


def test_batches_do_not_change_labels():
    labeller = H.Labeller(5)
    pages = [H.leaves("<p>a</p>" * n + "<div class=ad>b</div>") for n in (1, 2, 3, 30, 31, 7)]
    alone = [labeller.label([p])[0].tolist() for p in pages]
    assert [x.tolist() for x in labeller.label(pages)] == alone


@pytest.fixture(scope="module")
def labeller(spark, folder):
    return H.train(H.training_pages(catalog.table(spark, folder, "pages")))


OTHER = """<html><body><header><h1>Site name</h1></header><nav><a href=x>Home</a> <a href=y>About us</a></nav>
<div class="cookie-notice">We use cookies to improve things.</div><main><article><h1>A title of words</h1>
<p>First paragraph of the article, with many words.</p><div class="ad">Buy this now</div><p>Second &amp; last paragraph of it.</p></article></main>
<section class="comments"><h2>Comments</h2><div class="comment">I do not agree with this</div></section>
<aside class="sidebar"><p>Popular posts</p></aside><form><p>Subscribe here</p></form><footer><p>All rights reserved</p></footer></body></html>"""


def test_query_extracts_every_article(spark, folder):
    pages = catalog.table(spark, folder, "pages")
    got = {r["page_id"]: r for r in catalog.QUERIES["op10_html_text"](spark, folder).collect()}
    for row in pages.collect():
        want = " ".join(b.text for b in H.leaves(row["html"]) if H.taught(b))
        assert got[row["page_id"]]["text"] == want and got[row["page_id"]]["n_chars"] == len(want)
        assert got[row["page_id"]]["url"] == row["url"]


def test_other_layouts_and_odd_rows(spark, labeller):
    rows = [(1, "u", OTHER), (2, None, None), (3, "u", ""), (1, "u", OTHER), (4, "u", "<nav></nav>")]
    df = spark.createDataFrame([(*r, 5, "t") for r in rows], "page_id long, url string, html string, n_chars int, text string")
    got = sorted(map(tuple, H.extract(df, labeller, ["page_id", "url"]).collect()), key=str)
    text = "A title of words First paragraph of the article, with many words. Second & last paragraph of it."
    assert got == sorted([(1, "u", text, len(text))] * 2 + [(2, None, "", 0), (3, "u", "", 0), (4, "u", "", 0)], key=str)
    assert H.extract(df.limit(0), labeller, ["page_id"]).collect() == []


def test_held_out_layouts(spark, folder, labeller):
    rng = np.random.default_rng(123)
    pages = [H.leaves(r["html"]) for r in catalog.table(spark, folder, "pages").collect()]
    made = [H.rendered([b for b in p if H.taught(b)][:25], "home about the contact of some words in here".split() * 5, rng) for p in pages]
    labels = labeller.label([m[0] for m in made])
    assert np.mean(np.concatenate([a == y for a, (_, y) in zip(labels, made)])) > 0.98


def test_made_layouts_teach_without_pages():
    labeller = H.train([])
    blocks = H.leaves(OTHER)
    assert np.mean(labeller.label([blocks])[0] == np.array([H.taught(b) for b in blocks])) > 0.9
