import html
import itertools
import re
import time

import numpy as np
import pytest

from chainfeatures.llm import ann as A
from chainfeatures.llm import html_text as H
from chainfeatures.llm.labelled_pages import labelled_pages


@pytest.fixture(scope="module")
def model():
    return H.train()


def test_marginals_equal_enumeration(model):
    p = H.Page("<body><nav><ul><li><a>x</a></li></ul></nav><article><h1>T</h1><p>one</p><div class=ad>buy</div></article></body>")
    u = np.array(p.features()) @ model.weights[:-1] + model.weights[-1]
    n, total, on = len(p.parent), 0.0, np.zeros(len(p.parent))
    for s in itertools.product((0, 1), repeat=n):
        v = sum(u[k] * s[k] for k in range(n)) + sum(model.pair[p.kind(k)][s[p.parent[k]]][s[k]] for k in range(1, n))
        total += np.exp(v)
        on += np.exp(v) * np.array(s)
    assert np.allclose(model.marginals(p, u), on / total, atol=1e-9)


def test_held_out_labelled_pages(model):
    ok = total = 0
    for s in labelled_pages(150, seed=77):
        p = H.Page(s)
        q = model.marginals(p, np.array(p.features()) @ model.weights[:-1] + model.weights[-1])
        for k, _ in p.blocks:
            total += 1
            ok += (q[k] > 0.5) == p.label[k]
    assert ok / total > 0.98


def expected(h):
    """Main text of the pages of the test tables, whose template is known."""
    a, b = h.index("<article>") + 9, h.find("</article>")
    body = h[a:b if b >= 0 else h.index("<footer>")]
    out = [" ".join(html.unescape(re.sub("<[^>]+>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
    return "\n".join(x for x in out if x)


def test_pages_of_the_tables(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r["page_id"]: expected(r["html"]) for r in pages.collect()}
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in H.op8_html_text(spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == len(want) and np.mean([got[i] == (t, len(t)) for i, t in want.items()]) > 0.99


def test_parser_repairs(model):
    p = H.Page('<div><p>a &amp; b<p>c<br>d<ul><li>1<li>2</ul><script>x="</p>"</script><!-- <p>no --><td>e</div>f < g <a href="x>y">h</a>')
    assert [t for _, t in p.blocks] == ["a & b", "c d", "1", "2", "e", "f < g h"]
    for bad in ("", "<", "<<<>>>", "<p", "</div></div>", "<script>", "<!--", "&#0;&bogus;", "<a b='", "x" * 10, "<div>" * 3000 + "deep"):
        model.extract([bad])
    assert model.extract(["", None, "<script>x</script>"]) == ["", "", ""]


def texts(s):
    return [t for _, t in H.Page(s).blocks]


def test_attributes_end_as_in_the_standard():
    assert texts("<article><p title=it's>one</p><p>two isn't</p><p>three</p></article>") == ["one", "two isn't", "three"]
    assert texts("<p a'b=\"c>d\" e = 'f>g' h=i\"j>k</p><p \">l</p><p class=\"m>n</p>") == ["k", "l", "n"]
    assert texts("<p/a=b/>x<p a= >y<p a==\"b>z") == ["x", "y", "z"]
    p = H.Page("<div class='side bar' id=nav/1 title=it's role=\"x\">t</div>")
    assert p.attrs[1] == "side bar nav/1 x"


@pytest.mark.parametrize("name", sorted(H.HIDDEN))
def test_hidden_elements_never_take_the_article(name):
    rest = "<p>two</p><ul><li>three</ul>"
    assert texts(f"<article><p>one</p><{name}>{rest}</article><p>four") == ["one", "two", "three", "four"]  # unclosed
    assert texts(f"<article><p>one</p><{name}>no<p>no</p></{name}>{rest}</article>") == ["one", "two", "three"]
    assert texts(f"<p>one</p><{name}>no<{name}>no</{name}>no</{name}><p>two") == ["one", "two"]  # nested
    assert texts(f"<article><p>one</p><{name}>{rest}</article><div><{name}>no</{name}>four</div>") == ["one", "two", "three", "four"]  # end tag of a later one
    assert texts(f"<p>one</p><{name}/><p>two</p></{name}><p>three") == ["one", "two", "three"]


def test_raw_text_elements():
    assert texts("<title>a<b></title ><p>x<script>if (a < b) '</p>'</SCRIPT\n>y</p><style>p</style><textarea><p>no</textarea>z") == ["xy", "z"]
    assert texts("<p>x</p><textarea><p>y</p><iframe><p>z</p>") == ["x", "y", "z"]  # no end tag: only the tag goes
    assert texts("<p>x</p><script>var a = '<p>y</p>'") == ["x"]
    assert texts("<p>a<!-->b<!--->c<!-- <p>no --->d") == ["abcd"]


@pytest.mark.parametrize("s", ["<div>" * 20000 + "</section>" * 20000, "<table><td><table>" + "<div>" * 20000 + "<td>" * 20000, "<a <a " * 30000,
                               "<a b='" * 30000, "<svg>" * 20000 + "</div>" * 20000, "<textarea>" * 20000, "<" * 50000])
def test_broken_pages_take_linear_time(s):
    t = time.time()
    H.Page(s)
    assert time.time() - t < 2


def test_unseen_page(model):
    page = """<html><body><div id="cookie-consent"><p>We use cookies.</p></div><header><h2>Site</h2></header><main><article><h1>Title</h1>
    <p>First  paragraph
    here.</p><aside class="related"><ul><li><a href=1>More news</a></li></ul></aside><p>Second &eacute;t&eacute;.</p></article>
    <section class="comments"><div class="comment"><p>I disagree with this.</p></div></section></main><form><label>Mail</label></form><footer><p>Imprint</p></footer></body></html>"""
    assert model.extract([page]) == ["Title\nFirst paragraph here.\nSecond été."]


def test_html_edges(spark):
    df = spark.createDataFrame([(1, None, None, "x"), (2, "u", "", "x"), (None, "u", "<p>a</p>", "x"), (2, "u", "", "x")], "page_id long, url string, html string, text string")
    rows = H.extract_pages(df).collect()
    assert len(rows) == 4 and all(r["text"] is not None and r["n_chars"] == len(r["text"]) for r in rows)
    assert H.extract_pages(df.limit(0)).count() == 0


def brute(x, k):
    out = {}
    for q in [i for i in x if i % 20 == 0]:
        s = sorted(((-float(np.dot(x[q], x[j])), j) for j in x if j != q))[:k]
        out[q] = s
    return out


def test_recall_and_scores(spark):
    e = {r["vec_id"]: np.array(r["embedding"], float) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()}
    got = A.op6_ann(spark, "/root/testdata/sf0.1").toPandas().sort_values(["query_id", "rank"])
    hit = total = 0
    for q, g in got.groupby("query_id"):
        ids, s = list(e), np.array([np.dot(e[q], v) for v in e.values()])
        s[ids.index(q)] = -np.inf
        want = {ids[k] for k in np.argsort(-s)[:20]}
        hit += len(want & set(g["vec_id"]))
        total += 20
        assert list(g["rank"]) == list(range(1, 21)) and g["vec_id"].is_unique and q not in set(g["vec_id"])
        assert np.allclose(g["score"], [np.dot(e[q], e[i]) for i in g["vec_id"]], atol=1e-12)
        assert (np.diff(g["score"]) <= 0).all()
    assert len(got) == 20 * len([i for i in e if i % 20 == 0]) and hit / total >= 0.9


def test_ann_edges(spark, monkeypatch):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, []), (9, [1.0, 2.0, 3.0]),
            (20, [0.5, 0.5]), (40, [0.0, 0.0]), (None, [1.0, 1.0]), (11, [-1.0, 0.0])]
    df = spark.createDataFrame([(i, v, 1.0, 1) for i, v in rows], "vec_id long, embedding array<double>, score double, leaf int")
    got = sorted(tuple(r) for r in A.nearest(df, lambda i: i % 20 == 0, 3).collect())
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 20, 0.5), (20, 1, 0, 0.5), (20, 2, 1, 0.5), (20, 3, 2, 0.5)]
    assert A.nearest(df.limit(0), lambda i: i % 20 == 0).count() == 0
    monkeypatch.setattr(A, "BLOCK", 2)  # a hot leaf in many blocks gives the same
    assert sorted(tuple(r) for r in A.nearest(df, lambda i: i % 20 == 0, 3).collect()) == got


def test_best_bins_visit_every_leaf_once():
    x = np.random.default_rng(0).normal(size=(900, 6))
    t = A.Tree(x, 30)
    order = t.best_bins(x[5], t.n_leaves)
    assert sorted(order) == list(range(t.n_leaves)) and t.n_leaves > 20
    assert order[0] == t.assign(x[5:6])[0] or order.index(t.assign(x[5:6])[0]) < 4


def test_queries_in_small_leaves_get_all_their_rows(spark):
    """Six common vectors that fill a leaf each, so that one visit is enough for nearly all, and two small outlying
    leaves: five rows, and 24 rows of one id with one other."""
    axes = np.eye(8)
    rows = [(i, 4 * axes[i % 6]) for i in range(6 * 390)]
    rows += [(i, -5 * axes[6]) for i in range(10_000, 10_005)] + [(10_020, -5 * axes[7])] * 24 + [(10_021, -5 * axes[7])]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id long, embedding array<double>")
    x = np.stack([v for _, v in rows])
    t = A.Tree(A.augment(x, 5.0), A.LEAF)
    assert sorted(np.bincount(t.assign(A.augment(x, 5.0))))[:3] == [5, 25, 390]
    got = A.nearest(df, lambda i: i % 20 == 0, k=20).toPandas()
    n = got.groupby("query_id").size()
    assert set(n.index) == {i for i, _ in rows if i % 20 == 0} and (n == 20).all(), n[n < 20]
    assert (got["query_id"] != got["vec_id"]).all()
    assert set(got[(got["query_id"] == 10_000) & (got["rank"] <= 4)]["vec_id"]) == {10_001, 10_002, 10_003, 10_004}
    assert set(got[(got["query_id"] == 10_020) & (got["rank"] == 1)]["vec_id"]) == {10_021}


def test_best_bins_go_on_until_they_hold_enough():
    x = np.random.default_rng(0).normal(size=(900, 6))
    t = A.Tree(x, 30)
    sizes = np.bincount(t.assign(x), minlength=t.n_leaves).tolist()
    whole = t.best_bins(x[5], t.n_leaves)
    for least in (0, 1, 40, 200, 900, 10**6):
        got = t.best_bins(x[5], 2, sizes, least)
        assert got == whole[:len(got)] and len(got) >= 2
        assert sum(sizes[i] for i in got) >= min(least, 900)
        assert len(got) == 2 or sum(sizes[i] for i in got[:-1]) < least
