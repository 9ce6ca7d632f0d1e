import re

import numpy as np
import pytest

from ringwise.llm import html_text as H

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header><div class="logo">My Site</div>
<nav><a href=1>Home</a> <a href=2>About</a></nav></header><div class="cookie-notice">We use cookies &amp; more.</div>
<article><h1>The title</h1><p>First &eacute;t&eacute; with <a href=x>a link</a>&nbsp;inside.</p><div class="advertisement">Buy now, it is cheap</div>
<p>Second<br>line<p>Third one<script>var a="<p>no</p>";</script><!-- <p>hidden</p> --><form><label>Your name</label></form>
<section class="comments"><p>Great article, thanks!</p></section></article><aside class="sidebar"><p>Other things to read</p></aside>
<footer>&copy; someone</footer></body></html>"""


@pytest.fixture(scope="module")
def net(spark):
    return H.learn(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def article(html):
    """The article of a test page by plain text search."""
    body = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    import html as h

    parts = [" ".join(h.unescape(re.sub(r"<br>|</?b>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", body)]
    return "\n".join(p for p in parts if p)


def test_pages_equal_their_articles(spark, net):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    rows = H.extract(pages, net).collect()
    assert len(rows) == len(html)
    for r in rows:
        assert r["text"] == article(html[r["page_id"]]) and r["n_chars"] == len(r["text"])


def test_other_markup(net):
    found = H.blocks(PAGE)
    main = [b.text for b, m in zip(found, net.label([found])[0], strict=True) if m]
    assert main == ["The title", "First été with a link inside.", "Second line", "Third one"]


def test_held_out_blocks(spark, net):
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").limit(300).collect()]
    found = [H.blocks(p) for p in pages]
    right = sum(int((m == [H.weak_label(b) for b in p]).sum()) for p, m in zip(found, net.label(found), strict=True))
    assert right / sum(map(len, found)) > 0.999


def test_gradients():
    rng = np.random.default_rng(1)
    net = H.Network.fresh(rng)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    x, mask, y = rng.normal(size=(2, 4, H.INPUTS)), np.array([[1, 1, 1, 1], [1, 1, 0, 0]], float), rng.integers(0, 2, (2, 4)).astype(float)

    def loss():
        s = net.forward(x, mask)[0]
        return float(((np.log1p(np.exp(s)) - y * s) * mask).sum() / mask.sum())

    grad = net.gradients(x, y, mask)
    for k in net.w:
        for at in rng.integers(0, net.w[k].size, 3):
            flat, old = net.w[k].reshape(-1), net.w[k].reshape(-1)[at]
            flat[at] = old + 1e-4
            up = loss()
            flat[at] = old - 1e-4
            down = loss()
            flat[at] = old
            assert abs((up - down) / 2e-4 - grad[k].reshape(-1)[at]) < 1e-3


def test_odd_rows(spark, net):
    rows = [(1, None, None, 7), (2, "u", "", 7), (None, "u", "<p", 7), (4, "u", "no markup at all", 7), (5, "u", "<article><p>" + "word " * 20_000 + "</article>", 7), (6, "u", "<article>" * 300 + "x", 7)]
    df = spark.createDataFrame(rows * 2, "page_id long, url string, html string, text int")
    out = sorted(((r["page_id"] or 0, r["url"] or "", r["text"], r["n_chars"]) for r in H.extract(df, net).collect()), key=str)
    assert len(out) == 12 and all(len(t) == n for _, _, t, n in out)
    assert [t for i, _, t, _ in out if i in (1, 2)] == [""] * 4
    empty = df.limit(0)
    assert H.learn(empty) is None and H.extract(empty, None).collect() == [] and H.extract(df, None).where("n_chars > 0").count() == 0


def test_sample_is_of_distinct_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").orderBy("page_id").limit(5).select("html")
    copies = pages.crossJoin(spark.range(400)).select("html")
    once, found = H.sample(pages, sample_pages=5), H.sample(copies, sample_pages=5)
    assert len(found) == 5 and [[b.text for b in p] for p in found] == [[b.text for b in p] for p in once]
    assert H.learn(copies, sample_pages=5) is not None


def test_long_and_blank_pages_in_the_sample(spark):
    paragraphs = "".join(f"<p>Paragraph {i} of a long page, with words enough. {'word ' * 200}</p>" for i in range(60))
    long = [f"<html><body><nav><a href=x>Home {k}</a></nav><article>{paragraphs}</article><footer>Legal {k}</footer></body></html>" for k in range(8)]
    assert all(len(p) > 32_768 for p in long)
    df = spark.createDataFrame([(p,) for p in [*long, *(f"<div id={i}></div>" for i in range(2_000)), None, ""]], "html string")
    found = H.sample(df, sample_pages=4)
    assert len(found) == 4 and all(p[0].text.startswith("Home") and p[-1].text.startswith("Legal") for p in found)
    assert all(sum(len(b.text) for b in p) <= 32_768 and len(p) <= H.SAMPLE_BLOCKS and all(b.text in paragraphs for b in p[1:-1]) for p in [[H.Block(b.path, b.text.strip(), 0) for b in p] for p in found])
    texts = [r["text"] for r in H.extract(df, H.learn(df)).collect()]
    assert sum("Paragraph 59" in t and "Home" not in t and "Legal" not in t for t in texts) == 8
    huge = H.excerpt([H.Block(("p",), "é" * 100_000, 100_000)], 1_000)
    assert len(huge) == 1 and len(huge[0].text.encode()) <= 1_000 and huge[0].linked == len(huge[0].text)


def test_query_joins_blocks_by_two_line_feeds(spark):
    from ringwise.llm.queries import QUERIES

    html = {r["page_id"]: r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    rows = QUERIES["op6_html_extraction"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(html) and any("\n\n" in r["text"] for r in rows)
    for r in rows:
        assert r["text"] == article(html[r["page_id"]]).replace("\n", "\n\n") and r["n_chars"] == len(r["text"])


def test_quotes_in_attributes():
    texts = lambda page: [b.text for b in H.blocks(page)]
    assert texts("<p title=it's>First part.</p><p>Second.</p><p>They don't know.</p>") == ["First part.", "Second.", "They don't know."]
    assert texts("<p title=it's>First.</p><p it's \"odd>Second.</p>") == ["First.", "Second."]
    assert texts("<p title='a>b' id = \"c>d\"e='f>g'>One</p><p title=a=\"b>Two</p><p class=\"open>Three</p>") == ["One", "Two", "Three"]
    assert texts("<p title=>One</p><p><a href=x/>Two</a></p><p title= 'a>b'>Three</p>") == ["One", "Two", "Three"]
    assert texts("<p>a</p>" + "<p " + "a=\"b\" " * 20_000)[0] == "a"


def test_containers_of_unknown_names(spark, net):
    """Pages whose containers are named at random keep their main text, and so does one of other blocks."""
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").orderBy("page_id").limit(300).collect()]
    found = [b for b in map(H.blocks, pages) if b]
    truth = [[H.weak_label(b) for b in p] for p in found]
    rng = np.random.default_rng(8)
    got = net.label([H._renamed(p, rng) for p in found])
    main = sum(sum(t) for t in truth)
    kept = sum(int((g & np.array(t)).sum()) for g, t in zip(got, truth, strict=True))
    wrong = sum(int((g & ~np.array(t)).sum()) for g, t in zip(got, truth, strict=True))
    assert kept >= 0.97 * main and wrong <= 0.03 * main
    body = "".join(f"<p>{'Words of a paragraph that is long enough to be text. ' * 6}{i}</p>" for i in range(5))
    menu = "<ul><li><a href=a>Main page</a></li><li><a href=b>Contents</a></li></ul>"
    page = f"<html><body><div class=x1>{menu}</div><div class=x2><h1>Title here</h1>{body}</div><div class=x3><p><a href=c>Privacy About</a></p></div></body></html>"
    labelled = dict(zip([b.text for b in H.blocks(page)], net.label([H.blocks(page)])[0], strict=True))
    assert sum(bool(v) for t, v in labelled.items() if t.startswith("Words")) == 5
    assert not any(labelled[t] for t in ("Main page", "Contents", "Privacy About"))
