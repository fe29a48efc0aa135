"""Block reading, the labeller on pages it has not met, and the operator's odd rows."""

from __future__ import annotations

import re
from html import unescape

import numpy as np
import pytest

from slotwise.llm import block_labeller as B
from slotwise.llm import html_extract as H
from slotwise.llm import html_layouts as L
from slotwise.llm.html_blocks import Paths, read
from slotwise.llm.queries import queries

SMALL = "/root/testdata/sf0.01"


def texts(html):
    return [b.text for b in read(html)]


@pytest.mark.parametrize("html,want", [
    ("", []), ("plain", ["plain"]), ("<p>a<p>b", ["a", "b"]), ("<p>a <b>b</b>c<br>d</p>", ["a bc d"]),
    ("<script>var t='</p><p>x</p>';</script><p>y", ["y"]), ("<style>p{}</style><!-- <p>no</p> -->z", ["z"]), ("<p>a &amp; b &lt;i&gt; &#233;&nbsp;x", ["a & b <i> é x"]),
    ("a < b > c", ["a < b > c"]), ('<a title="x > y" href=z>link</a> t', ["link t"]), ("<ul><li>a<li>b</ul>c", ["a", "b", "c"]),
    ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]), ("</p></div>x</b>", ["x"]), ("<p>a<script>never closed", ["a"]),
    ("<p>a<!-- never closed", ["a"]), ("<p>a<b", ["a"]), ("<template><p>a</p></template>b", ["b"]), ("<head><title>t</title></head>b", ["b"]),
    ("<P CLASS=x>A</P><Br/>b", ["A", "b"]), ("a\n\t \x0c b", ["a b"]), ("<p> </p>", []),
])
def test_blocks(html, want):
    assert texts(html) == want


def test_deep_and_unclosed_pages_stay_linear():
    n = 30_000
    assert texts("<div>" * n + "x") == ["x"]
    assert texts("<b>" * n + "x" + "</i>" * n) == ["x"]
    assert len(texts("<p>a" * n)) == n


@pytest.fixture(scope="module")
def weights(spark):
    return H.fitted(H.sampled(spark.read.parquet(f"{SMALL}/pages.parquet")))


def article(html: str) -> str:
    """The article of a driver page by a pattern: all blocks inside ``<article>``."""
    inside = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    parts = re.split(r"</?(?:p|h1|h2|ul|li|div|blockquote)\b[^>]*>", inside)
    clean = [" ".join(unescape(re.sub(r"<br>", " ", p).replace("<b>", "").replace("</b>", "")).split()) for p in parts]
    return " ".join(c for c in clean if c)


def test_every_page_of_the_table(spark):
    html = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    got = queries()["op11_html_extraction"](spark, SMALL).collect()
    assert len(got) == len(html)
    for r in got:
        assert r["n_chars"] == len(r["text"])
    assert sum(r["text"] == article(html[r["page_id"]]) for r in got) >= 0.99 * len(got)


def test_generated_layouts_held_out(spark, weights):
    texts = [b.text for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect() for b in read(r["html"])]
    layouts, paths = L.Layouts(texts, np.random.default_rng(2024)), Paths()
    pages = [L.marked(layouts.page(), paths) for _ in range(300)]
    scores = B.label(weights, B.Features(), [b for b, _ in pages])
    wrong = sum(((s >= 0.5) != y).sum() for s, (_, y) in zip(scores, pages, strict=True))
    assert wrong <= 0.02 * sum(len(y) for _, y in pages)


UNSEEN = """<!doctype html><html><head><title>Site</title></head><body class=home><div id=cookie-consent><p>We use cookies to improve your visit.
<button>Accept</button></div><header class="site-header"><a href=/>The Gazette</a><ul class=main-menu><li><a href=/a>News</a><li><a href=/b>Sport</a></ul></header>
<div class="content-wrapper"><div class="post-body"><h1>Rivers rise again</h1><p>The rivers rose for the third time this year, and the towns along them
made ready.</p><div class="advertisement"><p>Buy boots today at half the price.</p></div><p>Nobody was hurt, the mayor said on <a href=x>Monday</a>.</p>
<ul><li>First, the dam held.</li><li>Second, the bridge did not.</li></ul></div><div class="comments-area"><h3>2 comments</h3><div class=comment><p>I saw the
bridge go down myself, it was quite a sight to see.</p></div></div></div><aside class="sidebar"><h3>Most read</h3><ul><li><a href=1>Ten towns to visit</a></ul></aside>
<form class="newsletter"><label>Your e-mail</label><button>Subscribe</button></form><footer>&copy; 2024 The Gazette</footer>"""


def test_a_page_written_by_hand(weights):
    blocks = read(UNSEEN)
    kept = [b.text for b, s in zip(blocks, B.label(weights, B.Features(), [blocks])[0], strict=True) if s >= 0.5]
    assert kept == [
        "Rivers rise again", "The rivers rose for the third time this year, and the towns along them made ready.",
        "Nobody was hurt, the mayor said on Monday.", "First, the dam held.", "Second, the bridge did not.",
    ]


def test_long_pages_carry_states(weights, monkeypatch):
    blocks = read(UNSEEN)
    whole = B.label(weights, B.Features(), [blocks])[0]
    monkeypatch.setattr(B, "SPAN", 4)
    assert np.allclose(B.label(weights, B.Features(), [blocks])[0], whole, atol=1e-4)


def test_odd_rows(spark, weights):
    rows = [(1, "u", None), (1, "u", ""), (None, None, "<p>"), (2, "u", UNSEEN), (2, "u", UNSEEN), (3, "u", "<p>" + "word " * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS blocks", "3 AS n_chars", "4 AS `a.b`")
    got = H.extract(pages, weights)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    found = got.collect()
    assert len(found) == len(rows)
    assert sorted(r["n_chars"] for r in found if r["page_id"] in (1, None)) == [0, 0, 0]
    two = [r["text"] for r in found if r["page_id"] == 2]
    assert len(two) == 2 and two[0] == two[1] and "Rivers rise" in two[0] and "cookies" not in two[0]
    assert H.extract(pages.limit(0)).count() == 0
    assert H.extract(spark.createDataFrame([(1, "u", None)], "page_id long, url string, html string")).first()["text"] == ""
