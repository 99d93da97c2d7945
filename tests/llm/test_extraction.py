"""Main text of pages."""

from __future__ import annotations

import re

import numpy as np
import pytest

from telemetry_lake.llm import extraction


@pytest.fixture(scope="module")
def field():
    return extraction.train(extraction.labelled_pages(extraction.TRAINING_PAGES))


def test_held_out_pages(field):
    right = total = 0
    for features, labels in extraction.labelled_pages(200, seed=77):
        right += sum(a == b for a, b in zip(field.decode(features), labels))
        total += len(labels)
    assert right / total > 0.95


def test_viterbi_against_all_sequences():
    rng = np.random.default_rng(0)
    f = extraction.Field(rng.normal(size=(extraction.FEATURES, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
    page = [tuple(rng.integers(0, extraction.FEATURES, 3)) for _ in range(9)]
    s = f.scores(page)

    def worth(y):
        return f.first[y[0]] + sum(s[t, y[t]] for t in range(9)) + sum(f.steps[y[t - 1], y[t]] for t in range(1, 9))

    assert f.decode(page) == max(([k >> t & 1 for t in range(9)] for k in range(512)), key=worth)
    assert f.decode([]) == []


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li><li><a href=/b>News</a></li></ul></nav><!-- ad <p>x</p> -->
<div class="cookie-notice"><p>We use cookies on this site, as all others do.</p></div>
<div class="ad">Buy this now, only today.</div>
<article><h1>The &amp; title</h1><p><b>First   line<br>goes
on.<br><p>Second one with <a href="/x">a link</a> &eacute;t&#233;.</p><blockquote>Quoted words are here.</blockquote></article>
<aside class="sidebar"><h3>More</h3><p>Other things to read on the side.</p></aside>
<section class="comments"><h2>Comments</h2><div class="comment"><p>I do not agree with any of it.</p></div></section>
<form><label>Name</label><input><textarea>x</textarea></form>
<footer>&copy; somebody &middot; all rights.</footer></body></html>"""


def test_page(field):
    assert extraction.main_text(PAGE, field) == "The & title\nFirst line goes on.\nSecond one with a link été.\nQuoted words are here."


def test_table_pages(spark, field):
    """In these pages the article element holds the main text, and all of it."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    same = 0
    for r in extraction.extract(pages, field).collect():
        inside = re.findall(r"<article[^>]*>(.*?)</article>", html[r["page_id"]], re.S)
        want = "\n".join(b.text for x in inside for b in extraction.leaf_blocks(x))
        same += r["text"] == want
        assert r["n_chars"] == len(r["text"])
    assert same >= 0.97 * len(html)


def test_odd_pages(spark, field):
    rows = [(1, None, None), (2, "u", ""), (None, "u", "<p>"), (3, "u", "plain words only, no markup at all here."), (3, "u", "<div" * 300), (4, "u", "<!-- open"), (5, "u", "<script>x"), (6, "u", "<p>a</p>" * 3000)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    assert extraction.extract(pages, field).count() == len(rows)
    assert extraction.extract(pages.limit(0), field).count() == 0


def test_head_without_end_tag(field):
    open_head = PAGE.replace("</head>", "")
    assert extraction.main_text(open_head, field) == extraction.main_text(PAGE, field)
    assert extraction.main_text(open_head.replace("<body>", "").replace("</body>", ""), field) == extraction.main_text(PAGE, field)
    texts = lambda page: [b.text for b in extraction.leaf_blocks(page)]
    assert texts("<head><meta charset=x><title>T</title><link rel=y><template><p>no</p></template>Bare text") == ["Bare text"]
    assert texts("<html><head><base><template>no<body><p>one") == ["one"]


def test_phrases_run_on():
    texts = lambda page: [b.text for b in extraction.leaf_blocks(page)]
    formula = "<math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation>x=2</annotation></semantics></math>"
    assert texts(f"<p>If {formula} then <svg><g><title>t</title><text>no</text></g></svg>so.</p><p>Next") == ["If x=2 then so.", "Next"]
    assert texts("<p>a <ruby>b<rp>(</rp><rt>c</rt><rp>)</rp></ruby> <nobr>d e</nobr><script>x</script> f</p>") == ["a b(c) d e f"]
    assert texts("<p>a <template><div>no</div></template>b <svg><g></p><p>c") == ["a b", "c"]


def test_features_of_all_ancestors(field):
    thread = "<ol><li><article><div>" * 4
    page = f'<article><p>The main text of this page is here, in one line.</p></article><section class="a b c d e f g h comments">{thread}<p>A reply far below in the thread, of a few words.</p>'
    deep = extraction.leaf_blocks(page)[-1]
    assert len(deep.path) > 13
    assert {extraction._feature("t=section"), extraction._feature("c=comments")} <= set(extraction.block_features(deep))
    footer = "<footer>" + "<div>" * 15 + "<p>Words at the end of this page, and a few more."
    assert extraction._feature("t=footer") in extraction.block_features(extraction.leaf_blocks(footer)[0])
