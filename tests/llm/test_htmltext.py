import html as entities
import itertools
import re
import time

import numpy as np
from pyspark.sql import functions as F

from loomsift.llm import htmltext


def brute_labels(field, page):
    """The labelling of highest score among all."""
    def total(y):
        s = field.start[y[0]] + sum(field.emission(*b) for b, v in zip(page, y) if v)
        return s + sum(field.pairs[a][b] for a, b in zip(y, y[1:]))

    return list(max(itertools.product((0, 1), repeat=len(page)), key=total))


def test_viterbi_against_all_labellings():
    field = htmltext.default_field()
    for page, _ in htmltext.labelled_pages(60, seed=5):
        for at in range(0, len(page), 10):
            part = page[at : at + 10]
            assert field.labels(part) == brute_labels(field, part)


def test_held_out_pages():
    field = htmltext.default_field()
    pages = htmltext.labelled_pages(150, seed=77)
    right = [p == q for page, y in pages for p, q in zip(field.labels(page), y)]
    assert np.mean(right) > 0.97


def test_blocks():
    page = """<html><head><title>t</title></head><body>A&amp;B&nbsp; c<b>d</b>e<script>if (a</p>b) x</script>
    <div class='Ad-Box' id=side><p>one<p>two <a href="x>y">li<i>n</i>k</a><br>three<!-- <p>no --></div><ul><li>x<li>y</ul>&lt;p&gt;<p hidden>h"""
    assert [(t, p[-1]) for p, t, _ in htmltext.blocks(page)] == [("A&B cde", "body"), ("one", "p"), ("two link", "p"), ("three", "p"), ("x", "li"), ("y", "li"), ("<p>", "body"), ("h", "p:hidden")]
    assert htmltext.blocks(page)[1][0][-2] == "div:ad:box:side"
    assert htmltext.blocks(None) == htmltext.blocks("") == htmltext.blocks("<p> </p><!-- x") == []


def test_query_against_the_markup(spark, sf_dir):
    """The tables' pages keep their text in one article element."""
    want = {}
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        text = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)>", " ", article))
        want[r.page_id] = (r.url, " ".join(entities.unescape(text).split()))
    rows = htmltext.op2_html_extraction(spark, sf_dir).collect()
    assert {r.page_id: (r.url, r.text) for r in rows} == want
    assert all(r.n_chars == len(r.text) for r in rows)


def test_edge_rows(spark):
    rows = [(1, None, None), (2, "u", ""), (3, "u", "<article><p>Some text of it, here.</p></article>"), (3, "u", "<article><p>Some text of it, here.</p></article>"), (None, "v", "<p"), (4, "w", "<article>" + "<p>A sentence of words, here.</p>" * 20_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = sorted(((r.page_id, r.text if len(r.text) < 99 else "", r.n_chars) for r in htmltext.extract(pages).collect()), key=str)
    long = len("A sentence of words, here. ") * 20_000 - 1
    text = "Some text of it, here."
    assert got == sorted([(1, "", 0), (2, "", 0), (3, text, len(text)), (3, text, len(text)), (None, "", 0), (4, "", long)], key=str)
    assert htmltext.extract(pages.limit(0)).count() == 0


def test_pages_of_other_templates():
    field = htmltext.default_field()
    page = """<body><header><h1>My Site</h1><p>Tagline of the site here.</p></header><nav><a href="/a">A</a></nav><div class="cookie-banner"><p>We use cookies, please accept them.</p></div>
    <main><article><h1>Title of the story</h1><p>First paragraph of the story, with words.</p><div class="ad">Buy this thing now, it is good.</div><p>Second paragraph, also long enough.</p></article>
    <section id="comments"><div class="comment"><p>I liked this story a lot, thank you for it.</p></div></section></main>
    <aside class="sidebar"><p>Some longer text in the sidebar, which is not main.</p></aside><form><p>Subscribe to our letter, it is free.</p></form><footer>&copy; 2024 My Site.</footer></body>"""
    assert htmltext.main_text(page, field) == "Title of the story First paragraph of the story, with words. Second paragraph, also long enough."
    assert htmltext.main_text("<p>Plain page without structure, only text.</p><p>Second paragraph of it, also plain.</p>", field).startswith("Plain page")


def test_head_ends_where_the_body_begins():
    texts = lambda page: [t for _, t, _ in htmltext.blocks(page)]
    for page in ("<html><head><title>t</title><body><p>one</p>", "<head><meta charset=x><title>t</title><p>one</p>", "<head><style>p{}</style>one", "<head><script>a</script><svg></svg><p>one"):
        assert texts(page) == ["one"]
    assert "head" not in htmltext.blocks("<head><title>t</title><body><p>one</p>")[0][0]


def test_unclosed_and_self_closed_parts_leave_the_rest():
    texts = lambda page: [t for _, t, _ in htmltext.blocks(page)]
    for part in ("<svg width=1 />", "<math/>", "<iframe src='a>b'/>", "<object/>", "<select>", "<video src=x>", "<canvas>", "<video-player>"):
        assert texts(f"<p>one</p>{part}<p>two</p><p>three</p>") == ["one", "two", "three"]
        assert texts(f"<p>one</p>{part}<p>two</p><svg><text>no</text></svg><video>no</video><p>three</p>") == ["one", "two", "three"]
    assert texts("<p>one<template><p>no</p><template>no</template><p>no</p></template><p>two") == ["one", "two"]
    assert texts("<p>one<svg><script>'<svg>'</script>no</svg><p>two<script>no") == ["one", "two"]


def test_weights_of_paths_are_those_of_their_features():
    field = htmltext.default_field()
    for page, _ in htmltext.labelled_pages(30, seed=9):
        for path, text, links in page:
            want = sum(field.weights.get(f, 0.0) for f in [*htmltext.path_features(path), *htmltext.text_features(text, links)])
            assert abs(field.emission(path, text, links) - want) < 1e-9


def test_deep_nesting_takes_linear_time():
    field = htmltext.default_field()
    began = time.time()
    for opening, closing in (("<div>x", ""), ("<div class=c{}>x", ""), ("<ul><li>x", "</li></ul>"), ("<b><p>x", "</b>"), ("<a <", ""), ("<div><li>x", "</div>")):
        page = "".join(opening.replace("{}", str(k)) for k in range(50_000)) + closing * 50_000
        htmltext.main_text(page, field)
    assert time.time() - began < 60
