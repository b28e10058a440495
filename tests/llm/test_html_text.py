import re
from html import unescape

import pytest
from pyspark.sql import functions as F

from cartwright.llm import html_samples, html_text
from cartwright.llm.html_text import blocks_of, classify, extract_text, features_of, main_text


@pytest.fixture(scope="module")
def tree(spark):
    return html_text.train(html_text.labelled_blocks(spark))


BODY = "<p>The first paragraph of this article says something at length, with a comma.</p>"

CASES = {
    "entities, inline tags and white space": (
        "<article><h1>A &amp; B</h1><p>caf&eacute;  &#233;\n <b>bo</b>ld&nbsp;x &lt;p&gt; 1 < 2</p></article>",
        "A & B café é bold x <p> 1 < 2"),
    "unclosed tags": ("<nav><ul><li><a href=x>One</a><li><a href=y>Two</a></ul></nav><article><p>First<p><b>Second<br>line"
                      "<ul><li>item</article><footer>c", "First Second line item"),
    "scripts, styles and comments": (
        "<head><title>T</title><style>p{}</style></head><article><!-- <p>no</p> --><p>Yes.</p><script>var t='</p><p>no';"
        "</script><STYLE>x</STYLE><noscript>no</noscript><p>More.</p></article>", "Yes. More."),
    "forms, asides and adverts inside the article": (
        f"<article>{BODY}<aside><p>Not this one, it is beside.</p></aside><form><p>Name</p><input><button>Go</button></form>"
        "<div class='ad-slot'><p>Buy this thing now, it is very good and cheap.</p></div><p>End.</p></article>",
        "The first paragraph of this article says something at length, with a comma. End."),
    "comments of readers": (
        f"<main>{BODY}</main><section id='comments'><article class='comment'><p>I liked this article very much, it told me "
        "a lot of things that I did not know.</p></article></section>",
        "The first paragraph of this article says something at length, with a comma."),
    "class names": (
        "<div class='site-header'><p>Our site has a long slogan that nobody has ever read.</p></div><div id='cookieBanner'>"
        "<p>We use cookies to make this site better for you and for us.</p></div><div class='post-content'>"
        f"<h2>Head</h2>{BODY}<p>ok</p></div><div class='sidebar'><p>Some words about the author of this blog, at length."
        "</p></div><div class='related-posts'><ul><li><a href=1>An article about another thing</a></ul></div>",
        "Head The first paragraph of this article says something at length, with a comma. ok"),
    "attributes with brackets and quotes": (
        "<article><p title='a > b' data-x=\"it's > \">Text</p><img alt='<p>no</p>'><p>more</p></article>", "Text more"),
    "upper case and self-closing tags": ("<ARTICLE><P>One<BR/>two</P><HR/><P>three</P></ARTICLE>", "One two three"),
    "links inside sentences": (
        "<nav><a href=1>Home</a></nav><article><p>See <a href=2>this page</a> and that.</p><p><a href=3>Only a link</a></p>"
        "</article>", "See this page and that. Only a link"),
    "hidden blocks": (f"<article>{BODY}<div style='display: none'><p>hidden words</p></div></article>",
                      "The first paragraph of this article says something at length, with a comma."),
}


LONG = "Words of a reader or a company that are no part of the article, " * 6 + "and that end here."
PARA = "Some sentence with enough words to be the text of an article, and then some more words follow here. " * 3

CASES |= {
    "no end tag of the head": (f"<html><head><title>T</title><meta charset=x><body><article><h1>Short</h1>{BODY}</article>",
                               "Short " + BODY[3:-4]),
    "neither head's end nor body": (f"<head><title>T</title><link rel=x><article><p>Short.</p></article>", "Short."),
    "cells, items and terms without end tags": (
        "<table><tr><td class=menu><a href=x>One</a><td><article><p>Cell text.</article><tr><td class=sidebar>Beside<td>Not beside"
        "</table><article><ul><li class=ad>Buy<li>Item<li>Other</ul><dl><dt class=promo>Deal<dd>Meaning</dl></article>",
        "Cell text. Item Other Meaning"),
    "hidden paragraphs, headings and words": (
        f"<article><h2 hidden>No</h2><p hidden>No</p><p style='display:none'>No</p><p>Yes <span hidden>no <b>no</b></span>and "
        f"<i style='visibility: hidden'>no</i>yes.</p>{BODY}</article>", "Yes and yes. " + BODY[3:-4]),
    "a hidden word that never ends": ("<article><p>Yes <span hidden>no</p><p>Again.</p></article>", "Yes Again."),
}
CASES |= {f"nameless article beside {kind}": (
    f"<nav><a href=x>Menu</a></nav><div><h1>A title of the page</h1><p>{PARA}</p><p>{PARA}</p></div>{start}<p>{LONG}</p>{end}",
    " ".join(f"A title of the page {PARA}{PARA}".split()))
    for kind, start, end in (("comments", "<div class='comments'>", "</div>"), ("a footer", "<footer>", "</footer>"),
                             ("a notice", "<div class='cookie-notice'>", "</div>"), ("an advert", "<div class='ad'>", "</div>"),
                             ("a form", "<form>", "</form>"))}


@pytest.mark.parametrize("name", CASES)
def test_cases(tree, name):
    html, want = CASES[name]
    assert main_text(html, tree) == want


@pytest.mark.parametrize("start, end", [
    ("<div class='layout no-sidebar'>", "</div>"), ("<div class='page has-banner'>", "</div>"), ("<form>", "</form>"),
    ("<div class='page has-banner'><form>", "</form></div>")])
def test_wrappers_of_the_page(tree, start, end):
    comments = "<div class='comments'><article><p>A reader says something long about all of this.</p></article></div>"
    html = f"<body>{start}<nav><a href=x>Menu</a></nav><article>{BODY}<p>End.</p></article>{comments}<footer>c</footer>{end}</body>"
    assert main_text(html, tree) == f"{BODY[3:-4]} End."
    box = f"<article>{BODY}</article><div class='sidebar'><article><p>Another story, told elsewhere.</p></article></div>"
    assert main_text(box, tree) == BODY[3:-4]


def test_pages_without_names_are_told_by_text_and_links(tree):
    para = "Some sentence with enough words to be the text of an article, and then some more words follow here. " * 3
    html = ("<div>" + "".join(f"<p><a href={i}>Menu item</a></p>" for i in range(6)) + f"</div><div><p>{para}</p><p>{para}</p>"
            "</div><div><p><a href=x>Linked words all the way to the end of it</a></p></div>")
    assert main_text(html, tree) == " ".join((para + para).split())


def test_given_pages_match_a_naive_reading(spark, tree):
    """All given pages name their article: what is inside it, tag by tag."""
    def naive(html):
        inside = re.search(r"<article>(.*?)</article>", html, re.S)[1]
        text = unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?(b|i|em|a|span)\b[^>]*>", "", inside)))
        return " ".join(text.split())

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html", extract_text(F.col("html"), tree).alias("text"))
    rows = pages.collect()
    assert len(rows) > 100 and all(r["text"] == naive(r["html"]) for r in rows)
    assert all(any(b.zone > 0 for b in blocks_of(r["html"])) for r in rows)


def test_training_table_is_learnt(spark, tree):
    table = html_text.labelled_blocks(spark)
    assert table.columns == [*html_text.FEATURES, "label"]
    for page in html_samples.pages():
        blocks = blocks_of(page)
        assert [classify(tree, f) for f in features_of(blocks)] == [bool(b.label) for b in blocks]


@pytest.mark.parametrize("html", [
    None, "", "plain", "<", "<<<>>>", "<p", "<p>a<!-- b", "<p>a<script>b", "</", "</p", "<a", "<p 'x>y", "&", "&#x110000;",
    "<!doctype html>", "<?xml?>x", "<article></article>", "a" * 100_000, "<div>" * 3000 + "x", "<p>" * 3000 + "</div>" * 3000])
def test_broken_pages_do_not_fail(tree, html):
    assert isinstance(main_text(html, tree), str)


def test_block_features_know_their_neighbours():
    f = features_of(blocks_of("<p><a href=x>one two</a></p><p>three four five</p><p>six</p>"))
    names = html_text.FEATURES
    mid = dict(zip(names, f[1]))
    assert (mid["words"], mid["prev_words"], mid["prev_link_density"], mid["next_words"]) == (3, 2, 1.0, 1)


def test_frame_with_awkward_rows(spark, tree):
    rows = [(1, "u", "<article><p>x y</p></article>"), (1, "u", "<article><p>x y</p></article>"), (None, None, None), (2, "", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = sorted(r[0] for r in df.select(extract_text(F.col("html"), tree)).collect())
    assert got == ["", "", "x y", "x y"]
    assert df.limit(0).select(extract_text(F.col("html"), tree)).count() == 0
