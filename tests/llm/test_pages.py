"""Main text of pages: known articles inside many kinds of page."""

from __future__ import annotations

import html as H
import random
import re
import time

import pytest

from rulecheck.llm import page_text
from rulecheck.llm.page_text import extract

SF = "/root/testdata/sf0.001"


def plain(html):
    """The one article of a generated page, by patterns."""
    body = html[html.index("<article>") + 9 :].split("</article>")[0]
    blocks = [" ".join(H.unescape(re.sub(r"</?b>", "", re.sub(r"<br>", " ", b))).split()) for b in re.split(r"</?(?:p|h1)>", body)]
    return "\n".join(b for b in blocks if b)


def test_query_gives_every_article_of_the_table(spark):
    found = page_text.op12_main_text(spark, SF)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = found.collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r["url"] == pages[r["page_id"]]["url"] and r["text"] == plain(pages[r["page_id"]]["html"]) and r["n_chars"] == len(r["text"])


TEXT = ["A title, of sorts", "The first paragraph, with commas, & more than a few words in it.", "Short.", "The third says “very little”, but at length, as third ones do."]
AROUND = [
    "<nav><ul><li><a href=/a>Home</a><li><a href=/b>News, all of it</a></ul></nav>",
    "<div class='ad'>Buy, buy, buy, buy, buy now, it is cheap, really.</div>",
    "<div id=cookieConsent><p>We, and partners, use cookies, and you agree, surely.</p><button>Yes</button></div>",
    "<aside><h3>Read on</h3><p>Something else, by someone else, elsewhere.</p></aside>",
    "<div class=sidebar><p>Side matters, of all sorts, are told here at length, indeed.</p></div>",
    "<form action=/s><label>Search</label><input name=q><p>Type, please, what you look for, here.</p></form>",
    "<script>if (a < b && '</p>') { track('<article>'); }</script><style>p > b { color: red }</style>",
    "<header class=site><a href=/>The Paper</a><p>All the news, every day, for all of us.</p></header>",
    "<section id=comments><article class=comment><p>I, for one, disagree, strongly, with all of it, and more, and more.</p></article></section>",
    "<div class='related-posts'><h3>More</h3><a href=1>One, two</a><a href=2>Three, four</a></div>",
    "<footer>&copy; the paper, its owners, and others</footer>",
    "<!-- <p>not, even, shown</p> --><noscript>Turn it on, please</noscript>",
    "<div style='display:none'>hidden, text, here</div>",
]
ARTICLES = [
    "<article><h1>{0}</h1><p>{1}</p><p>{2}</p><p>{3}</p></article>",
    "<main><article><header><h1>{0}</h1></header><p>{1}<p>{2}<p>{3}</article></main>",
    "<div id=content><h1>{0}</h1><div class=body><p>{1}</p><p>{2}</p><div>{3}</div></div></div>",
    "<div class=post><h1>{0}</h1><div><b>{1}<br></b></div><blockquote>{2}</blockquote><p>{3}</div>",
    "<table><tr><td><h1>{0}</h1><p>{1}</p><ul><li>{2}<li>{3}</ul></table>",
    "<main><h1>{0}</h1><section><p>{1}</p></section><section><p>{2}</p><p><em>{3}</em></p></section></main>",
]


@pytest.mark.parametrize("layout", ARTICLES)
def test_article_of_any_layout_without_what_is_around(layout):
    dice = random.Random(layout)
    for _ in range(40):
        before, after = dice.sample(AROUND, 4), dice.sample(AROUND, 4)
        body = layout.format(*[H.escape(t).replace(" ", dice.choice([" ", "\n  ", "&#32;"])) for t in TEXT])
        html = f"<!DOCTYPE html><html><head><title>x, y</title></head><body class='has-sidebar'>{''.join(before)}{body}{''.join(after)}" + dice.choice(["</body></html>", ""])
        assert extract(html) == "\n".join(TEXT), html


def test_odd_pages():
    assert extract(None) == extract("") == extract(" \n") == extract("<p> </p>") == extract("<script>x</script>") == ""
    assert extract("plain < text &amp; more") == "plain < text & more"
    assert extract("<p>a<!-- x --><b>b</p>c &eacute;&#x1F642;") == "ab\nc é\U0001f642"
    assert extract("<p>whole text<!-- no end <p>lost") == "whole text"
    assert extract("<p>one<p class='open>two") == "one\ntwo"
    assert extract("<p>one<p class=cut") == "one"
    assert extract("<nav><article><p>In a menu that never ends.</article>") == "In a menu that never ends."
    assert extract("<div class=widget>All there is</div>") == "All there is"
    assert extract("<P>Upper</P><DIV>case</DIV>") == "Upper\ncase"


def test_hostile_pages_take_linear_time():
    for piece in ["<div>", "<a ", "<!--", '<a "', "<p>", "<b>x</i>", "<li>", "<p><button><div>", "<h1>", "&", "<", "<td><tr>"]:
        start = time.time()
        extract(piece * 20_000 + "<p>x")
        assert time.time() - start < 10, piece


def test_long_texts_repeats_nulls_and_clashing_columns(spark):
    long = "<article>" + "<p>word, word</p>" * 30_000 + "</article>"
    rows = [(1, "u", long), (2, None, None), (None, "v", "<p>x</p>"), (3, "w", "<p>y</p>"), (3, "w", "<p>y</p>")]
    df = spark.createDataFrame([(*r, "clash", 7) for r in rows], "page_id bigint, url string, html string, text string, n_chars int").repartition(2)
    got = sorted(map(tuple, page_text.extract_pages(df).collect()), key=str)
    whole = "\n".join(["word, word"] * 30_000)
    assert got == sorted([(1, "u", whole, len(whole)), (2, None, "", 0), (None, "v", "x", 1), (3, "w", "y", 1), (3, "w", "y", 1)], key=str)
    assert page_text.extract_pages(df.where("false")).collect() == []
