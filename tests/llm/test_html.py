import html
import re

import pyarrow.dataset as ds
import pytest

from redeemflow.llm.html_extract import extract, main_text

LONG = "The cat sat on the mat and it was in the house with the dog that is not as old as the hat."


def page(body):
    return f"<!DOCTYPE html><html><head><title>The title of it</title><style>p{{}}</style></head><body>{body}</body></html>"


@pytest.mark.parametrize("body,want", [
    (None, ""), ("", ""), ("<p>", ""), (f"<p>{LONG}</p>", LONG),
    (f"<nav><a href=/>Home</a></nav><article><h1>Head</h1><p>{LONG}</p><p>Short.</p></article><footer>&copy; x</footer>",
     f"Head\n{LONG}\nShort."),
    ("<div class='ad'>Buy</div><article><p>Les.</p></article>", "Les."),
    ("<article><p>Heat Heat " + "Heat " * 40 + "</p></article>", "Heat " * 41 + "Heat"),
    (f"<article><p>{LONG}</p><aside>Also see the of and</aside><form>Your name<input></form>"
     f"<div id='comments'><p>{LONG} I agree</p></div><p>End.</p></article>", f"{LONG}\nEnd."),
    (f"<div><div class='sidebar'><p>{LONG}</p></div><p>{LONG}</p><p>mid</p><p>{LONG}</p></div>", f"{LONG}\nmid\n{LONG}"),
    (f"<h2>Title here</h2><p>{LONG}</p><ul><li><a href=x>{LONG}</a></li></ul>", f"Title here\n{LONG}"),
    ("<article>A &lt;b&gt; &amp;amp; caf&eacute;&nbsp;x<br>y <b>z</b>w <!-- <p>no --> v<script>var t='</p>';</script></article>",
     "A <b> &amp; café x y zw v"),
    ("<article><p><b>one.<br><p>two</article><footer>f", "one.\ntwo"),
    ("<article><p title='a > b'>q</p><p class=x>r</article>", "q\nr"),
    ("<article><p>a < b and 3 > 2</p><script>unclosed", "a < b and 3 > 2"),
    (f"<article><h1><a href=/x>Linked head</a></h1><p>{LONG}</p><ul><li><a href=/y>More</a></li></ul>"
     f"<section id=commentList>{LONG} no</section></article>", f"Linked head\n{LONG}"),
    (f"<article><p>{LONG}</p><ul><li>one thing</li><li>two</li></ul></article>", f"{LONG}\none thing\ntwo"),
    (f"<div class='cookie-notice'>We use cookies. {LONG}</div><main>{LONG}</main>", LONG),
    # a holder named for its layout that has the page's running text
    (f"<div class='layout has-sidebar'><p>{LONG}</p></div>", LONG), (f"<div class='post no-comments'><h1>H</h1><p>{LONG}</p></div>", f"H\n{LONG}"),
    (f"<div class='right-sidebar'><div><p>{LONG}</p></div><div class=sidebar><p>{LONG}</p></div></div>", LONG),
    (f"<div class='cookie-consent'>{LONG}</div><section class='entry-content social'><p>{LONG}</p><p>{LONG}</p></section>", f"{LONG}\n{LONG}"),
    (f"<div class='cookie-notice'>{LONG}</div>", ""), (f"<article><p>{LONG}</p></article><div class='comment-list'>{LONG * 8}</div>", LONG),
    # custom and self-closed elements
    (f"<svg-icon>x</svg-icon><p>{LONG}</p>", LONG), (f"<title-bar>x</title-bar><p>{LONG}</p>", LONG),
    (f"<svg/><p>{LONG}</p>", LONG), (f"<svg a='/>' b/><p>{LONG}</p>", LONG), (f"<svg><path d='M'/>no</svg><p>{LONG}</p>", LONG),
    # names on any block element
    (f"<p>{LONG}</p><p class='advert'>{LONG}</p><p>{LONG}</p>", f"{LONG}\n{LONG}"),
    (f"<article><p>{LONG}</p><ul><li class='comment'>{LONG}<ul><li>inner</li></ul> tail</li></ul>"
     f"<blockquote class='comment'>{LONG}</blockquote><p>End.</p></article>", f"{LONG}\nEnd."),
    # short pages, and a headline in the article's header
    ("<h1>Hi</h1><p>Yes we can do it.</p>", "Hi\nYes we can do it."), ("<div><p>One is here.</p><p>Two is here.</p></div>", "One is here.\nTwo is here."),
    (f"<article><header><h1>Head</h1><p>By me</p></header><p>{LONG}</p></article>", f"Head\n{LONG}"),
])
def test_pages(body, want):
    assert main_text(None if body is None else page(body)) == want


def test_long_and_broken_pages_end():
    assert len(main_text(page("<article>" + "<p>word the " * 20_000))) > 100_000
    for junk in ("<" * 50_000, "<a " * 20_000, "<p title=\"" * 5_000, "<!--" * 10_000, "<div>" * 5_000 + "x"):
        main_text(junk)


def test_articles_of_the_pages_table(spark):
    path = "/root/testdata/sf0.01/pages.parquet"
    want = {}
    for r in ds.dataset(path).to_table().to_pylist():
        body = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1].replace("<br>", " ")
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        want[r["page_id"]] = "\n".join(filter(None, parts))
    got = extract(spark.read.parquet(path).selectExpr("*", "1 as text", "2 as n_chars")).collect()
    assert {r.page_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)


def test_empty_table_and_nulls(spark):
    schema = "page_id long, url string, html string"
    assert extract(spark.createDataFrame([], schema)).count() == 0
    got = extract(spark.createDataFrame([(None, None, None), (1, "u", ""), (1, "u", "")], schema)).collect()
    assert [(r.text, r.n_chars) for r in got] == [("", 0)] * 3


RUSSIAN = ("Кошка сидела на ковре, а собака спала в доме, потому что за окном весь день шёл сильный дождь. "
           "Вечером они вышли в сад.")
THAI = "แมวนั่งอยู่บนพรมและสุนัขนอนหลับอยู่ในบ้านเพราะข้างนอกฝนตกหนักตลอดทั้งวัน"
FIELDS = "<label>Your name of the user</label><input><button>Send it</button>"


@pytest.mark.parametrize("raw,want", [
    # </head> is optional
    (f"<html><head><title>T</title><meta charset=utf-8><body><article><p>{LONG}</p></article>", LONG),
    (f"<html><head><title>T</title><article><p>{LONG}</p></article>", LONG),
    (f"<head><title>T</title><link rel=x><body><p>{LONG}</p></body></html>", LONG),
    (f"<head><title>T</title><p>{LONG}</p>", LONG),
    # a form round the page; its fields stay out
    (f"<body><form><nav><a href=/>Home</a></nav><article><p>{LONG}</p></article>{FIELDS}</form></body>", LONG),
    (f"<body><form><div><p>{LONG}</p><p>{LONG}</p>{FIELDS}</div></form></body>", f"{LONG}\n{LONG}"),
    (f"<body><p>{LONG}</p><p>{LONG}</p><form><p>Send us your name.</p>{FIELDS}</form></body>", f"{LONG}\n{LONG}"),
    # unclosed boilerplate
    (f"<body><nav><a href=/>Home</a><article><p>{LONG}</p></article></body>", LONG),
    (f"<body><header>Site<main><p>{LONG}</p></main><footer>x</footer></body>", LONG),
    (f"<body><div><nav><a href=/>Home</a><p>{LONG}</p></div></body>", LONG),
    # closed boilerplate stays out, with an article in it too
    (f"<article><p>{LONG}</p></article><aside><article>{LONG} more</article></aside>", LONG),
    (f"<nav><p>{LONG}</p></nav><footer><p>{LONG}</p></footer>", ""),
    # languages without stop words here
    (f"<body><ul><li><a href=/>Дом</a></li></ul><p>{RUSSIAN}</p><p>\xa9 2024</p></body>", RUSSIAN),
    (f"<body><p>{THAI}</p></body>", THAI),
    (f"<body><div class=sidebar><p>{RUSSIAN}</p></div><p>{'Item ' * 40}</p></body>", ""),
])
def test_regions_end_and_languages(raw, want):
    assert main_text(raw) == want
