"""Main text and URL filter."""

import html
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from traceframe.llm import html_text, urls
from traceframe.llm.html_text import main_text
from traceframe.llm.queries import RULES

SF = "/root/testdata/sf0.01"

LAYOUT = """<html><body class="has-sidebar"><header><a href=/>Home</a> <h1>Site name</h1></header>
<div id="cookie-notice">We use cookies. Accept all of them now please, thank you very much indeed.</div>
<div class="layout"><div class="sidebar"><ul><li><a href=x>One</a><li><a href=y>Two</a></ul></div>
<div class="content"><h1>Title here</h1><p>First paragraph with many words in it, long enough &amp; fine.
<p>Second one that is long as well, with <a href=z>a link</a> in it and more words after that link.</p>
<p>Short.</p><form><input name=q><label>Search</label></form>
<div class="ad">Buy now this great thing, it is on sale for the rest of the day only, do not miss it.</div>
<p>Last paragraph of the article, which again is long enough to count as content by itself.</p></div></div>
<section id="comments"><h2>Comments</h2><article class="comment"><p>I like this so much that I write a very long
comment about it, longer than the article itself.</p></article></section><footer>(c) 2020 Site</footer></body></html>"""


def test_article_without_an_article_element():
    text = main_text(LAYOUT).split("\n\n")
    assert text[0] == "Title here" and text[3] == "Short." and text[-1].startswith("Last paragraph")
    assert len(text) == 5 and "&" in text[1]


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("plain text only", "plain text only"), ("<p>only", "only"), ("<div class=ad>x</div>", ""),
        ("<nav>menu</nav>", ""), ("<script>var a = '<p>no</p>'</script><style>p{}</style>", ""),
        ("<article><header><h1>T</h1></header><p>x &lt;b&gt; &nbsp; y<br>z</p><footer>f</footer>"
         "<div class='comments'><p>c</p></div><aside>s</aside></article>", "T\n\nx <b> y z"),
        ("<main><p>a<p>b</main><p>after", "a\n\nb"), ("<article><p>cut off &am", "cut off &am"),
        ("<article><p>a</b></i></div>b</p></article>", "ab"), ("<table><tr><td>a<td>b</table>", "a\n\nb"),
        ("<article hidden><p>no</p></article><article><p>yes</p></article>", "yes"),
        ("<article><p>same</p><p>same</p></article>", "same\n\nsame"),
    ],
)
def test_small_pages(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    "attrs", ["id=discussion", "id=related-work", "id=search-results", "id=ad-hoc-queries", "id=alert-rules", "class=notice-period"]
)
def test_slugs_with_a_word_of_a_role(attrs):
    long_ = "A paragraph that is long enough to count as content in any page, with some more words to it."
    page = f"<article><p>{long_}</p><section {attrs}><h2 {attrs}>Head</h2><p>{long_}</p></section><p>{long_}</p></article>"
    assert main_text(page) == f"{long_}\n\nHead\n\n{long_}\n\n{long_}"
    menu = f"<section {attrs}><a href=x>One link of them</a><a href=y>Two</a></section>"
    assert main_text(f"<article><p>{long_}</p>{menu}</article>") == long_
    assert main_text(f"<article><p>{long_}</p><div class='ad-box'><p>{long_}</p></div></article>") == long_


def test_clusters_select_the_regions():
    long_ = "A paragraph that is long enough to count as content in any page, with some more words to it."
    parts = f"<article><p>{long_} 1</p><p>short</p></article><article><p>{long_} 2</p></article>"
    both = f"{long_} 1\n\nshort\n\n{long_} 2"
    assert main_text(f"<div>{parts}</div><p>end</p>") == both
    assert main_text(f"<main><h1>Title</h1><p>Lead</p>{parts}</main>") == f"Title\n\nLead\n\n{both}"
    outside = "".join(f"<p>{long_} {i}</p>" for i in range(9))
    teaser = "<article><h3><a href=x>See this one</a></h3><p>Teaser</p></article>"
    assert "paragraph" in main_text(f"<div>{outside}</div><div>{teaser}</div>")
    assert main_text(f"<article><p>{long_}</p></article><article><a href=x>Next</a></article>") == long_


PARA = "A paragraph that is long enough to count as content in any page, with some more words to it."


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<article><p>{PARA}</p><![foo[ y ]]><p>{PARA}</p></article>", f"{PARA}\n\n{PARA}"),
        (f"<article><p>{PARA}</p><![ [x]]><p>{PARA}</p></article>", f"{PARA}\n\n{PARA}"),
        (f"<article><p>{PARA}</p><![if IE]>old<![endif]></article>", None),
        (f"<article><p>Let <math><mi>x</mi>=1</math> be given. {PARA}</p></article>", f"Let x=1 be given. {PARA}"),
        (f"<article><p>{PARA}</p><!-- unclosed <p>hello", PARA),
        (f"<article><p>{PARA}</p><![CDATA[ unclosed <p>{PARA}</p>", f"{PARA}\n\n{PARA}"),
        (f"<article><p>{PARA}</p><p>more <a href='x", f"{PARA}\n\nmore"),
        (f"<article><p>{PARA} 1 < 2", f"{PARA} 1 < 2"),
    ],
)
def test_broken_markup(page, text):
    found = main_text(page)
    assert PARA in found if text is None else found == text


MARKUP = ["<", ">", "<!", "<![", "]]>", "<!--", "-->", "<a ", "<p>", "</", "<div class='ad x'>", "</div>", "<article>", "</article>",
          "<?", "&", "&amp;", "&#", "'", '"', "=", "/", "x", "<script>", "</script>", "<main>", "\x00", "é", "<!doctype", "CDATA["]


@given(st.lists(st.one_of(st.sampled_from(MARKUP), st.text(max_size=4)), max_size=60))
@settings(max_examples=1500, deadline=None)
def test_any_markup_is_read(parts):
    assert isinstance(main_text("".join(parts).encode("utf-8", "replace").decode()), str)


@pytest.mark.parametrize(
    "page",
    [
        "<a " * 330_000, "<a " * 330_000 + ">", "<div>" * 200_000, "<div class='related-work'>x" * 40_000, "<article>x" * 100_000,
        "<span>" * 50_000 + "<p>x" * 100_000, "<b><div>" + "<span>" * 50_000 + "</b>" * 100_000, "<![CDATA[x" * 100_000 + ">",
        "<![foo[" * 100_000 + "]>", '<a b="' * 100_000 + ">", "<" * 500_000, "</x " * 200_000 + ">",
    ],
    ids=range(12),
)
def test_a_megabyte_of_bad_markup_takes_seconds(page):
    start = time.process_time()
    main_text(page)
    assert time.process_time() - start < 10


def test_long_page():
    page = "<article>" + "<p>some words of a paragraph</p>" * 20_000 + "</article>"
    assert main_text(page).count("\n\n") == 19_999


def test_whole_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for r in html_text.extract(pages.withColumn("text", F.lit("own"))).collect():
        inner = re.search(r"<article>(.*?)(</article>|<footer>|$)", r["html"], re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", inner.replace("<br>", " "))
        parts = [" ".join(html.unescape(re.sub(r"</?b>", "", x)).split()) for x in parts]
        assert r["text"] == "\n\n".join(x for x in parts if x)
    odd = spark.createDataFrame([(1, None), (1, None), (None, "")], "page_id int, html string")
    assert [r["text"] for r in html_text.extract(odd).collect()] == ["", "", ""]
    assert html_text.extract(pages.limit(0)).count() == 0


URLS = [
    "http://WWW.Bad.example.com/a/?utm_source=x&b=2&a=1#top", "https://bad.example.com:443/a?a=1&b=2",
    "https://bad.example.com/a?a=1", "http://x.example.org/es/1", "http://example.org/en/12?x", "http://notexample.org",
    "https://a.com/fr/x", "https://a.com/fr", "ftp://user@b.com/de/", None, "", "no scheme/org/", "://", "http://",
]


def test_rules_and_list(spark):
    pages = spark.createDataFrame([(i, u, "own") for i, u in enumerate(URLS * 2)], "page_id int, url string, rule string")
    listed = spark.createDataFrame([("https://bad.example.com/a/?a=1&b=2",), (None,), ("junk",)], "url string")
    for limit in (urls.BROADCAST_BLOCKS, 0):
        rows = {r["page_id"]: r for r in urls.judge(pages, listed, RULES, broadcast_blocks=limit).collect()}
        assert len(rows) == 2 * len(URLS)
        assert [rows[i]["listed"] for i in range(14)] == [True, True] + [False] * 12
        assert [rows[i]["rule"] for i in range(9)] == [
            None, None, None, "example.org/es/", "example.org/en/1", None, "com/fr/", None, "com/de/",
        ]
        assert [rows[i]["verdict"] for i in range(9)] == ["block"] * 2 + ["allow"] + ["block"] * 2 + ["allow"] * 3 + ["block"]
        assert all(rows[i]["host"] == rows[i]["path"] == "" and rows[i]["verdict"] == "allow" for i in range(9, 14))
        assert rows[0]["host"] == "www.bad.example.com" and rows[0]["path"] == "/a/"
    assert urls.judge(pages.limit(0), listed, RULES).count() == 0
    assert urls.judge(pages, listed.limit(0), RULES).where("listed").count() == 0


def test_bloom_filter_misses_nothing_and_passes_little(spark):
    keys = spark.range(5000).select(F.concat(F.lit("site/"), "id").alias("key"))
    blocks = 5000 // urls.URLS_PER_BLOCK
    table = {r["block"]: r for r in urls.bloom(keys, "key", blocks).collect()}
    bits = [urls.bit_of(F.col("key"), w).alias(f"b{w}") for w in range(urls.WORDS)]
    probe = spark.range(10_000).select(F.concat(F.lit("site/"), "id").alias("key"), "id")
    rows = probe.select("id", urls.block_of(F.col("key"), blocks).alias("at"), *bits).collect()
    def maybe(r):
        own = table.get(r["at"])
        return own is not None and all(own[f"w{w}"] & r[f"b{w}"] for w in range(urls.WORDS))
    assert all(maybe(r) for r in rows if r["id"] < 5000)
    assert sum(maybe(r) for r in rows if r["id"] >= 5000) < 100
