"""Main texts of pages built by hand, whose article is known."""

import time

import pytest

from tallyloom.llm.html_extraction import main_text, main_texts
from tallyloom.llm.queries import QUERIES

LONG = ["Rivers rise in the hills, run down to the plain, and reach the sea after many days.",
        "A miller, a baker, and a smith lived by the bridge, each with a house of their own.",
        "In spring the water stood high, in summer it was low, and in winter it froze."]
PARAGRAPHS = "".join(f"<p>{text}</p>" for text in LONG)
TEXT = " ".join(LONG)
NAV = "<nav><ul><li><a href=/a>Home</a></li><li><a href=/b>News, and more</a></li></ul></nav>"

PAGES = [
    # the shape of the given pages: unclosed paragraphs, a banner, and a page cut off at its end
    (f"<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{{}}</style><script>var t='</p>';</script></head><body>{NAV}"
     f"<!-- ad --><div class='ad'>Buy, buy, buy, and buy again, it is cheap.</div><article><h1>Head</h1><p><b>Head<br>{PARAGRAPHS}"
     "</article><footer>&copy; me &middot; you</footer>", f"Head Head {TEXT}"),
    # short articles stay whole
    ("<body><nav><a href=x>Menu</a></nav><article><h1>Hi.</h1><p>No.</p></article><footer>Foot</footer></body>", "Hi. No."),
    # no article element: the best container and its headings
    (f"<body><div id=top><a href=1>one</a> <a href=2>two</a></div><div class=content><h2>Head</h2>{PARAGRAPHS}</div>"
     "<div class=right>Some words here.</div></body>", f"Head {TEXT}"),
    # siblings of the container that are text
    (f"<body><h1>Head</h1><div class=s><p>{LONG[0]}</p></div><div class=s><p>{LONG[1]}</p><p>{LONG[2]}</p></div>"
     "<div><a href=1>one link</a><a href=2>another link</a></div></body>", f"Head {TEXT}"),
    # text with line breaks in a plain block
    (f"<body>{NAV}<div>{LONG[0]}<br><br>{LONG[1]}<br/>{LONG[2]}</div></body>", TEXT),
    # all that is left out, by element, role or name
    (f"<body><header><h1>Site</h1><p>Slogan, with, commas.</p></header><main><article><header><h1>Head</h1></header>{PARAGRAPHS}"
     "<aside><p>Aside, aside, aside.</p></aside><form><label>Name</label><input value=x><textarea>your text</textarea></form>"
     "<div class='cookie-notice'><p>We use cookies.</p></div><div id=comments><p>First, said a reader.</p></div>"
     "<section class='post-comments'><article class=comment><p>Nonsense, said another.</p></article></section>"
     "<div role=navigation>on</div><p hidden>no</p><p style='display: none'>no</p><noscript>Turn it on.</noscript>"
     "<div class=shareButtons>Share this</div><ul><li><a href=1>See one</a></li><li><a href=2>See two</a></li><li><a href=3>See three</a>"
     "</li></ul><footer>by me</footer></article></main><footer>Foot</footer></body>", f"Head {TEXT}"),
    # names that only sound like those
    (f"<body class='has-sidebar no-cookie'><div class='content-with-sidebar'><article class='commentary header'>{PARAGRAPHS}</article>"
     "</div></body>", TEXT),
    # a form or a widget around the page
    (f"<form id=aspnet><div class=widget>{NAV}<article>{PARAGRAPHS}</article></div></form>", TEXT),
    # links in a text and lists in an article
    (f"<article>{PARAGRAPHS}<p><a href=x>All of this is a link.</a></p><ul><li>one <a href=1>l</a></li><li>two</li></ul></article>",
     f"{TEXT} All of this is a link. one l two"),
    # inline marks do not part words, blocks and cells do
    ("<article><p>un<b>bro</b>ken&nbsp;and &lt;so&gt; on<span class=ad>x</span></p><table><tr><td>a<td>b<tr><td>c</table></article>",
     "unbroken and <so> on a b c"),
    ("<ARTICLE><P CLASS=x>Big<BR>tags<SCRIPT>no</SCRIPT>here</ARTICLE>", "Big tagshere"),
    # references
    ("<article>&amp;amp; &#65;&#x42;&copy &am &quo; &unknown; &#99999999999; &#xD800; &amp</article>",
     "&amp; AB© &am &quo; &unknown; � � &"),
    ("<article>&#" + "9" * 6000 + ";</article>", "�"),
    # attributes of all kinds, and marks that are none
    ("<article><p title='a > b' data-x=\"<p>\" checked = yes href=a/b>3 < 4 and 5 > 4</p><p/>then</article>", "3 < 4 and 5 > 4 then"),
    ("<article>one<!-- <p>no</p> -- > no --> two<!--> three<?php no ?> four<![CDATA[no]]> five</></article>", "one two three four five"),
    # ends of all kinds
    ("<article>kept<p", "kept"), ("<article>kept<!-- lost", "kept"), ("<article>kept<script>lost", "kept"), ("<article>a</p></b></div>b", "ab"),
    # nothing
    ("", ""), ("   ", ""), ("<body></body>", ""), (NAV, ""), ("<div class=ad>Buy, buy.</div>", ""), ("<p><a href=1>only a link</a></p>", ""),
    ("plain words, without any mark", "plain words, without any mark"),
]


@pytest.mark.parametrize("place", range(len(PAGES)))
def test_known_articles(place):
    page, text = PAGES[place]
    assert main_text(page) == text


def test_rows(spark):
    given = [(i, f"u{i}", page) for i, (page, _) in enumerate(PAGES)] + [(1, "again", PAGES[1][0]), (None, None, PAGES[1][0]), (50, "null", None)]
    pages = spark.createDataFrame(given, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS n_chars")
    want = [(i, u, text, len(text)) for (i, u, _), (_, text) in zip(given, [*PAGES, PAGES[1], PAGES[1], ("", "")])]
    assert sorted(map(tuple, main_texts(pages).collect()), key=str) == sorted(want, key=str)
    assert main_texts(pages.limit(0)).collect() == []


@pytest.mark.parametrize("piece", ["<", "<a ", "</", "<!--", "<div>", "<p>", "<b>", "</b>", "<a b=\"", "<a b='>", "&", "<div><p>a", "<table><tr><td>", "<li><ul>", "x, "])
def test_long_pages_take_time_in_proportion(piece):
    started = time.process_time()
    main_text("<article><p>text" + piece * 60_000)
    assert time.process_time() - started < 8


def test_query(spark, tmp_path):
    pages = [(i, "u", page) for i, (page, _) in enumerate(PAGES)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    df = QUERIES["op13_html_extraction"](spark, str(tmp_path))
    assert df.dtypes == [("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")]
    assert {(r.page_id, r.text, r.n_chars) for r in df.collect()} == {(i, text, len(text)) for i, (_, text) in enumerate(PAGES)}
