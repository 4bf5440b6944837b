"""Main text of pages with known articles."""

import re
import time
from html import unescape

import pytest

from textweft.llm.html_text import extract_text, main_text, smoothed

MENU = "<nav><ul><li><a href=/a>Home</a></li><li><a href=/b>About us</a></li></ul></nav>"
FOOT = "<footer>&copy; someone &middot; imprint</footer>"


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        ("   \n", ""),
        ("<p></p><script>var t='</p>'</script>", ""),
        ("just text &amp; more", "just text & more"),
        (f"<html><head><title>No</title><style>p{{}}</style></head><body>{MENU}<article><h1>Head</h1><p><b>One.<br><p>Two  \n <i>th</i>ree&eacute;.</article>{FOOT}", "Head One. Two threeé."),
        (f"<body>{MENU}<div class='ad'>Buy this very long advert text now, it is so good for all of you.</div><article><p>Be.</p></article>{FOOT}", "Be."),
        ("<article><p>Text.</p><section class='comments'><p>first!</p></section><form><input>Name</form><p>End</p></article>", "Text. End"),
        ("<div>a<span class='ad'>x</span>b <i>c</i>d</div><p class='ad'>no<p>yes", "a b cd yes"),
        ("<article>a<br/>b<img src=x>c<div/>d</article>", "a bc d"),
        ("<article>1 < 2 &lt; 3 &#8364; &nosuch; &#x110000;</article>", "1 < 2 < 3 € &nosuch; �"),
    ],
)
def test_pages(html, text):
    assert main_text(html) == text


def test_unmarked_regions():
    links = "".join(f"<a href='{i}'>go</a> " for i in range(30))
    page = f"<body><div>{links}</div><div><p>{'A long sentence of the story. ' * 9}</p><p>Short.</p></div></body>"
    assert main_text(page) == ("A long sentence of the story. " * 9 + "Short.")


STORY = "<p>" + "A long sentence of the story. " * 30 + "</p>"
TOLD = ("A long sentence of the story. " * 30).strip()


@pytest.mark.parametrize("name", ["content has-sidebar", "main-content no-sidebar", "wrap with-header", "entry social-post", "page promo"])
def test_a_name_does_not_drop_what_holds_the_text(name):
    assert main_text(f"<body>{MENU}<div class='{name}'>{STORY}</div><div class='sidebar'><p>Read this too, it is fine.</p></div>{FOOT}") == TOLD
    assert main_text(f"<body>{MENU}<div class='{name}'><article>{STORY}</article></div>{FOOT}") == TOLD


def test_readers_comments_go():
    comment = "<article class='comment'><p>" + "I have read this and I must say a thing. " * 8 + "</p></article>"
    for page in (
        f"<article>{STORY}</article><section>{comment}{comment}</section>",
        f"<main>{STORY}<section id='comments'>{comment}</section></main>",
        f"<div>{STORY}</div><div class='comment-list'><div>{comment * 9}</div></div>",
        f"<article>{STORY}{comment}</article>",
    ):
        assert main_text(f"<body>{MENU}{page}{FOOT}") == TOLD


def test_short_blocks_beside_the_story_stay():
    links = "<div>" + "<a href=/x>Another story</a> " * 6 + "</div>"
    page = f"<body>{MENU}<div><div>In short.</div><div>{STORY}</div><div>The end.</div>{links}</div>{FOOT}"
    assert main_text(page) == f"In short. {TOLD} The end."


def test_side_boxes_go_even_if_they_are_long():
    box = "<div class='related'>" + STORY * 3 + "</div>"
    assert main_text(f"<body><article>{STORY}</article>{box}</body>") == TOLD
    assert main_text(f"<body><div class='page has-related'>{box}<article>{STORY}</article></div></body>") == TOLD


def test_whole_table_against_what_it_was_made_of(spark):
    """Every given page is a title, a menu, an advert, an article of paragraphs and a footer."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html")
    got = {r["page_id"]: (r["html"], r["text"]) for r in extract_text(pages).collect()}
    assert len(got) == pages.count()
    for html, text in got.values():
        article = re.search(r"<article>(.*?)</article>", html or "", re.S)
        if article:
            plain = " ".join(unescape(re.sub(r"</?(?:p|h1|br)[^>]*>", " ", re.sub(r"</?b>", "", article.group(1)))).split())
            assert text == plain


def test_smoothing_keeps_a_constant():
    assert smoothed([2.0] * 9) == pytest.approx([2.0] * 9) and smoothed([]) == []


@pytest.mark.parametrize("html", ["<" * 100_000, "<p>" * 50_000, "<div class=ad>" * 20_000 + "x", "&" * 100_000, "a " * 500_000])
def test_odd_pages_end(html):
    began = time.process_time()
    main_text(html)
    assert time.process_time() - began < 20


def test_names_nest_deeply():
    """Every line lies in all elements before it; names are weighed once each, not once per line."""
    began = time.process_time()
    assert main_text("<div class=ad>x" * 20_000) == ""
    inner = "<div class=sidebar>" * 3000 + f"<article>{STORY}</article>" + "</div>" * 3000
    assert main_text(f"<div class=comments>{STORY}</div>{inner}") == TOLD
    assert time.process_time() - began < 8


def test_table(spark):
    rows = [(1, "u", "<p>a</p>", "own"), (1, "u", "<p>a</p>", "own"), (None, None, None, "own"), (2, "u", "", "own")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract_text(pages).collect()
    assert sorted((str(r.page_id), r.text) for r in got) == [("1", "a"), ("1", "a"), ("2", ""), ("None", "")]
    assert extract_text(pages.limit(0)).collect() == []
