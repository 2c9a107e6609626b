"""Main text of small pages with every kind of clutter, and of the whole table."""

import html
import re

import pytest

from tallyloom.llm.main_text import extract_pages, main_text
from tallyloom.llm.queries import QUERIES

from .conftest import PROSE, clashing

PARAGRAPHS = [PROSE * 2, "Short one.", "With <b>bold</b>, <a href='/x'>one link</a> and &eacute;&amp;&#x41;. " + PROSE, PROSE * 3]
WANTED = " ".join(" ".join(html.unescape(re.sub("<[^>]*>", "", p)).split()) for p in PARAGRAPHS)
BODY = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
CLUTTER = [
    "<nav><ul><li><a href='/'>Home, sweet, home</a></li></ul></nav>",
    f"<header><h1>Site name</h1><p>{PROSE}</p></header>",
    f"<footer>{PROSE * 4}</footer>",
    f"<aside><p>{PROSE * 4}</p></aside>",
    f"<div class='sidebar left'><p>{PROSE * 5}</p></div>",
    f"<div id='cookie-notice'><p>{PROSE * 5}</p></div>",
    f"<div class='ad'>{PROSE * 5}</div>",
    f"<form><p>{PROSE * 5}</p><input><button>Go</button></form>",
    f"<script>var t='</p>{PROSE * 5}';</script><style>p{{}}</style><noscript>{PROSE}</noscript>",
    f"<section id='comments'><p>{PROSE * 9}</p><p>{PROSE * 9}</p></section>",
    f"<div role='dialog'><p>{PROSE * 5}</p></div><div hidden>{PROSE * 5}</div><div style='display: none'>{PROSE * 5}</div>",
    f"<!-- {PROSE * 5} --><template><p>{PROSE * 5}</p></template>",
    "<div>" + "".join(f"<a href='/{i}'>Read, more, of, this, and, that</a> " for i in range(30)) + "</div>",
]


@pytest.mark.parametrize("clutter", CLUTTER)
@pytest.mark.parametrize("box", ["<article>{}</article>", "<main>{}</main>", "<div class='post-body'>{}</div>", "<div>{}</div>", "<div><div>{}</div></div>"])
def test_clutter_goes_and_all_paragraphs_stay(clutter, box):
    assert main_text(f"<html><head><title>T</title></head><body>{clutter}{box.format(BODY)}{clutter}</body></html>") == WANTED


def test_clutter_inside_the_article():
    inner = BODY.replace("</p>", "</p>" + CLUTTER[6] + CLUTTER[9] + CLUTTER[0], 1)
    assert main_text(f"<body><article>{inner}</article></body>") == WANTED


WRAPPERS = ["class='content with-sidebar'", "id='page' class='header-fixed'", "class='overflow-hidden'", "class='no-sidebar'", "class='site comments-open has-ads'", "id='newsletter-4'"]


@pytest.mark.parametrize("wrapper", WRAPPERS)
@pytest.mark.parametrize("box", ["<article>{}</article>", "<main>{}</main>", "<div class='post-body'>{}</div>", "<div>{}</div>", "{}"])
def test_wrappers_with_unlikely_words(wrapper, box):
    inner = f"<div {wrapper}>{box.format(BODY)}</div>"
    assert main_text(f"<body>{inner}</body>") == WANTED
    assert main_text(f"<body><div class='layout-menu'><section class='skip'>{inner}</section></div></body>") == WANTED
    for clutter in CLUTTER[:9]:
        assert main_text(f"<body>{clutter}{inner}</body>") == WANTED
        assert main_text(f"<body><div {wrapper}>{clutter}{box.format(BODY)}{clutter}</div></body>") == WANTED


def test_clutter_is_no_wrapper():
    comments = f"<div id='comments'><article class='comment'><p>{PROSE * 20}</p></article></div>"
    assert main_text(f"<body><div class='no-sidebar'>{BODY}{comments}</div></body>") == WANTED
    teaser = f"<div class='sidebar'><article><p>{PROSE}</p></article></div>"
    assert main_text(f"<body>{teaser}<div class='no-sidebar'><article>{BODY}</article></div></body>") == WANTED
    assert main_text(f"<body><article>{BODY}</article>{teaser * 40}</body>") == WANTED
    assert main_text(f"<body><div>{BODY}</div>{teaser}</body>") == WANTED
    assert main_text(f"<body><article>{BODY}</article><div class='sidebar'><p>{PROSE * 30}</p></div></body>") == WANTED
    assert main_text(f"<body><div>{BODY}</div><div id='cookie-consent'><p>{PROSE * 30}</p></div></body>") == WANTED


NAMES = ["sidebar", "menu", "footer", "widget", "header", "navbar", "toolbar", "banner", "modal", "hidden", "search", "comments", "discussion", "respond", "cookie", "adsbygoogle", "newsletter", "related", "share-bar"]


@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("box", ["<article>{}</article>", "<main>{}</main>", "<div class='post-body'>{}</div>", "<div>{}</div>"])
def test_clutter_that_is_longer_than_the_article(name, box):
    for attribute in ("class", "id"):
        clutter = f"<div {attribute}='{name}'><p>{PROSE * 30}</p><p>{PROSE * 9}</p></div>"
        assert main_text(f"<body>{clutter}{box.format(BODY)}</body>") == WANTED
        assert main_text(f"<body><div>{box.format(BODY)}</div>{clutter}{clutter}</body>") == WANTED
        inner = BODY.replace("</p>", f"</p><div {attribute}='{name}'>BUY NOW, leave a reply. {PROSE * 9}</div>", 1)
        assert main_text(f"<body>{box.format(inner)}</body>") == WANTED


def test_broken_markup():
    assert main_text(f"<body><article><p><b>One, two<br><p>{PROSE}</article><footer>foot") == f"One, two {PROSE.strip()}"
    assert main_text(f"<body><article><p>{PROSE}<nav><a>menu</a></article>") == PROSE.strip()
    assert main_text(f"<p>{PROSE}<p>{PROSE}") == f"{PROSE.strip()} {PROSE.strip()}"
    assert main_text(f"<![odd[<!doctype <p>{PROSE}</p></div></p>{PROSE}")


@pytest.mark.parametrize("page", ["", " ", "<", "<html>", "<p>", "</p>", "<script>", "&", "&#0;", "<a" * 50, "<div>" * 5000, "<!--", "<![CDATA[x", "\x00", "<p>a</p" * 3])
def test_any_page_gives_some_text(page):
    assert isinstance(main_text(page), str)


def test_long_page():
    assert len(main_text(f"<article>{BODY * 300}</article>")) == 300 * (len(WANTED) + 1) - 1


def test_whole_table(spark, folder):
    pages = {r.page_id: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    df = QUERIES["op4_html_extraction"](spark, folder)
    assert df.columns == ["page_id", "url", "text", "n_chars"]
    rows = df.collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search("<article>(.*?)(</article>|<footer|$)", pages[r.page_id].html, re.S)[1]
        article = re.sub("<br>|</?p>|</?h1>", " ", article).replace("<b>", "").replace("</b>", "")
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, " ".join(html.unescape(article).split()), len(r.text))


def test_awkward_rows(spark):
    rows = [(1, None, None), (2, "u", ""), (2, "u", ""), (None, "u", f"<p>{PROSE}</p>"), (4, "u", "plain text only")]
    got = extract_pages(clashing(spark.createDataFrame(rows, "page_id long, url string, html string"))).collect()
    assert sorted((r.page_id or 0, r.text) for r in got) == [(0, PROSE.strip()), (1, ""), (2, ""), (2, ""), (4, "plain text only")]
    assert extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
