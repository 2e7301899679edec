"""Main text of pages."""

from __future__ import annotations

import html
import re

import pytest

from tallyrank.llm import html_text
from tallyrank.llm.html_text import main_text

PROSE = "This is the kind of text that is found in an article and it goes on for a while."

CASES = {
    "article": (
        f"<head><title>T</title></head><nav><a href=/>Home</a></nav><article><h1>Head</h1><p>{PROSE}</p>"
        "<p>Short.</p></article><footer>&copy; all of it</footer>",
        f"Head\n\n{PROSE}\n\nShort.",
    ),
    "parts_that_go": (
        f"<article><p>{PROSE}</p><div class='ad-slot'>Buy <b>now</b></div><aside>side</aside>"
        f"<form>Name<input></form><section id=comments><p>{PROSE}</p></section><p>End</p></article>",
        f"{PROSE}\n\nEnd",
    ),
    "no_article": (
        f"<div id=menu><a href=a>A</a> <a href=b>B</a></div><div><p>{PROSE}</p><p>Yes.</p></div>"
        "<div class='cookie-notice'>We use cookies on this site and you will like them as we do.</div>",
        f"{PROSE}\n\nYes.",
    ),
    "names": (
        f"<div class='site-header'>{PROSE}</div><div class='entry-header'><h1>Head</h1></div><div id=post>"
        f"<p>{PROSE}</p></div><div class=leftSidebar>{PROSE}</div><div id='ad_1'>{PROSE}</div>"
        f"<div class=pagefooter>{PROSE}</div>",
        f"Head\n\n{PROSE}",
    ),
    "links": (f"<p>{PROSE}</p><p><a href=1>one two</a> <a href=2>three</a></p>", PROSE),
    "references": ("<article><p>a&amp;b &lt;x&gt; &eacute;&#233;&#xE9; &copy &unknown; &am</p></article>",
                   "a&b <x> ééé © &unknown; &am"),
    "white_space": ("<article><p> a\n\t b&nbsp;&#8195;c<br>d </p></article>", "a b c d"),
    "scripts": ("<article>a<script>if (x < 1) '</p>'</script><style>p{}</style><!-- <p>no</p> -->b</article>", "ab"),
    "unclosed": (f"<article><p><b>{PROSE}<br><p>two<p>three<div class=ad>no</div><p>four", f"{PROSE}\n\ntwo\n\nthree\n\nfour"),
    "cut_tag": ("<article><p>one</p><p cla", "one"),
    "cut_comment": ("<article><p>one</p><!-- two", "one"),
    "less_than": ("<article><p>1 < 2 and 3 > 2</p></article>", "1 < 2 and 3 > 2"),
    "plain": ("only words", "only words"),
    "empty": ("", ""),
    "none": (None, ""),
    "all_out": ("<nav>a</nav><footer>b</footer>", ""),
}


@pytest.mark.parametrize("name", CASES)
def test_cases(name):
    page, want = CASES[name]
    assert main_text(page) == want


def test_short_blocks_follow_their_neighbours():
    junk = "<p><a href=1>one two three</a></p>"
    page = f"{junk}<p>near junk</p>{junk}<div><p>{PROSE}</p><p>near prose</p><p>{PROSE}</p></div>"
    assert main_text(page) == f"{PROSE}\n\nnear prose\n\n{PROSE}"


LONG = f"{PROSE} Two of them are more than one, and that is what it is about."
STORY = f"<h1>Head</h1><p>{PROSE}</p><p>Short.</p><p>{LONG}</p>"
WANT = f"Head\n\n{PROSE}\n\nShort.\n\n{LONG}"
SIDE = "<div class=sidebar><p>Subscribe to our letter and you will get it in your box every day of the week.</p></div>"
TALK = f"<div id=comments><p>{PROSE} I do not think so, and you are wrong about it.</p></div>"
LAYOUTS = {
    "no_sidebar": f"<div class='wrap no-sidebar'>{STORY}</div>",
    "has_sidebar": f"<div class='layout has-sidebar'><main>{STORY}</main>{SIDE}</div>",
    "ad_free": f"<div class='ad-free page'><article>{STORY}</article></div>",
    "comments_open": f"<div class='post comments-open'>{STORY}{TALK}</div>",
    "widget": f"<div class='elementor-widget container'><article>{STORY}</article></div>{SIDE}",
    "widgets": "".join(f"<div class=elementor-widget>{x}</div>" for x in (f"<p>{PROSE}</p>", f"<p>{LONG}</p>", f"<p>{LONG}</p>")),
    "page_form": f"<form id=aspnetForm><input type=hidden><div id=menu><a href=/>A</a></div><div>{STORY}</div><button>Go</button></form>",
    "page_form_article": f"<form id=aspnetForm><select><option>1</select><article>{STORY}</article></form>",
    "open_nav": f"<nav><a href=/>Home</a><ul><li><a href=/a>A</a></ul><article>{STORY}</article>",
    "overlay": f"<div class='overlay'><section class='social'>{STORY}</section></div><div class=footer>All rights</div>",
    "share_in_story": f"<div class=promo-page>{STORY}<div class=share><a href=1>Share</a></div></div>",
    "plain_talk": f"<div>{STORY}</div>{TALK}{TALK}{TALK}{TALK}",
    "talk_of_articles": f"<div class=content>{STORY}</div><section class=comments><article class=c><p>{PROSE}</p></article></section>",
    "side_form": f"<div>{STORY}</div><form>Name <input> and tell us what you think of it, if you will be so kind.</form>",
    "cookie": f"<div class=cookie-bar><p>{LONG}</p></div><article><p>Short story.</p></article>",
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_names_are_reasons_not_verdicts(name):
    want = {"widgets": f"{PROSE}\n\n{LONG}\n\n{LONG}", "cookie": "Short story."}.get(name, WANT)
    assert main_text(LAYOUTS[name]) == want


def test_story_in_a_div_beside_article_teasers():
    page = f"<div><p>{PROSE}</p><p>{PROSE} Two.</p></div><article><h3>Teaser</h3></article>"
    assert html_text.main_text(page).startswith(f"{PROSE}\n\n{PROSE} Two.")


def test_short_blocks_in_an_article_follow_their_neighbours():
    links = "<p><a href=/>one</a> <a href=/>two</a></p>"
    page = f"<article><p>{PROSE}</p><p>Short.</p><p>{PROSE}</p>{links}<p>Tags</p>{links}</article>"
    assert html_text.main_text(page) == f"{PROSE}\n\nShort.\n\n{PROSE}"


def test_long_page_in_linear_time():
    page = "<article>" + f"<p>{PROSE}</p>" * 20_000 + "</article>"
    assert main_text(page).count("\n\n") == 19_999


def test_every_article_of_the_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in html_text.extract(pages).collect()}
    assert len(got) == pages.count()
    for page_id, _, page in pages.collect():
        body = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)[1]
        blocks = (
            " ".join(html.unescape(re.sub(r"<[^>]*(?:>|\Z)", "", b)).split())
            for b in re.split(r"</?(?:p|h1)>", body)
        )
        assert got[page_id] == "\n\n".join(b for b in blocks if b)


def test_columns(spark):
    rows = [(1, "<p>x</p>", "old", 3), (1, "<p>x</p>", "old", 3), (None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string, n_chars int")
    out = html_text.extract(pages)
    assert out.columns == ["page_id", "html", "text", "n_chars"]
    assert sorted((r["text"], r["n_chars"]) for r in out.collect()) == [("", 0), ("x", 1), ("x", 1)]
    assert html_text.extract(pages.limit(0)).count() == 0
