"""Articles inside parts whose name or tag tells otherwise, and pages that are hard to read fast."""

import time

import pytest
from deedflow.llm import html_main

TEXT = "Some long running text, with commas, and enough words to count as a paragraph of an article. " * 3
P, LINE = f"<p>{TEXT}</p>", TEXT.strip()
MENU = "<nav><a href=x>Home</a></nav>"


@pytest.mark.parametrize(
    "page, lines",
    [
        (f"{MENU}<form id=whole><article><h1>Title</h1>{P}{P}</article></form><footer>(c) me</footer>", ["Title", LINE, LINE]),
        (f"{MENU}<form><div>{P}{P}</div></form><footer>(c) me</footer>", [LINE, LINE]),
        (f"{MENU}<fieldset>{P}{P}</fieldset>", [LINE, LINE]),
        (f"{MENU}<div class='content has-sidebar'><div>{P}{P}</div><aside>x{P}</aside></div>", [LINE, LINE]),
        (f"<div class='page no-sidebar comments-open'>{P}{P}</div>", [LINE, LINE]),
        (f"{MENU}<div class='main-header-layout'>{P}{P}</div><div class=footer>end</div>", [LINE, LINE]),
        (f"<header><p>Site</p></header><article><header><h1>Title</h1></header>{P}<footer>tags</footer></article>", ["Title", LINE]),
        (f"<article>{P}</article><section class=comments>{P * 30}</section>", [LINE]),
        (f"<article></article><section class=comments>{P * 30}</section><footer>(c) {TEXT}</footer>", []),
        (f"<div class=sidebar><p>Not, this, one</p></div><aside>{P}</aside><div id=x>{P}{P}</div>", [LINE, LINE]),
        (f"{MENU}<div class=cookie-notice><p>We use cookies, and more.</p></div>", []),
    ],
)
def test_what_counts_is_the_score(page, lines):
    assert html_main.main_text(page).split("\n") == (lines or [""])


@pytest.mark.parametrize(
    "page",
    [
        '<a "' * 250000, "<a href='x " * 90000, "<div>x" * 100000, "<div><b>" * 40000 + "</i>y" * 100000, "<a><div>" + "<b>" * 100000 + "</a>z" * 100000,
        "<ul>" + "<b>" * 100000 + "<li>x" * 100000, "<article class=sidebar>x" * 40000, "<p><b>" * 150000, "<table><tr><td>x" * 60000, "<" * 1000000, "x" * 1000000 + "&" * 100000,
    ],
)
def test_a_megabyte_takes_seconds(page):
    began = time.time()
    html_main.main_text(page)
    assert time.time() - began < 15


def test_stray_quotes_and_ends():
    assert html_main.main_text('<p class=x">one</p><p title="a>b\'">two</b></i></p><p a=\'"\' b>three') == "one\ntwo\nthree"
    assert html_main.main_text("<p>a<br/>b</p></div></p></span><p>c") == "a b\nc"
    assert html_main.main_text("<p>one <b") == "one"


def test_ties_go_to_the_first():
    assert html_main.main_text(f"<div><div id=a>{P}</div></div><div><div id=b>{P}</div></div>") == LINE
