import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from placeweave.llm import main_text as module
from placeweave.llm.main_text import extract, lines_of, main_text, smoothed

LONG = "A long paragraph of running text that says something about the matter at hand, and goes on for a while."
PAGE = f"""<!DOCTYPE html><html class="no-sidebar"><head><title>T</title><style>p{{}}</style><script>var a = "<p>no</p>";</script></head><body>
<header><a href="/">Site</a> <h2>{LONG}</h2></header><nav><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></nav>
<div class="cookie-notice">{LONG} We use cookies.</div><main><article><h1>Title &amp; more</h1><p>{LONG}<br>Next&nbsp;line <b>bold</b>
<p>Short.</p><table><tr><td>cell one<td>cell two</table><ul><li>first<li>second</ul><form><input value=x><button>Go</button>{LONG}</form>
<aside>{LONG}</aside><div id="ads">{LONG}</div><p>The end.</article><section class="comments"><article class="comment">{LONG}</article></section></main>
<footer>&copy; {LONG}</footer></body></html>"""


def test_article_without_its_surroundings():
    assert main_text(PAGE).split("\n") == ["Title & more", f"{LONG} Next line bold", "Short.", "cell one", "cell two", "first", "second", "The end."]


def test_pages_that_mark_no_article():
    page = f"<body><div id=menu><a href=1>x</a> <a href=2>y</a></div><div><p>{LONG}</p><p>Brief.</p><p>{LONG}</p></div><div><a href=3>z</a> <a href=4>w</a></div></body>"
    assert main_text(page).split("\n") == [LONG, "Brief.", LONG]


def test_short_articles_and_empty_pages():
    assert main_text("<nav><a>Much longer than the text</a></nav><article><p>Hi.</p></article>") == "Hi."
    for page in (None, "", "<script>x", "<nav>only</nav>", "<p>", "<!-- open -->"):
        assert main_text(page) == ""
    assert main_text("just text &lt;here") == "just text <here"


def test_broken_markup_is_read_as_far_as_it_goes():
    assert main_text(f"<article><p><b>{LONG}<br><p>Two</b></i></p><p>Three") .split("\n") == [LONG, "Two", "Three"]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="<>/&;!-\"'= \nabpdivul\u00a0é[]?", max_size=120))
def test_any_text_can_be_read(page):
    text = main_text(page)
    assert all(line and line == " ".join(line.split()) for line in text.split("\n")) or text == ""
    assert all(line.tags >= 0 and 0 <= line.spoken <= len(line.text) for line in lines_of(page))


def test_smoothing_keeps_a_level():
    assert smoothed(__import__("numpy").full(7, 3.0)).tolist() == [3.0] * 7 or abs(smoothed(__import__("numpy").full(7, 3.0)) - 3).max() < 1e-9


def test_rows(spark):
    rows = [(1, "u", None, "clash"), (2, None, "", "clash"), (3, "u", PAGE, None), (3, "u", PAGE, None), (4, "u", "<p>" + "word " * 200_000, None)]
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"), keep=("page_id", "url"))
    found = sorted((r.page_id, r.n_chars, len(r.text)) for r in got.collect())
    assert [(i, n) for i, n, _ in found] == [(i, m) for i, _, m in found] and found[0] == (1, 0, 0) and found[-1] == (4, 999_999, 999_999)
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("page, text", [
    (f"<html><head><title>T</title><body><article><p>{LONG}</article>", LONG),  # a head left open
    (f"<title>T</title>{LONG}<p>{LONG}", f"{LONG}\n{LONG}"),
    (f'<div class="layout with-sidebar"><article><p>{LONG}</article></div>', LONG),  # names that say something else
    (f'<div class="sidebar"><article><p>{LONG}</article></div>', LONG),  # a name around everything
    (f'<article><div class="article-header"><h1>Title</h1></div><p class="market-share">{LONG}<section class="related-work"><p>More.</section></article>', f"Title\n{LONG}\nMore."),
    (f"<nav><a href=1>x</a><article><p>{LONG}</article>", LONG),  # a menu left open
    (f'<div class="comments"><p>{LONG * 5}</div><article><p>{LONG}</article>', LONG),
    (f'<div><p>{LONG}</p></div><div class="comment-list"><p>{LONG * 3}</div>', LONG),
    (f"<article><p>{LONG}<p><a href=1>Source</a></article>", f"{LONG}\nSource"),
    ("<article>" + "<span>" * 40 + f"<p>{LONG}" + "<b>" * 20 + "<p>Two.", f"{LONG}\nTwo."),  # a paragraph open far above
])
def test_pages_that_word_lists_alone_got_wrong(page, text):
    assert main_text(page) == text


def test_the_threshold_decides(monkeypatch):
    menu = "<ul><li><a href=1>one more thing</a> <a href=2>to read</a><li><a href=3>and another</a></ul>"
    for page in (f"<article><p>{LONG}<p>Short.</p>{menu}<p>{LONG}</article>", f"<div><p>{LONG}<p>Short.<p>{LONG}</div><div>{menu}</div>"):
        assert main_text(page).split("\n") == [LONG, "Short.", LONG]
        with monkeypatch.context() as patch:
            patch.setattr(module, "threshold", lambda values: -1.0)
            assert "and another" in main_text(page)


def test_generated_pages_come_back_as_they_were_written():
    """Articles of random blocks between random surroundings, against the blocks they were made of."""
    draw = random.Random(3)
    words = lambda low, high: " ".join(draw.choice(("ash", "birch &", "cedar", "d<e", "f\u00e9")) for _ in range(draw.randint(low, high)))
    shown = lambda text: text.replace("&", "&amp;").replace("<", "&lt;")

    def beside():
        return draw.choice((
            lambda: f"<nav>{''.join(f'<a href=x>{shown(words(1, 2))}</a>' for _ in range(4))}</nav>", lambda: f"<header><h2>{shown(words(3, 40))}</h2></header>",
            lambda: f'<div class="cookie-notice">{shown(words(5, 40))}</div>', lambda: f'<div id="ads">{shown(words(5, 40))}</div>', lambda: f"<form><p>{shown(words(2, 9))}<input></form>",
            lambda: f'<section class="comments"><article><p>{shown(words(5, 60))}</article></section>', lambda: "<script>var a = '<p>no</p>';</script>", lambda: ""))()
    for _ in range(300):
        blocks = [words(1, 3)] + [words(1, 60) for _ in range(draw.randint(1, 8))]
        inner = f"<h1>{shown(blocks[0])}</h1>"
        for block in blocks[1:]:
            form = draw.choice(("<p>{}</p>", "<p>{}", "<ul><li>{}</ul>", "<blockquote><p>{}</blockquote>", "<p><b>{}</b></p>", "<div>\n {} \n</div>", "<table><tr><td>{}</table>"))
            inner += form.format(shown(block).replace(" ", draw.choice((" ", "\n", " <i> </i> ")))) + draw.choice(("", "", "<aside>no</aside>", "<!-- x -->"))
        page = f"<html><head><title>t</title>{draw.choice(('</head>', ''))}<body>{beside()}{beside()}<article>{inner}</article>{beside()}{beside()}<footer>f</footer>"
        assert main_text(page).split("\n") == blocks
