from __future__ import annotations

import random

import pytest

from ledgersieve.llm import html_mss

FRAME = """<!DOCTYPE html><html><body><nav><ul><li><a href="/a">menu</a></li><li><a href="/b">more</a></li></ul></nav>
<div class="ad">Buy this thing today.{0}<footer>&copy; some foot words</footer></body></html>"""
LONG = " ".join(["word"] * 60)


@pytest.fixture(scope="module")
def weights():
    article = "<article><h1>Head</h1><p><b>First part<p>second part {0}</p></article>"
    return html_mss.learn([FRAME.format(article.format(i)) for i in range(40)])


CASES = {
    "links": ("<article>" + '<p>a <a href="u">b c</a> d <a href=x>e</a></p>' * 25 + "</article>", "a b c d e " * 25),
    "divs": ("<article>" + "<div>a b c d e f</div>" * 14 + "</article>", "a b c d e f " * 14),
    "list": ("<article><p>x</p><ul>" + "<li>a b c d</li>" * 14 + "</ul></article>", "x " + "a b c d " * 14),
    "list of single words": ("<article><p>x</p><ul>" + "<li>a</li>" * 9 + "</ul></article>", "x " + "a " * 9),
    "closed svg": ('<svg class="i"/><article><p>text is kept</p></article>', "text is kept"),
    "closed iframe": ('<iframe src="x"/><article><p>text is kept</p></article>', "text is kept"),
    "open button": ("<button>go<article><p>text is kept</p></article>", "text is kept"),
    "open button and another": ("<button>go<article><p>text is kept</p></article><button>x</button>", "text is kept"),
    "button": ("<article><p>text <button>press</button> kept</p></article>", "text kept"),
    "form around an article": ('<form action="x"><article><p>text is kept</p></article></form>', "text is kept"),
    "form around a page": (f"<form><input type=hidden><p>{LONG}</p><p>{LONG}</p></form>", f"{LONG} {LONG}"),
    "form to fill in": ("<article><p>text is</p><form><label>Mail me</label><input></form><p>kept</p></article>", "text is kept"),
    "comments inside": (f'<article><p>text</p><section class="comments"><p>{LONG}</p></section><p>kept</p></article>', "text kept"),
    "comments as articles": (f'<article><p>kept</p></article><div id="comments"><article><p>{LONG}</p></article></div>', "kept"),
    "comment articles": (f'<article><p>a</p><article class="comment"><p>{LONG}</p></article><p>b</p></article>', "a b"),
    "aside inside": (f"<article><p>text is</p><aside><p>{LONG}</p></aside><p>kept</p></article>", "text is kept"),
    "open aside": ("<article><p>text is</p><aside>note<p>kept</p></article>", "text is kept"),
    "headers": ("<header><h1>Site</h1></header><article><header><h1>Head</h1></header><p>kept</p></article>", "Head kept"),
    "advert longer than the article": (f"{LONG}<article><p>kept</p></article>", "kept"),
    "no label": (f'<div class="story"><p>{LONG}</p><ul>' + "<li>a b c</li>" * 5 + f"</ul><p>{LONG}</p></div><ul>"
                 + '<li><a href="q">q</a></li>' * 9 + "</ul>", f"{LONG} " + "a b c " * 5 + LONG),
}


@pytest.mark.parametrize("name", CASES)
def test_ordinary_pages_give_exactly_the_article(weights, name):
    inner, expected = CASES[name]
    assert html_mss.main_text(FRAME.format(inner), weights) == expected.strip()


def test_names_are_read_with_and_without_quotes():
    for attribute in ('class="x comments y"', "class='x comments'", "class=comments", 'id="comments"'):
        assert html_mss.main_text(f"<article><p>a</p><div {attribute}><p>b</p></div></article>", html_mss.Weights()) == "a"


def test_scan_equals_brute_force():
    draw = random.Random(5)
    for _ in range(300):
        scores = [draw.choice([-3, -2, -1, 0, 1, 2, 4]) for _ in range(draw.randrange(14))]
        sums = [sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)]
        start, end = html_mss.best_run(scores)
        assert sum(scores[start:end]) == max([0, *sums])


def test_weights_take_nothing_from_menus_and_wrappers(weights):
    assert not {"li", "ul", "a", "div", "article"} & weights.scores.keys()
    assert weights.scores["div.ad"] <= -html_mss.BESIDE_COST and weights.scores["nav"] <= -html_mss.BESIDE_COST
    wrapped = [f'<div class="page"><p>o</p>{FRAME.format("<article><p>a b</p></article>")}</div>' for _ in range(30)]
    wrapped = html_mss.learn(wrapped)
    assert not wrapped.apart
    assert html_mss.main_text(f'<div class="page"><p>{LONG}</p></div>', wrapped) == LONG
    story = "<article><p>a b</p></article>"
    learned = html_mss.learn([f'<div class="weather">sunny</div>{story}<div class="quiz">who</div>'] * 30)
    assert learned.apart == {"div.weather", "div.quiz"}
    assert html_mss.main_text(f'<div class="weather">{LONG}</div><p>b</p>', learned) == "b"


def test_pages_without_any_markup_or_end():
    empty = html_mss.Weights()
    assert [html_mss.main_text(p, empty) for p in (None, "", "a < b", "<", "<p", "</p>", "<article>a", "a</article>")] == [
        "", "", "a < b", "<", "", "", "a", "a"]
    assert len(html_mss.main_text("<article>" + "<div>x" * 20000, empty).split()) == 20000
