"""Main text of pages: marked pages word for word, the scan against all runs, odd markup."""

import html
import itertools
import random
import re

import pytest

from shelfscout.llm import html_extract
from shelfscout.llm.html_extract import best_run, main_text, pieces_of, weights_of

SF = "/root/testdata/sf0.001"
PLAIN = weights_of({}, 4.0)


def text_of(page, weights=PLAIN):
    return main_text(pieces_of(page), weights)


def between_marks(page):
    """The blocks of a test page's article, by patterns that fit only how these pages are made."""
    inside = re.search(r"<article>(.*)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", inside)
    blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", x.replace("<br>", " "))).split()) for x in blocks]
    return "\n\n".join(filter(None, blocks))


def test_marked_pages_give_their_article(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    want = {row.page_id: (row.url, between_marks(row.html)) for row in pages.collect()}
    found = html_extract.extract(pages, html_extract.train(pages))
    assert {r.id: (r.url, r.text) for r in found.collect()} == want
    assert found.where("n_chars != length(text)").count() == 0


def test_pages_without_marks_by_weights_of_marked_ones(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    weights = html_extract.train(pages)
    for row in pages.limit(40).collect():
        bare = row.html.replace("article>", "div>")
        assert text_of(bare, weights) == between_marks(row.html)


def test_run_is_the_best_of_all_runs():
    draw = random.Random(4)
    for _ in range(300):
        size = draw.randrange(0, 9)
        blocks = [draw.choice([-3, -1, 0, 1, 2, 5]) for _ in range(size)]
        gaps = [-draw.choice([0, 1, 2, 4]) for _ in range(size)]
        value = {
            (i, j): sum(blocks[i:j]) + sum(gaps[i + 1 : j]) for i, j in itertools.combinations(range(size + 1), 2)
        }
        best = max(value.values(), default=0)
        run = best_run(blocks, gaps)
        assert (value[run] if run != (0, 0) else 0) == max(best, 0)


FULL = """<html><head><title>T</title><style>x{}</style></head><body class="has-sidebar">
<header><a href=/>Site name</a><p>Our slogan here</p></header><div id="cookie-notice">We use cookies, a lot of them.</div>
<nav><ul><li><a href=1>One</a></ul></nav><div class=content><h1>Head&amp;line</h1><p>First &lt;b&gt; para<br>graph, <a href=2>linked
 words</a> and <em>more</em> of it.<script>if (a < b) { "</p>" }</script><div class="ad-slot">Buy now! Buy now! Buy now!</div>
<p>Second&nbsp;one &#233;&eacute; with an <!-- <p>hidden</p> --> end.<ul><li>item one is here<li>item two is here</ul>
<form action=x><label>Mail</label><input name=q><button>Go</button></form><noscript>Enable it</noscript><p hidden>unseen</p>
<table><tr><td>cell one<td>cell two</table></div><aside>Side words</aside><section id="comments"><p>I think that is all wrong.
<div class="comment">So do I and I write a long comment about it, with many more words than the text has.</div></section>
<footer>&copy; all of us</footer></body></html>"""
EXPECTED = [
    "Head&line",
    "First <b> para graph, linked words and more of it.",
    "Second one éé with an end.",
    "item one is here",
    "item two is here",
    "cell one",
    "cell two",
]


@pytest.mark.parametrize("holder", ["div class=content", "article", "main id=m", "section"])
def test_only_the_main_text_stays(holder):
    page = FULL.replace("<div class=content>", f"<{holder}>").replace(
        "</table></div>", f"</table></{holder.split()[0]}>"
    )
    assert text_of(page).split("\n\n") == EXPECTED


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("", ""),
        ("   ", ""),
        ("no markup at all", "no markup at all"),
        ("<p>a < b && c > d</p>", "a < b && c > d"),
        ("<p>cut off in a <b", "cut off in a"),
        ('<p>open <a href="x>quote</a> here</p>', "open quote here"),
        ("<p>one</b></i></p><p>two", "one\n\ntwo"),
        ("<script>only code", ""),
        ("<p>before <!-- never closed", "before"),
        ("<nav>menu</nav><footer>foot</footer>", ""),
        ("<div class='ad'>only an advert</div>", ""),
        ("<article><header><h1>Title</h1></header><p>Text of it</p></article>", "Title\n\nText of it"),
        ("<form><main><p>all inside one form</p></main></form>", "all inside one form"),
        ("<P>UPPER<BR/>case</P>", "UPPER case"),
        ("<p>a&#0;b&#x41;&nosuch;&am</p>", "a�bA&nosuch;&am"),
        ("<x-y>unknown tags <foo>keep</foo> text</x-y>", "unknown tags keep text"),
        ("</p></div>stray <br> ends", "stray ends"),
    ],
)
def test_odd_markup(page, want):
    assert text_of(page) == want


def test_long_pages_take_linear_time():
    for part, times in (("<p>word ", 60_000), ("<", 500_000), ("<a '", 120_000), ("<div>", 100_000), ("</b>", 200_000)):
        text_of(part * times)
    assert len(text_of("<div>" * 50_000 + "<p>" + "word " * 200_000).split()) == 200_000


def test_rows_of_every_kind(spark):
    schema = "page_id long, url string, html string, id string, text string, n_chars int"
    rows = [(1, "u", "<p>same</p>"), (1, "u", "<p>same</p>"), (None, None, "<p>x y</p>"), (2, "v", None), (3, "w", "")]
    pages = spark.createDataFrame([(*row, "i", "t", 0) for row in rows], schema)
    found = html_extract.extract(pages, html_extract.train(pages)).collect()
    got = sorted(((r.id, r.url, r.text, r.n_chars) for r in found), key=repr)
    assert got == sorted(
        [(1, "u", "same", 4)] * 2 + [(None, None, "x y", 3), (2, "v", "", 0), (3, "w", "", 0)], key=repr
    )
    nothing = pages.limit(0)
    assert html_extract.extract(nothing, html_extract.train(nothing)).count() == 0
