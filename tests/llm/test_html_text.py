"""Main text of the given pages by their template, of pages built in other ways, and of broken pages."""

import html
import re
import time

import numpy as np
import pytest

from tierloom.llm import html_text
from tierloom.llm.queries import QUERIES
from tierloom.llm.shared import read

LONG = "The quick brown fox jumps over the lazy dog and runs along the river until evening falls over the quiet town."


def by_template(page):
    """Text of a given page: its one article, cut at paragraphs and headings."""
    article = page.split("<article>", 1)[1].rsplit("</article>", 1)[0]
    parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", part)).split()) for part in re.split(r"</?(?:p|h1)>", article))
    return "\n\n".join(p for p in parts if p)


def test_given_pages(spark, sf_dir):
    pages = {r["page_id"]: r for r in read(spark, sf_dir, "pages").collect()}
    found = QUERIES["op11_html_text"](spark, sf_dir).collect()
    assert len(found) == len(pages)
    for row in found:
        assert row["url"] == pages[row["page_id"]]["url"]
        assert row["text"] == by_template(pages[row["page_id"]]["html"])
        assert row["n_chars"] == len(row["text"])


LAYOUTS = {
    "class names": (
        f"""<body class="has-sidebar"><div id="header"><a href=/>Home</a> Name</div><div class="navbar"><ul><li><a>A</a><li><a>B</a></ul></div>
        <div class="cookie-notice"><p>{LONG}</p></div><div class="post-content"><h1>T &amp t</h1><p>{LONG}<p>Short.<ul><li>One<li>Two</ul>
        <blockquote>Q</blockquote><div class="ad-slot">{LONG}</div><p>{LONG}<table><tr><td>a<td>b<tr><td>c</table></div>
        <div id="sidebar"><p>{LONG}</div><div class="comments"><p>{LONG * 3}</p></div><div class=footer>(c)</div>""",
        ["T & t", LONG, "Short.", "One", "Two", "Q", LONG, "a b", "c"],
    ),
    "no names": (
        f"""<html><body><div><a>Home</a> <a>News</a></div><div><div><h1>T</h1><p>{LONG * 2}</p><p>Short.</p><p>{LONG}</p></div>
        <div><ul><li><a>x</a></li><li><a>yy</a></li></ul></div></div><div>Copyright 2024</div></body></html>""",
        ["T", LONG * 2, "Short.", LONG],
    ),
    "one block a paragraph": (
        f"<div><a>Home</a></div><div id=c><div>{LONG}</div><div>Short.</div><div>{LONG}</div></div><div>Copyright</div>",
        [LONG, "Short.", LONG],
    ),
    "form around the page": (
        f"<form><div><input><label>Search</label></div><main><h1>T</h1><p>{LONG}</p></main></form>",
        ["T", LONG],
    ),
    "header, alerts, comments and copyright by name": (
        f"""<div class="site-header">Site</div><div class="alert alert-info">{LONG}</div><div class="post"><div class="entry-content">
        <div class="entry-header"><h1>T</h1><p>By A</p></div><p>{LONG}</p><p>Be.</p><p>{LONG}</p></div><div class="entry-footer">Tags</div></div><ol class="commentlist"><li>{LONG}</ol>
        <div class="copyright">(c) {LONG}</div>""",
        ["T", "By A", LONG, "Be.", LONG],
    ),
    "nothing but a form": (f"<form><div><p>{LONG}</p><p>Be.</p></div></form>", [LONG, "Be."]),
    "parts inside the article": (
        f"""<header><h1>Site</h1></header><main><article><header><h1>T</h1></header><p>Be.<p>{LONG}<form>Name <input></form><aside>{LONG}</aside>
        <footer>by me</footer><section class="comments"><article><p>{LONG}</article></section></article></main><aside>{LONG}</aside>""",
        ["T", "Be.", LONG],
    ),
    "hidden and scripts": (
        f"""<article><p>{LONG}</p><script>var a = "</p><p>no";</script><style>p {{}}</style><noscript><p>no</p></noscript><p hidden>no</p>
        <p style="display: none">no</p><!-- <p>no</p> --><textarea><p>no</textarea>tail&nbsp;&lt;b&gt; x<br>y</article>""",
        [LONG, "tail <b> x y"],
    ),
    "cut in a reference": (f"<article><p>{LONG}</p><p>cut &am", [LONG, "cut &am"]),
    "cut in a comment": (f"<article><p>{LONG}</p><!-- cut <p>no", [LONG]),
    "cut in a tag": (f"<article><p>{LONG}</p><p>A<a hr", [LONG, "A"]),
    "cut in a script": (f"<p>{LONG}</p><script>var x = '<p>no", [LONG]),
    "odd declarations": ("<![if x]><p>a < b & c &lt;d&gt;<![endif]><![CDATA[ q ]]>", ["a < b & c <d>"]),
    "end tags without a start": (f"</div></p><p>{LONG}</b></article></p>", [LONG]),
    "no markup": ("just  text\n&\tmore", ["just text & more"]),
    "empty": ("", []),
    "blank": (" <p> &nbsp; </p> ", []),
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_layouts(name):
    page, expected = LAYOUTS[name]
    assert html_text.blocks(page) == expected


def test_smoothing_against_sums():
    ratios = np.array([3.0, 0.0, 10.0, 1.0, 1.0, 7.5])
    weight = lambda d: np.exp(-0.5 * (d / html_text.SIGMA) ** 2)
    for i, value in enumerate(html_text.smoothed(ratios)):
        near = [j for j in range(len(ratios)) if abs(i - j) <= html_text.RADIUS]
        assert value == pytest.approx(sum(weight(i - j) * ratios[j] for j in near) / sum(weight(i - j) for j in near))
    assert html_text.smoothed(np.array([4.0])).tolist() == [4.0]


@pytest.mark.parametrize("page", ["<div>a" * 20_000, "<b>" * 20_000 + "<p>x" * 20_000, "<" * 50_000, "a " * 2_000_000, "<ul><li><a>q</a>" * 20_000, "<!--" * 50_000])
def test_long_and_deep_pages(page):
    start = time.monotonic()
    html_text.blocks(page)
    assert time.monotonic() - start < 20


def test_nulls_repeats_clashing_names_and_empty_table(rows):
    pages = rows("page_id long, url string, html string, blocks string, k0 int", (1, None, None, "b", 1), (None, "u", "<p>a", "b", 1), (2, "u", "<p>x</p>y", "b", 1), (2, "u", "<p>x</p>y", "b", 1))
    found = html_text.main_text(pages, keep=("page_id", "url", "k0")).collect()
    assert sorted(map(str, found)) == sorted(
        ["Row(page_id=1, url=None, k0=1, blocks=[])", "Row(page_id=None, url='u', k0=1, blocks=['a'])"] + ["Row(page_id=2, url='u', k0=1, blocks=['x', 'y'])"] * 2
    )
    assert html_text.main_text(pages.where("false")).collect() == []
