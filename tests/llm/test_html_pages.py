"""Main text: what an article keeps, broken and very deep markup, and every given page against a plain reading of its article."""

import re
from html import unescape

import pytest

from tabmill.llm import html_consensus

SF = "/root/testdata/sf0.001"


def prose(word):
    return " ".join(f"{word}{i}, and so on" for i in range(12)) + "."


def in_article(inner):
    text = html_consensus.extract(f"<body><article><p>{prose('a')}</p>{inner}<p>{prose('z')}</p></article></body>", [])
    start, end = prose("a") + "\n", "\n" + prose("z")
    assert text.startswith(start.rstrip()) and text.endswith(end.lstrip())
    return text[len(start):-len(end)]


@pytest.mark.parametrize("inner, want", [
    ('<h2 id="related-work">Related work</h2>', "Related work"),
    ('<p id="form-of-words">A form of words</p>', "A form of words"),
    (f'<section id="social-history"><p>{prose("s")}</p></section>', prose("s")),
    (f'<div id="search"><p>{prose("s")}</p></div>', prose("s")),
    (f'<div class="legal"><p>{prose("s")}</p></div>', prose("s")),
    ("<p>Energy <math><mi>E</mi>=mc2<annotation>E=mc^2</annotation></math> holds.</p>", "Energy E=mc2 holds."),
    ("<p>Press <button>OK</button>, then the <label>box</label>.</p>", "Press OK, then the box."),
    ("<header><h1>Its own title</h1><nav>Menu</nav></header>", "Its own title"),
    ("<div><button>Share</button></div>", ""),
    ('<p class="advert">Buy this now, please</p>', ""),
    ('<div class="related"><a href="#">Another page</a><a href="#">One more</a></div>', ""),
    ('<p class="copyright">(c) us</p>', ""),
    (f'<div class="sidebar"><p>{prose("s")}</p></div>', ""),
    (f'<div id="comments"><p>{prose("s")}</p></div>', ""),
    (f"<aside><p>{prose('s')}</p></aside>", ""),
    ('<form><label>Name</label></form>', ""),
])
def test_what_an_article_keeps(inner, want):
    assert in_article(inner) == want


@pytest.mark.parametrize("broken, text", [('<a "x ' * 150_000, None), ('<a ">" ' * 60_000, None), ("<div>" * 50_000, ""), ("<script>" * 60_000, ""),
                                          ("<!" * 100_000, None), ("<div>" * 30_000 + "</section>" * 30_000, ""), ('<span class="ad">' * 30_000, "")])
def test_broken_markup_takes_linear_time(broken, text):
    got = html_consensus.extract(f"<body><p>{prose('a')}</p></body>{broken}", [])
    assert got.startswith(prose("a")) and (text is None or got == prose("a"))


def test_deep_nesting_is_kept_whole():
    deep = "<div class='d1'>" * 20_000 + f"<p>{prose('a')}</p>" + "</div>" * 20_000
    page = html_consensus.parse(deep)
    best = html_consensus.best_container(page)
    path = page.path_text(page.containers[best].path)
    assert path.count(">") == 19_999 and page.path_number(path) == page.containers[best].path
    assert html_consensus.extract(deep, [path]) == prose("a") == html_consensus.extract(deep, ["body>main"])


def plain_article(html):
    inner = re.search(r"<article[^>]*>(.*?)</article>", html, re.S)[1]
    blocks = re.split(r"</?(?:p|h[1-6]|ul|li|div)\b[^>]*>", inner.replace("<br>", " "))
    texts = (" ".join(re.sub(r"\s+", " ", unescape(re.sub(r"<[^>]+>", "", b))).split(" ")).strip() for b in blocks)
    return "\n".join(t for t in texts if t)


def test_every_given_page_equals_its_article(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    html = {r["page_id"]: r["html"] for r in pages.select("page_id", "html").collect()}
    got = {r["page_id"]: r["text"] for r in html_consensus.main_text(pages).collect()}
    assert got.keys() == html.keys()
    for k, text in got.items():
        assert text == plain_article(html[k]), k
