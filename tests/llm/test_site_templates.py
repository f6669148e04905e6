"""Site templates: a plain version of the counting, templates without the help of names, broken and very long pages."""

import random
import time
from collections import defaultdict

import pyarrow.parquet as pq
import pytest

from conftest import SMALL_SF
from vitrina.llm import html_main_text, html_tree


def plain_extract(pages, min_pages=html_main_text.MIN_PAGES):
    """(id, url, html) -> {id: text}, by the rules: subtrees on enough pages with enough different contents are templates."""
    host = lambda url: url.split("//")[1].split("/")[0].lower() if url and "//" in url else ""
    found, on = {}, defaultdict(set)
    for _, url, html in pages:
        page = (host(url), html or "")
        if page not in found:
            found[page] = html_main_text.main_hashes(html_tree.parse(html or ""))
            for value in found[page][0]:
                on[page[0], value].add(page)
    recurring = {k for k, v in on.items() if len(v) >= min_pages}
    contents = defaultdict(set)
    for page, (own, rest) in found.items():
        content = frozenset({m for v, m in own.items() if (page[0], v) not in recurring and m is not None} | ({("rest", rest)} if rest is not None else set()))
        for value in own:
            if (page[0], value) in recurring:
                contents[page[0], value].add(content)
    known = {k for k, v in contents.items() if len(v) >= min_pages}
    return {i: html_main_text.main_text(html or "", {v for h, v in known if h == host(url)}) for i, url, html in pages}


def site(pages, variants=4, article="div"):
    """Pages of two hosts whose frames carry no telling name; the article is a plain element."""
    out = []
    for i in range(pages):
        v = i % variants
        story = " ".join(f"word{i}x{k}" for k in range(20))
        out.append((i, f"http://h{i % 2}.org/{i}", f"<body><div class=k{v}><ul><li>Start {v}</li><li>Shop</li></ul></div>"
                    f"<{article}><h1>Title {i}</h1><p>{story}</p></{article}><table><tr><td>Buy now {v}</td></tr></table><p>All rights {v}</p></body>",
                    f"Title {i} {story}"))
    return out


def test_templates_alone_give_the_article(monkeypatch):
    """No name of a tag or class helps here: what recurs on the site goes, the rest is the article."""
    for words in ("APART_WORDS", "APART_TAGS", "HEADER_WORDS", "APART_ROLES"):
        monkeypatch.setattr(html_tree, words, frozenset())
    pages = site(60)
    assert plain_extract([p[:3] for p in pages]) == {i: text for i, _, _, text in pages}
    off = {i: html_main_text.main_text(html, set()) for i, _, html, _ in pages}
    assert all(off[i] != text for i, _, _, text in pages)


def test_spark_equals_the_plain_version(spark):
    pages = [p[:3] for p in site(40)]
    draw = random.Random(2)
    for i in range(100, 160):  # copies of three articles in many frames, nulls, repeated rows
        pages.append((i, f"http://h{i % 3}.org/{i}", f"<nav>n{draw.randrange(30)}</nav><section><div>Article {i % 3}</div></section><footer>f{i % 4}</footer>"))
    pages += [(200, None, None), (201, "http://h0.org", ""), (202, None, "<p>no host</p>"), pages[0], pages[0]]
    df = spark.createDataFrame([(*p, "x", 1) for p in pages], "page_id bigint, url string, html string, page string, templates int").repartition(5)
    got = html_main_text.extract(df).collect()
    assert len(got) == len(pages) and {r.page_id: r.text for r in got} == plain_extract(pages)


def test_templates_change_texts_of_spark(spark):
    pages = site(40)
    df = spark.createDataFrame([p[:3] for p in pages], "page_id bigint, url string, html string")
    text = lambda least: {r.page_id: r.text for r in html_main_text.extract(df, min_pages=least).collect()}
    assert text(html_main_text.MIN_PAGES) == {i: t for i, _, _, t in pages}
    assert text(10 ** 9) != text(html_main_text.MIN_PAGES)


def test_templates_choose_the_group_of_articles():
    """A teaser list that recurs doesn't win over the page's article, however long it is."""
    teasers = "<div>" + "".join(f"<article><p>A long teaser of another story, number {k}</p></article>" for k in range(9)) + "</div>"
    root = html_tree.parse(f"<body>{teasers}<section><article><p>Short story.</p></article></section></body>")
    skip = {id(e) for e in html_tree.elements(root) if e.tag == "p" and "teaser" in html_tree.text_of(e)}
    assert [html_tree.text_of(r, skip) for r in html_tree.main_roots(root, skip)] == ["Short story."]


@pytest.mark.parametrize("html, text", [
    ("<body><form><div><article><p>Hi <b>you</b></p></article></div></form></body>", "Hi you"),
    ("<form><main><p>Main</p><form><p>Subscribe</p></form></main></form>", "Main"),
    ("<p>a<form><p>b</p></form>", "a"),
    ("<p>one<p>two</p></div></x>three", "one two three"),
    ("<div><p>one<div>two</div></div>", "one two"),
    ("<ul><li>a<ul><li>b</ul><li>c</ul>", "a b c"),
    ("<p>1 <b>2<p>3", "1 2 3"),
    ("<a 'x>text</a><p>y</p>", "text y"),
    ("x < y <b", "x < y <b"),
])
def test_single_pages(html, text):
    assert html_main_text.main_text(html, set()) == text


@pytest.mark.parametrize("page", ["<a " * 700_000, "<div>" * 200_000 + "</x>" * 250_000, "<a '>'" * 330_000, "<b>" * 100_000 + "<p></p>" * 100_000,
                                  "<p><button>" + "<b>" * 50_000 + "<p></p>" * 50_000, "<" * 2_000_000, "</x>" * 500_000])
def test_broken_pages_take_time_in_proportion(page):
    start = time.process_time()
    html_tree.parse(page)
    assert time.process_time() - start < 12  # 2 MB; a quadratic reader takes hours


def test_articles_of_the_given_pages(spark):
    """The given pages hold one article each; the whole of a very long one stays."""
    t = pq.read_table(f"{SMALL_SF}/pages.parquet")
    pages = list(zip(t["page_id"].to_pylist(), t["url"].to_pylist(), t["html"].to_pylist(), strict=True))
    long = "<article>" + "<p>word word</p>" * 50_000 + "</article>"
    pages.append((10 ** 9, "http://long.org", f"<body><nav>x</nav>{long}</body>"))
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in html_main_text.extract(df).collect()}
    assert got == plain_extract(pages) and got[10 ** 9] == " ".join(["word word"] * 50_000)
