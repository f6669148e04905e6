"""Main text of web pages: site templates are found by counting subtree hashes per host, and deleted.

A first pass hashes the subtrees of block elements on each page.  A hash on at least ``MIN_PAGES`` different pages of a host
recurs; what is left of a page's main text without its recurring subtrees is the page's content.  A recurring hash that stands
with at least ``MIN_PAGES`` different contents is a template, however large the host.  So copies of an article in differing frames
count once, like copies of a page: neither makes a template of the article's body.  The templates are joined to the pages' own hashes, so a page gets those that stand on it and no list
of a host is ever made.  The second pass deletes template subtrees, takes the article (else the main element, else the page) and
drops what marks itself as menu, header, footer, sidebar, notice, advert, form or comments.

Inside an article only containers can be templates: a paragraph or heading may well stand on many pages.
A null page has the empty text; a null address is a host of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.llm import html_tree
from vitrina.llm.common import map_arrow, shared_table, table, text_blocks

MIN_PAGES = 4
_CONTAINERS = frozenset("div section nav header footer aside ul ol dl table form figure details center".split())
_BLOCKS = _CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre address".split())


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def template_candidates(found: list[html_tree.Element]) -> list[tuple[html_tree.Element, int]]:
    """The subtrees of a page that could be a template, with their hashes; none holds an article."""
    hashes = html_tree.subtree_hashes(found)
    in_article: set[int] = set()
    holds: set[int] = set()
    for element in found:  # parents first
        if element.tag in ("article", "main") or id(element.parent) in in_article:
            in_article.add(id(element))
    for element in reversed(found):
        if element.tag in ("article", "main", "body") or id(element) in holds:
            holds.add(id(element.parent))
    out = []
    for element in found:
        kinds = _CONTAINERS if id(element) in in_article else _BLOCKS
        value, text = hashes[id(element)]
        if text and element.tag in kinds and id(element) not in holds:
            out.append((element, value))
    return out


def main_hashes(root: html_tree.Element) -> tuple[dict[int, int | None], int | None]:
    """Of each subtree that could be a template, by its hash: the hash of what it adds to the page's main text outside such
    subtrees within it, None if nothing.  And the hash of the rest of the main text.
    """
    candidates = template_candidates(html_tree.elements(root))
    texts = html_tree.texts_by_owner(html_tree.main_roots(root), {id(e) for e, _ in candidates})
    hashes = {owner: xxhash.xxh3_64_intdigest(text) - (1 << 63) for owner, text in texts.items() if text}
    return {value: hashes.get(id(e)) for e, value in candidates}, hashes.get(0)


def with_keys(pages: DataFrame) -> DataFrame:
    """Adds ``salt``, which tells the hosts' hashes apart, and ``page``, equal for copies of a page on one host."""
    return pages.withColumns({"salt": F.xxhash64("host"), "page": F.xxhash64("host", "html")})


def templates(pages: DataFrame, url_col: str = "url", html_col: str = "html", min_pages: int = MIN_PAGES) -> DataFrame:
    """(page, templates array<bigint>): salted hashes of the subtrees of each page that are templates of its host."""
    source = with_keys(pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias("html"))).drop("host")

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_blocks(batches, "html"):
            page, hash_, main = [], [], []
            for text, salt, key in zip(texts, rows.column("salt").to_pylist(), rows.column("page").to_pylist(), strict=True):
                own, rest = main_hashes(html_tree.parse(text))
                if own:  # the rest goes by the page's own key, which stands on one page only
                    page += [key] * (len(own) + 1)
                    hash_ += [*(value ^ salt for value in own), key]
                    main += [*own.values(), rest]
            yield pa.record_batch([pa.array(x, pa.int64()) for x in (page, hash_, main)], names=["page", "hash", "main"])

    found = shared_table(map_arrow(source, hashes, "page bigint, hash bigint, main bigint"), "subtrees")
    # the keys are stored, so that the planner knows their size before it deals the subtrees for a join
    recurring = shared_table(found.select("hash", "page").distinct().groupBy("hash").agg(F.count(F.lit(1)).alias("pages"))
                             .where(F.col("pages") >= min_pages).select("hash", F.lit(True).alias("recurs")), "recurring")
    by_page = (found.join(recurring, "hash", "left").groupBy("page")
               .agg(F.collect_set(F.when(F.col("recurs"), F.col("hash"))).alias("hashes"),
                    F.xxhash64(F.sort_array(F.collect_set(F.when(F.col("recurs").isNull(), F.col("main"))))).alias("content"))
               .where(F.size("hashes") > 0))
    marked = shared_table(by_page.select("page", "content", F.explode("hashes").alias("hash")), "recurring-subtrees")
    known = shared_table(marked.select("hash", "content").distinct().groupBy("hash").agg(F.count(F.lit(1)).alias("contents"))
                         .where(F.col("contents") >= min_pages).select("hash"), "known")
    return marked.join(known, "hash").groupBy("page").agg(F.collect_list("hash").alias("templates"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_pages: int = MIN_PAGES) -> DataFrame:
    """(id, url, text): the main text of every row."""
    marks = shared_table(templates(pages, url_col, html_col, min_pages), "templates")
    source = with_keys(pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"),
                                    host_of(F.col(url_col)).alias("host")))
    source = source.join(marks, "page", "left").select("id", "url", "html", "salt", "templates")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_blocks(batches, "html"):
            known = zip(texts, rows.column("salt").to_pylist(), rows.column("templates").to_pylist(), strict=True)
            out = [main_text(text, {value ^ salt for value in own or ()}) for text, salt, own in known]
            yield pa.record_batch([rows.column("id"), rows.column("url"), pa.array(out, pa.string())], names=["id", "url", "text"])

    kinds = [source.schema[c].dataType.simpleString() for c in ("id", "url")]
    return map_arrow(source, run, f"id {kinds[0]}, url {kinds[1]}, text string").withColumnsRenamed({"id": id_col, "url": url_col})


def main_text(page: str, known: set[int]) -> str:
    root = html_tree.parse(page)
    skip = {id(e) for e, value in template_candidates(html_tree.elements(root)) if value in known} if known else set()
    return " ".join(filter(None, (html_tree.text_of(r, skip) for r in html_tree.main_roots(root, skip))))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return texts.withColumn("n_chars", F.length("text").cast("bigint"))
