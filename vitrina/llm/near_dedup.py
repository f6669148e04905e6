"""Near-duplicates: circulant MinHash bands find candidates, full shingle sets confirm them.

Equal sets are one class from the start.  Classes that meet in a band bucket form families: each bucket ties its
members to its smallest one, so a bucket of any size gives a star and never all its pairs.  A family holds every pair
that shares a bucket.  Its full sets are compared in blocks of a bounded size, a large family in pairs of blocks, by
counting common shingles of all sets of a block at once; a task gives back one row for each set, its smallest linked
set.  Components of those links are the groups.

With 192 coordinates in 32 bands of 6, a pair at the default similarity of 0.85 shares no band with a chance of
3 in ten million; nothing else is approximate but the 64-bit hashes of shingles.

Null and empty texts have empty sets and are linked with nothing.  Rows of one id are one document.  Rows without an id are
linked through equal sets only, and to no id if their class has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.llm.common import WORD_BLOCK, map_arrow, shared_table, ship_package, table, text_blocks
from vitrina.llm.components import connected_components
from vitrina.llm.shingles import ShingleSets, band_keys, circulant_signatures

BANDS, ROWS = 32, 6
MIN_PERCENT = 85
#: A block of a family: so many sets and so many shingles at most, but one set at least.
BLOCK_SETS, BLOCK_SHINGLES = 400, 500_000


def text_print(text_col: str) -> Column:
    """With the id, tells rows apart."""
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def set_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, print, n, h1, h2, bands): size, 128-bit digest and band keys of each row's shingle set; no keys if it is empty.

    ``print`` is ``text_print`` of the text.
    """
    source = df.select(F.col(id_col).alias("id"), text_print(text_col).alias("print"), F.col(text_col).cast("string").cast("binary").alias("text"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = ShingleSets()
        for batch, texts in text_blocks(batches, "text", WORD_BLOCK):
            sets = shingle([t or b"" for t in texts])
            some = [s for s in sets if len(s)]
            keys = band_keys(circulant_signatures(some, bands * rows), rows).view(np.int64) if some else np.zeros((0, bands), np.int64)
            sizes = np.array([len(s) for s in sets], np.int64)
            ends = np.concatenate(([0], np.cumsum(np.where(sizes > 0, bands, 0)))).astype(np.int32)
            high, low = _digests(sets)
            yield pa.record_batch(
                [batch.column("id"), batch.column("print"), pa.array(sizes), pa.array(high), pa.array(low),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel()))], names=["id", "print", "n", "h1", "h2", "bands"])

    kind = source.schema["id"].dataType.simpleString()
    return map_arrow(source, digest, f"id {kind}, print bigint, n bigint, h1 bigint, h2 bigint, bands array<bigint>")


def _digests(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    whole = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
    return (np.array([h >> 64 for h in whole], np.uint64).view(np.int64),
            np.array([h & (1 << 64) - 1 for h in whole], np.uint64).view(np.int64))


def families(classes: DataFrame, block_sets: int = BLOCK_SETS, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(id, h1, h2, family, blocks, block) of every class (id, n, h1, h2, bands) that shares a bucket with another."""
    entries = classes.select("id", F.explode("bands").alias("bucket"))
    buckets = shared_table(entries.groupBy("bucket").agg(F.min("id").alias("hub"), F.count(F.lit(1)).alias("c"))
                           .where("c > 1").select("bucket", "hub"), "buckets")
    # a document with two texts may meet itself; it is a family of one, and harmless
    stars = entries.join(buckets, "bucket").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    member = connected_components(stars, "families").select(F.col("node").alias("id"), F.col("root").alias("family"))
    nodes = shared_table(classes.select("id", "n", "h1", "h2").join(member, "id"), "nodes")
    sizes = nodes.groupBy("family").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / block_sets), F.ceil(F.sum("n") / block_shingles)).alias("blocks"))
    return nodes.join(sizes, "family").select(
        "id", "h1", "h2", "family", "blocks", F.pmod(F.xxhash64("id", "h1"), F.col("blocks")).alias("block"))


def _linked(sets: list[np.ndarray], names: np.ndarray, percent: int) -> np.ndarray:
    """For each set the position of the first set it is connected with, through links or equal names."""
    sizes = np.array([len(s) for s in sets], np.int64)
    _, word = np.unique(np.concatenate(sets), return_inverse=True)
    uses = np.bincount(word)
    row = np.repeat(np.arange(len(sets)), sizes)
    often = uses[word] > 1
    row, word = row[often], word[often]
    order = np.argsort(word, kind="stable")
    row, word = row[order], word[order]
    _, word = np.unique(word, return_inverse=True)
    common = np.zeros((len(sets), len(sets)), np.float32)
    step = 2048  # shingles counted at once, over all sets of the block
    for first in range(0, int(word[-1]) + 1 if len(word) else 0, step):
        a, b = np.searchsorted(word, (first, first + step))
        holds = np.zeros((len(sets), step), np.float32)
        holds[row[a:b], word[a:b] - first] = 1
        common += holds @ holds.T
    common = common.astype(np.int64)
    joined = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
    joined |= names[:, None] == names[None, :]
    label = np.arange(len(sets))
    while True:
        least = np.where(joined, label[None, :], len(sets)).min(axis=1)
        least = least[least]
        if (least == label).all():
            return label
        label = least


def confirmed_links(df: DataFrame, member: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = MIN_PERCENT) -> DataFrame:
    """(a, b): for each set of a block its smallest confirmed relative; links enough to connect all that are linked."""
    docs = df.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").cast("binary").alias("text"))
    wanted = shared_table(member, "members")
    found = docs.join(wanted.hint("shuffle_hash"), docs["doc"] == wanted["id"])
    # repeated rows of one id and text count once
    found = found.groupBy("id", "h1", "h2", "family", "blocks", "block", F.xxhash64("text").alias("print")).agg(F.any_value("text").alias("text"))
    found = found.select("id", "h1", "h2", "family", "blocks", "block", "text")

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = ShingleSets()
        for batch, texts in text_blocks(batches, "text", WORD_BLOCK):
            sets = shingle([t or b"" for t in texts])
            high, low = _digests(sets)
            same = (high == batch.column("h1").to_numpy()) & (low == batch.column("h2").to_numpy())
            items = pa.array([s.tobytes() for s in sets], pa.binary())
            columns = [batch.column(c) for c in ("id", "family", "blocks", "block")]
            yield pa.record_batch([*columns, items], names=["id", "family", "blocks", "block", "items"]).filter(pa.array(same))

    kind = wanted.schema["id"].dataType.simpleString()
    sets = map_arrow(found, to_sets, f"id {kind}, family {kind}, blocks bigint, block bigint, items binary")
    # the only block meets itself; of several, each meets every other
    other = F.explode(F.when(F.col("blocks") == 1, F.array(F.lit(0).cast("bigint"))).otherwise(F.array_remove(
        F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1), F.col("block"))))
    pairs = sets.select("id", "family", "block", "items", other.alias("other")).select(
        "id", "family", "items", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))

    def link(group: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        names = group.column("id").combine_chunks()
        sets = [np.frombuffer(x, np.uint64) for x in group.column("items").to_pylist()]
        root = _linked(sets, np.asarray(names.dictionary_encode().indices), percent)
        return pa.table({"a": names, "b": names.take(pa.array(root))})

    ship_package(df.sparkSession)
    return pairs.groupBy("family", "i", "j").applyInArrow(link, f"a {kind}, b {kind}").where("a <> b")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = MIN_PERCENT) -> DataFrame:
    """(id, print, n_shingles, component_id) of every row; component_id is the smallest id reachable, null if there is none."""
    rows = shared_table(set_rows(df, id_col, text_col), "set-rows")
    classes = shared_table(rows.where("n > 0").groupBy("h1", "h2", "n").agg(F.min("id").alias("rep"), F.min_by("bands", "id").alias("bands")), "classes")
    known = classes.where(F.col("rep").isNotNull()).withColumnRenamed("rep", "id")
    links = confirmed_links(df, families(known), id_col, text_col, percent)
    # an id that stands in several classes ties them: its texts are one document
    several = rows.where("n > 0").groupBy("id").agg(F.min("h1").alias("low"), F.max("h1").alias("high")).where("low <> high").select("id")
    named = classes.select("h1", "h2", "n", "rep")
    ties = (rows.where("n > 0").join(several, "id").join(named, ["h1", "h2", "n"])
            .select(F.col("id").alias("a"), F.col("rep").alias("b")))
    roots = connected_components(links.union(ties), "links")
    named = named.join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left").select(
        "h1", "h2", "n", F.coalesce("root", "rep").alias("root"))
    return rows.join(named, ["h1", "h2", "n"], "left").select(
        F.col("id").alias(id_col), "print", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("root")).alias("component_id"))


def without_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = MIN_PERCENT) -> DataFrame:
    """The rows, all columns as they are, of the document with the smallest id of each group.

    Rows without an id stay if they are linked with no id; repeated rows stay or go together.
    """
    groups = near_duplicates(df, id_col, text_col, percent)
    gone = shared_table(groups.where(F.col("component_id").isNotNull() & ~F.col(id_col).eqNullSafe(F.col("component_id")))
                        .select(F.col(id_col).alias("gone"), F.col("print").alias("gone_print")).distinct(), "gone")
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(id_col).alias("key"),
                     text_print(text_col).alias("print"))
    same = rows["key"].eqNullSafe(gone["gone"]) & (rows["print"] == gone["gone_print"])
    kept = rows.join(gone.hint("shuffle_hash"), same, "left_anti")
    return kept.select(*[F.col("row")[c].alias(c) for c in df.columns])


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).drop("print").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


OP6_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x20\x09-\x0D]+')) AS w,
         generate_subscripts(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'), 1) AS pos FROM documents),
grams AS (
  SELECT doc_id, count(*) OVER (PARTITION BY doc_id) AS n,
         concat_ws(' ', w, lead(w, 1) OVER p, lead(w, 2) OVER p, lead(w, 3) OVER p, lead(w, 4) OVER p) AS g,
         lead(w, 4) OVER p IS NOT NULL OR pos = 1 AND count(*) OVER (PARTITION BY doc_id) < 5 AS whole
  FROM words WINDOW p AS (PARTITION BY doc_id ORDER BY pos)),
sets AS (SELECT DISTINCT doc_id, g FROM grams WHERE whole),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM sets a JOIN sets b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.r),
comp AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN comp c USING (doc_id) LEFT JOIN sizes s USING (doc_id)
"""
