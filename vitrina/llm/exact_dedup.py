"""Exact de-duplication of new batches against an immutable snapshot, screened by static binary fuse filters.

A snapshot's distinct digests are kept in hash buckets, and each bucket has one static filter.  An incoming digest
probes the filter of its bucket; only the positives join the exact bucket, where the texts of both representatives
are compared byte by byte.  Duplicates among the incoming rows are grouped on their own before that.

Texts are equal when identical after each run of \\x20 and \\x09-\\x0D becomes one space; null counts as empty.
The row with the smallest id stays, a null id being the largest; of repeated rows (same id, equal text) one stays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.llm import binary_fuse
from vitrina.llm.common import SPACE_RUN, shared_table, ship_package, table

#: Digests in a bucket, on average: the size of a filter and of a task's group.
KEYS_PER_BUCKET = 2000
_CHUNK = 10_000


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACE_RUN, " ")


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(digest, id, rows): how often each id holds each text."""
    return (df.select(F.unhex(F.sha2(normalised(F.col(text_col)).cast("binary"), 256)).alias("digest"), F.col(id_col).alias("id"))
            .groupBy("digest", "id").agg(F.count(F.lit(1)).alias("rows")))


def groups(per_id: DataFrame) -> DataFrame:
    """(old, digest, keep, size): copies grouped apart in the snapshot and in the new batch."""
    return per_id.groupBy("old", "digest").agg(F.min("id").alias("keep"), F.sum("rows").alias("size"))


def _key(digest: Column) -> Column:
    return F.conv(F.substring(F.hex(digest), 1, 15), 16, 10).cast("bigint")


def _bucketed(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.select("*", _key(F.col("digest")).alias("key")).withColumn("bucket", F.pmod("key", F.lit(buckets)))


def build_filters(store: DataFrame, buckets: int) -> DataFrame:
    """(bucket, filter): one static filter for the digests of each bucket of a snapshot's store."""
    def build(rows: pa.Table) -> pa.Table:
        keys = rows.column("key").to_numpy()
        return pa.table({"bucket": rows.column("bucket").slice(0, 1), "filter": pa.array([binary_fuse.build(keys)], pa.binary())})

    ship_package(store.sparkSession)
    return _bucketed(store, buckets).select("bucket", "key").groupBy("bucket").applyInArrow(build, "bucket bigint, filter binary")


def screen(incoming: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """The digests of ``incoming`` that the filter of their bucket lets through."""
    def probe(rows: pa.Table, filters: pa.Table) -> pa.Table:
        digest = rows.column("digest")
        if not rows.num_rows or not filters.num_rows:
            return pa.table({"digest": digest.slice(0, 0)})
        found = binary_fuse.contains(filters.column("filter")[0].as_py(), rows.column("key").to_numpy())
        return pa.table({"digest": digest.filter(pa.array(found))})

    ship_package(incoming.sparkSession)
    rows = _bucketed(incoming.select("digest"), buckets).groupBy("bucket")
    return rows.cogroup(filters.groupBy("bucket")).applyInArrow(probe, "digest binary")


def byte_checked(pairs: DataFrame, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The pairs (digest, keep, new_keep) of which both representatives hold the same bytes."""
    ids = pairs.select("digest", F.explode(F.array_distinct(F.array("keep", "new_keep"))).alias("id"))
    docs = df.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    texts = (docs.join(ids.hint("shuffle_hash"), docs["doc"].eqNullSafe(ids["id"]))
             .select("digest", normalised(F.col("text")).alias("text"))
             .where(F.unhex(F.sha2(F.col("text").cast("binary"), 256)) == F.col("digest")))
    same = texts.groupBy("digest").agg((F.min("text") == F.max("text")).alias("same")).where("same").select("digest")
    return pairs.join(same, "digest")


def deduplicate(df: DataFrame, snapshot: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) for every row: ``snapshot`` says whether its row is in the snapshot.

    ``snapshot`` is an expression over the id, named ``id``.
    """
    stored = shared_table(digests(df, id_col, text_col)
                          .withColumn("old", F.coalesce(snapshot, F.lit(False))), "digests")
    own = shared_table(groups(stored), "groups")
    store, incoming = own.where("old"), own.where(~F.col("old"))
    buckets = max(1, own.count() // (2 * KEYS_PER_BUCKET))
    positives = screen(incoming, build_filters(store, buckets), buckets)
    pairs = shared_table(
        incoming.select("digest", F.col("keep").alias("new_keep"), F.col("size").alias("new_size"))
        .join(positives, "digest").join(store.drop("old"), "digest"), "positives")
    merged = byte_checked(pairs, df, id_col, text_col).select(
        "digest", F.least("keep", "new_keep").alias("all_keep"), (F.col("size") + F.col("new_size")).alias("all_size"))
    final = own.join(merged, "digest", "left").select(
        "digest", "old", F.coalesce("all_keep", "keep").alias("keep_id"), F.coalesce("all_size", "size").alias("group_size"))
    rows = stored.join(final, ["digest", "old"])
    # repeated rows come back one by one, in pieces of a bounded size
    chunk = F.explode(F.sequence(F.lit(0), F.floor((F.col("rows") - 1) / _CHUNK)))
    copy = F.explode(F.sequence(F.lit(1), F.least(F.lit(_CHUNK), F.col("rows") - F.col("chunk") * _CHUNK)))
    return (rows.select("*", chunk.alias("chunk")).select("*", copy.alias("copy"))
            .select(F.col("id").alias(id_col), "keep_id", "group_size",
                    (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("chunk") == 0) & (F.col("copy") == 1)).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents in two batches, told apart by a hash of the id: the first is the snapshot, the second comes in."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return deduplicate(docs, F.pmod(F.xxhash64("id"), F.lit(2)) == 0)


OP2_SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (
  SELECT norm, min(doc_id) AS keep_id, CAST(count(*) AS BIGINT) AS group_size FROM t GROUP BY norm)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g ON t.norm = g.norm
"""
