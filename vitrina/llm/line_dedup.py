"""Line de-duplication with DataFrame functions only.

Each line's key (stripped, A-Z lower-cased) is hashed to 128 bits.  The hashes are range-partitioned together with
document and position and sorted within partitions, so a hot line is spread over partitions and the first occurrence of a key in
a document is a streaming window over the sorted rows.  First occurrences are counted per key with partial
aggregation; lines of recurring keys outside the largest document become cleared bits of the document's keep bitmap.
Recurring keys are joined back to their occurrences over salts, each key standing once for every salt, so no task receives all rows of a key.
Only the bitmaps travel: sparse 64-line words, a word that is not listed keeps all its lines.

A document is a distinct (id, text); repeated rows share one bitmap.  A null text counts as one empty line, a null id
as the smallest id.  Line hashes are 128 bits, so different lines of equal hash are not expected at any size.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from vitrina.llm.common import SPACES, shared_table, table

MIN_CHARS, MIN_DOCS = 20, 3
#: Occurrences of a key are spread over so many salts when the recurring keys are joined back to them.
SALTS = 8
_WORD = 64


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    """The line stripped of white space at both ends, A-Z lower-cased, other letters as they are."""
    bare = F.btrim(line, F.lit(SPACES))
    ascii_only = F.octet_length(bare) == F.length(bare)  # there the faster lower() changes A-Z only
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, string.ascii_uppercase, string.ascii_lowercase))


def keep_bitmaps(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                 min_docs: int = MIN_DOCS) -> DataFrame:
    """(id, print, dropped array<struct<word int, bits bigint>>) for each document that loses lines.

    ``print`` is xxhash64 of the text.  Bit b of word w stands for line 64 w + b; a set bit clears the line's keep bit.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = (df.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("print"), F.posexplode(_lines(text)).alias("pos", "line"))
             .withColumn("key", line_key(F.col("line"))).where(F.length("key") >= min_chars)
             .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"), "id", "print", "pos"))
    order = ["h1", "h2", "id", "print", "pos"]
    first = F.row_number().over(Window.partitionBy(*order[:4]).orderBy("pos")) == 1
    # stored before they are ranged: range partitioning reads its input twice, and shall not hash the texts twice
    hashed = shared_table(lines, "line-hashes")
    ranged = shared_table(hashed.repartitionByRange(*order[:4]).sortWithinPartitions(*order)
                          .withColumn("first", first), "line-ranges")
    recurring = shared_table(
        ranged.where("first").groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("docs"), F.max("id").alias("largest"))
        .where(F.col("docs") >= min_docs), "recurring")
    salted = recurring.select("h1", "h2", "largest", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salt = F.pmod(F.xxhash64("id", "print", "pos"), F.lit(SALTS)).cast("int")
    marked = ranged.withColumn("salt", salt).join(salted, ["h1", "h2", "salt"])
    doomed = (marked.where(~F.col("id").eqNullSafe(F.col("largest")))
              .select("id", "print", (F.col("pos") / _WORD).cast("int").alias("word"),
                      F.expr(f"shiftleft(1L, pos % {_WORD})").alias("bit")))
    return (doomed.groupBy("id", "print", "word").agg(F.bit_or("bit").alias("bits"))
            .groupBy("id", "print").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("dropped")))


def kept_text(text: Column, dropped: Column) -> Column:
    """The text without the lines that the bitmap clears; a null bitmap clears none."""
    lines = _lines(text)
    words = F.transform(F.sequence(F.lit(0), ((F.size(lines) - 1) / _WORD).cast("int")),
                        lambda w: F.coalesce(F.get(F.filter(dropped, lambda d: d["word"] == w), 0)["bits"], F.lit(0).cast("bigint")))
    # the one-element array binds the words once instead of for every line
    kept = F.transform(F.array(words), lambda ws: F.array_join(F.filter(
        lines, lambda _, i: F.getbit(F.get(ws, (i / _WORD).cast("int")), i % _WORD) == 0), "\n"))[0]
    return F.when(dropped.isNull(), text).otherwise(kept)


def without_recurring_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                            min_docs: int = MIN_DOCS) -> DataFrame:
    """(row, text, dropped): each row as a struct, its text (null as empty) and its bitmap, null where no line goes."""
    marks = keep_bitmaps(df, id_col, text_col, min_chars, min_docs).withColumnsRenamed({"id": "m_id", "print": "m_print"})
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(id_col).alias("id"), text.alias("text"))
    match = rows["id"].eqNullSafe(marks["m_id"]) & (F.xxhash64(rows["text"]) == marks["m_print"])
    return rows.join(marks.hint("shuffle_hash"), match, "left").select("row", "text", "dropped")


def deduplicated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """The rows, all columns as they are but for the text of documents that lose lines and, where there is one, its length."""
    found = without_recurring_lines(df, id_col, text_col)
    changed = F.col("dropped").isNotNull()
    found = found.select("row", changed.alias("changed"), kept_text(F.col("text"), F.col("dropped")).alias("kept"))
    replaced = {text_col: F.col("kept"), chars_col: F.length("kept")}
    return found.select(*[
        F.when(F.col("changed"), replaced[c].cast(df.schema[c].dataType)).otherwise(F.col("row")[c]).alias(c) if c in replaced else F.col("row")[c].alias(c)
        for c in df.columns])


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_recurring_lines(docs).select(
        F.col("row.doc_id").alias("doc_id"),
        (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("bigint").alias("n_lines"),
        F.when(F.col("dropped").isNull(), F.lit(0)).otherwise(F.aggregate(
            "dropped", F.lit(0), lambda n, d: n + F.bit_count(d["bits"]))).cast("bigint").alias("n_dropped"),
        F.sha2(kept_text(F.col("text"), F.col("dropped")).cast("binary"), 256).alias("kept_sha256"),
    )


OP10_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
recurring AS (
  SELECT k, max(doc_id) AS largest FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT d.doc_id, d.pos, d.line, r.k IS NOT NULL AND d.doc_id <> r.largest AS gone
  FROM keyed d LEFT JOIN recurring r ON d.k = r.k)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
