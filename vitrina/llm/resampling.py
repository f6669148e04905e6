"""Quality selection by importance resampling (Xie et al. 2023).

Words and word pairs are hashed to buckets.  Two bag-of-buckets models are counted on Spark: one of target text, one of
all raw text.  A document's weight is the likelihood ratio of the two, and a sample without replacement is drawn
by Gumbel top-k: the log weight plus Gumbel noise, made from a hash of the id, and the k largest keys.  The k-th key is found exactly by
four rounds of counting on its bits, so no sort and no single task sees all rows.

The models have a fixed number of buckets; counts are summed over all documents.  A null or empty text has weight 1
(log weight 0).  Rows with exactly the k-th key are all taken, so repeated rows stay together.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.llm.common import WordNumbers, held_out, map_arrow, mix64, shared_table, table, text_blocks

BITS = 16
FRACTION = 0.85
#: Added to every bucket's count, as a share of the mean count.
SMOOTHING = 0.05
_TOKENS = re.compile(r"\w+|[^\w\s]")


class Grams:
    """Buckets of the words and word pairs of texts."""

    def __init__(self, bits: int = BITS, remembered: int = 400_000) -> None:
        self.bits, self.limit = bits, remembered
        self._forget()

    def _forget(self) -> None:
        self.words, self.hashes = WordNumbers(), np.zeros(0, np.uint64)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(text number, bucket) of every word and pair."""
        if len(self.words) > self.limit:
            self._forget()
        at, counts = self.words.number(texts, _TOKENS.findall)
        new = self.words.since(len(self.hashes))
        self.hashes = np.concatenate((self.hashes, np.array([xxhash.xxh3_64_intdigest(w) for w in new], np.uint64)))
        one, doc = self.hashes[at], np.repeat(np.arange(len(texts)), counts)
        together = doc[1:] == doc[:-1]
        with np.errstate(over="ignore"):
            two = mix64(one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:])[together]
        buckets = (np.concatenate((one, two)) >> np.uint64(64 - self.bits)).astype(np.int64)
        return np.concatenate((doc, doc[1:][together])), buckets


def bucket_counts(df: DataFrame, target: Column, text_col: str = "text", bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """How often each bucket occurs in target text and in all text."""
    source = df.select(F.col(text_col).cast("string").alias("text"), F.coalesce(target, F.lit(False)).alias("target"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, total = Grams(bits), np.zeros((2, 1 << bits), np.int64)
        for rows, texts in text_blocks(batches, "text"):
            doc, bucket = grams(texts)
            chosen = rows.column("target").to_numpy(zero_copy_only=False)[doc]
            total[0] += np.bincount(bucket[chosen], minlength=1 << bits)
            total[1] += np.bincount(bucket, minlength=1 << bits)
        used = np.flatnonzero(total[1])
        yield pa.record_batch([pa.array(used), pa.array(total[0, used]), pa.array(total[1, used])], names=["bucket", "target", "raw"])

    sums = (map_arrow(source, count, "bucket bigint, target bigint, raw bigint")
            .groupBy("bucket").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw")).toArrow())  # 2**bits rows at most
    out = np.zeros((2, 1 << bits))
    at = sums.column("bucket").to_numpy()
    out[0, at], out[1, at] = sums.column("target").to_numpy(), sums.column("raw").to_numpy()
    return out[0], out[1]


def log_ratios(target: np.ndarray, raw: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    """Log of the target model's over the raw model's probability of each bucket; 0 without any target text."""
    if not target.sum():
        return np.zeros(len(raw))
    models = [(c + smoothing * c.sum() / len(c)) / (c.sum() * (1 + smoothing)) for c in (target, raw)]
    return np.log(models[0]) - np.log(models[1])


def log_weights(df: DataFrame, ratios: np.ndarray, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """(id, n_grams, log_weight): the log likelihood ratio of each whole text."""
    source = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    shared = df.sparkSession.sparkContext.broadcast(ratios)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(bits)
        for rows, texts in text_blocks(batches, "text"):
            doc, bucket = grams(texts)
            sums = np.bincount(doc, shared.value[bucket], len(texts))
            yield pa.record_batch([rows.column("id"), pa.array(np.bincount(doc, minlength=len(texts))), pa.array(sums)],
                                  names=["id", "n_grams", "log_weight"])

    kind = source.schema["id"].dataType.simpleString()
    return map_arrow(source, weigh, f"id {kind}, n_grams bigint, log_weight double").withColumnRenamed("id", id_col)


def gumbel(id_: Column, seed: int) -> Column:
    """Standard Gumbel noise, always the same for an id and a seed."""
    uniform = (F.pmod(F.xxhash64(F.lit(seed), id_), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return -F.log(-F.log(uniform))


def kth_largest(rows: DataFrame, key_col: str, k: int) -> int | None:
    """The k-th largest of a column of whole numbers between -2**62 and 2**62; None if there are not so many.

    Each round counts one 16-bit digit of the keys that share the digits known so far, and moves on to the digit that holds the k-th.
    """
    if k < 1:
        return None
    shifted = F.col(key_col) + F.lit(1 << 62)
    known = 0
    for bits in (48, 32, 16, 0):
        same = F.shiftright(shifted, bits + 16) == known if bits < 48 else F.lit(True)
        digit = F.shiftright(shifted, bits).bitwiseAND(0xFFFF)
        counts = rows.where(same).groupBy(digit.alias("digit")).count().collect()  # 65536 rows at most
        for row in sorted(counts, key=lambda r: -r["digit"]):
            if k <= row["count"]:
                known = known << 16 | row["digit"]
                break
            k -= row["count"]
        else:
            return None
    return known - (1 << 62)


def resample(df: DataFrame, target: DataFrame, fraction: float = FRACTION, seed: int = 1, id_col: str = "doc_id",
             text_col: str = "text", bits: int = BITS) -> DataFrame:
    """(id, n_grams, log_weight, key, selected) of every row; ``target`` has the ids of the target documents.

    ``selected`` marks the ``fraction`` of the rows, rounded up, with the largest keys.  Keys are compared to 20 binary places.
    """
    wanted = target.select(F.col(id_col).alias("wanted")).distinct().withColumn("hit", F.lit(True))
    flagged = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        wanted.hint("shuffle_hash"), F.col("id") == F.col("wanted"), "left")
    ratios = log_ratios(*bucket_counts(flagged, F.col("hit"), "text", bits))
    weighed = log_weights(df, ratios, id_col, text_col, bits)
    keyed = shared_table(weighed.withColumn("key", F.col("log_weight") + gumbel(F.col(id_col), seed))
                         .withColumn("place", F.floor(F.col("key") * (1 << 20)).cast("bigint")), "weights")
    least = kth_largest(keyed, "place", -int(-fraction * keyed.count() // 1))
    chosen = F.lit(False) if least is None else F.col("place") >= least
    return keyed.withColumn("selected", chosen).drop("place")


def op3_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target text: the documents labelled good, outside the held-out fold."""
    labels = table(spark, sf_dir, "labels").where((F.col("quality") == 1) & ~held_out(F.col("doc_id")))
    return resample(table(spark, sf_dir, "documents").select("doc_id", "text"), labels)
