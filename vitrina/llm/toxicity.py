"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the words, the pairs of neighbours and the pairs with one word between them, lower-cased and hashed to 2**bits
places; a text has a feature or not, however often.  Training (McMahan et al. 2013) goes once or a few times over a
bounded sample of labelled rows, with a learning rate per coordinate and L1 sparsity, so the model is a short list of
(place, weight) that is broadcast.  Features are made on Spark for the sample as for the scoring.

A null or empty text has no features and gets the bias alone.  Without any labelled row every score is 0.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.llm.common import REMEMBERED_WORDS, WORD_BLOCK, WordNumbers, held_out, map_arrow, mix64, shared_table, table, text_blocks

BITS = 20
#: The labelled sample: so many rows in order of a hash of their id, of texts up to so many characters, with so many features together (4 bytes each).
SAMPLE_ROWS, SAMPLE_CHARS, SAMPLE_FEATURES = 20_000, 40_000, 16_000_000
THRESHOLD = 0.3
_WORDS = re.compile(r"\w+")


@dataclass(frozen=True)
class Model:
    bits: int
    places: np.ndarray
    weights: np.ndarray
    bias: float | None

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << self.bits)
        out[self.places] = self.weights
        return out


class Features:
    """Hashed features of texts; remembers the hashes of the words it has met, up to a bound."""

    def __init__(self, bits: int, remembered: int = REMEMBERED_WORDS) -> None:
        self.bits, self.limit = bits, remembered
        self._forget()

    def _forget(self) -> None:
        self.words, self.hashes = WordNumbers(), np.zeros(0, np.uint64)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(text number, place) of every feature, with repeats."""
        if len(self.words) > self.limit:
            self._forget()
        at, counts = self.words.number(texts, lambda t: _WORDS.findall(t.lower()))
        new = self.words.since(len(self.hashes))
        self.hashes = np.concatenate((self.hashes, np.array([xxhash.xxh3_64_intdigest(w) for w in new], np.uint64)))
        one, doc = self.hashes[at], np.repeat(np.arange(len(texts)), counts)
        places, docs = [one], [doc]
        for gap, salt in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F)):
            if len(one) > gap:
                together = doc[gap:] == doc[:-gap]
                with np.errstate(over="ignore"):
                    pair = mix64(one[:-gap] * np.uint64(salt) + one[gap:])
                places.append(pair[together])
                docs.append(doc[gap:][together])
        return np.concatenate(docs), (np.concatenate(places) >> np.uint64(64 - self.bits)).astype(np.int64)


def train(rows: list[tuple[np.ndarray, int]], bits: int = BITS, epochs: int = 5, alpha: float = 2.0, beta: float = 1.0,
          l1: float = 3.0, l2: float = 0.1) -> Model:
    """FTRL-proximal over (distinct places, label), in the order given; the bias has no penalty."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    bias_z = bias_n = 0.0

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2))

    def bias() -> float:
        return -bias_z * alpha / (beta + bias_n ** 0.5)

    for _ in range(epochs):
        for at, label in rows:
            zs, ns = z[at], n[at]
            w = weights(zs, ns)
            b = bias()
            g = 1 / (1 + np.exp(-np.clip(w.sum() + b, -35, 35))) - label
            z[at] = zs + g - (np.sqrt(ns + g * g) - np.sqrt(ns)) / alpha * w
            n[at] = ns + g * g
            bias_z += g - ((bias_n + g * g) ** 0.5 - bias_n ** 0.5) / alpha * b
            bias_n += g * g
    w = weights(z, n)
    places = np.flatnonzero(w)
    return Model(bits, places.astype(np.int32), w[places].astype(np.float32), float(bias()) if rows else None)


def fit(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS,
        sample_rows: int = SAMPLE_ROWS, sample_chars: int = SAMPLE_CHARS, sample_features: int = SAMPLE_FEATURES, **ftrl: float) -> Model:
    """Learn from the labelled rows whose id is not in the held-out fold, at most ``sample_rows`` of them, and as many of these as have
    ``sample_features`` features together.
    """
    order = F.xxhash64(F.lit("sample"), "id")
    chosen = shared_table(
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
        .where(F.col("label").isNotNull() & ~held_out(F.col("id"))).orderBy(order, "id", "label").limit(sample_rows), "sample")
    texts = (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
             .where(F.coalesce(F.length("text"), F.lit(0)) <= sample_chars).join(chosen, "id"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extract = Features(bits)
        for rows, texts in text_blocks(batches, "text", WORD_BLOCK):
            doc, place = extract(texts)
            pairs = np.unique(doc << bits | place)
            ends = np.searchsorted(pairs >> bits, np.arange(len(texts) + 1)).astype(np.int32)
            places = pa.ListArray.from_arrays(pa.array(ends), pa.array((pairs & (1 << bits) - 1).astype(np.int32)))
            yield pa.record_batch([rows.column("id"), rows.column("label"), places], names=["id", "label", "places"])

    kind = texts.schema["id"].dataType.simpleString()
    found = shared_table(map_arrow(texts, features, f"id {kind}, label int, places array<int>").select(
        "label", "places", F.struct(order.alias("o"), "id", "label", F.xxhash64("places").alias("h")).alias("place")), "features")
    sizes = found.select("place", F.size("places").alias("n")).orderBy("place").limit(sample_rows).collect()
    total = np.cumsum([r["n"] for r in sizes])
    taken = int(np.searchsorted(total, sample_features, "right"))
    if not taken:
        return train([], bits, **ftrl)
    last = sizes[taken - 1]["place"]
    upto = F.struct(F.lit(last["o"]).alias("o"), F.lit(last["id"]).cast(kind).alias("id"), F.lit(last["label"]).alias("label"), F.lit(last["h"]).alias("h"))
    chunks = found.where(F.col("place") <= upto).orderBy("place").limit(taken).select("label", "places").toArrow().to_batches()
    rows = []
    for chunk in chunks:  # views of the chunks: the sample is held once
        ends, flat = chunk.column("places").offsets.to_numpy(), chunk.column("places").values.to_numpy()
        rows += [(flat[a:b], y) for a, b, y in zip(ends[:-1], ends[1:], chunk.column("label").to_pylist(), strict=True)]
    return train(rows, bits, **ftrl)


def _scores(batches: Iterator[pa.RecordBatch], text_col: str, model: Model) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    extract, weights = Features(model.bits), model.dense()
    for rows, texts in text_blocks(batches, text_col, WORD_BLOCK):
        if model.bias is None:
            yield rows, np.zeros(len(texts))
            continue
        doc, place = extract(texts)
        used = weights[place] != 0
        pairs = np.unique(doc[used] << model.bits | place[used])
        total = np.bincount(pairs >> model.bits, weights[pairs & (1 << model.bits) - 1], len(texts))
        yield rows, 1 / (1 + np.exp(-np.clip(total + model.bias, -35, 35)))


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row."""
    source = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, scores in _scores(batches, "text", shared.value):
            yield pa.record_batch([rows.column("id"), pa.array(scores)], names=["id", "score"])

    kind = source.schema["id"].dataType.simpleString()
    return map_arrow(source, run, f"id {kind}, score double").withColumnRenamed("id", id_col)


def without_toxic(df: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows, all columns as they are, whose score is below the threshold."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, scores in _scores(batches, text_col, shared.value):
            yield rows.filter(pa.array(scores < threshold))

    return map_arrow(df, run, df.schema)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"), "toxic")
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
