"""Helpers shared by the corpus operators: folds, shared tables, text blocks, word numbering."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from itertools import islice
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import vitrina
from vitrina.session import ensure_checkpoint_dir

#: The white space of the word and line contracts: \x20 and \x09-\x0D.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"

#: Bytes of an Arrow batch between Spark and a Python task, or one row more (Spark's own bound is 64 MB for every task).  A little under
#: the bound of ``text_blocks``, so that a batch isn't cut into a block and a small rest.
BATCH_BYTES = 3_800_000
_BATCH_OPTION = "spark.sql.execution.arrow.maxBytesPerBatch"
#: For operators that keep numbers for every word of a block: bytes of text worked on at once, words remembered from block to block.
WORD_BLOCK, REMEMBERED_WORDS = 1_000_000, 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, parts: int = 4) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text (fold 0)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def held_out(doc_id: Column) -> Column:
    return fold(doc_id) == 2


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the application's executors, once, as ``spark-submit --py-files`` would."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(vitrina.__file__).parent
        target = Path(tempfile.mkdtemp(prefix="vitrina-code-"), "vitrina.zip")
        with zipfile.ZipFile(target, "w") as out:
            for source in sorted(root.rglob("*.py")):
                out.write(source, source.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(target))
        _shipped.add(app)


def map_arrow(df: DataFrame, func: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with this package importable in the tasks, and batches of ``BATCH_BYTES`` if the session has no bound of its own."""
    spark = df.sparkSession
    ship_package(spark)
    if _BATCH_OPTION not in spark.conf.getAll:
        spark.conf.set(_BATCH_OPTION, str(BATCH_BYTES))
    return df.mapInArrow(func, schema)


def shared_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once below the cluster's shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor rereads files instead of recomputing), and gives the planner true sizes.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_blocks(batches: Iterable[pa.RecordBatch], text_col: str,
                max_bytes: int = 4_000_000) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Consecutive slices of the batches with their texts (null as ''), each of about ``max_bytes`` of text at most.

    A text is never cut: one longer than the bound is a block of its own.
    """
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text_col))
        ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + max_bytes, "right")))
            yield batch.slice(start, stop - start), [t or "" for t in column.slice(start, stop - start).to_pylist()]
            start = stop


class WordNumbers(dict):
    """Numbers words in order of first sight; a holder starts a new one when it has grown past a bound."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n

    def number(self, texts: Iterable[str], find: Callable[[str], list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all words of the texts, one text after the other, and each text's number of words."""
        at = self.__getitem__
        parts = [np.fromiter(map(at, words), np.int64, len(words)) for words in map(find, texts)]
        return np.concatenate(parts or [np.zeros(0, np.int64)]), np.array([len(p) for p in parts], np.int64)

    def since(self, known: int) -> list[str]:
        """The words numbered ``known`` and later."""
        return list(islice(self, known, None))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of start .. start+length-1 for every pair."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (the finaliser of splitmix64) on uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
