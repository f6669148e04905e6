"""Best-fit packing of tokenised documents into sequences, after Martello-Toth dominance reduction.

The instance is described whole by one count per piece length, at most ``capacity`` numbers whatever the corpus
holds.  On it, the driver first fixes the sets that provably dominate every other filling of their bin (one, two or
three pieces), then packs the remainder best-fit, longest first, for all pieces of a length at once.  The plan is a
table of slots: runs of sequences that take the next so many pieces of a length at an offset.  Each length opens
three runs at most and a sequence holds under 91 different lengths, so the plan is bounded by the capacity too and is
safe to broadcast.  Pieces are ranked within their length on Spark, over salted groups, and look up their slot.

Null texts count as empty.  Documents without an id or with the same id are packed like any others.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitrina.llm.bpe import DEFAULT_VOCABULARY, coder
from vitrina.llm.common import map_arrow, shared_table, table, text_blocks

CAPACITY = 4096
END_ID = 1
#: Salts of a length: so many at least, and one more for each so many pieces.
LEAST_SALTS, ROWS_PER_SALT = 64, 50_000


def document_pieces(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                    end_id: int = END_ID, vocabulary: str = DEFAULT_VOCABULARY, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) for every piece of every document.

    A document is its text's ids and ``end_id``; only one longer than ``capacity`` is cut.  ``ids`` are packed
    little-endian unsigned 32-bit integers.
    """
    source = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(vocabulary)
        for rows, texts in text_blocks(batches, "text"):
            ids, sizes = bpe.encode(texts)
            packed, lengths = ids.astype("<u4").tobytes(), sizes + 1
            pieces = -(-lengths // capacity)
            doc = np.repeat(np.arange(len(texts)), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(lengths[doc] - start, capacity)
            first = (np.cumsum(sizes) - sizes)[doc] + start
            last = start + length == lengths[doc]
            parts = [packed[4 * a:4 * (a + n - e)] + end * e
                     for a, n, e in zip(first.tolist(), length.tolist(), last.tolist(), strict=True)]
            columns = [rows.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                       pa.array(length, pa.int64()), pa.array(list(map(zlib.crc32, parts)), pa.int64())]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns, names = [*columns, pa.array(parts, pa.binary())], [*names, "ids"]
            yield pa.record_batch(columns, names=names)

    schema = f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    return map_arrow(source, cut, schema).withColumnRenamed("id", id_col)


class _Counts:
    """How many pieces of each length are left, with their lengths in order."""

    def __init__(self, counts: dict[int, int]) -> None:
        self.left = {n: c for n, c in counts.items() if c > 0}
        self.lengths = sorted(self.left)

    def largest(self, most: int, without: Counter) -> int | None:
        """The largest length up to ``most`` with a piece left beside those of ``without``."""
        at = bisect_right(self.lengths, most)
        while at:
            at -= 1
            n = self.lengths[at]
            if self.left[n] > without[n]:
                return n
        return None

    def smallest(self, how_many: int, without: Counter) -> list[int]:
        out: list[int] = []
        for n in self.lengths:
            out += [n] * min(how_many - len(out), self.left[n] - without[n])
            if len(out) == how_many:
                break
        return out

    def take(self, lengths: Counter, times: int) -> None:
        for n, k in lengths.items():
            self.left[n] -= k * times
            if not self.left[n]:
                del self.left[n]
                self.lengths.remove(n)


def dominating_set(counts: _Counts, longest: int, capacity: int) -> tuple[int, ...] | None:
    """A filling with ``longest`` that dominates every other one, or None if the criterion finds none.

    One filling dominates another if the pieces of the other can be grouped so that each group fits under a piece of
    its own in the first (Martello and Toth 1990).  Fillings of up to three pieces are tried.
    """
    room = capacity - longest
    own = Counter([longest])
    best = counts.largest(room, own)
    if best is None:
        return (longest,)
    if best == room:
        return (longest, best)
    small = counts.smallest(3, own)
    if len(small) < 2 or small[0] + small[1] > room:
        return (longest, best)  # every other filling is a single piece, at most as long
    if len(small) == 3 and sum(small) <= room:
        return None
    # at most two more pieces fit
    second = counts.largest(room - best, own + Counter([best]))
    pair, low, used = 0, counts.largest(room, own), own
    while low is not None:
        mate = counts.largest(min(low, room - low), used + Counter([low]))
        if mate is not None:
            pair = max(pair, low + mate)
        low = counts.largest(low - 1, own)
    if best >= pair:
        return (longest, best)
    half = counts.largest(room // 2, own)
    if second is not None and (half is None or half <= second):
        return (longest, best, second)  # in any pair the longer is at most best, the shorter at most second
    return None


def plan_slots(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int, int]:
    """Slots (length, first rank, copies, sequences, first sequence, offset), the number of sequences, those fixed."""
    counts = _Counts(histogram)
    used: Counter = Counter()
    slots: list[tuple[int, int, int, int, int, int]] = []
    sequences = 0

    def place(length: int, copies: int, first: int, many: int, offset: int) -> None:
        slots.append((length, used[length], copies, many, first, offset))
        used[length] += copies * many

    for longest in sorted(counts.left, reverse=True):
        while counts.left.get(longest, 0) and (chosen := dominating_set(counts, longest, capacity)):
            need = Counter(chosen)
            times = min(counts.left[n] // k for n, k in need.items())  # what is taken away only weakens the rivals
            offset = 0
            for n, k in need.items():
                place(n, k, sequences, times, offset)
                offset += n * k
            sequences += times
            counts.take(need, times)
    fixed = sequences

    open_runs: dict[int, list[tuple[int, int]]] = {}  # room left -> runs of sequences
    rooms: list[int] = []

    def opened(room: int, first: int, many: int) -> None:
        if many and room:
            if room not in open_runs:
                open_runs[room] = []
                insort(rooms, room)
            open_runs[room].append((first, many))

    for length in sorted(counts.left, reverse=True):
        left = counts.left[length]
        for room in rooms[bisect_right(rooms, length - 1):]:
            if not left:
                break
            copies = room // length  # the fullest sequence that takes one stays the fullest that takes the next
            runs = open_runs.pop(room)
            rooms.remove(room)
            for k, (first, many) in enumerate(runs):
                whole = min(many, left // copies)
                if whole:
                    place(length, copies, first, whole, capacity - room)
                    opened(room - copies * length, first, whole)
                    left -= whole * copies
                first, many = first + whole, many - whole
                if many and left:
                    place(length, left, first, 1, capacity - room)
                    opened(room - left * length, first, 1)
                    first, many, left = first + 1, many - 1, 0
                opened(room, first, many)
                if not left:
                    for rest in runs[k + 1:]:
                        opened(room, *rest)
                    break
        copies = capacity // length
        for many, each in ((left // copies, copies), (1, left % copies)):
            if many and each:
                place(length, each, sequences, many, 0)
                opened(capacity - each * length, sequences, many)
                sequences += many
    return np.array(sorted(slots), np.int64).reshape(-1, 6), sequences, fixed


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces (any columns, with ``length`` from 1 to ``capacity``) and their (sequence_id, offset).

    ``pieces`` is read three times: pass a stored table.  Columns of those two names are replaced.
    """
    spark = pieces.sparkSession
    own = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    lengths = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # capacity rows at most
    slots, _, _ = plan_slots(lengths, capacity)
    shared = spark.sparkContext.broadcast(slots)
    salts = max(LEAST_SALTS, sum(lengths.values()) // ROWS_PER_SALT)
    rows = pieces.select(F.struct(*own).alias("row"), "length",
                         F.pmod(F.xxhash64(*own), F.lit(salts)).alias("salt"), F.xxhash64(*own).alias("h"))
    before = (rows.groupBy("length", "salt").count()
              .select("length", "salt", (F.sum("count").over(Window.partitionBy("length").orderBy("salt"))
                                         - F.col("count")).alias("before")))
    in_group = F.row_number().over(Window.partitionBy("length", "salt").orderBy("h"))
    ranked = (rows.withColumn("at", in_group).join(before, ["length", "salt"])
              .select("row", "length", (F.col("before") + F.col("at") - 1).alias("rank")))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = shared.value
        keys = slots[:, 0] << 44 | slots[:, 1]
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            _, first_rank, copies, _, first, offset = slots[np.searchsorted(keys, length << 44 | rank, "right") - 1].T
            into = rank - first_rank
            yield pa.record_batch([batch.column(0), pa.array(first + into // copies, pa.int64()),
                                   pa.array(offset + into % copies * length, pa.int64())],
                                  names=["row", "sequence_id", "offset"])

    kind = ranked.schema["row"].dataType.simpleString()
    return map_arrow(ranked, assign, f"row {kind}, sequence_id bigint, offset bigint").select(
        *[F.col("row")[c].alias(c) for c in own], "sequence_id", "offset")


def pack_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                   end_id: int = END_ID, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """Pieces of all documents with their place; the pieces' table (no texts, no ids) is stored once."""
    pieces = shared_table(document_pieces(df, id_col, text_col, capacity, end_id, vocabulary), "pieces")
    return pack_pieces(pieces, capacity)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
