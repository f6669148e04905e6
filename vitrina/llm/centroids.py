"""Integer k-means with a progressive nearest-centroid search in the Walsh-Hadamard domain.

A vector counts if it has exactly ``SIZE`` components, none null or non-finite; component x becomes the integer floor(1024 x).
The Walsh-Hadamard transform H is an integer matrix with H'H = SIZE * I, so SIZE * |x - c|^2 = sum of (Hx - Hc)_k^2, without rounding.
The search adds up these squared coefficient differences from low sequency (coarse) to high (fine), in steps of doubling length.  After
the first step the leading centroid is finished over all coefficients; from then on a centroid whose partial sum is strictly greater than that distance
is out, since its sum can only grow.  The others are finished over all 64; of equal distances the smaller number wins.

Integers that could overflow 64 bits (components beyond ``SAFE``) are computed with Python's unbounded integers, by the same steps.
Only 8 centroids and their sums travel between Spark and the driver.  Every round reads the vectors anew from the source, so a lost executor
costs the reading of its part again.

Repeated rows count as often as they stand there.  A null id is hashed as the empty text.  Where several vectors share an id
and its hash places them among the first 8, they go by their components.  With fewer than 8 kept vectors there are as many clusters; with none the result is
empty.  A distance or inertia beyond a 64-bit integer is null.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrina.llm.common import map_arrow, shared_table, table

SIZE, CLUSTERS, ROUNDS, SEED, SCALE = 64, 8, 10, 3, 1024
#: Components up to this size keep every sum of the search below 2^63: 64 * (2 * 64 * SAFE)^2 <= 2^61.
SAFE = 1 << 20
_LIMB = 32


def sequency_order(size: int = SIZE) -> np.ndarray:
    """The rows of the natural Hadamard matrix, by their number of sign changes."""
    rows = transform(np.eye(size, dtype=np.int64))
    return np.argsort((np.diff(rows, axis=1) != 0).sum(axis=1), kind="stable")


def transform(rows: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform (natural order) of every row, in the rows' own integers."""
    out, width = rows.copy(), 1
    while width < rows.shape[1]:
        pairs = out.reshape(len(rows), -1, 2, width)
        out = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2).reshape(rows.shape)
        width *= 2
    return out


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of the nearest centroid and squared distance of each row; and how many coefficient differences were squared.

    ``vectors`` and ``centroids`` hold int64 up to SAFE, or Python integers of any size.
    """
    size, order = vectors.shape[1], sequency_order(vectors.shape[1])
    x, c = transform(vectors)[:, order], transform(centroids)[:, order]
    first = min(4, size)
    partial = ((x[:, None, :first] - c[None, :, :first]) ** 2).sum(axis=2)
    leader = np.argmin(partial, axis=1) if len(x) else np.zeros(0, np.int64)
    at = np.arange(len(x))
    bound = partial[at, leader] + ((x[:, first:] - c[leader, first:]) ** 2).sum(axis=1)
    work = len(x) * (len(c) * first + size - first)
    rows, which = np.nonzero(partial <= bound[:, None])
    sums, done = partial[rows, which], first
    while done < size:
        until = min(2 * done, size)
        sums = sums + ((x[rows, done:until] - c[which, done:until]) ** 2).sum(axis=1)
        work += len(rows) * (until - done)
        alive = (sums <= bound[rows]).astype(bool)
        rows, which, sums, done = rows[alive], which[alive], sums[alive], until
    # rows are in ascending order, and centroids within a row: of each row's survivors the least, then the first
    best, distance = leader.copy(), bound.copy()
    for k in reversed(range(len(c))):
        mine = which == k
        hit, value = rows[mine], sums[mine]
        better = (value <= distance[hit]) & ((value < distance[hit]) | (k < best[hit]))
        best[hit[better.astype(bool)]], distance[hit[better.astype(bool)]] = k, value[better.astype(bool)]
    return best, distance // size, work


def _kept(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of a list column count, and their components as integers (int64, or objects where they are large)."""
    lengths = np.diff(np.asarray(column.offsets))
    good = (lengths == SIZE) & np.asarray(column.is_valid())
    flat = column.values.slice(column.offsets[0].as_py(), int(lengths.sum()))
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become NaN
    starts = np.cumsum(lengths) - lengths
    rows = values[(starts[good][:, None] + np.arange(SIZE)).reshape(-1)].reshape(-1, SIZE)
    finite = np.isfinite(rows).all(axis=1)
    good[np.nonzero(good)[0][~finite]] = False
    return good, integers(rows[finite])


def integers(rows: np.ndarray) -> np.ndarray:
    """floor(1024 x) of every double."""
    if not rows.size or np.abs(rows).max() <= SAFE / SCALE:
        return np.floor(rows * SCALE).astype(np.int64)
    exact = [int(x) * SCALE if abs(x) >= 2 ** 53 else math.floor(x * SCALE) for x in rows.reshape(-1).tolist()]
    return np.array(exact, dtype=object).reshape(rows.shape)


def _parts(rows: np.ndarray, centroids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The rows whose search is safe in 64 bits, then the others, each with the centroids in fitting integers."""
    if rows.dtype != object and (not centroids.size or abs(centroids).max() <= SAFE):
        yield np.arange(len(rows)), rows.astype(np.int64)
        return
    large = np.array([bool(abs(r).max() > SAFE) for r in rows], bool) | bool((abs(centroids) > SAFE).any())
    for some, kind in ((~large, np.int64), (large, object)):
        if some.any():
            yield np.nonzero(some)[0], rows[some].astype(kind)


def assign(rows: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Cluster and squared distance of each row."""
    cluster, distance = np.zeros(len(rows), np.int64), [0] * len(rows)
    for at, part in _parts(rows, centroids):
        best, away, _ = nearest(part, centroids.astype(part.dtype))
        cluster[at] = best
        for k, d in zip(at.tolist(), away.tolist(), strict=True):
            distance[k] = d
    return cluster, distance


def _limbs(value: int, number: int) -> list[int]:
    """The value as ``number`` digits of 32 bits, the last one signed."""
    low = [value >> (_LIMB * k) & ((1 << _LIMB) - 1) for k in range(number - 1)]
    return [*low, value >> (_LIMB * (number - 1))]


def _vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))


def _first_centroids(vectors: DataFrame, clusters: int, seed: int) -> list[list[int]]:
    """The kept vectors with the smallest hashes of their ids."""
    element = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    kept = vectors.where((F.size("vector") == SIZE) & F.forall("vector", element))
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    rows = kept.select(key.alias("key"), "vector").orderBy("key", "vector").limit(clusters).collect()
    return [integers(np.array([r["vector"]], np.float64))[0].tolist() for r in rows]


def _array(centroids: list[list[int]]) -> np.ndarray:
    fits = all(abs(x) < 1 << 62 for row in centroids for x in row)
    return np.array(centroids, dtype=np.int64 if fits else object).reshape(-1, SIZE)


def _next(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """One round: every non-empty centroid becomes the floor of its vectors' mean."""
    now = _array(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, rows = _kept(batch.column(0))
            cluster, _ = assign(rows, now)
            out = []
            for k in np.unique(cluster).tolist():
                own = rows[cluster == k]
                sums = [int(s) for s in own.sum(axis=0)]
                number = max(1, -(-max(abs(s).bit_length() + 1 for s in sums) // _LIMB))
                digits = list(zip(*(_limbs(s, number) for s in sums), strict=True))
                out += [(k, limb, len(own) if not limb else 0, list(d)) for limb, d in enumerate(digits)]
            yield pa.record_batch([pa.array([r[i] for r in out], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())))],
                                  names=["cluster", "limb", "n", "sums"])

    parts = map_arrow(vectors.select("vector"), run, "cluster bigint, limb bigint, n bigint, sums array<bigint>")
    summed = parts.groupBy("cluster", "limb").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(SIZE)])
    totals: dict[int, list[int]] = {}
    counts: dict[int, int] = {}
    for row in summed.collect():  # a row for each centroid and 32-bit digit
        k = row["cluster"]
        counts[k] = counts.get(k, 0) + row["n"]
        own = totals.setdefault(k, [0] * SIZE)
        for i in range(SIZE):
            own[i] += row[f"s{i}"] << (_LIMB * row["limb"])
    return [[s // counts[k] for s in totals[k]] if k in totals else old for k, old in enumerate(centroids)]


def cluster(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS,
            seed: int = SEED) -> tuple[DataFrame, list[list[int]]]:
    """(id, cluster, distance) of every vector that counts, and the final centroids."""
    vectors = _vectors(df, id_col, vector_col)
    centroids = _first_centroids(vectors, clusters, seed)
    for _ in range(rounds if centroids else 0):
        centroids = _next(vectors, centroids)
    final = _array(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, rows = _kept(batch.column(1))
            best, away = assign(rows, final) if len(final) else (np.zeros(0, np.int64), [])
            yield pa.record_batch([batch.column(0).filter(pa.array(good)), pa.array(best, pa.int64()),
                                   pa.array([d if d < 1 << 63 else None for d in away], pa.int64())], names=["id", "cluster", "distance"])

    kind = vectors.schema["id"].dataType.simpleString()
    return map_arrow(vectors, run, f"id {kind}, cluster bigint, distance bigint").withColumnRenamed("id", id_col), centroids


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = cluster(table(spark, sf_dir, "embeddings"))
    assigned = shared_table(found, "assigned")
    sums = {r["cluster"]: r["total"] if r["whole"] else None for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total"), (F.count("distance") == F.count(F.lit(1))).alias("whole")).collect()}
    total = None if None in sums.values() else sum(sums.values(), Decimal(0))
    fitting = lambda x: int(x) if x is not None and x < 1 << 63 else None
    report = [(k, fitting(sums.get(k)), fitting(total), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for k, c in enumerate(centroids)]
    kinds = T.StructType.fromDDL("cluster bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    one_each = F.broadcast(spark.createDataFrame(report, kinds))  # a row for each of the 8 centroids
    return (assigned.join(one_each, "cluster", "left")
            .select("vec_id", F.col("cluster").cast("int").alias("cluster"), "distance", "cluster_inertia", "inertia", "centroid_sha256"))


def _oracle() -> str:
    start = f"""
WITH kept AS (SELECT vec_id, row_number() OVER () AS n, [floor({SCALE} * x::DOUBLE)::HUGEINT FOR x IN embedding] AS v FROM embeddings
  WHERE len(embedding) = {SIZE} AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = {SIZE}),
long AS MATERIALIZED (SELECT n, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM kept),
firsts AS (SELECT n, row_number() OVER (ORDER BY sha256('{SEED}:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS k FROM kept QUALIFY k < {CLUSTERS}),
c0 AS MATERIALIZED (SELECT k, i, x FROM firsts JOIN long USING (n))"""
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (SELECT n, min(ROW(d, k)) AS best FROM (
  SELECT l.n, c.k, sum((l.x - c.x) * (l.x - c.x)) AS d FROM long l JOIN c{r} c USING (i) GROUP BY ALL) GROUP BY n)""")
        if r < ROUNDS:
            steps.append(f"""
m{r} AS (SELECT best[2] AS k, i, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS m FROM a{r} JOIN long USING (n) GROUP BY ALL),
c{r + 1} AS MATERIALIZED (SELECT k, i, coalesce((s - ((s % m) + m) % m) // m, c.x) AS x FROM c{r} c LEFT JOIN m{r} USING (k, i))""")
    return ",".join([start, *steps, f"""
shas AS (SELECT k, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS sha FROM c{ROUNDS} GROUP BY k),
done AS (SELECT vec_id, best[2]::INT AS cluster, best[1]::BIGINT AS distance FROM a{ROUNDS} JOIN kept USING (n))
SELECT vec_id, cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
       sum(distance) OVER ()::BIGINT AS inertia, sha AS centroid_sha256
FROM done JOIN shas ON cluster = k
"""])


OP12_SQL = _oracle()
