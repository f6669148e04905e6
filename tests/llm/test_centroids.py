"""Integer k-means: search against plain distances, rounds against plain k-means, odd vectors."""

import hashlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from conftest import SMALL_SF
from vitrina.llm import centroids


def distances(x, c):
    return [[sum((int(p) - int(q)) ** 2 for p, q in zip(row, centre, strict=True)) for centre in c] for row in x]


@pytest.mark.parametrize("dtype, most", [(np.int64, 3), (np.int64, 700), (np.int64, centroids.SAFE), (object, 1 << 90)])
def test_nearest_is_exact(dtype, most):
    draw = np.random.default_rng(most % 97)
    x = np.array([[int(v) for v in row] for row in np.round((draw.random((120, 64)) * 2 - 1) * most)], dtype=dtype)
    c = np.concatenate((x[:5], x[2:4], x[:1]))  # equal centroids: the smaller number wins
    want = distances(x, c)
    best, away, _ = centroids.nearest(x, c)
    assert best.tolist() == [min(range(8), key=lambda k: (row[k], k)) for row in want]
    assert away.tolist() == [min(row) for row in want]


def test_search_drops_centroids_early():
    draw = np.random.default_rng(5)
    c = draw.integers(-500, 500, (8, 64))
    c[:, :] += (np.arange(8) * 2000)[:, None]
    x = c[draw.integers(0, 8, 1000)] + draw.integers(-50, 50, (1000, 64))
    assert centroids.nearest(x, c)[2] < 0.4 * 1000 * 8 * 64


def test_transform_keeps_distances():
    x = np.random.default_rng(0).integers(-1000, 1000, (2, 64))
    y = centroids.transform(x)
    assert ((y[0] - y[1]) ** 2).sum() == 64 * ((x[0] - x[1]) ** 2).sum()
    rows = centroids.transform(np.eye(64, dtype=np.int64))[:, centroids.sequency_order()]
    assert [(np.diff(rows[:, k]) != 0).sum() for k in range(64)] == list(range(64))


def plain_kmeans(rows, rounds=10):
    """rows: (id, vector); Python integers throughout."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v):
            kept.append((i, [(int(x) * 1024 if abs(x) >= 2 ** 53 else int(np.floor(float(x) * 1024))) for x in v], v))
    key = lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[2])
    c = [v for _, v, _ in sorted(kept, key=key)[:8]]
    near = lambda v: min((sum((p - q) ** 2 for p, q in zip(v, m, strict=True)), k) for k, m in enumerate(c))
    for _ in range(rounds):
        groups = {}
        for _, v, _ in kept:
            groups.setdefault(near(v)[1], []).append(v)
        c = [[sum(col) // len(groups[k]) for col in zip(*groups[k], strict=True)] if k in groups else m for k, m in enumerate(c)]
    return [(i, near(v)[1], near(v)[0]) for i, v, _ in kept], c


def columns(spark, folder):
    out = centroids.op12_centroids(spark, folder).collect()
    fit = lambda x: x if x < 1 << 63 else None
    return [(r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) for r in out], fit


def expected(rows, fit):
    assigned, c = plain_kmeans(rows)
    of = lambda k: sum(d for _, n, d in assigned if n == k)
    sha = lambda k: hashlib.sha256(",".join(map(str, c[k])).encode()).hexdigest()
    total = fit(sum(d for *_, d in assigned))
    return [(i, k, fit(d), fit(of(k)), total, sha(k)) for i, k, d in assigned]


def test_query_equals_plain_kmeans(spark):
    t = pq.read_table(f"{SMALL_SF}/embeddings.parquet").slice(0, 500)
    rows = list(zip(t["vec_id"].to_pylist(), t["embedding"].to_pylist(), strict=True))
    got, fit = columns(spark, SMALL_SF)
    assert sorted(got) == sorted(expected(rows, fit))


def test_odd_vectors(spark, tmp_path):
    draw = np.random.default_rng(3)
    vec = lambda scale=1.0: [float(x) for x in draw.normal(size=64) * scale]
    nan, inf = float("nan"), float("inf")
    same = vec()
    rows = [(i, vec()) for i in range(20)] + [(i, same) for i in range(20, 30)] + [
        (30, None), (31, []), (32, vec()[:63]), (33, vec() + [0.0]), (34, [nan] + vec()[1:]), (35, [None] + vec()[1:]), (36, vec()[:63] + [-inf]),
        (None, vec()), (1, vec()), (1, vec()), (2, same), (2, same)]
    kinds = "vec_id bigint, embedding array<double>, cluster string, distance int"
    spark.createDataFrame([(i, v, "x", 1) for i, v in rows], kinds).repartition(3).write.parquet(f"{tmp_path}/a/embeddings.parquet")
    got, fit = columns(spark, f"{tmp_path}/a")
    assert sorted(got, key=str) == sorted(expected(rows, fit), key=str)
    large = rows + [(40, vec(1e5)), (41, vec(1e6)), (42, vec(1e12)), (43, vec(1e200)), (44, [-1e308] * 64)]
    spark.createDataFrame([(i, v, "x", 1) for i, v in large], kinds).repartition(3).write.parquet(f"{tmp_path}/b/embeddings.parquet")
    got, fit = columns(spark, f"{tmp_path}/b")
    assert sorted(got, key=str) == sorted(expected(large, fit), key=str)
    few = [(7, same), (8, vec())]
    spark.createDataFrame([(i, v, "x", 1) for i, v in few], kinds).write.parquet(f"{tmp_path}/c/embeddings.parquet")
    got, fit = columns(spark, f"{tmp_path}/c")
    assert sorted(got) == sorted(expected(few, fit))
