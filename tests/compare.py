"""Order-insensitive comparison of a Spark query with its DuckDB oracle."""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import SparkSession

from vitrina.plans.catalog import Query

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    return v


def compare(spark: SparkSession, con, query: Query, sf_dir: str) -> dict:
    sdf = query.spark(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(_norm(v) for v in r) for r in sdf.collect()]
    res = con.execute(query.sql())
    d_cols = [c[0] for c in res.description]
    d_rows = [tuple(_norm(v) for v in r) for r in res.fetchall()]
    out = {"query": query.name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": s_cols == d_cols}
    if s_cols != d_cols:
        out["columns"] = (s_cols, d_cols)
        return out
    cs, cd = Counter(s_rows), Counter(d_rows)
    only_s, only_d = cs - cd, cd - cs
    out["match"] = not only_s and not only_d
    if not out["match"]:
        out["only_spark"] = list(only_s.elements())[:5]
        out["only_oracle"] = list(only_d.elements())[:5]
    return out
