"""Runs that extend or refresh a written feature table instead of making all of it again.

The rows of a campaign depend on the facts of that campaign alone, except for their sequence numbers, which count the campaigns before.  So a
run may make the campaigns from any one on: the numbers go on from the state that the table's earlier rows hold (the last numbers of every category
and CUC, one aggregate over four columns of the earlier partitions).  The result equals a run over the whole windows.

``fingerprints`` tells which campaigns of the facts have changed since the last run; a refresh starts at the first of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..codes import OUTPUT_COLUMNS
from ..functions.columns import CAMP
from ..operators.sequences import continue_sequences, sequence_state
from ..params import Params
from ..session import stored
from ..sources.tables import Tables
from .feature_job import build
from .sink import read_features, write_features

FACTS = ("sales", "plan", "estimates", "support", "orders")


def fingerprints(t: Tables) -> DataFrame:
    """(table, campaign, rows, mark): one row for each campaign of each fact, the same for every order of its rows."""
    parts = []
    for name in FACTS:
        fact = getattr(t, name)
        h = F.xxhash64(*sorted(fact.columns))
        parts.append(fact.groupBy(F.col(CAMP).alias("campaign")).agg(
            F.count(F.lit(1)).alias("rows"), F.sum(h.cast("decimal(38,0)")).cast("string").alias("mark")).select(
            F.lit(name).alias("table"), "campaign", "rows", "mark"))
    return reduce(DataFrame.unionByName, parts)


def changed_campaigns(before: DataFrame, after: DataFrame) -> list[str]:
    """Campaigns whose rows differ in some fact between two sets of fingerprints, in order; new and vanished ones included."""
    keys = ["table", "campaign"]
    both = before.withColumnsRenamed({"rows": "_rows", "mark": "_mark"}).join(after, keys, "full")
    differ = ~(F.col("rows").eqNullSafe(F.col("_rows")) & F.col("mark").eqNullSafe(F.col("_mark")))
    return sorted(r[0] for r in both.where(differ & F.col("campaign").isNotNull()).select("campaign").distinct().collect())


def features_from(t: Tables, p: Params, earlier: DataFrame) -> DataFrame:
    """The rows of the campaigns of ``p.part_from`` and later, numbered on from ``earlier``, the table's rows before them."""
    core = stored(build(t, p).core, "features")
    state = stored(sequence_state(earlier.filter(F.col(CAMP) < p.part_from)), "sequence-state")
    most = p.max_campaigns() * len(p.run_categories)
    return continue_sequences(core, state, most).select(*OUTPUT_COLUMNS)


def _campaigns(features: DataFrame) -> set[str]:
    return {r[0] for r in features.select(CAMP).distinct().collect()}


def _remove_campaigns(spark: SparkSession, path: str, campaigns: set[str]) -> None:
    """Partitions of campaigns that have no row any more; an overwrite replaces only the partitions it has rows for."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for campaign in sorted(campaigns):
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(folder, f"{CAMP}={campaign}"), True)


def update(t: Tables, p: Params, path: str, first: str) -> None:
    """Make the campaigns from ``first`` on again, in the table at ``path`` (made by ``write_features`` for the same categories)."""
    spark = t.plan.sparkSession
    p = p.with_(part_from=max(first, p.part_from))
    table = read_features(spark, path)
    later = _campaigns(table.filter(F.col(CAMP).between(p.part_from, p.part_to)))
    rows = stored(features_from(t, p, table), "update")  # its source is the table that is written next
    write_features(rows, path)
    _remove_campaigns(spark, path, later - _campaigns(rows))


def extend(t: Tables, p: Params, path: str) -> None:
    """Add the campaigns after the last one of the table at ``path``."""
    last = read_features(t.plan.sparkSession, path).agg(F.max(CAMP)).first()[0]
    update(t, p, path, f"{int(last) + 1:06}" if last else p.part_from)


def refresh(t: Tables, p: Params, path: str, before: DataFrame) -> list[str]:
    """Bring the table up to date with facts that changed since the fingerprints ``before``; returns the changed campaigns of the windows."""
    changed = [c for c in changed_campaigns(before, fingerprints(t)) if p.all_from <= c <= p.all_to]
    if changed:
        update(t, p, path, changed[0])
    return changed
