"""Feature-table sink (SNK-1 / OP-21)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import CAMP

_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def write_features(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write the feature table partitioned by campaign, replacing only the
    campaigns present in ``df`` (dynamic partition overwrite), so a run for a
    new window leaves the other campaigns untouched.

    The ``rebalance`` hint lets AQE size the write tasks: small campaigns are
    coalesced, a hot campaign is split over several tasks and files.
    """
    (df.hint("rebalance", CAMP)
     .write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(CAMP)
     .format(fmt)
     .save(path))


def read_features(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The written table; a plain read would take the campaign, a folder name there, for a number."""
    return spark.read.format(fmt).load(path).withColumn(CAMP, F.col(CAMP).cast("string"))


def write_features_table(df: DataFrame, table: str) -> None:
    """Same, into a catalog table (created on the first run).

    Columns are put in the table's own order (partition columns last), and only the campaigns of ``df`` are replaced.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        df.hint("rebalance", CAMP).write.partitionBy(CAMP).saveAsTable(table)
        return
    columns = spark.table(table).columns
    if set(columns) != set(df.columns):
        raise ValueError(f"{table} has other columns: {sorted(set(columns) ^ set(df.columns))}")
    before = spark.conf.get(_OVERWRITE_MODE)
    spark.conf.set(_OVERWRITE_MODE, "dynamic")
    try:
        df.select(*columns).hint("rebalance", CAMP).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(_OVERWRITE_MODE, before)
