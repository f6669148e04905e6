"""Session options the feature job runs with."""

from __future__ import annotations

from pyspark.sql import SparkSession

JOB_OPTIONS = {
    # Every join of the job has the campaign code in its key, and the facts are
    # partitioned by it.  Dynamic partition pruning would copy the other join
    # side into a pruning subquery at each of these joins (the copies nest),
    # while the static campaign-window filters already prune the partitions.
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "false",
    # Runtime re-planning: partition coalescing, skew-join splitting, and
    # broadcast of sides measured small at runtime.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE puts partitions together to so much; a task holds several sorted or hashed shuffles at once.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # Offers, tactic totals and supported keys all arrive hash-partitioned on
    # (campaign, CUC); joins on (campaign, CUC, offer key) may then reuse that
    # partitioning instead of re-shuffling both sides.  Safe here because an
    # offer group per (campaign, CUC) is bounded by the offer-type dimension.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Campaign codes stay strings when a partitioned table is read.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


#: Fact rows of a shuffle partition, about.
PARTITION_ROWS = 200_000

#: Largest side of a broadcast join, in bytes as Spark estimates them (of a file: compressed, some 4 bytes a product).  The driver builds every
#: broadcast table by itself, many times as large and a dozen of them at once, so a larger product table is shuffled with its facts instead.
BROADCAST_BYTES = 256 << 10
_BROADCAST_LIMITS = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")


def job_session(spark: SparkSession, own: SparkSession | None = None, fact_rows: int = 0) -> SparkSession:
    """A session of the same application with the caller's settings and, on top, the job's; the caller's stays as it is.

    Given a session made before, it is brought up to date instead.  With the rows of the largest fact, shuffles get more partitions than the
    caller's where those would grow beyond ``PARTITION_ROWS``, so a task's memory does not grow with the facts.  The caller's broadcast limit
    holds up to ``BROADCAST_BYTES``, so the driver's memory does not grow with the products.
    """
    own = own or spark.newSession()
    for key, value in {**spark.conf.getAll, **JOB_OPTIONS}.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    in_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for key in _BROADCAST_LIMITS:
        given = own.conf.get(key, None)  # the second is unset by default and then follows the first; -1 stands for no broadcasts
        if given is not None and not given.startswith("-") and in_bytes(given) > BROADCAST_BYTES:
            own.conf.set(key, str(BROADCAST_BYTES))
    dealt = max(-(-fact_rows // PARTITION_ROWS), int(own.conf.get("spark.sql.shuffle.partitions")))
    own.conf.set("spark.sql.shuffle.partitions", str(dealt))
    return own
