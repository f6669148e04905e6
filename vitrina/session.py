"""Session helpers for tests, bench and local runs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cores}]")
             .appName("vitrina")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "8g")
             # the call site of each column function costs several round trips to the JVM, half of a plan's building time
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only a local session that names none (tests) gets a scratch folder; on a
    cluster the executors would not share it, so there the setting is required.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured and not context.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="vitrina-ckpt-"))
    return context.getCheckpointDir()


_stored: dict[str, list[str]] = {}


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as parquet below the shared checkpoint folder, and read back: lineage cut, true sizes."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _stored.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_stored(spark: SparkSession) -> int:
    """Delete what this application has ``stored``, when its results are written; frames that read it can't be used after that."""
    paths = _stored.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return len(paths)
