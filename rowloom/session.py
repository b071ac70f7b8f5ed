"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Kept per process so that one local run uses one folder.
_local_scratch: str | None = None


def build_session(app: str = "rowloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here assumes: AQE with skew handling, and UTC."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder named by ``spark.checkpoint.dir``.

    The folder must be one that every executor sees. Only a local master, where driver and
    executors are one process, may fall back to a folder of this machine.
    """
    global _local_scratch
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the whole cluster")
        if _local_scratch is None:
            _local_scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        base = _local_scratch
    return f"{base.rstrip('/')}/rowloom-{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Used where a result feeds several later steps: the work is not repeated, and losing an
    executor later costs a re-read rather than a recomputation.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _input_splits(df: DataFrame) -> int:
    """How many splits of the configured size the rows fill, by the plan's own statistics."""
    spark = df.sparkSession
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    per_split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes")
    )
    return -(-size // per_split)


def spread(df: DataFrame, *keys: str, partitions: int | None = None) -> DataFrame:
    """Spread rows over tasks before costly per-row work.

    An explicit ``partitions`` always repartitions. Otherwise rows are moved only where the input fills fewer splits
    than the cluster has cores, and then to as many partitions as there are cores, each smaller than a split. A large
    table already has enough splits, and moving it would be a wasted shuffle.
    """
    if partitions is None:
        partitions = df.sparkSession.sparkContext.defaultParallelism
        if _input_splits(df) >= partitions:
            return df
    return df.repartition(partitions, *keys)
