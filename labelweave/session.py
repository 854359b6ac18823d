"""Session helpers: table access, parallelism and lineage cuts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app_name: str = "labelweave", master: str | None = None,
                  shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the jobs are designed for."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def parallelism(spark: SparkSession) -> int:
    """Tasks that can usefully run at once: cores now, or the shuffle width if larger."""
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(spark.sparkContext.defaultParallelism, shuffle)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give heavy per-row work one task per core when a scan has fewer splits.

    A no-op for scans with at least as many splits as cores, so large inputs
    are never shuffled for this. Select the needed columns first.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)


def broadcast_if_small(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """*df* (short rows) hinted for broadcast if it has at most *rows* rows; else Spark's own choice."""
    return F.broadcast(df) if df.count() <= rows else df


def _checkpoint_dir(spark: SparkSession) -> str:
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="labelweave-checkpoint-")
    sc.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise *df* in the shared checkpoint folder.

    Used where a plan depends on values Spark may not reproduce on a second
    evaluation (partition offsets); the files outlive any executor.
    """
    _checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
