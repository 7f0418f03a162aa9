"""Session helpers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", partitions: int = 8, name: str = "pitpanel") -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # a join on (entity, date) may keep a partitioning by entity that windows already made
        .config("spark.sql.requireAllClusterKeysForCoPartition", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the checkpoint folder, which the driver and all executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        stable(spark.range(1))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stable(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a reliable checkpoint that survives lost executors.

    Uses the folder of ``spark.checkpoint.dir``. A session without one gets a private folder if it is local; on a
    cluster, where executors do not share local folders, it is refused. Local sessions remove their files at the end.
    """
    context = df.sparkSession.sparkContext
    if df.sparkSession.conf.get("spark.checkpoint.dir", None) is None and context.getCheckpointDir() is None:
        if not context.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="pitpanel-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
