"""Shared helpers of the operators in this folder."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel.session import stable

#: Upper bound on the bytes of rows that go to a Python worker at once.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, not only by rows, so that long texts do not add up in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_folder(spark: SparkSession, kind: str) -> str:
    """A new folder below spark.checkpoint.dir, which the driver and all executors share."""
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        stable(spark.range(1))  # sets a folder in local tests, refuses elsewhere
        base = context.getCheckpointDir()
    return f"{base.rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files and checkpoints of steps that nothing refers to any more.

    Its cleaner learns of them from a garbage collection on the driver, which may otherwise come late or never in a job
    whose driver has little to do; until then they take disk on the executors. Call it after a step that shuffles much.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


class Steps:
    """Tables between the steps of a job, as compressed Parquet in the shared folder, deleted by name when they are done with.

    While it is open as a context, Spark removes shuffle files as soon as the action that made them ends; at its end all tables
    go and the session is as before. What outlives it has to be checkpointed.
    """

    _CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self, spark: SparkSession, kind: str) -> None:
        self.spark, self.kind, self.paths, self.number = spark, kind, {}, 0

    def __enter__(self) -> Steps:
        self.folder, self.before = shared_folder(self.spark, self.kind), self.spark.conf.get(self._CLEANUP, None)
        self.spark.conf.set(self._CLEANUP, "true")
        return self

    def __exit__(self, *_) -> None:
        if self.before is None:
            self.spark.conf.unset(self._CLEANUP)
        else:
            self.spark.conf.set(self._CLEANUP, self.before)
        self._delete(self.folder)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """The rows of ``df``, written and read again."""
        self.number += 1
        path = f"{self.folder}/{self.number}-{name}"
        df.write.option("compression", "zstd").parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(table)] = (path, table)
        return table

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            self._delete(self.paths.pop(id(table))[0])

    def _delete(self, path: str) -> None:
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def most_frequent(counts: DataFrame, n: str, most: int) -> DataFrame:
    """Rows of ``counts`` with the highest counts, at most ``most``; rows of one count are all in or all out.

    What comes to the driver is the number of rows by count: with N counted things there are at most sqrt(2 N) of them.
    """
    left, least = most, None
    for row in sorted(counts.groupBy(n).agg(F.count("*").alias("rows")).collect(), key=lambda r: -r[n]):
        if row["rows"] > left:
            break
        left, least = left - row["rows"], row[n]
    return counts.where(F.col(n) >= least) if least is not None else counts.limit(0)


def lower_ascii(text: Column) -> Column:
    """A-Z to lower case, all other characters as they are; null counts as empty."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.coalesce(text, F.lit("")), upper, upper.lower())


def crc_of(identifier: Column) -> Column:
    """CRC-32 of an identifier's text; null counts as empty text."""
    return F.crc32(F.coalesce(identifier.cast("string"), F.lit("")).cast("binary"))


def slices(text: str, size: int = 1 << 20) -> Iterator[str]:
    """Pieces of a long text of at most ``size`` characters, cut before a space where there is one."""
    start = 0
    while len(text) - start > size:
        cut = text.rfind(" ", start + 1, start + size)
        cut = cut if cut > start else start + size
        yield text[start:cut]
        start = cut
    yield text[start:] if start else text
