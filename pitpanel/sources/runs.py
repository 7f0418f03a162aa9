"""Append-only reports in which a run appears once, however often it is written.

The rows of an attempt go to a folder of their own. Only then a manifest, a file named after the run, says which folder counts. A
manifest is created, never replaced: the first attempt that finishes wins, a repeated one finds the manifest and removes what it
wrote. Readers see folders that a manifest names, so an attempt that failed half-way is never read.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _files(spark: SparkSession, folder: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    return hadoop, hadoop.Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def append_run(df: DataFrame, folder: str, run: str) -> bool:
    """Write the rows of ``run`` (ASCII letters and digits, then also ``_``, ``-`` and ``.``); False if the run was there already."""
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", run):
        raise ValueError(f"{run!r} is no name for a run")
    spark = df.sparkSession
    hadoop, files = _files(spark, folder)
    manifest = hadoop.Path(f"{folder}/_manifest/{run}")
    if files.exists(manifest):
        return False
    attempt = f"attempt-{uuid.uuid4().hex}"
    df.write.parquet(f"{folder}/{attempt}")
    files.mkdirs(manifest.getParent())
    try:
        out = files.create(manifest, False)
    except Exception as fault:  # another attempt was faster; whatever else went wrong is raised
        if not files.exists(manifest):
            raise
        files.delete(hadoop.Path(f"{folder}/{attempt}"), True)
        del fault
        return False
    out.write(attempt.encode())
    out.close()
    return True


def read_runs(spark: SparkSession, folder: str) -> DataFrame | None:
    """All rows of all runs, with the run in column ``run``; None if there is no run yet."""
    hadoop, files = _files(spark, folder)
    place = hadoop.Path(f"{folder}/_manifest")
    if not files.exists(place):
        return None
    # a line for each run: what the driver holds is as long as the list of runs
    manifests = spark.read.option("wholetext", True).text(f"{folder}/_manifest")
    named = {r["folder"]: r["run"] for r in manifests.select(F.col("value").alias("folder"), F.element_at(F.split(F.input_file_name(), "/"), -1).alias("run")).collect()}
    if not named:
        return None
    runs = F.create_map(*[F.lit(x) for pair in named.items() for x in pair])
    rows = spark.read.option("mergeSchema", True).parquet(*[f"{folder}/{attempt}" for attempt in named])
    return rows.withColumn("run", runs[F.element_at(F.split(F.input_file_name(), "/"), -2)])
