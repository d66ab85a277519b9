"""Versioned Parquet tables: read the newest whole version, write the next, never in place. The run log."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from listwright.schema import RUN_LOG


def _folder(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _folder(spark, path)
    return fs.exists(target)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder of spark.checkpoint.dir, which all executors share; a local one only
    where that is unset and Spark is local (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return f"{found.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str) -> DataFrame:
    """df, written once and read back: what several results need is computed once."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions: those with a _SUCCESS file."""
    fs, root = _folder(spark, path)
    if not fs.exists(root):
        return []
    found = [(re.fullmatch(r"v=(\d+)", s.getPath().getName()), s.getPath()) for s in fs.listStatus(root)]
    return sorted(int(m[1]) for m, p in found if m and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def read_latest(spark: SparkSession, path: str) -> DataFrame | None:
    have = versions(spark, path)
    return spark.read.parquet(f"{path}/v={have[-1]}") if have else None  # one job wrote it: all its files have one schema


def write_next(df: DataFrame, path: str, partition_by: str = "source") -> int:
    """The number of the version written. Parquet files are sorted by the partition column."""
    have = versions(df.sparkSession, path)
    n = (have[-1] + 1) if have else 1
    df.write.mode("overwrite").partitionBy(partition_by).parquet(f"{path}/v={n}")
    return n


def overwrite_parts(df: DataFrame, path: str, *parts: str) -> None:
    """Replace the partitions that df has rows of, and no others. Files are staged beside the table and
    moved at the job's commit, so a write that fails leaves the table as it was."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)


def append_run(log: DataFrame, path: str) -> None:
    """Add runs (columns of RUN_LOG) to the log. A run's rows are the partition of its date and id:
    appended again, after a retry or a lost acknowledgement, they replace themselves."""
    overwrite_parts(log.repartition("run_date", "run_id"), path, "run_date", "run_id")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The run log; no rows where nothing has been appended."""
    empty = spark.createDataFrame([], RUN_LOG)
    return spark.read.schema(RUN_LOG).parquet(path).select(*empty.columns) if exists(spark, path) else empty
