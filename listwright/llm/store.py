"""Intermediate tables that every executor can read again after a loss."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a local one only where it is unset and Spark is local (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def clash_free(*internal: str) -> Callable:
    """For operators on a table: columns of the caller that are named like the operator's intermediate
    ones, in any case, have other names while it runs and come back as they were."""

    def wrap(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @functools.wraps(operator)
        def run(rows: DataFrame, *args, **kwargs) -> DataFrame:
            taken, other = {c.lower() for c in (*rows.columns, *internal)}, {}
            for c in rows.columns:
                if c.lower() in internal:
                    name = c
                    while name.lower() in taken:
                        name += "_"
                    taken.add(name.lower())
                    other[c] = name
            out = operator(rows.withColumnsRenamed(other) if other else rows, *args, **kwargs)
            return out.withColumnsRenamed({name: c for c, name in other.items()}) if other else out

        return run

    return wrap


BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Texts are long rows: Arrow batches of BATCH_ROWS, unless the session has its own number."""
    if spark.conf.get(_BATCH) == "10000":  # Spark's default
        spark.conf.set(_BATCH, str(BATCH_ROWS))


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it again: cuts the lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_kept(*tables: DataFrame) -> None:
    """Remove the files of kept tables that nothing will read again."""
    for df in tables:
        spark = df.sparkSession
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
