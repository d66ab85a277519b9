"""A master in hash buckets, which a day's batch changes in place, bucket by bucket.

The table is a Parquet table bucketed by id, and partitioned by the bucket's number as well, so that
a bucket is a folder of its own. Spark joins it with a batch without moving the master: only
the batch is shuffled. Dynamic partition overwrite replaces the folders of the buckets that the
batch touches and leaves all others alone.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listwright.config import DEFAULT, Rules
from listwright.operators.changes import merge_batch, observe_changes, observed_counts
from listwright.sources.snapshots import exists

BUCKET = "bucket"
_MODE = "spark.sql.sources.partitionOverwriteMode"


def bucket_of(key: str, buckets: int) -> Column:
    """The bucket that Spark writes and reads a key in."""
    return F.pmod(F.hash(key), F.lit(buckets)).cast("int")


def open_master(spark: SparkSession, table: str, path: str, schema: str, buckets: int, key: str = "id") -> DataFrame:
    """The master at path under a table name of this session; an empty one if there is none yet.

    The number of buckets belongs to the files: it is given again as it was at first."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({schema}, {BUCKET} int) USING parquet PARTITIONED BY ({BUCKET}) CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'")
    if exists(spark, path):
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    return spark.table(table)


@contextmanager
def _dynamic(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_MODE)
    spark.conf.set(_MODE, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(_MODE, before)


def replace_buckets(df: DataFrame, table: str, buckets: int, key: str = "id") -> None:
    """Write df's rows as the whole content of the buckets they fall in, one file each."""
    spark = df.sparkSession
    columns = [c for c in spark.table(table).columns if c != BUCKET]
    with _dynamic(spark):
        df.repartition(buckets, key).select(*columns, bucket_of(key, buckets).alias(BUCKET)).write.mode("overwrite").insertInto(table)


def merged_buckets(spark: SparkSession, table: str, batch: DataFrame, run_ts: Column, buckets: int, rules: Rules = DEFAULT) -> DataFrame:
    """merge_batch of the buckets that have a row of the batch. Listings of other buckets are absent from the
    batch, and absent listings stay as they are, so these buckets need not be read.

    The driver gets the numbers of these buckets, at most as many as there are."""
    touched = [r[0] for r in batch.select(bucket_of("id", buckets)).distinct().collect()]
    master = spark.table(table).where(F.col(BUCKET).isin(touched)).drop(BUCKET)
    return merge_batch(master, batch, run_ts, rules)


def merge_in_place(spark: SparkSession, table: str, batch: DataFrame, run_ts: Column, buckets: int, sources: Sequence[str], rules: Rules = DEFAULT) -> list[tuple]:
    """Merge the batch (unique ids) into the table; rows (source, change_type, n, guarded) of what it did,
    counted by the write itself.

    Absent listings of buckets that the batch does not touch are not read and so not counted. A run
    that failed can be repeated: what it had written already is then unchanged."""
    merged, seen = observe_changes(merged_buckets(spark, table, batch, run_ts, buckets, rules), sources)
    columns = [c for c in spark.table(table).columns if c != BUCKET]
    with _dynamic(spark):  # the join has left the rows in their buckets
        merged.select(*columns, bucket_of("id", buckets).alias(BUCKET)).write.mode("overwrite").insertInto(table)
    return observed_counts(seen, sources)
