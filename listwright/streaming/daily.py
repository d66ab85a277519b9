"""The batch operators on Structured Streaming: landed payloads and daily baselines."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from listwright.config import DEFAULT, Rules
from listwright.operators.changes import merge_batch
from listwright.sources import buckets, snapshots


def landed(spark: SparkSession, path: str, schema: str, late: str = "2 days") -> DataFrame:
    """New JSON payloads of a folder; an id counts once within the watermark."""
    rows = spark.readStream.schema(schema).json(path)
    return rows.withWatermark("landed_at", late).dropDuplicatesWithinWatermark(["id"])


def merge_stream(batches: DataFrame, master_path: str, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] = lambda b: b, rules: Rules = DEFAULT) -> StreamingQuery:
    """Merge each micro-batch into the next master version, then stop when nothing is left.

    A version holds everything, so a batch that is replayed after a failure changes nothing.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        rows, run_ts = prepare(batch), F.current_timestamp().cast("timestamp_ntz")
        master = snapshots.read_latest(spark, master_path)
        if master is None:
            master = rows.withColumn("last_seen_date", F.to_date(run_ts)).limit(0)
        merged = merge_batch(master, rows, run_ts, rules).drop("change_type", "guarded", "old_deadline")
        snapshots.write_next(merged, master_path)

    return batches.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merge_stream_in_place(batches: DataFrame, table: str, n_buckets: int, checkpoint: str, sources: Sequence[str] = (), prepare: Callable[[DataFrame], DataFrame] = lambda b: b, done: Callable[[int, list[tuple]], None] = lambda batch_id, counts: None, rules: Rules = DEFAULT) -> StreamingQuery:
    """Merge each micro-batch into a bucketed master: only the buckets that it touches are read and written.

    done gets each batch's number and the counts of its merge, from the write itself. A batch that is
    replayed after a failure finds its rows in place and changes nothing.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark, run_ts = batch.sparkSession, F.current_timestamp().cast("timestamp_ntz")
        rows = snapshots.keep(prepare(batch), "batch")  # read for its buckets, then merged
        done(batch_id, [] if rows.isEmpty() else buckets.merge_in_place(spark, table, rows, run_ts, n_buckets, sources, rules))

    return batches.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def daily_counts(events: DataFrame, at: str = "ts", source: str = "source", late: str = "1 day") -> DataFrame:
    """(day, source, n): tumbling days; late rows count until the watermark passes."""
    return events.withWatermark(at, late).groupBy(F.window(at, "1 day").alias("w"), F.lower(source).alias("source")).agg(F.count("*").alias("n")).select(F.to_date("w.start").alias("day"), "source", "n")
