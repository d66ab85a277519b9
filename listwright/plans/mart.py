"""The mart as a table that is laid out for its scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listwright.functions.text import has_body

from .classify import faceted


def write_mart(rows: DataFrame, path: str, body: str = "raw_html", facets: tuple[str, ...] = ("category", "min_experience"), ids: str = "id") -> None:
    """Store rows with body_len, the length of the body, so that no scan reads a body to measure it.

    Files are sorted by the facets, so that the statistics of their row groups tell them apart; a
    Bloom filter on the id lets a lookup skip row groups."""
    out = rows.withColumn("body_len", F.length(body)).repartitionByRange(*facets).sortWithinPartitions(*facets)
    out.write.option(f"parquet.bloom.filter.enabled#{ids}", "true").parquet(path)


def scan_mart(spark: SparkSession, path: str, categories: tuple[str, ...] = (), low: int | None = None, high: int | None = None, least_body: int | None = None) -> DataFrame:
    """(id, source, title, posted_at, category, body_len, has_body) under the facets. All filters are on stored
    columns, so Parquet gets them; the body is never read."""
    rows = faceted(spark.read.parquet(path), None, categories, low, high)
    if least_body is not None:
        rows = rows.where(F.col("body_len") >= least_body)
    return rows.select("id", "source", "title", "posted_at", "category", "body_len", has_body(F.col("title"), F.col("body_len")).alias("has_body"))
