"""Landed board payloads (JSON) as standard posting rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listwright.functions.dates import due_date, posted_date
from listwright.functions.text import html_to_text
from listwright.schema import COMPANY_API, DATAS_BOARD, JOBS_BOARD, LISTS_BOARD

POSTING_COLUMNS = ("id", "source", "company_name", "title", "origin_url", "location", "posted_at", "status", "raw_html", "first_seen_at", "last_updated_at", "deadline")


def first_filled(*columns: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def standardize(rows: DataFrame, run_ts: Column) -> DataFrame:
    """Posting rows with defaults; rows needs id, source, company_name, title, origin_url and may
    have location, posted_at, raw_html, deadline. All rows of a run share run_ts."""
    have = lambda c, kind: F.col(c) if c in rows.columns else F.lit(None).cast(kind)
    return rows.select(
        "id", "source", "company_name", "title", "origin_url",
        F.coalesce(have("location", "string"), F.lit("")).alias("location"),
        F.coalesce(have("posted_at", "date"), F.to_date(run_ts)).alias("posted_at"),
        F.lit("ACTIVE").alias("status"),
        F.coalesce(F.nullif(have("raw_html", "string"), F.lit("")), F.col("title")).alias("raw_html"),
        run_ts.alias("first_seen_at"), run_ts.alias("last_updated_at"),
        have("deadline", "date").alias("deadline"),
    )


def union_sources(*batches: DataFrame) -> DataFrame:
    """One batch; columns that a source lacks are null. ingest order is the caller's column."""
    out = batches[0]
    for b in batches[1:]:
        out = out.unionByName(b, allowMissingColumns=True)
    return out


def jobs_board(payloads: DataFrame, source: str, company: str, run_ts: Column, json: str = "payload") -> DataFrame:
    """{"jobs": [...]}: one posting per job."""
    job = payloads.select(F.explode(F.from_json(json, JOBS_BOARD)["jobs"]).alias("j"))
    day = F.try_to_date(F.left(first_filled(F.col("j.updated_at"), F.col("j.first_published")), F.lit(10)), "yyyy-MM-dd")
    return standardize(job.select(F.concat(F.lit(f"{source}_"), "j.id").alias("id"), F.lit(source).alias("source"), F.lit(company).alias("company_name"), "j.title", F.col("j.absolute_url").alias("origin_url"), F.col("j.location.name").alias("location"), day.alias("posted_at"), html_to_text(F.col("j.content")).alias("raw_html")), run_ts)


def lists_board(payloads: DataFrame, source: str, company: str, run_ts: Column, json: str = "payload") -> DataFrame:
    """A root array: the body is the description and each list's heading and content, by lines."""
    job = payloads.select(F.explode(F.from_json(json, LISTS_BOARD)).alias("j"))
    parts = F.flatten(F.transform(F.coalesce("j.lists", F.array()), lambda x: F.array(x["text"], html_to_text(x["content"]))))
    body = F.array_join(F.array_remove(F.concat(F.array("j.descriptionPlain"), parts), ""), "\n")  # nulls are not joined
    day = F.to_date(F.timestamp_millis("j.createdAt"))
    return standardize(job.select(F.concat(F.lit(f"{source}_"), "j.id").alias("id"), F.lit(source).alias("source"), F.lit(company).alias("company_name"), F.col("j.text").alias("title"), F.col("j.hostedUrl").alias("origin_url"), F.col("j.categories.location").alias("location"), day.alias("posted_at"), body.alias("raw_html")), run_ts)


def datas_board(payloads: DataFrame, details: DataFrame, accepted: Column, source: str, company: str, base_url: str, run_ts: Column, json: str = "payload") -> DataFrame:
    """{"data": {"datas": [...]}}: titles are filtered before bodies are joined from details (id, body)."""
    job = payloads.select(F.explode(F.from_json(json, DATAS_BOARD)["data"]["datas"]).alias("j")).select("j.*").where(accepted)
    rows = job.join(details.select(F.col("id").alias("detail_id"), "body"), F.col("id") == F.col("detail_id"), "left")
    return standardize(rows.select(F.concat(F.lit(f"{source}_"), "id").alias("id"), F.lit(source).alias("source"), F.lit(company).alias("company_name"), "title", F.concat(F.lit(base_url), "id").alias("origin_url"), F.col("place").alias("location"), F.try_to_date(F.left("openingDate", F.lit(10)), "yyyy-MM-dd").alias("posted_at"), F.col("body").alias("raw_html"), due_date(F.col("dueDate"), F.to_date(run_ts)).alias("deadline")), run_ts)


def company_api(payloads: DataFrame, source: str, company: str, base_url: str, run_ts: Column, json: str = "payload") -> DataFrame:
    """{"list": [...]}: the body is made of two HTML fields."""
    job = payloads.select(F.explode(F.from_json(json, COMPANY_API)["list"]).alias("j")).select("j.*")
    body = F.concat_ws("\n", html_to_text(F.col("content1")), html_to_text(F.col("content2")))
    return standardize(job.select(F.concat(F.lit(f"{source}_"), "seq").alias("id"), F.lit(source).alias("source"), F.lit(company).alias("company_name"), F.col("subject").alias("title"), F.concat(F.lit(base_url), "seq").alias("origin_url"), F.try_to_date(posted_date(F.col("wdate"), F.to_date(run_ts)), "yyyy-MM-dd").alias("posted_at"), body.alias("raw_html")), run_ts)
