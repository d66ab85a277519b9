"""Engine-shaped views over the driver tables, in Spark and as DuckDB common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listwright.config import CompanyRules, Rules, TitleRules

LATIN = Rules(
    titles=TitleRules(deny=("idiot", "clown", "&"), allow_exact=("The", "Of"), allow_any_case=("ment", "eau"), patterns=(r"(er|in)\s?and",), whole_words=("in",)),
    companies=CompanyRules(deny=("gizmo",), deny_context=("promo",), allow=("small", "red", "brand#1")),
    work_types=(("remote", ("ationth", r"on\s+the\s+in")), ("hybrid", (r"de\s+la", r"und\s+der")), ("site", (r"of\s+and", "ciónes"))),
    work_type_unknown="unknown",
    categories=(("tax", ("tax", "eau")), ("treasury", ("tion", "treasury"))),
    category_default="accounting",
    body_markers=("licensed", "andthe", "delala"),
    extra_body_markers=("theand", "ofthe"),
    navigation=("the ", "and ", "la ", "de ", "der "),
    tail_markers=("Licensed", "license", "token", "the of", "de la"),
    requirement_start=("and the", "the and", "de la", "und der"),
    requirement_end=(" of ", " que ", " zu "),
    section_requirements=("Requirements",),
    section_preferences=("Preferences",),
    section_other=("Other",),
    tools=("the", "ing", "tion", "eau", "sch", "ment"),
    certificates=(("A", ("ation", "eur")), ("B", ("ich ", "ung")), ("C", ("ción",))),
    skills=(("S1", ("and", "und")), ("S2", ("que",)), ("S3", ("zzz",))),
    closed_badge=r"closed\s*\(~",
    platforms=("src1", "src3", "src5"),
    close_least_seen=3,
)
RUN_DAY = "2024-02-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_add(F.to_date(F.lit("2024-01-01")), (F.col("doc_id") % 30).cast("int"))
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), "source", F.concat(F.lit("co "), F.col("doc_id") % 50).alias("company"), F.element_at(F.split("text", "\n", 2), 1).alias("title"), F.col("text").alias("raw"), day.alias("posted_at"),
        F.when(F.col("doc_id") % 4 != 0, F.date_add(day, 10)).alias("deadline"),
    )


def previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("id")
    return posts(spark, sf_dir).where(i % 10 != 0).select(
        "id", "source", F.col("company").alias("company_name"), "title", F.concat(F.lit("u/"), "id").alias("origin_url"), F.lit("here").alias("location"), "posted_at", F.when(i % 17 == 0, "CLOSED").otherwise("ACTIVE").alias("status"), F.col("raw").alias("raw_html"),
        F.to_timestamp_ntz(F.lit("2024-01-31 09:00:00")).alias("first_seen_at"), F.to_timestamp_ntz(F.lit("2024-01-31 09:00:00")).alias("last_updated_at"), "deadline", F.when(i % 19 != 0, F.date_sub(F.to_date(F.lit(RUN_DAY)), (i % 5).cast("int"))).alias("last_seen_date"),
    )


def today(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("id")
    return posts(spark, sf_dir).where(i % 7 != 0).select(
        "id", "source", F.col("company").alias("company_name"), F.when(i % 11 == 0, F.concat("title", F.lit(" x"))).otherwise(F.col("title")).alias("title"), F.concat(F.lit("u/"), "id").alias("origin_url"), F.lit("there").alias("location"), "posted_at", F.lit("ACTIVE").alias("status"),
        F.when(i % 5 == 0, F.left("raw", F.floor(F.length("raw") / 4).cast("int"))).otherwise(F.col("raw")).alias("raw_html"), F.to_timestamp_ntz(F.lit(f"{RUN_DAY} 09:00:00")).alias("first_seen_at"), F.to_timestamp_ntz(F.lit(f"{RUN_DAY} 09:00:00")).alias("last_updated_at"), F.when(i % 13 == 0, F.date_add("deadline", 3)).otherwise(F.col("deadline")).alias("deadline"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run_date, half, source, n, is_success): two runs a day; days divisible by 9 failed."""
    e = table(spark, sf_dir, "events").select(F.to_date("ts").alias("run_date"), (F.hour("ts") >= 12).cast("int").alias("half"), F.col("event_type").alias("source"))
    return e.groupBy("run_date", "half", "source").agg(F.count("*").alias("n")).withColumn("is_success", F.day("run_date") % 9 != 0)


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run_id, run_date, is_success, source_counts JSON, successful_sources JSON)."""
    r = runs(spark, sf_dir)
    entries = F.array_sort(F.collect_list(F.struct("source", "n")))
    g = r.groupBy("run_date", "half", "is_success").agg(entries.alias("e"))
    return g.select((F.unix_date("run_date").cast("long") * 2 + F.col("half")).alias("run_id"), "run_date", "is_success", F.to_json(F.map_from_entries("e")).alias("source_counts"), F.to_json(F.transform(F.filter("e", lambda x: x["n"] > 5), lambda x: x["source"])).alias("successful_sources"))


def last_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the last date: few purchases (a drop), no views (a zero source)."""
    e = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    e = e.join(F.broadcast(e.agg(F.max("day").alias("last"))), F.col("day") == F.col("last"))
    t = F.col("event_type")
    return e.where((t != "view") & ((t != "purchase") | (F.col("event_id") % 10 == 0))).select("event_id", F.col("event_type").alias("source"), "last")


SQL = {
    "v_post": "SELECT doc_id AS id, source, 'co ' || (doc_id % 50) AS company, split_part(text, chr(10), 1) AS title, text AS raw, DATE '2024-01-01' + (doc_id % 30)::INT AS posted_at, CASE WHEN doc_id % 4 <> 0 THEN DATE '2024-01-01' + (doc_id % 30)::INT + 10 END AS deadline FROM documents",
    "v_prev": f"SELECT id, source, company AS company_name, title, 'u/' || id AS origin_url, 'here' AS location, posted_at, CASE WHEN id % 17 = 0 THEN 'CLOSED' ELSE 'ACTIVE' END AS status, raw AS raw_html, deadline, CASE WHEN id % 19 <> 0 THEN DATE '{RUN_DAY}' - (id % 5)::INT END AS last_seen_date FROM v_post WHERE id % 10 <> 0",
    "v_today": "SELECT id, source, company AS company_name, CASE WHEN id % 11 = 0 THEN title || ' x' ELSE title END AS title, 'u/' || id AS origin_url, 'there' AS location, posted_at, CASE WHEN id % 5 = 0 THEN left(raw, (length(raw) // 4)::INT) ELSE raw END AS raw_html, CASE WHEN id % 13 = 0 THEN deadline + 3 ELSE deadline END AS deadline FROM v_post WHERE id % 7 <> 0",
    "v_runs": "SELECT ts::DATE AS run_date, (hour(ts) >= 12)::INT AS half, event_type AS source, count(*) AS n, day(ts::DATE) % 9 <> 0 AS is_success FROM events GROUP BY ALL",
    "v_last": "SELECT event_id, event_type AS source, ts::DATE AS last FROM events WHERE ts::DATE = (SELECT max(ts::DATE) FROM events) AND event_type <> 'view' AND (event_type <> 'purchase' OR event_id % 10 = 0)",
}
NEEDS = {"v_prev": ["v_post"], "v_today": ["v_post"]}


def with_views(body: str, *names: str, more: str = "") -> str:
    """body after WITH of the views it needs."""
    wanted: list[str] = []
    for n in names:
        for x in [*NEEDS.get(n, []), n]:
            if x not in wanted:
                wanted.append(x)
    parts = [f"{n} AS ({SQL[n]})" for n in wanted] + ([more] if more else [])
    return ("WITH " + ", ".join(parts) + " " if parts else "") + body
