"""Queries: landed board payloads, one of each order's lines or of each customer's orders, as posting rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listwright.sources import payloads as P

from .registry import query
from .views import table

BOARD_TS = "1997-07-01 09:00:00"
SHOWN = ("id", "source", "company_name", "title", "origin_url", "location", "posted_at", "status", "raw_html", "deadline")
LINES = "(SELECT *, l_orderkey * 10 + l_linenumber AS k, l_shipdate::DATE AS d FROM lineitem)"


def _ts() -> Column:
    return F.to_timestamp_ntz(F.lit(BOARD_TS))


def _lines(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"), "l_orderkey", F.col("l_linenumber").alias("n"), "l_returnflag", "l_linestatus", F.to_date("l_shipdate").alias("d"))


def _landed(rows: DataFrame, key: str, entry: Column, before: str, after: str) -> DataFrame:
    """(payload): one JSON text for each key; an order has at most seven lines, a customer some ten orders.
    Entries are gathered as texts: buffers of nested structs are copied field by field at each step."""
    entries = F.array_join(F.collect_list(F.to_json(entry)), ",")
    return rows.groupBy(key).agg(F.concat(F.lit(before), entries, F.lit(after)).alias("payload"))


def _rows(one: str, tail: str) -> str:
    return f"SELECT '{one}_' || k AS id, '{one}' AS source, 'Co {one}' AS company_name, {tail}"


@query(_rows("jobs", f"l_returnflag || ' role ' || l_linenumber AS title, 'u/' || k AS origin_url, CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE l_linestatus END AS location, CASE WHEN l_linenumber % 2 = 0 THEN d - 3 ELSE d END AS posted_at, 'ACTIVE' AS status, 'Line ' || l_linenumber || ' & more' || chr(10) || l_returnflag || chr(10) || l_linestatus AS raw_html, NULL::DATE AS deadline FROM {LINES}"), dates="posted_at deadline")
def jobs_payloads(spark, sf_dir):
    iso = lambda d: F.date_format(d, "yyyy-MM-dd'T'00:00:00")
    content = F.concat(F.lit("<p>Line "), "n", F.lit(" &amp; more</p><script>x</script><ul><li>"), "l_returnflag", F.lit("</li> <li>"), "l_linestatus", F.lit("</li></ul>"))
    place = F.struct(F.when(F.col("n") % 3 != 0, F.col("l_linestatus")).alias("name"))
    job = F.struct(F.col("k").alias("id"), F.concat("l_returnflag", F.lit(" role "), "n").alias("title"), F.concat(F.lit("u/"), "k").alias("absolute_url"), content.alias("content"), place.alias("location"), F.when(F.col("n") % 2 == 0, "").otherwise(iso(F.col("d"))).alias("updated_at"), iso(F.date_sub("d", 3)).alias("first_published"))
    landed = _landed(_lines(spark, sf_dir), "l_orderkey", job, '{"jobs":[', "]}")
    return P.jobs_board(landed, "jobs", "Co jobs", _ts()).select(*SHOWN)


@query(_rows("lists", f"l_returnflag || ' role' AS title, 'u/' || k AS origin_url, l_linestatus AS location, d AS posted_at, 'ACTIVE' AS status, CASE WHEN l_linenumber % 2 = 1 THEN 'Line ' || l_linenumber || chr(10) ELSE '' END || 'Duties' || chr(10) || l_returnflag || chr(10) || l_linestatus AS raw_html, NULL::DATE AS deadline FROM {LINES}"), dates="posted_at deadline")
def lists_payloads(spark, sf_dir):
    part = lambda text, content: F.struct(text.alias("text"), content.alias("content"))
    parts = F.array(part(F.lit("Duties"), F.concat(F.lit("<li>"), "l_returnflag", F.lit("</li><li>"), "l_linestatus", F.lit("</li>"))), part(F.lit(""), F.lit("")))
    noon = (F.unix_date("d").cast("long") * 86400 + 43200) * 1000
    job = F.struct(F.col("k").cast("string").alias("id"), F.concat("l_returnflag", F.lit(" role")).alias("text"), F.concat(F.lit("u/"), "k").alias("hostedUrl"), F.when(F.col("n") % 2 == 1, F.concat(F.lit("Line "), "n")).alias("descriptionPlain"), parts.alias("lists"), F.struct(F.col("l_linestatus").alias("location")).alias("categories"), noon.alias("createdAt"))
    return P.lists_board(_landed(_lines(spark, sf_dir), "l_orderkey", job, "[", "]"), "lists", "Co lists", _ts()).select(*SHOWN)


@query(_rows("datas", "o_orderpriority || ' ' || o_orderstatus AS title, 'd/' || k AS origin_url, o_orderstatus AS location, d AS posted_at, 'ACTIVE' AS status, CASE WHEN k % 3 = 0 THEN o_orderpriority || ' ' || o_orderstatus ELSE 'body of ' || k END AS raw_html, CASE WHEN k % 4 <> 0 AND d + 30 - DATE '1997-07-01' <= 365 THEN d + 30 END AS deadline FROM (SELECT *, o_orderkey AS k, o_orderdate::DATE AS d FROM orders) WHERE NOT contains(o_orderpriority, 'LOW')"), dates="posted_at deadline")
def datas_payloads(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("d", F.to_date("o_orderdate"))
    due = F.when(F.col("o_orderkey") % 4 == 0, "soon").otherwise(F.date_format(F.date_add("d", 30), "yyyy-MM-dd'T'00:00"))
    job = F.struct(F.col("o_orderkey").alias("id"), F.concat_ws(" ", "o_orderpriority", "o_orderstatus").alias("title"), F.date_format("d", "yyyy-MM-dd").alias("openingDate"), due.alias("dueDate"), F.col("o_orderstatus").alias("place"))
    landed = _landed(orders, "o_custkey", job, '{"data":{"datas":[', "]}}")
    bodies = orders.where("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("id"), F.concat(F.lit("body of "), "o_orderkey").alias("body"))
    return P.datas_board(landed, bodies, ~F.contains("title", F.lit("LOW")), "datas", "Co datas", "d/", _ts()).select(*SHOWN)


@query(_rows("api", f"l_returnflag || ' role' AS title, 'a/' || k AS origin_url, '' AS location, d AS posted_at, 'ACTIVE' AS status, l_returnflag || CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE chr(10) || l_linestatus END AS raw_html, NULL::DATE AS deadline FROM {LINES}"), dates="posted_at deadline")
def api_payloads(spark, sf_dir):
    epoch = (F.unix_date("d").cast("long") * 86400 + 43200).cast("string")
    when = F.when((F.col("n") % 2 == 0) & (F.length(epoch) >= 9), epoch).otherwise(F.date_format("d", "yyyy-MM-dd HH:mm"))
    job = F.struct(F.col("k").alias("seq"), F.concat("l_returnflag", F.lit(" role")).alias("subject"), F.concat(F.lit("<b>"), "l_returnflag", F.lit("</b>")).alias("content1"), F.when(F.col("n") % 3 != 0, F.col("l_linestatus")).alias("content2"), when.alias("wdate"))
    landed = _landed(_lines(spark, sf_dir), "l_orderkey", job, '{"list":[', "]}")
    return P.company_api(landed, "api", "Co api", "a/", _ts()).select(*SHOWN)
