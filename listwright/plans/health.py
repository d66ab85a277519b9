"""Queries: run log, source health, blocks, trends."""

from __future__ import annotations

from pyspark.sql import functions as F

from listwright.operators import health as H
from listwright.operators.lookups import known_block_split as split_known

from .registry import query
from .views import LATIN, last_day, run_log as logged, runs, table, with_views

BEFORE = "2024-01-30"
TYPES = ("click", "error", "purchase", "signup", "view")
PLATFORMS = "p AS (SELECT unnest(['click', 'error', 'purchase', 'signup', 'view']) AS source)"
BASE = f"b AS (SELECT source, run_date AS day, max(n) AS n FROM v_runs WHERE is_success AND run_date >= DATE '{BEFORE}' - 7 AND run_date < DATE '{BEFORE}' GROUP BY ALL)"


def _day():
    return F.to_date(F.lit(BEFORE))


def _platforms(spark):
    return spark.range(1).select(F.explode(F.array(*[F.lit(t) for t in TYPES])).alias("source"))


def _counts(spark, sf_dir):
    return H.log_counts(logged(spark, sf_dir))


def _today(spark, sf_dir):
    return last_day(spark, sf_dir).groupBy("source").agg(F.count("*").alias("n"))


@query(with_views("SELECT epoch(run_date)::BIGINT // 86400 * 2 + half AS run_id, run_date, '{' || string_agg('\"' || source || '\":' || n, ',' ORDER BY source) || '}' AS source_counts, coalesce(string_agg(source, ',' ORDER BY source) FILTER (n > 5), '') AS successful, count(*) FILTER (n > 5) > 0 AS is_success, concat_ws('; ', CASE WHEN NOT is_success THEN 'publishing failed' END, 'failed: ' || string_agg(source, ',' ORDER BY source) FILTER (n <= 5)) AS error_log FROM v_runs GROUP BY run_date, half, is_success", "v_runs"), dates="run_date")
def run_log(spark, sf_dir):
    """A run's row: sources with more than five rows count as successes, the others as failures."""
    entries = F.array_sort(F.collect_list(F.struct("source", "n")))
    some = lambda ok: F.array_sort(F.collect_list(F.when(ok, F.col("source"))))
    day = F.unix_date("run_date").cast("long") * 2 + F.col("half")
    run = runs(spark, sf_dir).groupBy("run_date", "half", "is_success").agg(entries.alias("counts"), some(F.col("n") > 5).alias("ok"), some(F.col("n") <= 5).alias("bad"))
    errors = F.array(F.when(~F.col("is_success"), "publishing failed"), F.when(F.size("bad") > 0, F.concat(F.lit("failed: "), F.array_join("bad", ","))))
    row = H.run_row(run.select(day.alias("run_id"), "run_date", F.map_from_entries("counts").alias("counts"), "ok", errors.alias("errors")))
    return row.select("run_id", "run_date", "source_counts", F.array_join(F.from_json("successful_sources", "array<string>"), ",").alias("successful"), "is_success", "error_log")


@query(with_views("SELECT p.source, (SELECT count(*) FROM v_last l WHERE l.source = p.source) AS n FROM p", "v_last", more=PLATFORMS))
def source_counts(spark, sf_dir):
    return H.source_counts(last_day(spark, sf_dir), _platforms(spark))


@query(with_views("SELECT source, array_to_string(list(n ORDER BY day DESC), ',') AS counts FROM b GROUP BY source", "v_runs", more=BASE))
def daily_baseline(spark, sf_dir):
    return H.history(H.daily_baseline(_counts(spark, sf_dir), _day())).select("source", F.array_join(F.transform("counts", lambda n: n.cast("string")), ",").alias("counts"))


@query(
    with_views(
        "SELECT p.source, coalesce(t.n, 0) AS today_n, coalesce(a.days, 0) AS days, round(a.average, 6) AS average, CASE WHEN a.days >= 3 AND a.average >= 3 AND coalesce(t.n, 0) > 0 AND t.n < 0.3::DOUBLE * a.average THEN 'drop' WHEN coalesce(a.days, 0) < 3 AND coalesce(t.n, 0) > 0 THEN 'insufficient' ELSE 'ok' END AS verdict FROM p LEFT JOIN (SELECT source, count(*) AS days, avg(n) AS average FROM b GROUP BY source) a USING (source) LEFT JOIN (SELECT source, count(*) AS n FROM v_last GROUP BY source) t USING (source)",
        "v_runs", "v_last", more=f"{PLATFORMS}, {BASE}",
    )
)
def drop_alerts(spark, sf_dir):
    return H.drop_alerts(H.daily_baseline(_counts(spark, sf_dir), _day()), _today(spark, sf_dir), _platforms(spark), LATIN)


@query("SELECT user_id AS source, CASE WHEN bool_or(event_type <> 'error') AND bool_or(event_type = 'error') THEN 'partial' WHEN bool_or(event_type <> 'error') THEN 'success' ELSE 'failed' END AS state FROM events GROUP BY user_id")
def source_health(spark, sf_dir):
    return H.source_health(table(spark, sf_dir, "events").select(F.col("user_id").alias("source"), (F.col("event_type") != "error").alias("ok")))


@query("SELECT user_id AS source, min(event_id) AS attempt, arg_min(value, event_id) AS payload FROM events WHERE event_type <> 'error' GROUP BY user_id")
def first_success(spark, sf_dir):
    return H.first_success(table(spark, sf_dir, "events").select(F.col("user_id").alias("source"), F.col("event_id").alias("attempt"), F.col("value").alias("payload"), (F.col("event_type") != "error").alias("ok")))


@query(with_views("SELECT source, max(run_date) AS last_date FROM v_runs WHERE n > 0 GROUP BY source", "v_runs"), dates="last_date")
def last_collected(spark, sf_dir):
    return H.last_collected(_counts(spark, sf_dir))


@query(with_views("SELECT DISTINCT lower(source) AS source FROM v_runs WHERE run_date = DATE '2024-01-18' AND n > 0", "v_runs"))
def collected_today(spark, sf_dir):
    return _counts(spark, sf_dir).where("run_date = date'2024-01-18'").select("source").distinct()


@query(with_views("SELECT DISTINCT lower(source) AS source FROM v_runs WHERE run_date = DATE '2024-01-18' AND n > 0", "v_runs"))
def ok_today(spark, sf_dir):
    log = logged(spark, sf_dir).where("run_date = date'2024-01-18'")
    listed = log.select(F.explode(F.from_json("successful_sources", "array<string>")).alias("source")).select(F.lower("source").alias("source"))
    return listed.union(H.log_counts(log).select("source")).distinct()


@query(with_views("SELECT source, since::DATE AS since, last_date, datediff('day', coalesce(last_date, since::DATE), DATE '2024-02-10') AS days, n_active, datediff('day', coalesce(last_date, since::DATE), DATE '2024-02-10') >= 14 AND coalesce(n_active, 1) <> 0 AS escalate FROM (VALUES ('click', '2024-01-16'), ('gone', '2024-01-16'), ('late', '2024-02-05')) t(source, since) LEFT JOIN (SELECT source, max(run_date) AS last_date FROM v_runs GROUP BY source) USING (source) LEFT JOIN (SELECT event_type AS source, count(*) AS n_active FROM events GROUP BY 1) USING (source)", "v_runs"), dates="since last_date")
def stale_blocks(spark, sf_dir):
    return H.stale_blocks(_blocks(spark), H.last_collected(_counts(spark, sf_dir)), table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("source")).agg(F.count("*").alias("n_active")), F.to_date(F.lit("2024-02-10")), LATIN)


def _blocks(spark):
    rows = [("click", "2024-01-16"), ("gone", "2024-01-16"), ("late", "2024-02-05")]
    return spark.createDataFrame(rows, "source string, since string").withColumn("since", F.to_date("since"))


@query(with_views("SELECT source, last_date FROM (SELECT source, max(run_date) AS last_date FROM v_runs GROUP BY source) WHERE source IN ('click', 'gone', 'late') AND last_date = DATE '2024-01-30'", "v_runs"), dates="last_date")
def recovered_blocks(spark, sf_dir):
    return H.recovered_blocks(_blocks(spark), H.last_collected(_counts(spark, sf_dir)), _day())


@query("SELECT event_type AS source, event_type IN ('click', 'gone', 'late') AS known, CASE WHEN event_type = 'click' THEN 'refused' END AS summary FROM (SELECT DISTINCT event_type FROM events)")
def known_block_split(spark, sf_dir):
    return split_known(table(spark, sf_dir, "events").select(F.col("event_type").alias("source")), _blocks(spark).select("source", F.lit("refused").alias("summary")))


@query("SELECT CASE WHEN count(*) >= 3 THEN r_name || '*' ELSE string_agg(n_name, ',' ORDER BY n_name) END AS label, count(*) AS n FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 3 <> 0 OR n_regionkey = 1 GROUP BY r_name")
def failed_families(spark, sf_dir):
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    family = n.join(r, n["n_regionkey"] == r["r_regionkey"]).select(F.col("n_name").alias("source"), F.col("r_name").alias("family"))
    return H.failed_families(n.where("n_nationkey % 3 <> 0 or n_regionkey = 1").select(F.col("n_name").alias("source")), family, LATIN)


@query(with_views("SELECT source, CASE WHEN source IN (SELECT source FROM v_runs WHERE run_date = DATE '2024-01-30') THEN 'recovered' ELSE 'failed' END AS kind FROM (SELECT DISTINCT source FROM v_runs WHERE run_date = DATE '2024-01-02' UNION SELECT 'lost')", "v_runs"))
def source_sets(spark, sf_dir):
    r = runs(spark, sf_dir)
    failed = r.where("run_date = date'2024-01-02'").select("source").union(spark.range(1).select(F.lit("lost").alias("source"))).distinct()
    ok = r.where("run_date = date'2024-01-30'").select("source").distinct()
    return failed.subtract(ok).withColumn("kind", F.lit("failed")).union(failed.intersect(ok).withColumn("kind", F.lit("recovered")))


@query("SELECT d AS run_date, n_new, n_modified, n_closed, (sum(n_new) OVER ())::BIGINT AS total_new, (sum(n_closed) OVER ())::BIGINT AS total_closed FROM (SELECT o_orderdate::DATE AS d, count(*) FILTER (o_orderstatus = 'O') AS n_new, count(*) FILTER (o_orderstatus = 'P') AS n_modified, count(*) FILTER (o_orderstatus = 'F') AS n_closed FROM orders GROUP BY 1 ORDER BY 1 DESC LIMIT 7)", dates="run_date")
def weekly_trend(spark, sf_dir):
    n = lambda s: F.count_if(F.col("o_orderstatus") == s)
    days = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("run_date")).agg(n("O").alias("n_new"), n("P").alias("n_modified"), n("F").alias("n_closed"))
    days = days.orderBy(F.desc("run_date")).limit(LATIN.baseline_days)
    return days.crossJoin(F.broadcast(days.agg(F.sum("n_new").alias("total_new"), F.sum("n_closed").alias("total_closed"))))


@query(
    with_views(
        "SELECT * FROM (SELECT 'warning' AS severity, 'failed' AS kind, 'lost' AS detail UNION ALL SELECT 'warning', 'zero', source FROM p WHERE source NOT IN (SELECT source FROM v_last) UNION ALL SELECT 'warning', 'drop', b.source FROM (SELECT source, avg(n) AS a, count(*) AS days FROM b GROUP BY source) b JOIN (SELECT source, count(*) AS n FROM v_last GROUP BY source) t ON b.source = t.source WHERE days >= 3 AND a >= 3 AND n < 0.3::DOUBLE * a UNION ALL SELECT 'warning', 'stale_block', 'gone' UNION ALL SELECT 'info', 'recovered', 'click' WHERE (SELECT max(run_date) FROM v_runs WHERE source = 'click') = DATE '2024-01-30' UNION ALL SELECT 'info', 'known_block', 'click' WHERE (SELECT max(run_date) FROM v_runs WHERE source = 'click') <> DATE '2024-01-30' UNION ALL SELECT 'info', 'known_block', 'late' UNION ALL SELECT 'info', 'closes_held', '')",
        "v_runs", "v_last", more=f"{PLATFORMS}, {BASE}",
    )
)
def health_report(spark, sf_dir):
    last = H.last_collected(_counts(spark, sf_dir))
    failed = spark.range(1).select(F.lit("lost").alias("source"))
    zero = source_counts(spark, sf_dir).where("n = 0")
    drops = drop_alerts(spark, sf_dir).where("verdict = 'drop'")
    active = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("source")).agg(F.count("*").alias("n_active"))
    stale = H.stale_blocks(_blocks(spark), last, active, F.to_date(F.lit("2024-02-10")), LATIN)
    return H.health_report(failed, zero, drops, stale, H.recovered_blocks(_blocks(spark), last, _day()))


@query("SELECT weekday, business, count(*) AS n FROM (SELECT (isodow(o_orderdate) - 1)::INT AS weekday, isodow(o_orderdate) < 6 AND o_orderdate::DATE NOT IN (DATE '1998-01-01', DATE '1998-12-25') AS business FROM orders) GROUP BY ALL")
def business_days(spark, sf_dir):
    holidays = spark.sql("SELECT explode(array(date'1998-01-01', date'1998-12-25')) AS holiday")
    o = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d")).join(F.broadcast(holidays), F.col("d") == F.col("holiday"), "left")
    return o.select(F.weekday("d").alias("weekday"), ((F.weekday("d") < 5) & F.col("holiday").isNull()).alias("business")).groupBy("weekday", "business").agg(F.count("*").alias("n"))


@query("SELECT event_id, (props->>'k')::INT AS k, CASE WHEN (props->>'k')::INT % 2 = 0 THEN 'even' ELSE 'odd' END AS parity FROM events WHERE (props->>'k') IS NOT NULL")
def json_flatten(spark, sf_dir):
    k = F.from_json("props", "k int")["k"]
    return table(spark, sf_dir, "events").select("event_id", k.alias("k")).where("k is not null").withColumn("parity", F.when(F.col("k") % 2 == 0, "even").otherwise("odd"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN strftime(to_timestamp(1700000000 + event_id * 1000) AT TIME ZONE 'UTC' + INTERVAL 9 HOUR, '%Y-%m-%d') WHEN event_id % 3 = 1 THEN strftime(ts, '%Y-%m-%d') ELSE '2024-01-31' END AS posted FROM events")
def epoch_or_date(spark, sf_dir):
    from listwright.functions.dates import posted_date

    raw = F.when(F.col("event_id") % 3 == 0, (F.col("event_id") * 1000 + 1700000000).cast("string")).when(F.col("event_id") % 3 == 1, F.date_format("ts", "yyyy-MM-dd HH:mm")).otherwise("")
    return table(spark, sf_dir, "events").select("event_id", posted_date(raw, F.to_date(F.lit("2024-01-31"))).alias("posted"))
