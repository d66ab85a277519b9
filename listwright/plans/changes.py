"""Queries: merge, close detection, marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listwright.functions.dates import days_left_label
from listwright.functions.text import body_degraded, for_diff, has_markers
from listwright.functions.text import has_body as longer_than_title
from listwright.operators import changes as C
from listwright.operators import closing as K
from listwright.operators.health import source_health
from listwright.sources.payloads import standardize as standard_rows
from listwright.sources.payloads import union_sources as union_all

from .daily import mart_rows, run_day
from .registry import query
from .views import LATIN, RUN_DAY, posts, previous, runs, table, today, with_views



def _ts():
    return F.to_timestamp_ntz(F.lit(f"{RUN_DAY} 09:00:00"))


def _day():
    return F.to_date(F.lit(RUN_DAY))


ACTIVE = "status = 'ACTIVE'"
MARK = "regexp_matches(regexp_replace({c}, '\\s+', '', 'g'), 'licensed|andthe|delala')"
NORM = r"trim(regexp_replace(regexp_replace(regexp_replace({c}, '\s+', ' ', 'g'), '\d{{4}}[-.]\d{{1,2}}[-.]\d{{1,2}}', '', 'g'), '\b\d{{1,2}}:\d{{2}}\b', '', 'g'))"
DEGRADED = f"(length(n) < length(o) AND (({MARK.format(c='o')} AND NOT {MARK.format(c='n')} AND length(n) < length(o) * 0.7::DOUBLE) OR (length(o) >= 400 AND length(n) * 3 <= length(o))))"
MERGE = f"""j AS (SELECT p.id AS pid, t.id AS tid, p.source AS psource, t.source AS tsource, p.title AS ptitle, t.title AS ttitle, p.status, p.deadline AS pdeadline, t.deadline AS tdeadline, p.raw_html AS o, t.raw_html AS n, p.last_seen_date
  FROM v_prev p FULL JOIN v_today t ON p.id = t.id),
g AS (SELECT *, coalesce(pid IS NOT NULL AND tid IS NOT NULL AND {DEGRADED}, false) AS guarded FROM j),
m AS (SELECT coalesce(pid, tid) AS id, coalesce(psource, tsource) AS source, guarded, coalesce(tdeadline, pdeadline) AS deadline, CASE WHEN tid IS NOT NULL THEN pdeadline END AS old_deadline,
  CASE WHEN tid IS NOT NULL THEN DATE '{RUN_DAY}' ELSE last_seen_date END AS last_seen_date,
  CASE WHEN pid IS NULL THEN 'new' WHEN tid IS NULL THEN 'absent' WHEN (NOT guarded AND {NORM.format(c='o')} <> {NORM.format(c='n')}) OR ptitle IS DISTINCT FROM ttitle OR (tdeadline IS NOT NULL AND tdeadline IS DISTINCT FROM pdeadline) OR status <> 'ACTIVE' THEN 'modified' ELSE 'unchanged' END AS change_type,
  CASE WHEN guarded OR tid IS NULL THEN length(o) ELSE length(n) END AS new_len, length(o) AS old_len FROM g)"""


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.merge_batch(previous(spark, sf_dir), today(spark, sf_dir), _ts(), LATIN)


@query(with_views("SELECT id, source, change_type, guarded, deadline, last_seen_date, CASE WHEN change_type IN ('unchanged', 'absent') THEN old_len ELSE new_len END AS body_len FROM m", "v_prev", "v_today", more=MERGE), dates="deadline last_seen_date")
def upsert_merge(spark, sf_dir):
    return _merged(spark, sf_dir).select("id", "source", "change_type", "guarded", "deadline", "last_seen_date", F.length("raw_html").alias("body_len"))


@query(with_views("SELECT source, change_type, count(*) AS n, count(*) FILTER (guarded) AS guarded FROM m GROUP BY ALL", "v_prev", "v_today", more=MERGE))
def change_counts(spark, sf_dir):
    return C.change_counts(_merged(spark, sf_dir))


@query(with_views("SELECT id, old_deadline AS old, deadline AS new, CASE WHEN deadline > old_deadline THEN 'extended' ELSE 'shortened' END AS verdict FROM m WHERE old_deadline IS NOT NULL AND deadline <> old_deadline", "v_prev", "v_today", more=MERGE), dates="old new")
def deadline_changes(spark, sf_dir):
    return C.deadline_changes(_merged(spark, sf_dir))


@query(with_views(f"SELECT id, md5({NORM.format(c='raw')}) AS norm_md5 FROM v_post", "v_post"))
def diff_norm(spark, sf_dir):
    return posts(spark, sf_dir).select("id", F.md5(for_diff(F.col("raw"))).alias("norm_md5"))


@query(with_views(f"SELECT p.id, {DEGRADED.replace('(o', '(p.raw_html').replace('(n)', '(t.raw_html)').replace('(n,', '(t.raw_html,')} AS degraded FROM v_prev p JOIN v_today t ON p.id = t.id", "v_prev", "v_today"))
def degrade_guard(spark, sf_dir):
    p, t = previous(spark, sf_dir).select("id", F.col("raw_html").alias("o")), today(spark, sf_dir).select("id", F.col("raw_html").alias("n"))
    return p.join(t, "id").select("id", body_degraded(F.col("o"), F.col("n"), LATIN).alias("degraded"))


@query(with_views("SELECT id AS job_id, length(title) AS n FROM v_today UNION ALL SELECT id, -1 FROM v_prev WHERE id NOT IN (SELECT id FROM v_today)", "v_prev", "v_today"))
def category_upsert(spark, sf_dir):
    old = previous(spark, sf_dir).select(F.col("id").alias("job_id"), F.lit(-1).alias("n"))
    return C.category_upsert(old, today(spark, sf_dir).select(F.col("id").alias("job_id"), F.length("title").alias("n")))


@query(with_views(f"SELECT id, CASE WHEN id IN (SELECT id FROM v_today) THEN DATE '{RUN_DAY}' ELSE last_seen_date END AS last_seen_date FROM v_prev", "v_prev", "v_today"), dates="last_seen_date")
def stamp_seen(spark, sf_dir):
    return C.stamp_seen(previous(spark, sf_dir).select("id", "last_seen_date"), today(spark, sf_dir).select("id"), _day())


@query(with_views(f"SELECT t.id, NOT {MARK.format(c='t.raw_html')} AND coalesce({MARK.format(c='p.raw_html')}, false) AS reused, CASE WHEN NOT {MARK.format(c='t.raw_html')} AND coalesce({MARK.format(c='p.raw_html')}, false) THEN length(p.raw_html) ELSE length(t.raw_html) END AS body_len FROM v_today t LEFT JOIN v_prev p ON t.id = p.id", "v_prev", "v_today"))
def body_reuse(spark, sf_dir):
    out = C.body_reuse(today(spark, sf_dir).select("id", "raw_html"), previous(spark, sf_dir), lambda c: has_markers(c, LATIN.body_markers))
    return out.select("id", "reused", F.length("raw_html").alias("body_len"))


@query(with_views(f"SELECT id FROM v_today WHERE NOT {MARK.format(c='raw_html')} ORDER BY id LIMIT 12", "v_today"))
def fetch_budget(spark, sf_dir):
    return today(spark, sf_dir).where(~has_markers(F.col("raw_html"), LATIN.body_markers)).select("id").orderBy("id").limit(LATIN.fetch_budget)


def _health(spark, sf_dir):
    p = posts(spark, sf_dir)
    return source_health(p.select("source", (F.col("id") % 97 != 0).alias("ok")).unionByName(p.where("source = 'src2'").select("source", F.lit(True).alias("ok"))).where("source <> 'src7'"))


def _doc_runs(spark, sf_dir):
    """Runs of document sources: each posting day is a run of its source."""
    return posts(spark, sf_dir).groupBy("source", F.date_add("posted_at", 4).alias("run_date")).agg(F.count("*").alias("n")).withColumn("is_success", F.day("run_date") % 9 != 0)


DOC_RUNS = "r AS (SELECT source, posted_at + 4 AS run_date, count(*) AS n, day(posted_at + 4) % 9 <> 0 AS is_success FROM v_post GROUP BY source, posted_at)"
HEALTH = "h AS (SELECT source, CASE WHEN bool_or(id % 97 <> 0) AND bool_or(id % 97 = 0) THEN 'partial' WHEN bool_or(id % 97 <> 0) THEN 'success' ELSE 'failed' END AS state FROM v_post WHERE source <> 'src7' GROUP BY source)"
CLOSE = f"""{HEALTH}, {DOC_RUNS}, a AS (SELECT * FROM v_prev WHERE status = 'ACTIVE'), b AS (SELECT id, source FROM v_today WHERE source <> 'src4'),
z AS (SELECT a.source, count(*) AS n_active FROM a WHERE source IN (SELECT source FROM h WHERE state <> 'failed') AND source NOT IN (SELECT source FROM b) GROUP BY a.source),
f AS (SELECT x.source, x.last_seen_date, count(DISTINCT r.run_date) AS fair_days FROM (SELECT DISTINCT source, last_seen_date FROM a WHERE last_seen_date IS NOT NULL AND id NOT IN (SELECT id FROM b)) x LEFT JOIN r ON lower(r.source) = lower(x.source) AND r.is_success AND r.run_date > x.last_seen_date AND r.run_date < DATE '{RUN_DAY}' GROUP BY ALL),
d AS (SELECT a.id, a.source, CASE WHEN a.id IN (SELECT id FROM b) THEN 'seen' WHEN (SELECT count(*) FROM b) < 3 THEN 'too_few_seen' WHEN coalesce(h.state, 'failed') = 'failed' THEN 'source_failed' WHEN h.state = 'partial' THEN 'source_suspect'
  WHEN z.source IS NOT NULL AND (z.n_active >= 2 OR (SELECT count(*) FROM z) >= 4) THEN 'mass_close' WHEN a.last_seen_date IS NULL OR a.last_seen_date > DATE '{RUN_DAY}' THEN 'restamp' WHEN a.last_seen_date = DATE '{RUN_DAY}' THEN 'same_day' WHEN coalesce(f.fair_days, 0) < 1 THEN 'grace' ELSE 'CLOSED' END AS decision
  FROM a LEFT JOIN h ON a.source = h.source LEFT JOIN z ON a.source = z.source LEFT JOIN f ON a.source = f.source AND a.last_seen_date = f.last_seen_date)"""


def _decisions(spark, sf_dir):
    batch = today(spark, sf_dir).where("source <> 'src4'")
    counts = batch.groupBy("source").agg(F.count("*").alias("n"))
    return K.close_decisions(previous(spark, sf_dir).where(ACTIVE), batch.select("id"), _health(spark, sf_dir), _doc_runs(spark, sf_dir), counts, _day(), LATIN)


@query(with_views("SELECT id, source, decision FROM d", "v_prev", "v_today", more=CLOSE))
def close_detect(spark, sf_dir):
    return _decisions(spark, sf_dir).select("id", "source", "decision")


@query(with_views("SELECT decision, count(*) AS n FROM d GROUP BY ALL", "v_prev", "v_today", more=CLOSE))
def close_summary(spark, sf_dir):
    return _decisions(spark, sf_dir).groupBy("decision").agg(F.count("*").alias("n"))


@query(with_views(f"SELECT p.id, CASE WHEN d.decision = 'CLOSED' THEN 'CLOSED' ELSE p.status END AS status, CASE WHEN d.decision = 'restamp' THEN DATE '{RUN_DAY}' ELSE p.last_seen_date END AS last_seen_date, CASE WHEN d.decision = 'CLOSED' THEN '{RUN_DAY} 09:00:00' ELSE '2024-01-31 09:00:00' END AS last_updated_at FROM v_prev p LEFT JOIN d ON p.id = d.id", "v_prev", "v_today", more=CLOSE), dates="last_seen_date")
def closed_master(spark, sf_dir):
    """The master after the decisions: closed rows and stamps are written."""
    out = K.apply_decisions(previous(spark, sf_dir), _decisions(spark, sf_dir), _ts())
    return out.select("id", "status", "last_seen_date", F.date_format("last_updated_at", "yyyy-MM-dd HH:mm:ss").alias("last_updated_at"))


DAILY = f"{MERGE}, " + CLOSE.replace(" WHERE source <> 'src4'", "").replace("a AS (SELECT * FROM v_prev WHERE status = 'ACTIVE')", "a AS (SELECT id, source, last_seen_date FROM m WHERE change_type <> 'absent' OR id IN (SELECT id FROM v_prev WHERE status = 'ACTIVE'))")


@query(
    with_views(
        "SELECT 'change' AS step, source, change_type AS kind, count(*) AS n FROM m GROUP BY ALL UNION ALL SELECT 'close', source, decision, count(*) FROM d GROUP BY ALL UNION ALL SELECT 'health', source, state, 1 FROM h UNION ALL SELECT 'active', source, 'ACTIVE', count(*) FROM d WHERE decision <> 'CLOSED' GROUP BY ALL "
        "UNION ALL SELECT 'category', source, CASE WHEN regexp_matches(lower(title), 'tax|eau') THEN 'tax' WHEN regexp_matches(lower(title), 'tion|treasury') THEN 'treasury' ELSE 'accounting' END, count(*) FROM (SELECT t.source, t.title FROM v_today t JOIN m ON t.id = m.id WHERE m.change_type IN ('new', 'modified')) GROUP BY ALL",
        "v_prev", "v_today", more=DAILY,
    )
)
def daily_run(spark, sf_dir):
    """A whole day: native dedup, merge, classification of what changed, close detection, health."""
    batch = today(spark, sf_dir)
    again = batch.where("id % 13 = 0").withColumns({"seq": F.lit(2), "search": F.lit(True)})  # arrives once more, from a search
    batch = batch.withColumns({"seq": F.lit(1), "search": F.lit(False)}).unionByName(again)
    day = run_day(previous(spark, sf_dir), batch, _health(spark, sf_dir), _doc_runs(spark, sf_dir), _ts(), "id", F.col("search"), "seq", LATIN)
    return day.report()


@query(with_views("SELECT source, n_active, (SELECT count(*) FROM z) AS zeroed, n_active >= 2 OR (SELECT count(*) FROM z) >= 4 AS hold FROM z", "v_prev", "v_today", more=CLOSE))
def mass_close_sources(spark, sf_dir):
    batch = today(spark, sf_dir).where("source <> 'src4'").groupBy("source").agg(F.count("*").alias("n"))
    return K.mass_close_sources(previous(spark, sf_dir).where(ACTIVE), batch, _health(spark, sf_dir).where("state <> 'failed'"), LATIN)


@query(with_views("SELECT x.source, x.last_seen, count(DISTINCT r.run_date) AS fair_days FROM (SELECT DISTINCT event_type AS source, ts::DATE AS last_seen FROM events) x LEFT JOIN (SELECT DISTINCT source, run_date FROM v_runs WHERE is_success AND n > 0) r ON r.source = x.source AND r.run_date > x.last_seen AND r.run_date < DATE '2024-01-25' GROUP BY ALL", "v_runs"), dates="last_seen")
def fair_miss_days(spark, sf_dir):
    pairs = table(spark, sf_dir, "events").select(F.col("event_type").alias("source"), F.to_date("ts").alias("last_seen"))
    return K.fair_miss_days(pairs, runs(spark, sf_dir), F.to_date(F.lit("2024-01-25")))


@query(with_views("SELECT x.source, x.last_seen, count(DISTINCT r.run_date) AS fair_days FROM (SELECT DISTINCT event_type AS source, ts::DATE AS last_seen FROM events) x LEFT JOIN (SELECT DISTINCT source, run_date FROM v_runs WHERE is_success AND n > 0) r ON r.source = x.source AND r.run_date > x.last_seen AND r.run_date < DATE '2024-01-25' GROUP BY ALL", "v_runs"), dates="last_seen")
def asof_fair_days(spark, sf_dir):
    pairs = table(spark, sf_dir, "events").select(F.col("event_type").alias("source"), F.to_date("ts").alias("last_seen"))
    return K.asof_fair_days(pairs, runs(spark, sf_dir), F.to_date(F.lit("2024-01-25")))


@query(with_views("SELECT p.id, p.source, p.title, p.posted_at, length(p.raw) AS raw_len, l.quality, l.toxic FROM v_post p LEFT JOIN labels l ON p.id = l.doc_id WHERE p.id % 17 <> 0", "v_post"), dates="posted_at")
def active_mart(spark, sf_dir):
    p = posts(spark, sf_dir).where("id % 17 <> 0")
    labels = table(spark, sf_dir, "labels")
    return p.join(labels, p["id"] == labels["doc_id"], "left").select("id", "source", "title", "posted_at", F.length("raw").alias("raw_len"), "quality", "toxic").orderBy(F.desc("posted_at"), F.desc("id"))


STORED = "CASE id % 4 WHEN 0 THEN '[\"ledger\",\"a</b>\"]' WHEN 1 THEN 'broken' WHEN 2 THEN '[]' END"


@query(with_views(f"SELECT id, replace(replace(title, '<', '&lt;'), '>', '&gt;') AS shown, replace('{{\"id\":' || id || ',\"source\":\"' || source || '\",\"min_experience\":' || coalesce(CASE WHEN id % 3 = 0 THEN id % 9 END, 0) || ',\"key_requirements\":' || CASE WHEN id % 4 = 0 THEN '[\"ledger\",\"a</b>\"]' ELSE '[]' END || ',\"is_new\":' || (posted_at = DATE '2024-01-11')::VARCHAR || ',\"has_body\":' || (length(raw) > length(title) + 60)::VARCHAR || '}}', '</', '<\\/') AS doc FROM v_post", "v_post"))
def mart_json(spark, sf_dir):
    p = posts(spark, sf_dir).withColumns({"key_requirements": F.expr(STORED), "min_experience": F.when(F.col("id") % 3 == 0, F.col("id") % 9).cast("int")})
    return mart_rows(p, F.to_date(F.lit("2024-01-11"))).select("id", "shown", "doc")


@query(with_views("SELECT id, source, company AS company_name, title, 'u/' || id AS origin_url, '' AS location, posted_at, 'ACTIVE' AS status, length(CASE WHEN id % 3 = 0 THEN title ELSE raw END) AS body_len, deadline FROM v_post", "v_post"), dates="posted_at deadline")
def standardize(spark, sf_dir):
    p = posts(spark, sf_dir).select("id", "source", F.col("company").alias("company_name"), "title", F.concat(F.lit("u/"), "id").alias("origin_url"), "posted_at", F.when(F.col("id") % 3 != 0, F.col("raw")).alias("raw_html"), "deadline")
    return standard_rows(p, _ts()).select("id", "source", "company_name", "title", "origin_url", "location", "posted_at", "status", F.length("raw_html").alias("body_len"), "deadline")


@query("SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier")
def union_sources(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return union_all(c, table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")))


@query(with_views("SELECT id, length(raw) > length(title) + 60 AS has_body FROM v_post", "v_post"))
def has_body(spark, sf_dir):
    return posts(spark, sf_dir).select("id", longer_than_title(F.col("title"), F.length("raw")).alias("has_body"))


@query(with_views("SELECT source, count(*) AS n_active FROM v_prev WHERE status = 'ACTIVE' GROUP BY ALL", "v_prev"))
def active_by_source(spark, sf_dir):
    return previous(spark, sf_dir).where(ACTIVE).groupBy("source").agg(F.count("*").alias("n_active"))


@query(with_views("SELECT count(*) FILTER (change_type = 'new') AS n_new, count(*) FILTER (change_type = 'modified') AS n_modified, count(*) FILTER (change_type = 'absent') AS n_absent, count(*) > 15 AS compact FROM m", "v_prev", "v_today", more=MERGE))
def briefing_counts(spark, sf_dir):
    n = lambda kind: F.count_if(F.col("change_type") == kind)
    return _merged(spark, sf_dir).agg(n("new").alias("n_new"), n("modified").alias("n_modified"), n("absent").alias("n_absent"), (F.count("*") > LATIN.compact_over).alias("compact"))


@query(with_views("SELECT id FROM v_prev WHERE status = 'ACTIVE' AND id NOT IN (SELECT id FROM m WHERE change_type = 'new')", "v_prev", "v_today", more=MERGE))
def briefing_existing(spark, sf_dir):
    new = _merged(spark, sf_dir).where("change_type = 'new'").select("id")
    return previous(spark, sf_dir).where(ACTIVE).select("id").join(new, "id", "left_anti")


@query("SELECT o_orderkey AS id, datediff('day', DATE '1998-01-01', o_orderdate::DATE) AS days_left, CASE WHEN datediff('day', DATE '1998-01-01', o_orderdate::DATE) = 0 THEN 'today' ELSE 'D-' || datediff('day', DATE '1998-01-01', o_orderdate::DATE) END AS label FROM orders WHERE datediff('day', DATE '1998-01-01', o_orderdate::DATE) BETWEEN 0 AND 3")
def urgent_list(spark, sf_dir):
    days = F.datediff(F.to_date("o_orderdate"), F.to_date(F.lit("1998-01-01")))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), days.alias("days_left")).where(F.col("days_left").between(0, LATIN.urgent_days))
    return o.withColumn("label", days_left_label(F.col("days_left"), "today")).orderBy("days_left", "id")
