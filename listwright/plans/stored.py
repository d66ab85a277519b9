"""Queries over tables that the engine writes itself: merges in place, run log, rebuilt categories, mart."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from listwright.operators.health import run_row
from listwright.sources import buckets, snapshots

from . import mart, rebuild
from .changes import MERGE, _ts
from .registry import query
from .views import LATIN, posts, previous, run_log, table, today, with_views

BUCKETS = 16


def _bucketed(spark, sf_dir):
    """The previous master as a bucketed table."""
    rows, name = previous(spark, sf_dir), f"master_{uuid.uuid4().hex}"
    buckets.open_master(spark, name, snapshots.scratch(spark, "master"), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema), BUCKETS)
    buckets.replace_buckets(rows, name, BUCKETS)
    return name


STATE = "CASE WHEN change_type IN ('new', 'modified') THEN 'ACTIVE' ELSE (SELECT status FROM v_prev WHERE v_prev.id = m.id) END"


@query(with_views(f"SELECT id, source, {STATE} AS status, deadline, last_seen_date, CASE WHEN change_type IN ('unchanged', 'absent') THEN old_len ELSE new_len END AS body_len FROM m", "v_prev", "v_today", more=MERGE), dates="deadline last_seen_date")
def bucketed_merge(spark, sf_dir):
    """The master after a merge in place, bucket by bucket."""
    name = _bucketed(spark, sf_dir)
    buckets.merge_in_place(spark, name, today(spark, sf_dir), _ts(), BUCKETS, (), LATIN)
    return spark.table(name).select("id", "source", "status", "deadline", "last_seen_date", F.length("raw_html").alias("body_len"))


@query(with_views("SELECT source, change_type, count(*) AS n, count(*) FILTER (guarded) AS guarded FROM m GROUP BY ALL", "v_prev", "v_today", more=MERGE))
def observed_counts(spark, sf_dir):
    """change_counts as the write of the merge has counted them."""
    name, batch = _bucketed(spark, sf_dir), today(spark, sf_dir)
    sources = [r.source for r in table(spark, sf_dir, "documents").select("source").distinct().collect() if r.source is not None]
    return spark.createDataFrame(buckets.merge_in_place(spark, name, batch, _ts(), BUCKETS, sources, LATIN), "source string, change_type string, n long, guarded long")


@query(with_views("SELECT epoch(run_date)::BIGINT // 86400 * 2 + half AS run_id, run_date, '{' || string_agg('\"' || source || '\":' || n, ',' ORDER BY source) || '}' AS source_counts, CASE WHEN half = 1 THEN 'repeated' END AS error_log, is_success FROM v_runs GROUP BY run_date, half, is_success", "v_runs"), dates="run_date")
def run_log_replayed(spark, sf_dir):
    """The run log after every run was appended, and each second one once more with a note: one row for each run."""
    log = run_log(spark, sf_dir).withColumns({"newly_added": F.lit(0), "modified_count": F.lit(0), "closed_count": F.lit(0), "error_log": F.lit(None).cast("string")})
    path = snapshots.scratch(spark, "runs")
    snapshots.append_run(log, path)
    snapshots.append_run(log.where("run_id % 2 = 1").withColumn("error_log", F.lit("repeated")), path)
    return snapshots.read_runs(spark, path).select("run_id", "run_date", "source_counts", "error_log", "is_success")


@query(with_views("SELECT id AS job_id, source, CASE WHEN source = 'src1' THEN CASE WHEN regexp_matches(lower(title), 'th') THEN 'law' ELSE 'accounting' END WHEN regexp_matches(lower(title), 'tax|eau') THEN 'tax' WHEN regexp_matches(lower(title), 'tion|treasury') THEN 'treasury' ELSE 'accounting' END AS category, source = 'src1' OR id % 50 = 0 AS rebuilt FROM v_prev", "v_prev"))
def rebuilt_categories(spark, sf_dir):
    """Categories after a change of one source's rules and of some bodies: only these rows are classified again."""
    path, master = snapshots.scratch(spark, "categories"), previous(spark, sf_dir)
    rebuild.rebuild_stale(spark, master, path, otherwise=LATIN)
    before = snapshots.keep(rebuild.stored_categories(spark, path).select("job_id", "rules_md5", "as_of"), "categories")
    later = F.when(F.col("id") % 50 == 0, _ts()).otherwise(F.col("last_updated_at"))
    rebuild.rebuild_stale(spark, master.withColumn("last_updated_at", later), path, {"src1": replace(LATIN, categories=(("law", ("th",)),))}, LATIN)
    same = before.select(F.col("job_id").alias("id"), F.col("rules_md5").alias("md5"), F.col("as_of").alias("at"))
    both = rebuild.stored_categories(spark, path).join(same, F.col("job_id") == F.col("id"))
    return both.select(F.col("job_id").cast("long").alias("job_id"), "source", F.col("primary_category").alias("category"), ((F.col("rules_md5") != F.col("md5")) | (F.col("as_of") != F.col("at"))).alias("rebuilt"))


@query(with_views("SELECT id, source, title, posted_at, category, length(raw) AS body_len, length(raw) > length(title) + 60 AS has_body FROM (SELECT *, CASE id % 3 WHEN 0 THEN 'tax' WHEN 1 THEN 'treasury' ELSE 'other' END AS category, (id % 9)::INT AS low, CASE WHEN id % 4 <> 0 THEN (id % 9 + id % 3)::INT END AS high FROM v_post) WHERE category IN ('tax', 'treasury') AND low <= 6 AND (high IS NULL OR high >= 4) AND length(raw) >= 100", "v_post"), dates="posted_at")
def mart_scan(spark, sf_dir):
    """A faceted scan of the stored mart: lengths of bodies without the bodies."""
    i, path = F.col("id"), snapshots.scratch(spark, "mart")
    rows = posts(spark, sf_dir).withColumns({"category": F.when(i % 3 == 0, "tax").when(i % 3 == 1, "treasury").otherwise("other"), "min_experience": (i % 9).cast("int"), "max_experience": F.when(i % 4 != 0, i % 9 + i % 3).cast("int")})
    mart.write_mart(rows, path, body="raw")
    return mart.scan_mart(spark, path, ("tax", "treasury"), 4, 6, 100)
