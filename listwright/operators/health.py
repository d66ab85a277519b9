"""Source health: counts, baselines, alerts, blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listwright.config import DEFAULT, Rules


def log_counts(log: DataFrame) -> DataFrame:
    """(run_id, run_date, is_success, source, n) from JSON source_counts; only numbers over zero.

    Values that are booleans or strings, and JSON that is no object, give no row.
    """
    rows = log.sparkSession.sql("SELECT l.run_id, l.run_date, l.is_success, lower(e.key) AS source, schema_of_variant(e.value) AS kind, try_variant_get(e.value, '$', 'double') AS n FROM {log} l, LATERAL variant_explode(CASE WHEN schema_of_variant(try_parse_json(l.source_counts)) LIKE 'OBJECT%' THEN try_parse_json(l.source_counts) END) e", log=log)
    return rows.where((F.col("kind").isin("BIGINT", "DOUBLE") | F.col("kind").startswith("DECIMAL")) & (F.col("n") > 0)).drop("kind").withColumn("n", F.col("n").cast("long"))


def run_row(runs: DataFrame) -> DataFrame:
    """(run_id, run_date, is_success, error_log, source_counts, successful_sources) of runs (run_id,
    run_date, counts map, ok array of sources, errors array of texts): a run succeeded if any source
    did; its error text is what there is of errors, joined; counts and sources are JSON."""
    told = F.array_join(F.filter("errors", lambda e: e != ""), "; ")
    return runs.select("run_id", "run_date", (F.size("ok") > 0).alias("is_success"), told.alias("error_log"), F.to_json("counts").alias("source_counts"), F.to_json("ok").alias("successful_sources"))


def daily_baseline(counts: DataFrame, before: Column, days: int = DEFAULT.baseline_days) -> DataFrame:
    """(source, day, n): the best successful run of each day in [before - days, before)."""
    d = F.col("run_date")
    return counts.where(F.col("is_success") & (d >= F.date_sub(before, days)) & (d < before)).groupBy("source", d.alias("day")).agg(F.max("n").alias("n"))


def history(baseline: DataFrame) -> DataFrame:
    """(source, counts): newest day first."""
    newest = F.sort_array(F.collect_list(F.struct("day", "n")), asc=False)
    return baseline.groupBy("source").agg(F.transform(newest, lambda x: x["n"]).alias("counts"))


def drop_alerts(baseline: DataFrame, today: DataFrame, platforms: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """(source, today_n, days, average, verdict): drop, insufficient or ok for each platform."""
    base = baseline.groupBy("source").agg(F.count("*").alias("days"), F.avg("n").alias("average"))
    now = today.groupBy("source").agg(F.sum("n").alias("today_n"))
    p = platforms.select("source").distinct().join(base, "source", "left").join(now, "source", "left").na.fill({"days": 0, "today_n": 0})
    few = (F.col("days") < rules.drop_least_days) & (F.col("today_n") > 0)
    drop = (F.col("days") >= rules.drop_least_days) & (F.col("average") >= rules.drop_least_average) & (F.col("today_n") > 0) & (F.col("today_n") < rules.drop_ratio * F.col("average"))
    return p.select("source", "today_n", "days", F.round("average", 6).alias("average"), F.when(drop, "drop").when(few, "insufficient").otherwise("ok").alias("verdict"))


def source_counts(rows: DataFrame, platforms: DataFrame) -> DataFrame:
    """(source, n) of each platform, zero if it delivered nothing."""
    n = rows.groupBy("source").agg(F.count("*").alias("n"))
    return platforms.join(n, "source", "left").select("source", F.coalesce("n", F.lit(0)).alias("n"))


def source_health(attempts: DataFrame) -> DataFrame:
    """(source, state) from attempts (source, ok): success, partial or failed."""
    a = attempts.groupBy("source").agg(F.bool_or("ok").alias("any_ok"), F.bool_or(~F.col("ok")).alias("any_bad"))
    return a.select("source", F.when(F.col("any_ok") & F.col("any_bad"), "partial").when(F.col("any_ok"), "success").otherwise("failed").alias("state"))


def first_success(attempts: DataFrame) -> DataFrame:
    """(source, attempt, payload) of the first attempt that succeeded."""
    best = attempts.where("ok").groupBy("source").agg(F.min("attempt").alias("attempt"), F.min_by("payload", "attempt").alias("payload"))
    return best.select("source", "attempt", "payload")


def failed_families(failed: DataFrame, family: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """(label, n): a family with family_least failed sources or more is one label; others by name."""
    f = failed.select("source").distinct().join(family, "source", "left").withColumn("family", F.coalesce("family", "source"))
    g = f.groupBy("family").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("source")), ",").alias("names"))
    return g.select(F.when(F.col("n") >= rules.family_least, F.concat("family", F.lit("*"))).otherwise(F.col("names")).alias("label"), "n")


def last_collected(counts: DataFrame) -> DataFrame:
    return counts.where("n > 0").groupBy("source").agg(F.max("run_date").alias("last_date"))


def stale_blocks(blocks: DataFrame, last: DataFrame, active: DataFrame, today: Column, rules: Rules = DEFAULT) -> DataFrame:
    """blocks (source, since) with last_date, days, n_active, escalate; unknown actives count as some."""
    b = blocks.join(last, "source", "left").join(active, "source", "left")
    days = F.datediff(today, F.coalesce("last_date", "since"))
    return b.select("source", "since", "last_date", days.alias("days"), "n_active", ((days >= rules.stale_days) & (F.coalesce("n_active", F.lit(1)) != 0)).alias("escalate"))


def recovered_blocks(blocks: DataFrame, last: DataFrame, today: Column) -> DataFrame:
    return blocks.join(last, "source").where(F.col("last_date") == today).select("source", "last_date")


def health_report(failed: DataFrame, zero: DataFrame, drops: DataFrame, stale: DataFrame, recovered: DataFrame) -> DataFrame:
    """(severity, kind, detail): a row per finding, or one all-clear row if nothing warns."""
    line = lambda df, severity, kind: df.select(F.lit(severity).alias("severity"), F.lit(kind).alias("kind"), F.col("source").alias("detail"))
    warns = line(failed, "warning", "failed").unionByName(line(zero, "warning", "zero")).unionByName(line(drops, "warning", "drop")).unionByName(line(stale.where("escalate"), "warning", "stale_block"))
    info = line(recovered, "info", "recovered").unionByName(line(stale.where("not escalate").join(recovered, "source", "left_anti"), "info", "known_block"))
    holds = warns.where("kind = 'failed'").select(F.lit("info").alias("severity"), F.lit("closes_held").alias("kind"), F.lit("").alias("detail")).distinct()
    clear = warns.agg(F.count("*").alias("n")).where("n = 0").select(F.lit("info").alias("severity"), F.lit("all_clear").alias("kind"), F.lit("").alias("detail"))
    return warns.unionByName(info).unionByName(holds).unionByName(clear)
