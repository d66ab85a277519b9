"""Guarded close detection: one decision with a named reason per active listing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listwright.config import DEFAULT, Rules
from listwright.functions.arrays import count_between


def fair_miss_days(pairs: DataFrame, runs: DataFrame, today: Column) -> DataFrame:
    """pairs (source, last_seen) distinct, with fair_days: days strictly between last_seen and
    today on which the source's run delivered rows. runs: (source, run_date, n, is_success)."""
    days = runs.where("is_success and n > 0").select(F.lower("source").alias("_source"), "run_date").distinct()
    between = (F.lower("source") == F.col("_source")) & (F.col("run_date") > F.col("last_seen")) & (F.col("run_date") < today)
    return pairs.distinct().join(days, between, "left").groupBy("source", "last_seen").agg(F.count("run_date").alias("fair_days"))


def fair_days(runs: DataFrame) -> DataFrame:
    """(source lower-cased, days): one row per source with the ascending days on which its run
    delivered rows. It is as large as the calendar of runs, whatever the listings."""
    days = runs.where("is_success and n > 0").select(F.lower("source").alias("source"), "run_date").distinct()
    return days.groupBy("source").agg(F.array_sort(F.collect_list("run_date")).alias("days"))


def asof_fair_days(pairs: DataFrame, runs: DataFrame, today: Column) -> DataFrame:
    """fair_miss_days by a search in each source's sorted days: the join gives one row for each pair,
    not one for each pair and day."""
    days = fair_days(runs).withColumnRenamed("source", "_source")
    found = pairs.distinct().join(days, F.lower("source") == F.col("_source"), "left")
    return found.select("source", "last_seen", count_between(F.col("days"), F.col("last_seen"), today).cast("long").alias("fair_days"))


def mass_close_sources(active: DataFrame, today_counts: DataFrame, trusted: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """(source, n_active, zeroed, hold): trusted sources that delivered nothing today.

    Held with zeroed_least_active active rows or more, or all of them if zeroed_most_sources are zeroed.
    """
    own = active.groupBy("source").agg(F.count("*").alias("n_active"))
    seen = today_counts.where("n > 0").select("source").distinct()
    z = own.join(trusted.select("source").distinct(), "source", "left_semi").join(seen, "source", "left_anti")
    total = z.agg(F.count("*").alias("zeroed"))
    return z.crossJoin(F.broadcast(total)).withColumn("hold", (F.col("n_active") >= rules.zeroed_least_active) | (F.col("zeroed") >= rules.zeroed_most_sources))


def close_decisions(active: DataFrame, batch_ids: DataFrame, health: DataFrame, runs: DataFrame, today_counts: DataFrame, today: Column, rules: Rules = DEFAULT) -> DataFrame:
    """active (id, source, company_name, title, last_seen_date) with decision.

    health: (source, state) with state success, partial or failed; a source that is missing or
    failed is not trusted, a partial one is suspect. Decisions, first guard wins: seen,
    too_few_seen, source_failed, source_suspect, mass_close, restamp, same_day, grace, CLOSED.
    """
    trusted = health.where("state <> 'failed'").select("source")
    held = mass_close_sources(active, today_counts, trusted, rules).where("hold").select("source", F.lit(True).alias("held"))
    seen = batch_ids.select("id").distinct()
    few = seen.agg((F.count("*") < rules.close_least_seen).alias("few"))
    a = active.join(seen.withColumn("seen", F.lit(True)), "id", "left").crossJoin(F.broadcast(few))
    a = a.join(health.select("source", "state"), "source", "left").join(held, "source", "left")
    a = a.withColumn("last_seen", F.try_to_date(F.col("last_seen_date").cast("string"), "yyyy-MM-dd"))
    days = fair_days(runs).withColumnRenamed("source", "_source")
    a = a.join(days, F.lower("source") == F.col("_source"), "left").withColumn("fair_days", count_between(F.col("days"), F.col("last_seen"), today))
    decision = (
        F.when(F.col("seen"), "seen")
        .when(F.col("few"), "too_few_seen")
        .when(F.coalesce(F.col("state"), F.lit("failed")) == "failed", "source_failed")
        .when(F.col("state") == "partial", "source_suspect")
        .when(F.coalesce(F.col("held"), F.lit(False)), "mass_close")
        .when(F.col("last_seen").isNull() | (F.col("last_seen") > today), "restamp")
        .when(F.col("last_seen") == today, "same_day")
        .when(F.col("fair_days") < rules.close_grace_days - 1, "grace")
        .otherwise("CLOSED")
    )
    return a.select("id", "source", "company_name", "title", "last_seen_date", decision.alias("decision"))


def apply_decisions(master: DataFrame, decisions: DataFrame, run_ts: Column) -> DataFrame:
    """The master after close detection: CLOSED rows get the status and run_ts as last_updated_at;
    rows whose last_seen_date could not be used are stamped with the run's date. Others stay as they are.

    decisions (id, decision) has one row per active listing; listings without one stay."""
    d = decisions.select(F.col("id").alias("_id"), "decision")
    closed, restamp = F.col("decision").eqNullSafe("CLOSED"), F.col("decision").eqNullSafe("restamp")
    rows = master.join(d, F.col("id") == F.col("_id"), "left")
    return rows.withColumns({
        "status": F.when(closed, "CLOSED").otherwise(F.col("status")),
        "last_updated_at": F.when(closed, run_ts).otherwise(F.col("last_updated_at")),
        "last_seen_date": F.when(restamp, F.to_date(run_ts)).otherwise(F.col("last_seen_date")),
    }).select(*master.columns)
