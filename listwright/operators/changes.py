"""Snapshot change tracking: a day's batch against the master."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from listwright.config import DEFAULT, Rules
from listwright.functions.text import body_degraded, for_diff


def merge_batch(master: DataFrame, batch: DataFrame, run_ts: Column, rules: Rules = DEFAULT) -> DataFrame:
    """The next master with change_type (new, modified, unchanged, absent), guarded, old_deadline.

    One full outer join on id; batch ids are unique. A guarded body keeps the old text. A null
    deadline never overwrites. company, source, posted_at and first_seen_at never change.
    Closed rows in the batch come back as ACTIVE and count as modified.
    """
    m, b = master.alias("m"), batch.alias("b")
    j = m.join(b, F.col("m.id") == F.col("b.id"), "full_outer")
    old, new = (lambda c: F.col(f"m.{c}")), (lambda c: F.col(f"b.{c}"))
    here, known = new("id").isNotNull(), old("id").isNotNull()
    guarded = here & known & body_degraded(old("raw_html"), new("raw_html"), rules)
    j = j.withColumn("_guarded", guarded)
    body = F.when(F.col("_guarded") | ~here, old("raw_html")).otherwise(new("raw_html"))
    deadline = F.coalesce(new("deadline"), old("deadline"))
    differs = (
        (~F.col("_guarded") & F.when(old("raw_html").eqNullSafe(new("raw_html")), False).otherwise(for_diff(old("raw_html")) != for_diff(new("raw_html"))))
        | ~F.coalesce(old("title"), F.lit("")).eqNullSafe(F.coalesce(new("title"), F.lit("")))
        | (new("deadline").isNotNull() & ~new("deadline").eqNullSafe(old("deadline")))
        | (old("status") != "ACTIVE")
    )
    j = j.withColumn("change_type", F.when(~known, "new").when(~here, "absent").when(differs, "modified").otherwise("unchanged"))
    written = F.col("change_type").isin("new", "modified")
    take = lambda c: F.when(written, new(c)).otherwise(old(c)).alias(c)
    keep = lambda c: F.when(known, old(c)).otherwise(new(c)).alias(c)
    return j.select(
        F.coalesce(old("id"), new("id")).alias("id"), keep("source"), keep("company_name"), take("title"), take("origin_url"), take("location"), keep("posted_at"),
        F.when(written, "ACTIVE").otherwise(old("status")).alias("status"), F.when(written, body).otherwise(old("raw_html")).alias("raw_html"),
        F.when(known, old("first_seen_at")).otherwise(run_ts).alias("first_seen_at"), F.when(written, run_ts).otherwise(old("last_updated_at")).alias("last_updated_at"),
        F.when(here, deadline).otherwise(old("deadline")).alias("deadline"), F.when(here, F.to_date(run_ts)).otherwise(old("last_seen_date")).alias("last_seen_date"),
        "change_type", F.col("_guarded").alias("guarded"), F.when(here & known, old("deadline")).alias("old_deadline"),
    )


def change_counts(merged: DataFrame) -> DataFrame:
    return merged.groupBy("source", "change_type").agg(F.count("*").alias("n"), F.count_if("guarded").alias("guarded"))


KINDS = ("new", "modified", "unchanged", "absent")


def observe_changes(merged: DataFrame, sources: Sequence[str]) -> tuple[DataFrame, Observation]:
    """merged, and an observation that its write fills with the counts of each source and kind of change:
    the counters of a run cost no pass of their own. sources is the registry's list; rows of others, or
    of none, are counted together under a null source."""
    seen = Observation()
    own = {s: F.col("source").eqNullSafe(s) for s in sources}
    own[None] = ~F.coalesce(F.col("source").isin(*sources), F.lit(False))
    counts = []
    for i, at in enumerate(own.values()):
        for kind in KINDS:
            here = at & (F.col("change_type") == kind)
            counts += [F.count_if(here).alias(f"{i}:{kind}:n"), F.count_if(here & F.col("guarded")).alias(f"{i}:{kind}:guarded")]
    return merged.observe(seen, *counts), seen


def observed_counts(seen: Observation, sources: Sequence[str]) -> list[tuple]:
    """change_counts as rows (source, change_type, n, guarded), from an observation that a write has filled."""
    found = seen.get
    rows = [(s, kind, found[f"{i}:{kind}:n"], found[f"{i}:{kind}:guarded"]) for i, s in enumerate([*sources, None]) for kind in KINDS]
    return [r for r in rows if r[2]]


def deadline_changes(merged: DataFrame) -> DataFrame:
    """(id, old, new, verdict): only where a deadline was known and became another."""
    changed = merged.where("old_deadline is not null and deadline <> old_deadline")
    return changed.select("id", F.col("old_deadline").alias("old"), F.col("deadline").alias("new"), F.when(F.col("deadline") > F.col("old_deadline"), "extended").otherwise("shortened").alias("verdict"))


def category_upsert(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of new, and those of old whose job_id is not in new."""
    return old.join(new.select("job_id"), "job_id", "left_anti").unionByName(new)


def stamp_seen(master: DataFrame, ids: DataFrame, run_date: Column) -> DataFrame:
    seen = ids.select(F.col("id").alias("_id")).distinct()
    return master.join(seen, F.col("id") == F.col("_id"), "left").withColumn("last_seen_date", F.when(F.col("_id").isNotNull(), run_date).otherwise(F.col("last_seen_date"))).drop("_id")


def body_reuse(batch: DataFrame, stored: DataFrame, has_markers) -> DataFrame:
    """batch (id, raw_html, ..) with the stored body where only that one has markers."""
    s = stored.select(F.col("id").alias("_id"), F.col("raw_html").alias("_stored"))
    use = ~has_markers(F.col("raw_html")) & has_markers(F.col("_stored"))
    return batch.join(s, F.col("id") == F.col("_id"), "left").withColumns({"reused": use, "raw_html": F.when(use, F.col("_stored")).otherwise(F.col("raw_html"))}).drop("_id", "_stored")
