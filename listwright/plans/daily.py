"""One day of the engine as a chain of DataFrames, from the landed batch to the next master."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listwright.config import DEFAULT, Rules
from listwright.functions.text import has_body
from listwright.operators import changes, closing, dedup
from listwright.sources.snapshots import keep

from .classify import classify


@dataclass(frozen=True)
class Day:
    """Results of a run: merged has the kind of each change, master is the next version."""

    merged: DataFrame
    categories: DataFrame
    decisions: DataFrame
    master: DataFrame
    health: DataFrame

    def report(self) -> DataFrame:
        """(step, source, kind, n) over all results."""
        count = lambda df, step, kind: df.groupBy("source", F.col(kind).alias("kind")).agg(F.count("*").alias("n")).select(F.lit(step).alias("step"), "source", "kind", "n")
        named = self.categories.join(self.merged.select(F.col("id").alias("job_id"), "source"), "job_id")
        parts = [count(self.merged, "change", "change_type"), count(self.decisions, "close", "decision"), count(self.health, "health", "state"), count(self.master.where("status = 'ACTIVE'"), "active", "status"), count(named, "category", "primary_category")]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out


def run_day(master: DataFrame, batch: DataFrame, health: DataFrame, runs: DataFrame, run_ts: Column, number: str, is_search: Column, seq: str, rules: Rules = DEFAULT) -> Day:
    """Dedup by native number, merge, classify new and modified rows, detect and apply closes.

    The merge and the decisions are read by several results and are written once, so that no
    result joins the master again.

    batch needs the posting columns, number, seq and what is_search reads; health (source, state)
    and runs (source, run_date, n, is_success) are of the sources."""
    batch = dedup.native_dedup(batch, number, is_search, seq)
    merged = keep(changes.merge_batch(master, batch, run_ts, rules), "merged")
    written = merged.where(F.col("change_type").isin("new", "modified"))
    categories = classify(written.select("id", "company_name", "title", "raw_html"), rules)
    seen = merged.where("change_type <> 'absent'").select("id", "source")  # the batch; a listing's source never changes
    counts = seen.groupBy("source").agg(F.count("*").alias("n"))
    columns = [c for c in merged.columns if c not in ("change_type", "guarded", "old_deadline")]
    after = merged.select(*columns)
    decisions = closing.close_decisions(after.where("status = 'ACTIVE'"), seen, health, runs, counts, F.to_date(run_ts), rules)
    decisions = keep(decisions, "decisions")
    return Day(merged, categories, decisions, closing.apply_decisions(after, decisions, run_ts), health)


def mart_rows(rows: DataFrame, run_date: Column) -> DataFrame:
    """rows (id, source, title, raw, posted_at, key_requirements JSON, min_experience) with shown, the
    escaped title, and doc, a JSON object safe inside a script element.

    A list that is missing or no JSON is empty; min_experience is 0 if unknown."""
    listed = F.coalesce(F.from_json("key_requirements", "array<string>"), F.array().cast("array<string>"))
    flags = [(F.col("posted_at") == run_date).alias("is_new"), has_body(F.col("title"), F.length("raw")).alias("has_body")]
    row = F.to_json(F.struct("id", "source", F.coalesce("min_experience", F.lit(0)).alias("min_experience"), listed.alias("key_requirements"), *flags))
    shown = F.replace(F.replace("title", F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return rows.withColumns({"shown": shown, "doc": F.replace(row, F.lit("</"), F.lit("<\\/"))})
