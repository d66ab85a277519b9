"""Stored category rows: rebuilt from stored bodies where rules or bodies have changed, and nowhere else."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listwright.config import DEFAULT, Rules
from listwright.schema import STORED_CATEGORY
from listwright.sources.snapshots import exists, keep, overwrite_parts

from .classify import classify


def fingerprint(rules: Rules) -> str:
    """Equal for equal rules, whatever the session."""
    return hashlib.md5(repr(rules).encode()).hexdigest()


def stored_categories(spark: SparkSession, path: str) -> DataFrame:
    """Category rows at path, with source, rules_md5 and as_of; none if nothing is stored."""
    return spark.read.schema(STORED_CATEGORY).parquet(path) if exists(spark, path) else spark.createDataFrame([], STORED_CATEGORY)


def stale_rows(master: DataFrame, stored: DataFrame, rules_of: Mapping[str, Rules], otherwise: Rules = DEFAULT) -> DataFrame:
    """(id, source, why) of master (id, source, last_updated_at): missing, rules or body.

    rules_of has the rules of sources that differ from otherwise. Bodies are not read."""
    now = F.lit(fingerprint(otherwise))
    for source, rules in rules_of.items():
        now = F.when(F.col("m.source") == source, fingerprint(rules)).otherwise(now)
    m, s = master.select("id", "source", "last_updated_at").alias("m"), stored.select("job_id", "rules_md5", "as_of").alias("s")
    why = F.when(F.col("job_id").isNull(), "missing").when(F.col("rules_md5") != now, "rules").when(F.col("as_of") < F.col("last_updated_at"), "body")
    return m.join(s, F.col("m.id").cast("string") == F.col("s.job_id"), "left").select("m.id", "m.source", why.alias("why")).where("why is not null")


def rebuild_stale(spark: SparkSession, master: DataFrame, path: str, rules_of: Mapping[str, Rules] | None = None, otherwise: Rules = DEFAULT) -> DataFrame:
    """Classify the stale rows of master (id unique, source, company_name, title, raw_html, last_updated_at)
    and write them; (source, why, n) of what was stale.

    Category rows are partitioned by source. Only sources with stale rows are written, and in them
    rows that are not stale are copied, not classified. The driver gets the names of these sources. A null
    source is one of its own."""
    rules_of = dict(rules_of or {})
    stored = stored_categories(spark, path)
    stale = keep(stale_rows(master, stored, rules_of, otherwise), "stale")
    touched = [r.source for r in stale.select("source").distinct().collect()]
    if not touched:
        return stale.groupBy("source", "why").agg(F.count("*").alias("n"))
    ids = stale.select("id")
    rows = master.join(ids, "id", "left_semi")
    here = lambda names: F.coalesce(F.col("source").isin([n for n in names if n is not None]), F.lit(False)) | (F.col("source").isNull() if None in names else F.lit(False))
    new = None
    for rules in dict.fromkeys([*rules_of.values(), otherwise]):
        names = [s for s in touched if rules_of.get(s, otherwise) == rules]
        if names:
            part = rows.where(here(names))
            made = classify(part.select("id", "company_name", "title", "raw_html"), rules).withColumn("rules_md5", F.lit(fingerprint(rules)))
            made = made.join(part.select(F.col("id").alias("job_id"), "source", F.col("last_updated_at").alias("as_of")), "job_id")
            made = made.select(*[F.col(f.name).cast(f.dataType) for f in stored.schema])
            new = made if new is None else new.unionByName(made)
    fresh = stored.where(here(touched)).join(ids, F.col("job_id") == F.col("id").cast("string"), "left_anti")
    overwrite_parts(new.unionByName(fresh), path, "source")
    return stale.groupBy("source", "why").agg(F.count("*").alias("n"))

