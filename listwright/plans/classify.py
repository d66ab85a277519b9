"""The full row classifier and the faceted search over its results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listwright.config import DEFAULT, Rules
from listwright.functions import text as X
from listwright.operators import lookups, sections


def classify(postings: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """Category rows of postings (id unique, company_name, title, raw_html), one per id."""
    spark = postings.sparkSession
    # Texts that several rules search are columns first: lower case is made once, of the head only where a tail is cut.
    rows = postings.withColumns({"_both": F.concat_ws("\n", "title", "raw_html"), "_cut": X.earliest(F.col("raw_html"), rules.tail_markers)})
    rows = rows.withColumn("_low", F.lower("_both"))
    head = F.lower(F.concat_ws("\n", "title", F.substring(F.col("raw_html"), F.lit(1), F.col("_cut") - 1)))
    rows = rows.withColumn("_head", F.when(F.col("_cut").isNull(), F.col("_low")).otherwise(head))
    opened = X.has_any(F.col("raw_html"), [*rules.section_requirements, *rules.section_preferences])  # else no line is in a section
    rows = X.with_experience(rows, F.col("_both"), F.col("title"), rules, "_y").withColumn("_b", sections.bullets_of(F.when(opened, F.split("raw_html", "\n")), rules)).select(
        "_b", F.col("id").alias("job_id"), "company_name", "title", X.category(F.col("title"), rules).alias("primary_category"), "_y", X.salary(F.col("_both")).alias("_s"), X.first_rule(F.col("_low"), rules.work_types, rules.work_type_unknown).alias("work_type"),
        X.tools_in(F.col("_low"), rules.tools).alias("tools_used"), X.tags_in(F.col("_head"), rules.certificates).alias("preferred_certifications"), X.tags_in(F.col("_head"), rules.skills).alias("preferred_skills_tags"),
    )
    presets = spark.createDataFrame([(i, *p) for i, p in enumerate(rules.presets)], "ord long, preset string, revenue int, size int")
    fallbacks = spark.createDataFrame([(i, *f) for i, f in enumerate(rules.preset_fallbacks)], "ord long, keyword string, preset string")
    meta = lookups.tiered_lookup(postings.select(F.col("company_name").alias("name")), presets.select("ord", "preset"), fallbacks, rules).join(F.broadcast(presets.drop("ord")), "preset")
    rows = rows.join(meta, F.col("company_name") == F.col("name"), "left")
    return rows.select(
        "job_id", "primary_category", F.col("_y.min_years").alias("min_experience"), F.col("_y.max_years").alias("max_experience"), "_s.salary_min", "_s.salary_max", "work_type", F.col("revenue").alias("company_revenue"), F.col("size").alias("company_size"),
        F.col("_b.req").alias("key_requirements"), F.col("_b.pref").alias("preferred_skills"), "tools_used",
        X.summary(F.col("company_name"), F.col("primary_category"), F.col("title"), F.col("work_type"), F.col("_y.min_years"), F.col("_y.max_years"), F.col("tools_used")).alias("ai_summary"), "preferred_certifications", "preferred_skills_tags",
    )


def faceted(rows: DataFrame, text: str | None = None, categories: tuple[str, ...] = (), low: int | None = None, high: int | None = None) -> DataFrame:
    """rows (text, category, min_experience, max_experience) under optional filters; years overlap [low, high]."""
    if text:
        rows = rows.where(F.col("text").contains(text))
    if categories:
        rows = rows.where(F.col("category").isin(*categories))
    if high is not None:
        rows = rows.where(F.col("min_experience") <= high)
    if low is not None:
        rows = rows.where(F.col("max_experience").isNull() | (F.col("max_experience") >= low))
    return rows
