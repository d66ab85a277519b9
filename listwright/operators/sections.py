"""Sections and bullets of listing bodies, line by line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listwright.config import DEFAULT, Rules
from listwright.functions.text import has_any, let, matches, strip


def lines_of(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(key, pos, line): only these columns are multiplied."""
    return rows.select(key, F.posexplode(F.split(text, "\n")).alias("pos", "line"))


def _header(line: Column, rules: Rules) -> Column:
    """The section that a header line opens; null for other lines."""
    return F.when(has_any(line, rules.section_requirements), "req").when(has_any(line, rules.section_preferences), "pref").when(has_any(line, rules.section_other), "none")


def _bullet(line: Column, rules: Rules) -> Column:
    """The text of a bullet with 6 to 99 characters and no contact data; null for other lines."""
    text = strip(F.regexp_replace(line, r"(?U)^[-*•\s\d.]+", ""))
    good = lambda t: F.when((F.length(t) > 5) & (F.length(t) < 100) & ~matches(t, rules.contact), t)
    return F.when(line.rlike(r"^([-*•]|[1-5]\.)"), let(text, good))


def section_lines(lines: DataFrame, key: str, rules: Rules = DEFAULT) -> DataFrame:
    """(key, pos, line, section) of lines that are no headers; section is req, pref or none."""
    line = strip(F.col("line"))
    so_far = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = lines.withColumns({"line": line, "header": _header(line, rules)})
    return rows.withColumn("section", F.coalesce(F.last("header", ignorenulls=True).over(so_far), F.lit("none"))).where("header is null").select(key, "pos", "line", "section")


def bullets(sectioned: DataFrame, key: str, rules: Rules = DEFAULT) -> DataFrame:
    """(key, section, bullets) of lines that section_lines has sectioned, where they are rows already."""
    b = sectioned.where(F.col("section").isin("req", "pref")).withColumn("line", _bullet(F.col("line"), rules)).where("line is not null")
    b = b.withColumn("n", F.row_number().over(Window.partitionBy(key, "section").orderBy("pos"))).where(F.col("n") <= rules.bullets_each)
    return b.groupBy(key, "section").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]).alias("bullets"))


def bullets_of(lines: Column, rules: Rules = DEFAULT) -> Column:
    """struct(req, pref) of an array of lines: the first bullets_each bullets of either section, in order.

    One pass over the array with the open section as state, so that a body stays in its row: nothing
    is exploded, sorted or shuffled. A null array has no bullets.
    """
    read = F.transform(lines, lambda x: let(strip(x), lambda line: F.struct(_header(line, rules).alias("header"), _bullet(line, rules).alias("bullet"))))
    none = F.array().cast("array<string>")
    start = F.struct(F.lit("none").alias("section"), none.alias("req"), none.alias("pref"))

    def step(state: Column, line: Column) -> Column:
        fits = lambda name: line["header"].isNull() & line["bullet"].isNotNull() & (state["section"] == name) & (F.size(state[name]) < rules.bullets_each)
        taken = lambda name: F.when(fits(name), F.concat(state[name], F.array(line["bullet"]))).otherwise(state[name]).alias(name)
        return F.struct(F.coalesce(line["header"], state["section"]).alias("section"), taken("req"), taken("pref"))

    return F.aggregate(F.coalesce(read, F.array().cast("array<struct<header:string,bullet:string>>")), start, step, lambda s: F.struct(s["req"].alias("req"), s["pref"].alias("pref")))
