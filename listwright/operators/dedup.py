"""Duplicates within and across sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listwright.config import DEFAULT, Rules
from listwright.functions.keys import content_key, source_rank


def first_by(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in order, by an aggregate: partial results shrink hot keys."""
    rest = [c for c in rows.columns if c not in key]
    rank = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    best = rows.groupBy(*key).agg(F.min_by(F.struct(*rest), rank).alias("_best"))
    return best.select(*key, *[F.col(f"_best.{c}").alias(c) for c in rest]).select(*rows.columns)


def native_dedup(rows: DataFrame, number: str, is_search: Column, seq: str) -> DataFrame:
    """One row per native number: not from a search source if possible, then the first to arrive.
    Rows without a number all stay."""
    rows = rows.withColumn("_search", is_search.cast("int"))
    once = first_by(rows.where(F.col(number).isNotNull()), [number], [F.col("_search"), F.col(seq)])
    return once.unionByName(rows.where(F.col(number).isNull())).drop("_search")


def last_wins(rows: DataFrame, key: str, seq: str) -> DataFrame:
    """Per key the last values at the first place: columns of rows and first_seq."""
    rest = [c for c in rows.columns if c != key]
    got = rows.groupBy(key).agg(F.max_by(F.struct(*rest), seq).alias("_last"), F.min(seq).alias("first_seq"))
    return got.select(key, *[F.col(f"_last.{c}").alias(c) for c in rest], "first_seq")


def content_merge(rows: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """One row per content key: the best-ranked, first-arrived survivor, the place of the group and
    its sources (first URL of each), by rank and arrival. rows needs id, company_name, title,
    source, origin_url, ingest_seq."""
    rows = rows.withColumns({"key": content_key(F.col("company_name"), F.col("title"), rules), "rank": source_rank(F.col("source"), rules)})
    per = rows.groupBy("key", "source").agg(F.min(F.struct("rank", "ingest_seq", "source", "origin_url")).alias("s"), F.min(F.struct("rank", "ingest_seq", "id", "title")).alias("best"))
    merged = per.groupBy("key").agg(F.min("best").alias("best"), F.min("s.ingest_seq").alias("first_seq"), F.array_sort(F.collect_list("s")).alias("sources"))
    return merged.select("key", "best.id", "best.title", "first_seq", "sources")


def repost_flags(active: DataFrame, closed: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """(key, closed_on): groups first seen at least repost_gap_days after their last close.

    active (company_name, title, first_seen_at), closed (company_name, title, closed_at).
    """
    key = content_key(F.col("company_name"), F.col("title"), rules).alias("key")
    last = closed.select(key, "closed_at").groupBy("key").agg(F.max("closed_at").alias("closed_at"))
    first = active.select(key, "first_seen_at").groupBy("key").agg(F.min("first_seen_at").alias("first_seen"))
    gap = F.datediff(F.to_date("first_seen"), F.to_date("closed_at")) >= rules.repost_gap_days
    return first.join(last, "key").where((F.col("closed_at") < F.col("first_seen")) & gap).select("key", F.to_date("closed_at").alias("closed_on"))


def capped_by_keyword(hits: DataFrame, k: int, keywords: int) -> DataFrame:
    """(source, keyword, item, pos): of hits (source, keyword from 1 to keywords, pos, item) those that a
    search takes which asks one keyword after the other and stops each at k new items.

    An item that an earlier keyword has taken is passed over and doesn't count, so one beyond the cap
    of keyword 1 may still enter through keyword 2. At most k * keyword items of a keyword can matter, as the
    ones before it take k each at most; only these meet in the fold over a source, which keeps its
    memory within k * keywords**2 rows. An item counts once in a keyword, at its first place.
    """
    first = hits.groupBy("source", "keyword", "item").agg(F.min("pos").alias("pos"))
    place = F.row_number().over(Window.partitionBy("source", "keyword").orderBy("pos", "item"))
    near = first.withColumn("place", place).where(F.col("place") <= k * keywords).where(F.col("place") <= k * F.col("keyword"))
    kind = first.schema["item"].dataType.simpleString()
    hit = f"struct<keyword:int,pos:{first.schema['pos'].dataType.simpleString()},item:{kind}>"
    listed = near.groupBy("source").agg(F.array_sort(F.collect_list(F.struct(F.col("keyword").cast("int").alias("keyword"), "pos", "item"))).alias("hits"))

    def step(state: Column, h: Column) -> Column:
        n = F.when(state["keyword"] == h["keyword"], state["n"]).otherwise(0)
        takes = (n < k) & ~F.exists(state["taken"], lambda t: t["item"] == h["item"])
        return F.struct(F.when(takes, F.concat(state["taken"], F.array(h))).otherwise(state["taken"]).alias("taken"), h["keyword"].alias("keyword"), (n + takes.cast("int")).alias("n"))

    start = F.struct(F.array().cast(f"array<{hit}>").alias("taken"), F.lit(0).alias("keyword"), F.lit(0).alias("n"))
    taken = listed.select("source", F.explode(F.aggregate("hits", start, step, lambda s: s["taken"])).alias("t"))
    return taken.select("source", "t.keyword", "t.item", "t.pos")


def top_per_group(rows: DataFrame, group: str, order: Column, k: int) -> DataFrame:
    """At most k rows of each group. Spark limits each group inside the tasks before the shuffle."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(order))).where(F.col("place") <= k)
