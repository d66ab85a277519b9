"""Lookups against dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listwright.config import DEFAULT, Rules
from listwright.functions.keys import preset_key

GRAM = 3


def _grams(text: str, size: int) -> Column:
    """The substrings of one size; empty for shorter texts."""
    n = F.length(text) - size + 1
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(F.col(text), i, F.lit(size)))).otherwise(F.array().cast("array<string>"))


def contained_pairs(needles: DataFrame, haystacks: DataFrame, gram: int = GRAM) -> DataFrame:
    """(needle, haystack): each pair where the haystack contains the needle.

    needles (needle) and haystacks (haystack) are distinct and not empty. The index has the haystacks under each of
    their substrings of up to gram characters; a needle is looked up under one only, the one of its
    own that the fewest haystacks have (a needle shorter than gram: under itself). What is met is
    compared in full. All joins are on grams, so nothing is compared with everything.
    """
    sizes = F.flatten(F.array(*[_grams("haystack", n) for n in range(1, gram + 1)]))
    index = haystacks.select("haystack", F.explode(F.array_distinct(sizes)).alias("gram"))
    often = index.groupBy("gram").agg(F.count("*").alias("n"))
    own = F.when(F.length("needle") < gram, F.array("needle")).otherwise(F.array_distinct(_grams("needle", gram)))
    asked = needles.select("needle", F.explode(own).alias("gram")).join(often, "gram", "left")
    rarest = asked.groupBy("needle").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("best")).where("best.n > 0")
    return rarest.select("needle", F.col("best.gram").alias("gram")).join(index, "gram").where(F.contains("haystack", "needle")).select("needle", "haystack")


def tiered_lookup(names: DataFrame, presets: DataFrame, fallbacks: DataFrame | None = None, rules: Rules = DEFAULT) -> DataFrame:
    """(name, preset, tier): exact, then normalised, then containment either way in order, then keyword.

    names (name), presets (ord, preset), fallbacks (ord, keyword, preset). Only distinct names and keys are
    compared; containment goes through an index of grams, whatever the number of presets. An empty
    normalised name matches nothing. Names without a match are left out.
    """
    n = names.where("name is not null").select("name").distinct().withColumn("key", preset_key(F.col("name"), rules))
    p = presets.withColumn("pkey", preset_key(F.col("preset"), rules))
    hit = lambda rows, tier: rows.select("name", F.struct(F.lit(tier).alias("tier"), "ord", "preset").alias("hit"))
    keyed, named = n.where("key <> ''"), p.where("pkey <> ''")
    keys, pkeys = keyed.select("key").distinct(), named.select("pkey").distinct()
    within = contained_pairs(pkeys.select(F.col("pkey").alias("needle")), keys.select(F.col("key").alias("haystack"))).select(F.col("needle").alias("pkey"), F.col("haystack").alias("key"))
    around = contained_pairs(keys.select(F.col("key").alias("needle")), pkeys.select(F.col("pkey").alias("haystack"))).select(F.col("haystack").alias("pkey"), F.col("needle").alias("key"))
    either = within.unionByName(around).distinct()
    hits = hit(n.join(p, F.col("name") == F.col("preset")), 1).unionByName(hit(keyed.join(named, F.col("key") == F.col("pkey")), 2))
    hits = hits.unionByName(hit(keyed.join(either, "key").join(named, "pkey"), 3))
    if fallbacks is not None:
        low = keyed.select("name", F.lower("key").alias("haystack"))
        met = contained_pairs(fallbacks.where("keyword <> ''").select(F.col("keyword").alias("needle")).distinct(), low.select("haystack").distinct())
        hits = hits.unionByName(hit(low.join(met, "haystack").join(fallbacks, F.col("needle") == F.col("keyword")), 4))
    return hits.groupBy("name").agg(F.min("hit").alias("hit")).select("name", "hit.preset", "hit.tier")


def new_entities(rows: DataFrame, key: str, seen_at: str, cutoff: Column) -> DataFrame:
    """Distinct keys of rows on or after the cutoff that no row before it has."""
    before = rows.where(F.col(seen_at) < cutoff).select(key)
    return rows.where(F.col(seen_at) >= cutoff).select(key).distinct().join(before, key, "left_anti")


def known_block_split(sources: DataFrame, blocks: DataFrame) -> DataFrame:
    """sources (source) with known and summary; blocks (source, summary)."""
    b = blocks.select(F.lower("source").alias("_source"), "summary")
    return sources.select("source").distinct().join(b, F.lower("source") == F.col("_source"), "left").select("source", F.col("_source").isNotNull().alias("known"), "summary")
