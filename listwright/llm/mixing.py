"""Mixing sources to target weights by Efraimidis-Spirakis sampling; DataFrame functions only.

Each document draws an exponential key, -ln(u) / quality weight, with u from a hash of its id.
Whole epochs of a source come first; what is left of its target goes to the documents with the
smallest keys. Prefix sums have levels: sums by (source, key bin), then by finer bins inside the one
in which the target falls, until it is small, and by document there. A source of any size is thus
never in one window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import clash_free, keep

BINS = 4096
CUT_ROWS = 20_000  # of the bin that is divided by document; larger ones are split into BINS again
KEY_LEVELS, LEVELS = 4, 9  # of 12 bits each: of the key, then of a hash of the text
WORDS = r"[^\x20\x09-\x0D]+"
_U = 1 << 48


def words_in(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: list[float], share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    Sources in code-point order, null last, take weights in turn and divide share times all
    sizes in proportion; a target stops at most times its source's size and the excess goes to
    the others by weight. The fixed point is direct: with sources ordered by cap / weight, those
    before the first whose part fits under its cap are full. One row per source is windowed.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    t = total.withColumn("w", weight).withColumn("cap", F.col("source_size") * float(most))
    fill = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before, after = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    everything = fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) * float(share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after)
    t = t.withColumn("level", level)
    first_fit = F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct(F.col("cap") / F.col("w"), "level"))).over(everything)
    t = t.withColumn("fit", first_fit["level"])
    target = F.least(F.col("cap"), F.coalesce(F.col("fit") * F.col("w"), F.col("cap")))
    return t.select("source", "source_size", target.alias("target"))


def sampling_key(doc_id: Column, text: Column, weight: Column, seed: str = "mix") -> Column:
    """The key -ln(u) / weight; u, in (0, 1), is from a hash of doc_id, or of the text where it is null."""
    named = F.coalesce(doc_id.cast("string"), F.concat(F.lit("#"), F.md5(F.coalesce(text, F.lit("")))))
    u = (F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), named)), 1, 12), 16, 10).cast("double") + 0.5) / float(_U)
    return -F.log(u) / weight


def _bin(level: int) -> Column:
    """The key's bin at a level, 1 to LEVELS, as a struct that sorts as the keys do."""
    place = F.floor(F.least((F.lit(1.0) - F.exp(-F.col("_key"))) * float(_U), F.lit(float(_U - 1)))).cast("long")
    high = F.shiftright(place, 12 * max(0, KEY_LEVELS - level))
    low = F.shiftrightunsigned(F.xxhash64("text"), 64 - 12 * (level - KEY_LEVELS)) if level > KEY_LEVELS else F.lit(0).cast("long")
    return F.struct(high.alias("high"), low.alias("low"))


def _cuts(keyed: DataFrame, weights: list[float], share: float, most: float) -> tuple[DataFrame, int]:
    """One row per source with the bin in which what is left of its target runs out, the words
    before it, and the level of the bins."""
    upto = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    sums = keep(keyed.groupBy("source", _bin(1).alias("bin")).agg(F.sum("size").alias("size"), F.count("*").alias("n")), "mix-sums")
    targets = source_targets(sums, weights, share, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = targets.withColumn("_epochs", epochs).withColumn("_left", F.floor("target").cast("long") - F.col("_epochs") * F.col("source_size")).withColumn("_before", F.lit(0).cast("long"))
    level = 1
    while True:
        bins = sums.withColumn("_sum", F.coalesce(F.sum("size").over(upto), F.lit(0))).withColumnRenamed("source", "_s")
        here = F.col("_before") + F.col("_sum")
        hit = F.min(F.when(here + F.col("size") > F.col("_left"), F.struct("bin", here.alias("before"), "n")))
        new = plan.join(bins, F.col("_s").eqNullSafe(F.col("source"))).groupBy("_s").agg(hit.alias("_hit"))
        old = plan.drop("_s", "_cut", "_n")
        plan = old.withColumn("_was", F.col("_before")).drop("_before").join(new, F.col("source").eqNullSafe(F.col("_s")), "left")
        plan = keep(plan.select("source", "source_size", "target", "_epochs", "_left", F.coalesce("_hit.before", "_was").alias("_before"), F.col("_hit.bin").alias("_cut"), F.coalesce("_hit.n", F.lit(0)).alias("_n")), "mix-plan")
        if level == LEVELS or not (plan.agg(F.max("_n")).first()[0] or 0) > CUT_ROWS:
            return plan, level
        cut = plan.select(F.col("source").alias("_s"), "_cut")
        inside = keyed.join(cut, F.col("source").eqNullSafe(F.col("_s")) & (_bin(level) == F.col("_cut")))
        level += 1
        sums = keep(inside.groupBy("source", _bin(level).alias("bin")).agg(F.sum("size").alias("size"), F.count("*").alias("n")), "mix-sums")


@clash_free("_key", "_bin", "_s", "_cut", "_n", "_left", "_before", "_epochs", "_prior")
def mix_sources(documents: DataFrame, weights: list[float], share: float = 1.5, most: float = 2.0, quality: Column | None = None, seed: str = "mix") -> DataFrame:
    """documents with size, source_size, target and taken (words the mix takes, repeats counted).

    documents needs doc_id, text and source; a clashing size, source_size, target or taken
    column is replaced. taken: whole epochs of the source, then, by ascending key (ties by
    doc_id, then text), as many words as the target still has; the last document is taken in part,
    so the words of a source are its target rounded down. Null or empty texts have size 0 and
    take 0; null sources are one source. Repeated rows are taken on their own; more than CUT_ROWS
    rows with one id and text, if the target falls among them, are sorted in one task. Reruns agree.
    quality: weight of a document, over 0; null counts as 1.
    """
    extra = ["size", "source_size", "target", "taken"]
    weight = F.coalesce(quality if quality is not None else F.lit(1.0), F.lit(1.0))
    rows = documents.withColumn("_key", sampling_key(F.col("doc_id"), F.col("text"), weight, seed)).drop(*extra)
    size = words_in(F.col("text"))
    plan, level = _cuts(rows.select("source", "_key", "text", size.alias("size")), weights, share, most)
    placed = rows.join(plan.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).withColumn("size", size).withColumn("_bin", _bin(level))
    inside = F.col("_bin").eqNullSafe(F.col("_cut"))
    before = F.col("_cut").isNull() | (F.col("_bin") < F.col("_cut"))
    whole = placed.where(~inside).withColumn("taken", F.col("size") * (F.col("_epochs") + before.cast("long")))
    upto = Window.partitionBy("_s").orderBy("_key", "doc_id", F.xxhash64("text")).rowsBetween(Window.unboundedPreceding, -1)
    part = placed.where(inside).withColumn("_prior", F.col("_before") + F.coalesce(F.sum("size").over(upto), F.lit(0)))
    part = part.withColumn("taken", F.col("_epochs") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), F.col("_left") - F.col("_prior"))))
    names = [c for c in documents.columns if c not in extra] + extra
    return whole.select(*names).unionByName(part.select(*names))
