"""Benchmark decontamination by winnowing; DataFrame and SQL functions only.

The smallest hash of the K-grams in each sliding window of WINDOW - K + 1 of them is a
fingerprint, so a span of WINDOW shared words always shares one. Training fingerprints meet
the benchmark's in a join; texts with a common one are extended to exact windows of words.
Work is done on distinct texts, so groups of exact copies are searched once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import keep

WINDOW, K = 10, 5
#: Letters and digits of ASCII and everything beyond it; a plain class is several times faster than the negated one.
ANY_CASE = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def any_case_words(text: Column) -> Column:
    """The words with their case as it is; null has none."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(ANY_CASE), F.lit(0)), F.array().cast("array<string>"))


def folded_words(text: Column) -> Column:
    """The words after A-Z became a-z."""
    return any_case_words(F.translate(text, UPPER, LOWER))


def _hashes(words: str) -> Column:
    """A hash per word. lower() on single words maps equal folded words to equal values."""
    return F.transform(F.col(words), lambda w: F.xxhash64(F.lower(w)))


def _gram(values: str, k: int) -> Column:
    """Hashes of k consecutive values, an empty array where there are fewer."""
    n = F.size(values)
    places = F.when(n >= k, F.sequence(F.lit(1), n - (k - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(F.lit(k), *[F.element_at(F.col(values), i + j) for j in range(k)]))


def _least(values: str, step: int, to: str) -> Column:
    """(..) of the smaller of each two values, one from values and one step further in to."""
    n = F.greatest(F.least(F.size(values), F.size(to) - step), F.lit(0))
    return F.zip_with(F.slice(values, 1, n), F.slice(to, step + 1, n), lambda x, y: F.least(x, y))


def _fingerprints(rows: DataFrame, words: str, short: list[int]) -> DataFrame:
    """rows with column fp, one row per fingerprint of the array column words.

    Windows of WINDOW - K + 1 = 6 grams are winnowed, by minima of 2, 4 and then 6; each length in
    short, below WINDOW, adds its grams.
    """
    names = [c for c in rows.columns if c != words]
    rows = rows.select(*names, _hashes(words).alias("_h")).select(*names, "_h", _gram("_h", K).alias("_g"))
    rows = rows.withColumn("_2", _least("_g", 1, "_g"))
    rows = rows.withColumn("_4", _least("_2", 2, "_2"))
    fp = F.array_distinct(_least("_4", 4, "_2"))
    for k in short:
        fp = F.concat(fp, F.array_distinct(_gram("_h", k)))
    return rows.select(*names, F.explode(fp).alias("fp"))


def _windows(words: Column, n: int) -> Column:
    """(place, window) of every n consecutive words, joined by a space; place counts from 1."""
    size = F.size(words)
    places = F.when(size >= n, F.sequence(F.lit(1), size - (n - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.struct(i.alias("place"), F.lit(n).alias("n"), F.array_join(F.slice(words, i, n), " ").alias("window")))


def _item_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, n, window): every WINDOW words of an item, or all its words if it has fewer."""
    items = benchmark.select("item_id", folded_words(F.col("text")).alias("words")).where(F.size("words") > 0)
    whole = F.array(F.struct(F.lit(1).alias("place"), F.size("words").alias("n"), F.array_join("words", " ").alias("window")))
    windows = items.select("item_id", F.explode(F.when(F.size("words") >= WINDOW, _windows(F.col("words"), WINDOW)).otherwise(whole)).alias("w"))
    return keep(windows.select("item_id", "w.n", "w.window").distinct(), "item-windows")


def _hits(documents: DataFrame, windows: DataFrame) -> DataFrame:
    """(text_key, place, n, kind) of each window of an item in a distinct text; text_key is md5.

    Windows of the same items are of one kind, so a window that very many items share is one row
    here and not a row for each item.
    """
    short = sorted(r.n for r in windows.select("n").where(f"n < {WINDOW}").distinct().collect())  # at most WINDOW - 1 numbers
    grams = windows.select(F.split("window", " ").alias("words")).distinct()
    listed = keep(_fingerprints(grams, "words", short).distinct(), "item-fingerprints")
    base = documents.select(F.md5("text").alias("text_key"), any_case_words(F.col("text")).alias("words"))
    met = keep(_fingerprints(base, "words", short).join(listed, "fp", "left_semi").select("text_key").distinct(), "met-texts")
    texts = documents.select(F.md5("text").alias("text_key"), "text").join(met, "text_key", "left_semi").dropDuplicates(["text_key"])
    spans = texts.select("text_key", folded_words(F.col("text")).alias("words"))
    spans = spans.select("text_key", F.explode(F.flatten(F.array(*[_windows(F.col("words"), n) for n in [*short, WINDOW]]))).alias("w")).select("text_key", "w.place", "w.n", "w.window")
    one, two = F.bit_xor(F.xxhash64("item_id")), F.bit_xor(F.xxhash64(F.lit(2), "item_id"))
    known = keep(windows.groupBy("n", "window").agg(F.md5(F.concat_ws(" ", F.count("*"), one, two)).alias("kind")), "windows")
    return keep(spans.join(known, ["n", "window"]).select("text_key", "place", "n", "kind", "window"), "hits")


def contaminated_texts(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(text_key, n_hit, n_items, items_sha256) of the distinct texts with a hit."""
    windows = _item_windows(benchmark)
    hits = _hits(documents, windows)
    merged = F.aggregate(
        F.array_sort(F.collect_list(F.struct("place", (F.col("place") + F.col("n") - 1).alias("end")))),
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("hit")),
        lambda s, x: F.struct(F.greatest(s["end"], x["end"]).alias("end"), (s["hit"] + F.greatest(F.lit(0), x["end"] - F.greatest(s["end"], x["place"] - 1))).cast("long").alias("hit")),
        lambda s: s["hit"],
    )
    covered = hits.groupBy("text_key").agg(merged.alias("n_hit"), F.array_sort(F.collect_set("kind")).alias("kinds"))
    covered = keep(covered.withColumn("items", F.md5(F.array_join("kinds", " "))), "covered")
    # Items are named once for each set of kinds, not for each text.
    members = hits.groupBy("kind").agg(F.min(F.struct("n", "window")).alias("w")).select("kind", "w.n", "w.window").join(windows, ["n", "window"]).select("kind", F.col("item_id").cast("string").alias("item"))
    named = covered.dropDuplicates(["items"]).select("items", F.explode("kinds").alias("kind")).join(members, "kind").select("items", "item").distinct()
    named = named.groupBy("items").agg(F.count("*").alias("n_items"), F.sha2(F.array_join(F.array_sort(F.collect_list("item")), ","), 256).alias("items_sha256"))
    return keep(covered.join(named, "items").select("text_key", "n_hit", "n_items", "items_sha256"), "contaminated")


def find_contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, text_key.

    documents needs doc_id and text, benchmark item_id and text; other columns are ignored. An
    item's windows are its WINDOW consecutive words, or all its words if it has fewer; an item or
    document that is null or has no word has none. n_hit counts the document's words in any
    occurrence of a window; items_sha256 hashes the ids of the items met, sorted as strings and
    joined by commas (items without an id are counted as one and add nothing to it). Repeated
    rows, and rows without doc_id, get the result of their text. A long text is one row with its
    words in arrays, a few times its size in memory; nothing of it is left out.
    """
    found = contaminated_texts(documents, benchmark)
    base = documents.select("doc_id", F.md5("text").alias("text_key"), F.coalesce(F.regexp_count("text", F.lit(ANY_CASE)), F.lit(0)).cast("long").alias("n_words"))
    return base.join(found, "text_key", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"), F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"), "text_key"
    )


def drop_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """documents whose text has no hit; null texts stay. Columns are those of documents."""
    found = keep(_hits(documents, _item_windows(benchmark)).select("text_key").distinct(), "contaminated")
    keys = found.withColumnRenamed("text_key", "_hit_key")
    return documents.join(keys, F.md5("text") == F.col("_hit_key"), "left_anti")
