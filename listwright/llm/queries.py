"""Queries over the driver tables: one opN_<name> for each operator of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontam import find_contamination
from .divergence import source_divergence
from .fingerprints import fingerprint_documents
from .html_text import extract_main_text
from .lang_id import is_held_out, learn, predict
from .licenses import scan_licenses
from .mixing import mix_sources
from .near_dup import near_duplicates
from .passages import remove_repeats
from .secret_scan import scan_secrets
from .spelling import corpus_words, variant_groups
from .token_count import count_tokens, length_histogram
from .url_filter import judge_urls

WEIGHTS = [3.0, 1.0, 2.0]
#: The rules of op3's contract. The default rules of judge_urls, which op3's SQL takes, block net/de/.
URL_RULES = (("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block"))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(_table(spark, sf_dir, "documents"), k=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(_table(spark, sf_dir, "documents"), WEIGHTS, share=1.5, most=2.0, quality=text_quality())
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def text_quality() -> Column:
    """A document's quality weight from its length alone: texts of 500 characters or more count double."""
    return F.when(F.col("n_chars") >= 500, 2.0).otherwise(1.0)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(_table(spark, sf_dir, "documents"))
    spans = F.array_join(F.transform("secrets", lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    return found.select("doc_id", "n_candidates", F.size("secrets").cast("long").alias("n_secrets"), spans.alias("spans"), F.sha2("redacted", 256).alias("redacted_sha256"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return predict(documents, learn(documents)).select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    positions = F.array_join(F.col("positions").cast("array<string>"), ",").alias("positions")
    return fingerprint_documents(_table(spark, sf_dir, "documents")).select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", positions)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_histogram(count_tokens(_table(spark, sf_dir, "documents")))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("detections", lambda d: d["base"])
    named = lambda d: F.array_join(F.array_sort(F.array_distinct(F.transform(d, lambda x: x["label"]))), ",")
    starts = F.transform(base, lambda d: d["start"])
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"), named(base).alias("base_labels"), named(F.col("detections")).alias("labels"),
        F.coalesce(F.array_max(F.transform("detections", lambda d: d["weight"])), F.lit(0.0)).alias("score"),
    )


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(_table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variant_groups(corpus_words(_table(spark, sf_dir, "documents")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [op1_minhash_near_dedup, op2_mix_sources, op3_url_filter, op4_html_text, op5_secret_scan, op6_language_id, op7_substring_dedup, op8_fingerprints, op9_token_counts, op10_decontamination, op11_license_scan, op12_source_divergence, op13_spelling_variants]
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    from .oracle import ORACLE_SQL

    return dict(ORACLE_SQL)
