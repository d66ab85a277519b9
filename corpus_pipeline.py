"""A corpus pipeline: each stage is written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listwright.llm.decontam import drop_contaminated
from listwright.llm.lang_id import learn, predict
from listwright.llm.mixing import mix_sources
from listwright.llm.near_dup import drop_near_duplicates
from listwright.llm.queries import WEIGHTS, text_quality
from listwright.llm.secret_scan import scan_secrets
from listwright.llm.store import keep

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
LEAST_SCORE = 0.5
PLAIN_BITS = 8.0  # of a byte of text as it stands


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: null texts, texts without a letter, undecided ones, and
    texts whose code under each learned language is not shorter than the text itself."""
    known = (F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE) & (F.col("bits_per_byte") < PLAIN_BITS)
    return predict(docs, learn(docs)).where(known).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest id."""
    return drop_near_duplicates(docs, k=5, percent=80).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; no document goes."""
    scanned = scan_secrets(docs.select(*COLUMNS))
    return scanned.withColumn("text", F.col("redacted")).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with the words taken of each, repeats counted."""
    return mix_sources(docs.select(*COLUMNS), WEIGHTS, share=1.5, most=2.0, quality=text_quality()).where("taken > 0")


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("secret_scan", secret_scan), ("mix", mix)]

#: SQL can't express the trained stages; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs
