"""The stages of the pipeline, each against brute force on its own input."""

import re

import corpus_pipeline
from pyspark.sql import functions as F

from listwright.llm.store import keep

from .test_llm import brute_components, brute_contamination

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    foreign = ["Привет мир, это русский текст о погоде и природе. " * 5, "bxqzk vwtrp gkzzx qqjvb " * 3 + "zvkxw pqrtj"]
    planted = [(90001, None, "en", "s", 0), (90002, "123 !!", None, None, 6)] + [(90003 + i, t, None, "s", len(t)) for i, t in enumerate(foreign)]
    docs = docs.unionByName(docs.limit(3)).unionByName(spark.createDataFrame(planted, docs.schema))
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = keep(stage(spark, docs, SF), name)
        after = {r.doc_id: r.text for r in docs.collect()}
        if name != "mix":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
        if name == "language_id":
            assert set(before) - set(after) == {90001, 90002, 90003, 90004}
        elif name == "near_dedup":
            ids = sorted(before)
            found = brute_components([before[i] for i in ids], 5)
            assert set(after) == {i for k, (i, (_, c)) in enumerate(zip(ids, found, strict=True)) if c == k} and docs.count() == len(after)
        elif name == "decontaminate":
            assert set(after) == {r[0] for r in brute_contamination(list(before.items()), items) if not r[5]}
        elif name == "secret_scan":
            assert set(after) == set(before)
            assert not any(re.search(r'token = "[0-9a-f]{40}"', t) for t in after.values())
        else:
            assert docs.where("taken > 2 * size or taken <= 0").count() == 0
            near = docs.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g")).where("t <> floor(g)")
            assert near.count() == 0


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 100
