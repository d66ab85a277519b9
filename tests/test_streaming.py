from pyspark.sql import functions as F

from listwright.streaming import daily


def test_daily_counts(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.createDataFrame([("2026-07-01 10:00:00", "A"), ("2026-07-01 23:00:00", "a"), ("2026-07-03 01:00:00", "b")], "ts string, source string").withColumn("ts", F.to_timestamp("ts")).write.parquet(path)
    stream = spark.readStream.schema("ts timestamp, source string").parquet(path)
    q = daily.daily_counts(stream).writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((str(r.day), r.source, r.n) for r in spark.table("counts").collect()) == [("2026-07-01", "a", 2), ("2026-07-03", "b", 1)]


def test_merge_stream(spark, tmp_path):
    from listwright.schema import POSTING
    from listwright.sources import snapshots

    landing, master = str(tmp_path / "landing"), str(tmp_path / "master")
    rows = [("1", "s", "c", "t", "u", None, None, "ACTIVE", "body", None, None, None)] * 2
    spark.createDataFrame(rows, POSTING).withColumn("landed_at", F.current_timestamp()).write.json(landing)
    stream = daily.landed(spark, landing, f"{POSTING}, landed_at timestamp")
    daily.merge_stream(stream, master, str(tmp_path / "ck"), lambda b: b.drop("landed_at")).awaitTermination()
    assert [(r.id, r.title) for r in snapshots.read_latest(spark, master).collect()] == [("1", "t")]


def test_merge_stream_in_place(spark, tmp_path):
    import uuid

    from listwright.schema import MASTER, POSTING
    from listwright.sources import buckets, snapshots

    name, landing, seen = f"m_{uuid.uuid4().hex}", str(tmp_path / "landing"), []
    buckets.open_master(spark, name, snapshots.scratch(spark, "master"), MASTER, 4)
    for title in ("t", "u", "u"):
        rows = [(str(i), "s", "c", title if i == 1 else "same", "u", None, None, "ACTIVE", "body", None, None, None) for i in range(3)]
        spark.createDataFrame(rows, POSTING).withColumn("landed_at", F.current_timestamp()).write.mode("overwrite").json(landing)
        daily.merge_stream_in_place(spark.readStream.schema(f"{POSTING}, landed_at timestamp").json(landing), name, 4, str(tmp_path / f"ck{len(seen)}"), ["s"], lambda b: b.drop("landed_at"), lambda i, counts: seen.append(counts)).awaitTermination()
    assert [{k: n for _, k, n, _ in counts} for counts in seen] == [{"new": 3}, {"modified": 1, "unchanged": 2}, {"unchanged": 3}]
    assert {r.id: r.title for r in spark.table(name).collect()} == {"0": "same", "1": "u", "2": "same"}
