"""Tables that the engine writes itself, and the operators that came with them."""

import datetime as dt
import html.parser
import random
import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from listwright.config import DEFAULT
from listwright.functions.arrays import count_between, count_upto
from listwright.operators import changes, closing, dedup, lookups, sections
from listwright.plans import mart, rebuild
from listwright.schema import MASTER, RUN_LOG
from listwright.sources import buckets, pages, registry, snapshots

D, RUN = dt.date, dt.datetime(2026, 7, 24, 9)
OLD = dt.datetime(2026, 7, 1, 9)


def posting(i, title="회계", body="본문", source="s1", status="ACTIVE", seen=D(2026, 7, 23), updated=OLD):
    return (i, source, "회사", title, f"u/{i}", "서울", D(2026, 7, 1), status, body, OLD, updated, None, seen)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def files_of(spark, table):
    return {r.bucket: r.files for r in spark.table(table).select("bucket", F.input_file_name().alias("f")).groupBy("bucket").agg(F.sort_array(F.collect_set("f")).alias("files")).collect()}


def test_merge_in_place(spark):
    rows = [posting(f"j{i}", source=f"s{i % 3}", status="CLOSED" if i % 7 == 0 else "ACTIVE") for i in range(60)]
    master = spark.createDataFrame(rows, MASTER)
    name = f"m_{uuid.uuid4().hex}"
    path = snapshots.scratch(spark, "master")
    buckets.open_master(spark, name, path, MASTER, 8)
    buckets.replace_buckets(master, name, 8)
    before = files_of(spark, name)
    assert len(before) == 8 and all(len(f) == 1 for f in before.values())
    batch = spark.createDataFrame([posting("j1", title="세무"), posting("j7"), posting("j8"), posting("new")], MASTER).drop("last_seen_date")
    ts = F.lit(RUN).cast("timestamp_ntz")
    touched = {r[0] for r in batch.select(buckets.bucket_of("id", 8)).distinct().collect()}
    assert 0 < len(touched) < 8
    expected = changes.merge_batch(master, batch, ts)
    counts = buckets.merge_in_place(spark, name, batch, ts, 8, ["s0", "s1"])
    seen = {(r.source if r.source in ("s0", "s1") else None, r.change_type): r.n for r in changes.change_counts(expected).collect() if r.change_type != "absent"}
    assert {(s, k): n for s, k, n, _ in counts if k != "absent"} == seen
    columns = [c for c in expected.columns if c not in ("change_type", "guarded", "old_deadline")]
    assert sorted(map(str, spark.table(name).select(*columns).collect())) == sorted(map(str, expected.select(*columns).collect()))
    after = files_of(spark, name)
    assert all((before[b] == after[b]) == (b not in touched) for b in before)
    again = buckets.merge_in_place(spark, name, batch, ts, 8, ["s0", "s1"])
    assert {k for _, k, _, _ in again} == {"unchanged", "absent"}
    spark.sql(f"DROP TABLE {name}")  # another session finds the files
    assert buckets.open_master(spark, f"{name}_b", path, MASTER, 8).count() == 61


def test_the_master_is_not_shuffled(spark):
    name = f"m_{uuid.uuid4().hex}"
    buckets.open_master(spark, name, snapshots.scratch(spark, "master"), MASTER, 8)
    buckets.replace_buckets(spark.createDataFrame([posting(f"j{i}") for i in range(40)], MASTER), name, 8)
    batch = spark.createDataFrame([posting(f"j{i}") for i in range(5)], MASTER).drop("last_seen_date")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(buckets.merged_buckets(spark, name, batch, F.lit(RUN).cast("timestamp_ntz"), 8))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan and "SelectedBucketsCount: 8 out of 8" in plan
    scan = plan[plan.index("FileScan parquet") - 400 : plan.index("FileScan parquet")]
    assert "Exchange" not in scan.rsplit("SortMergeJoin", 1)[-1] or plan.index("Exchange") > plan.index("FileScan parquet")


def test_observed_counts_take_one_job(spark):
    merged = spark.createDataFrame([("s1", "new", False), ("s1", "modified", True), ("s2", "absent", False), (None, "new", False), ("odd", "new", False)], "source string, change_type string, guarded boolean")
    df, seen = changes.observe_changes(merged, ["s1", "s2"])
    tracker, group = spark.sparkContext.statusTracker(), uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "observed")
    df.write.parquet(snapshots.scratch(spark, "observed"))
    got = changes.observed_counts(seen, ["s1", "s2"])
    assert len(tracker.getJobIdsForGroup(group)) == 1
    assert sorted(got, key=str) == sorted([("s1", "new", 1, 0), ("s1", "modified", 1, 1), ("s2", "absent", 1, 0), (None, "new", 2, 0)], key=str)


@pytest.mark.parametrize("n", [0, 1, 2, 7, 33])
def test_search_in_a_sorted_array(spark, n):
    days = sorted(random.Random(n).sample(range(100), n))
    rows = [(days, x) for x in range(-1, 101)] + [(None, 3), (days, None)]
    got = spark.createDataFrame(rows, "d array<int>, x int").select("x", "d", count_upto(F.col("d"), F.col("x")).alias("n")).collect()
    assert all(r.n == (None if r.d is None or r.x is None else sum(d <= r.x for d in days)) for r in got)


def test_asof_fair_days(spark):
    rng = random.Random(1)
    runs = [(rng.choice(["A", "a", "b"]), D(2026, 7, rng.randint(1, 28)), rng.randint(0, 2), rng.random() < 0.8) for _ in range(80)]
    pairs = [(s, D(2026, 7, d) if d else None) for s in ("a", "B", "none") for d in range(0, 31, 3)] * 2
    log, asked = spark.createDataFrame(runs, "source string, run_date date, n long, is_success boolean"), spark.createDataFrame(pairs, "source string, last_seen date")
    of = lambda f: sorted(((r.source, str(r.last_seen), r.fair_days) for r in f(asked, log, F.lit(D(2026, 7, 24))).collect()))
    assert of(closing.asof_fair_days) == of(closing.fair_miss_days)
    plan = plan_of(closing.asof_fair_days(asked, log, F.lit(D(2026, 7, 24))))
    assert "run_date" not in plan.split("Join")[1].split("\n")[0]  # the condition is on the source alone
    assert spark.range(1).select(count_between(F.lit(None).cast("array<date>"), F.lit(D(2026, 7, 1)), F.lit(D(2026, 7, 3))).alias("n")).first().n == 0


def test_containment_through_grams(spark):
    rng = random.Random(4)
    word = lambda k: "".join(rng.choices("abcde가나", k=k))
    needles = {word(rng.randint(1, 6)) for _ in range(150)}
    hay = {word(rng.randint(1, 14)) for _ in range(150)} | set(list(needles)[:5])
    got = lookups.contained_pairs(spark.createDataFrame([(x,) for x in needles], "needle string"), spark.createDataFrame([(x,) for x in hay], "haystack string"))
    rows = [(r.needle, r.haystack) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == {(n, h) for n in needles for h in hay if n in h}


def test_lookup_with_ten_thousand_presets(spark):
    presets = spark.range(10_000).select(F.col("id").alias("ord"), F.concat(F.lit("firm "), F.sha2(F.col("id").cast("string"), 256).substr(1, 9)).alias("preset"))
    some = presets.where("ord % 500 = 3").select(F.concat(F.lit("(주) "), "preset", F.lit(" korea")).alias("name"))
    names = some.unionByName(spark.createDataFrame([("nowhere",), ("firm",), ("",), (None,)], "name string"))
    df = lookups.tiered_lookup(names, presets)
    assert "NestedLoop" not in plan_of(df) and "Cartesian" not in plan_of(df)
    got = {r.name: (r.preset, r.tier) for r in df.collect()}
    assert len(got) == 21 and got["firm"][1] == 3  # every preset has it in its name: the first wins
    assert got["firm"][0] == presets.where("ord = 0").first().preset
    assert all(n.replace("(주) ", "").replace(" korea", "") == p for n, (p, t) in got.items() if n != "firm")


def brute_sections(body, rules=DEFAULT):
    import re

    state, out = "none", {"req": [], "pref": []}
    for line in body.split("\n"):
        line = line.strip()
        header = next((s for s, words in (("req", rules.section_requirements), ("pref", rules.section_preferences), ("none", rules.section_other)) if any(w in line for w in words)), None)
        if header:
            state = header
        elif state != "none" and re.match(r"[-*•]|[1-5]\.", line):
            text = re.sub(r"^[-*•\s\d.]+", "", line).strip()
            if 5 < len(text) < 100 and not re.search(rules.contact, text) and len(out[state]) < rules.bullets_each:
                out[state].append(text)
    return out


def test_sections_in_one_fold(spark):
    rng = random.Random(3)
    lines = ["자격요건", "우대사항", "복리후생", "- 회계 결산 경험자", "* 공인회계사 우대합니다", "• short", "1. 더존 사용 가능자 누구나", "6. 여섯째 항목입니다", "그냥 문장입니다", "- mail a@b.com 으로 연락", "", "  - 앞에 빈칸이 있는 항목  ", "-" + "긴" * 120]
    bodies = ["\n".join(rng.choices(lines, k=rng.randint(0, 40))) for _ in range(80)]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)] + [(99, None)], "id int, body string").select("id", sections.bullets_of(F.split("body", "\n")).alias("b"))
    assert "Exchange" not in plan_of(df) and "Generate" not in plan_of(df) and "Window" not in plan_of(df)
    got = {r.id: r.b.asDict() for r in df.collect()}
    assert got.pop(99) == {"req": [], "pref": []}
    assert got == {i: brute_sections(b) for i, b in enumerate(bodies)}


@pytest.mark.parametrize("seed", range(3))
def test_keywords_are_asked_in_order(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice("ab"), rng.randint(1, 4), pos, rng.randrange(25)) for pos in range(150)]
    expected = set()
    for source in "ab":
        taken = set()
        for keyword in range(1, 5):
            n = 0
            for _, _, pos, item in sorted((r for r in rows if r[0] == source and r[1] == keyword), key=lambda r: r[2]):
                if n >= 5:
                    break
                if item not in taken:
                    taken.add(item)
                    n += 1
                    expected.add((source, keyword, item, pos))
    hits = spark.createDataFrame(rows, "source string, keyword int, pos long, item long")
    assert {tuple(r) for r in dedup.capped_by_keyword(hits, 5, 4).collect()} == expected
    over = spark.createDataFrame([("a", 1, 1, 1), ("a", 1, 2, 2), ("a", 2, 3, 2)], "source string, keyword int, pos long, item long")
    assert {tuple(r) for r in dedup.capped_by_keyword(over, 1, 2).collect()} == {("a", 1, 1, 1), ("a", 2, 2, 3)}  # over the cap of 1, in by 2


def run_rows(spark, ids, note=None):
    return spark.createDataFrame([(i, D(2026, 7, 20 + i % 3), 1, 2, 3, True, note, "{}", "[]") for i in ids], RUN_LOG)


def test_a_run_is_logged_once(spark):
    path = snapshots.scratch(spark, "runs")
    assert snapshots.read_runs(spark, path).count() == 0
    snapshots.append_run(run_rows(spark, [1, 2, 4]), path)
    snapshots.append_run(run_rows(spark, [2], "again"), path)
    snapshots.append_run(run_rows(spark, [3]), path)
    got = snapshots.read_runs(spark, path)
    assert got.columns == run_rows(spark, []).columns
    assert sorted((r.run_id, r.run_date, r.error_log) for r in got.collect()) == [(1, D(2026, 7, 21), None), (2, D(2026, 7, 22), "again"), (3, D(2026, 7, 20), None), (4, D(2026, 7, 21), None)]


def test_a_failed_append_leaves_the_log_as_it_was(spark):
    path = snapshots.scratch(spark, "runs")
    snapshots.append_run(run_rows(spark, [1, 2]), path)
    broken = run_rows(spark, [2, 5, 8, 11]).withColumn("error_log", F.when(F.col("run_id") == 11, F.raise_error(F.lit("lost"))).otherwise("half"))
    with pytest.raises(Exception, match="lost"):
        snapshots.append_run(broken, path)
    assert sorted((r.run_id, r.error_log) for r in snapshots.read_runs(spark, path).collect()) == [(1, None), (2, None)]
    snapshots.append_run(run_rows(spark, [2, 5, 8, 11], "whole"), path)
    assert sorted((r.run_id, r.error_log) for r in snapshots.read_runs(spark, path).collect()) == [(1, None), (2, "whole"), (5, "whole"), (8, "whole"), (11, "whole")]


def test_only_stale_categories_are_rebuilt(spark):
    path = snapshots.scratch(spark, "categories")
    master = spark.createDataFrame([posting(f"j{i}", title="세무 담당" if i % 2 else "회계", source=f"s{i % 3}") for i in range(12)] + [posting("n", source=None)], MASTER)
    stored = lambda: {r.job_id: r for r in rebuild.stored_categories(spark, path).collect()}
    of = lambda df: {(r.source, r.why): r.n for r in df.collect()}
    assert of(rebuild.rebuild_stale(spark, master, path)) == {("s0", "missing"): 4, ("s1", "missing"): 4, ("s2", "missing"): 4, (None, "missing"): 1}
    first = stored()
    assert len(first) == 13 and first["j1"].primary_category == "세무"
    assert of(rebuild.rebuild_stale(spark, master, path)) == {}
    parts = lambda: {r.source: r.f for r in rebuild.stored_categories(spark, path).select("source", F.input_file_name().alias("f")).groupBy("source").agg(F.sort_array(F.collect_set("f")).alias("f")).collect()}
    before = parts()
    other = replace(DEFAULT, categories=(("조세", ("세무",)),))
    assert of(rebuild.rebuild_stale(spark, master, path, {"s1": other})) == {("s1", "rules"): 4}
    second, after = stored(), parts()
    assert {i for i in first if first[i] != second[i]} == {i for i, r in first.items() if r.source == "s1"}
    assert second["j1"].primary_category == "조세" and second["j3"].primary_category == "세무"
    assert {s for s in before if before[s] != after[s]} == {"s1"}
    newer = master.withColumn("last_updated_at", F.when(F.col("id") == "j3", F.lit(RUN).cast("timestamp_ntz")).otherwise(F.col("last_updated_at"))).withColumn("title", F.when(F.col("id") == "j3", "자금").otherwise(F.col("title")))
    assert of(rebuild.rebuild_stale(spark, newer, path, {"s1": other})) == {("s0", "body"): 1}
    third = stored()
    assert {i for i in third if second[i] != third[i]} == {"j3"} and third["j3"].primary_category == "재무/자금"


def test_mart_scans_push_their_filters(spark):
    path = snapshots.scratch(spark, "mart")
    rows = [(i, "s", f"t{i}", D(2026, 7, 1), "x" * i, "tax" if i % 2 else "other", i % 9, None if i % 4 == 0 else i % 9 + 1) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, source string, title string, posted_at date, raw_html string, category string, min_experience int, max_experience int")
    mart.write_mart(df, path)
    scan = mart.scan_mart(spark, path, ("tax",), 3, 5, 100)
    assert {r.id for r in scan.collect()} == {i for i, _, _, _, body, c, low, high in rows if c == "tax" and low <= 5 and (high is None or high >= 3) and len(body) >= 100}
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    line = next(x for x in plan_of(mart.scan_mart(spark, path, ("tax",), 3, 5, 100)).split("\n") if "FileScan parquet" in x)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "raw_html" not in line.split("ReadSchema")[1] and "GreaterThanOrEqual(body_len,100)" in line and "LessThanOrEqual(min_experience,5)" in line


class Blocks(html.parser.HTMLParser):
    """Texts of elements whose class has a word, by a stack of open elements."""

    def __init__(self, word):
        super().__init__()
        self.word, self.open, self.blocks = word, [], []

    def handle_starttag(self, tag, attrs):
        if tag not in pages.VOID:
            block = [] if self.word in (dict(attrs).get("class") or "") else None
            self.open.append((tag, block))
            if block is not None:
                self.blocks.append(block)

    def handle_endtag(self, tag):
        if any(t == tag for t, _ in self.open):
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data):
        for _, block in self.open:
            if block is not None and data.strip():
                block.append(data.strip())


def nested_page(rng, depth=0):
    if depth > 4 or rng.random() < 0.3:
        return f"text{rng.randrange(10**rng.randint(1, 8))} "
    kind = rng.choice(["div", "div", "section", "p"])
    own = rng.choice(['class="xContent"', "class='Content_1 a'", 'class="other"', 'data-x="</div>" class="bContent"', ""])
    return f"<{kind} {own}>" + "".join(nested_page(rng, depth + 1) for _ in range(rng.randint(1, 4))) + rng.choice(["", "<br>", "<!-- </div> -->"]) + f"</{kind}>"


def test_nested_blocks(spark):
    rng = random.Random(6)
    made = ["<html><body>" + "".join(nested_page(rng) for _ in range(4)) + "</body></html>" for _ in range(80)]
    expected = {}
    for i, page in enumerate(made):
        parser = Blocks("Content")
        parser.feed(page)
        best = max(parser.blocks, key=lambda b: sum(map(len, b)), default=[])
        text = "\n".join(best)
        expected[i] = text if len(text) > 10 else ""
    odd = ['<div class="Content">never closed <p>but long enough', '</div></div><div class="Content">after ends without a start</div> tail', None, "no tag at all", ""]
    df = spark.createDataFrame(list(enumerate([*made, *odd])), "page_id int, html string")
    got = {r.page_id: r.body for r in pages.nested_block(df, "Content", 10).collect()}
    n = len(made)
    assert [got.pop(n + k) for k in range(5)] == ["never closed\nbut long enough", "after ends without a start", "", "", ""]
    assert got == expected


def test_registry(spark):
    rows = registry.source_registry(spark)
    assert registry.registry_problems(rows).count() == 0
    own = {r.source: r.aliases for r in rows.collect()}
    assert own["nhn"] == ["NHN", "엔에이치엔"] and own["gravity"] == ["그라비티"]
    titles = spark.createDataFrame([(1, "ncsoft", "NC 채용"), (2, "nhn", "엔에이치엔㈜ 채용"), (3, "gravity", "다른회사 채용"), (4, "nowhere", "NC")], "page_id int, source string, page_title string")
    assert {r.page_id for r in pages.guarded(titles, registry.aliases_of(rows)).collect()} == {1, 2}
    bad = registry.source_registry(spark, [("a", "A", "x", "1"), ("a", "B", "x", "2"), ("c", " ", "x", "1")], {})
    assert {tuple(r) for r in registry.registry_problems(bad).collect()} == {("a", "duplicate source"), ("a", "duplicate board"), ("c", "duplicate board"), ("c", "no alias")}
