"""State sequences, guards and invariants."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from listwright.config import DEFAULT
from listwright.operators import changes, closing, dedup, health, lookups, sections
from listwright.sources import pages, payloads, snapshots

D = dt.date
RUN = dt.datetime(2026, 7, 24, 9)
POSTING = "id string, source string, company_name string, title string, origin_url string, location string, posted_at date, status string, raw_html string, first_seen_at timestamp_ntz, last_updated_at timestamp_ntz, deadline date"
BODY = "담당업무 회계 결산 " + "가나다 " * 150


def batch(spark, *rows):
    full = [(i, "saramin", "회사", t, "u", None, D(2026, 7, 1), "ACTIVE", b, RUN, RUN, d) for i, t, b, d in rows]
    return spark.createDataFrame(full, POSTING)


def merged(spark, old, new):
    master = batch(spark, *old).withColumn("last_seen_date", F.lit(D(2026, 7, 23)))
    out = changes.merge_batch(master, batch(spark, *new), F.lit(RUN).cast("timestamp_ntz"))
    return {r.id: r for r in out.collect()}, out


def test_merge_rules(spark):
    d1, d2 = D(2026, 8, 1), D(2026, 8, 9)
    old = [("same", "t", BODY + " 2026-07-01", None), ("body", "t", BODY, None), ("guard", "t", BODY, None), ("guardtitle", "t", BODY, None), ("dl", "t", BODY, d1), ("first", "t", BODY, None), ("nodl", "t", BODY, d1), ("gone", "t", BODY, None)]
    new = [("same", "t", BODY.replace(" ", "  ") + " 2026-07-02", None), ("body", "t", BODY + "추가", None), ("guard", "t", "t", None), ("guardtitle", "t2", "t2", None), ("dl", "t", BODY, d2), ("first", "t", BODY, d1), ("nodl", "t", BODY, None), ("new", "t", BODY, None)]
    got, out = merged(spark, old, new)
    kinds = {k: r.change_type for k, r in got.items()}
    assert kinds == {"same": "unchanged", "body": "modified", "guard": "unchanged", "guardtitle": "modified", "dl": "modified", "first": "modified", "nodl": "unchanged", "gone": "absent", "new": "new"}
    assert got["guard"].raw_html == BODY and got["guardtitle"].raw_html == BODY and got["guardtitle"].title == "t2"
    assert got["nodl"].deadline == d1 and got["gone"].last_seen_date == D(2026, 7, 23) and got["same"].last_seen_date == D(2026, 7, 24)
    assert [(r.id, r.verdict) for r in changes.deadline_changes(out).collect()] == [("dl", "extended")]


def test_merge_twice_changes_nothing(spark):
    _, out = merged(spark, [("a", "t", BODY, None)], [("a", "t2", BODY + "x", None), ("b", "t", BODY, None)])
    again = changes.merge_batch(out.drop("change_type", "guarded", "old_deadline"), batch(spark, ("a", "t2", BODY + "x", None), ("b", "t", BODY, None)), F.lit(RUN).cast("timestamp_ntz"))
    assert {r.change_type for r in again.collect()} == {"unchanged"}


@pytest.mark.parametrize("parts", [1, 17])
def test_content_merge_ignores_partitions(spark, parts):
    rows = [("1", "회사", "회계", "saramin", "u1", 1), ("2", "회사", "회계", "com2us", "u2", 2), ("3", "회사", "회계", "saramin", "u3", 3), ("4", "다른", "회계", "wanted", "u4", 4)]
    df = spark.createDataFrame(rows, "id string, company_name string, title string, source string, origin_url string, ingest_seq int").repartition(parts)
    got = {r.id: (r.first_seq, [s.origin_url for s in r.sources]) for r in dedup.content_merge(df).collect()}
    assert got == {"2": (1, ["u2", "u1"]), "4": (4, ["u4"])}


def test_native_dedup_and_last_wins(spark):
    df = spark.createDataFrame([("1", "jobkorea", 1), ("1", "corp", 2), ("1", "corp2", 3), (None, "x", 4), (None, "x", 5)], "no string, source string, seq int")
    got = sorted((r.no or "", r.seq) for r in dedup.native_dedup(df, "no", F.col("source") == "jobkorea", "seq").collect())
    assert got == [("", 4), ("", 5), ("1", 2)]
    df = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("a", 3, "z")], "k string, seq int, v string")
    assert sorted((r.k, r.v, r.first_seq) for r in dedup.last_wins(df, "k", "seq").collect()) == [("a", "z", 1), ("b", "y", 2)]


def test_repost(spark):
    closed = spark.createDataFrame([("회사", "회계", dt.datetime(2026, 6, 15)), ("회사", "세무", dt.datetime(2026, 7, 15))], "company_name string, title string, closed_at timestamp")
    active = spark.createDataFrame([("회사", "회계", dt.datetime(2026, 7, 16)), ("회사", "세무", dt.datetime(2026, 7, 16))], "company_name string, title string, first_seen_at timestamp")
    assert [(r.key.title, r.closed_on) for r in dedup.repost_flags(active, closed).collect()] == [("회계", D(2026, 6, 15))]


def decide(spark, last_seen, runs, source="saramin", state="success", seen=3, today=D(2026, 7, 24), more=()):
    active = spark.createDataFrame([("x", source, "c", "t", last_seen), *more], "id string, source string, company_name string, title string, last_seen_date string")
    ids = spark.createDataFrame([(f"s{i}",) for i in range(seen)], "id string")
    h = spark.createDataFrame([(source, state)], "source string, state string")
    log = spark.createDataFrame(runs or [("none", D(2020, 1, 1), 0, True)], "source string, run_date date, n long, is_success boolean")
    counts = spark.createDataFrame([(source, 5)], "source string, n long")
    return {r.id: r.decision for r in closing.close_decisions(active, ids, h, log, counts, F.lit(today)).collect()}["x"]


def test_close_guards(spark):
    run = [("saramin", D(2026, 7, 23), 5, True)]
    assert decide(spark, "2026-07-22", run) == "CLOSED"
    assert decide(spark, "2026-07-24", run) == "same_day"
    assert decide(spark, "2026-07-23", run) == "grace"
    assert decide(spark, "2026-07-22", [("gamejob", D(2026, 7, 23), 5, True)]) == "grace"
    assert decide(spark, "2026-07-17", [], today=D(2026, 7, 20)) == "grace"
    assert decide(spark, "2026-07-17", [("saramin", D(2026, 7, 20), 5, True)], today=D(2026, 7, 21)) == "CLOSED"
    assert [decide(spark, x, run) for x in (None, "not-a-date", "2030-01-01")] == ["restamp"] * 3
    assert decide(spark, "2026-07-22", run, seen=2) == "too_few_seen"
    assert decide(spark, "2026-07-22", run, state="failed") == "source_failed"
    assert decide(spark, "2026-07-22", run, state="partial") == "source_suspect"


def test_mass_close(spark):
    active = spark.createDataFrame([("a", "s1"), ("b", "s1"), ("c", "s2")], "id string, source string")
    trusted = spark.createDataFrame([("s1",), ("s2",)], "source string")
    none = spark.createDataFrame([], "source string, n long")
    assert {r.source: r.hold for r in closing.mass_close_sources(active, none, trusted).collect()} == {"s1": True, "s2": False}
    four = spark.createDataFrame([(str(i), f"s{i}") for i in range(4)], "id string, source string")
    assert all(r.hold for r in closing.mass_close_sources(four, none, four.select("source")).collect())


def test_bad_count_maps(spark):
    rows = [(1, D(2026, 7, 20), True, '{"Saramin": 11, "x": 0, "jobkorea": "n/a", "gamejob": true}'), (2, D(2026, 7, 20), True, "[]"), (3, D(2026, 7, 20), True, "null"), (4, D(2026, 7, 20), True, None), (5, D(2026, 7, 20), True, "{oops"), (6, D(2026, 7, 20), True, '{"saramin": 14}'), (7, D(2026, 7, 19), False, '{"saramin": 99}')]
    log = spark.createDataFrame(rows, "run_id long, run_date date, is_success boolean, source_counts string")
    counts = health.log_counts(log)
    assert sorted((r.run_id, r.source, r.n) for r in counts.collect()) == [(1, "saramin", 11), (6, "saramin", 14), (7, "saramin", 99)]
    base = health.daily_baseline(counts, F.lit(D(2026, 7, 22)))
    assert [(r.source, r.counts) for r in health.history(base).collect()] == [("saramin", [14])]


@pytest.mark.parametrize(("past", "now", "verdict"), [([10, 10, 10], 2, "drop"), ([10, 10, 10], 3, "ok"), ([10, 10, 10], 0, "ok"), ([1, 1, 1], 1, "ok"), ([10, 10], 2, "insufficient")])
def test_drops(spark, past, now, verdict):
    base = spark.createDataFrame([("s", D(2026, 7, i + 1), n) for i, n in enumerate(past)], "source string, day date, n long")
    today, p = spark.createDataFrame([("s", now)], "source string, n long"), spark.createDataFrame([("s",)], "source string")
    assert health.drop_alerts(base, today, p).first().verdict == verdict


def test_health_rollups(spark):
    a = spark.createDataFrame([("a", True), ("a", False), ("b", True), ("c", False)], "source string, ok boolean")
    assert {r.source: r.state for r in health.source_health(a).collect()} == {"a": "partial", "b": "success", "c": "failed"}
    none = spark.createDataFrame([], "source string")
    stale = spark.createDataFrame([], "source string, since date, last_date date, days int, n_active long, escalate boolean")
    assert [r.kind for r in health.health_report(none, none, none, stale, none).collect()] == ["all_clear"]


def test_sections(spark):
    body = "소개\n자격요건\n- 회계 결산 경험자\n- mail a@b.com 으로\n2. 더존 사용 가능자\n우대사항\n* 공인회계사 우대합니다\n복리후생\n- 점심 식대 제공합니다"
    lines = sections.section_lines(sections.lines_of(spark.createDataFrame([(1, body)], "id int, t string"), "id", "t"), "id")
    got = {r.section: r.bullets for r in sections.bullets(lines, "id").collect()}
    assert got == {"req": ["회계 결산 경험자", "더존 사용 가능자"], "pref": ["공인회계사 우대합니다"]}


def test_lookup_tiers(spark):
    names = spark.createDataFrame([("넥슨",), ("㈜ 넥슨",), ("넥슨코리아서비스",), ("hybe im",), ("(주)",), ("없는회사",)], "name string")
    presets = spark.createDataFrame([(i, p[0]) for i, p in enumerate(DEFAULT.presets)], "ord long, preset string")
    fallbacks = spark.createDataFrame([(i, *f) for i, f in enumerate(DEFAULT.preset_fallbacks)], "ord long, keyword string, preset string")
    got = {r.name: (r.preset, r.tier) for r in lookups.tiered_lookup(names, presets, fallbacks).collect()}
    assert got == {"넥슨": ("넥슨", 1), "㈜ 넥슨": ("넥슨", 2), "넥슨코리아서비스": ("넥슨", 3), "hybe im": ("NHN", 4)}


def test_payloads(spark):
    ts = F.lit(RUN).cast("timestamp_ntz")
    one = spark.createDataFrame([('{"jobs":[{"id":7,"title":"회계","absolute_url":"u","content":"<p>본문</p>","location":{"name":"서울"},"updated_at":"","first_published":"2026-07-01T10:00:00"}]}',)], "payload string")
    r = payloads.jobs_board(one, "krafton", "크래프톤", ts).first()
    assert (r.id, r.location, r.posted_at, r.raw_html, r.status) == ("krafton_7", "서울", D(2026, 7, 1), "본문", "ACTIVE")
    two = spark.createDataFrame([('[{"id":"x","text":"세무","hostedUrl":"u","descriptionPlain":"소개","lists":[{"text":"자격","content":"<li>가</li><li>나</li>"},{"text":"","content":""}],"createdAt":1784122620000}]',)], "payload string")
    assert payloads.lists_board(two, "s", "c", ts).first().raw_html == "소개\n자격\n가\n나"
    three = spark.createDataFrame([('{"data":{"datas":[{"id":1,"title":"재무","openingDate":"2026-07-02","dueDate":"2026-08-01T00:00"},{"id":2,"title":"개발"}]}}',)], "payload string")
    got = payloads.datas_board(three, spark.createDataFrame([], "id long, body string"), F.col("title") == "재무", "g", "c", "b/", ts).collect()
    assert [(x.id, x.raw_html, x.deadline) for x in got] == [("g_1", "재무", D(2026, 8, 1))]
    four = spark.createDataFrame([('{"list":[{"seq":9,"subject":"자금","content1":"<b>가</b>","content2":"나","wdate":"1784122620"}]}',)], "payload string")
    assert [(x.id, x.posted_at, x.raw_html) for x in payloads.company_api(four, "shiftup", "c", "b/", ts).collect()] == [("shiftup_9", D(2026, 7, 15), "가\n나")]


def test_listing_states(spark):
    html = ["<div>blocked</div>", '<div class="jobListWrap"></div>', '<div class="jobListWrap"><tr><td>회사</td><td><a href="GI_No=5">회계</a> ~07/31</td></tr><tr><td>또</td><td><a href="GI_No=5">회계</a></td></tr></div>']
    df = spark.createDataFrame(list(enumerate(html)), "page_id int, html string")
    got = pages.listing_rows(df, "jobListWrap", r"(?is)<tr>(.*?)</tr>", r"GI_No=(\d+)", r"(?is)<a[^>]*>(.*?)</a>", r"(?is)<td>(.*?)</td>", F.lit(D(2026, 7, 9))).orderBy("page_id").collect()
    assert [(r.page_id, r.state, r.native_no, r.company, r.title, r.deadline) for r in got] == [(0, "failed", None, None, None, None), (1, "empty", None, None, None, None), (2, "ok", "5", "회사", "회계", D(2026, 7, 31))]


def test_versions(spark, tmp_path):
    path = str(tmp_path / "master")
    assert snapshots.read_latest(spark, path) is None
    df = spark.createDataFrame([("a", "s")], "id string, source string")
    assert snapshots.write_next(df, path) == 1 and snapshots.write_next(df.union(df), path) == 2
    assert snapshots.read_latest(spark, path).count() == 2


def plan_text(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_payload_entries_are_gathered_as_texts(spark):
    from listwright.plans import boards

    rows = spark.createDataFrame([(1, 10, "a"), (1, 11, None), (2, 20, "b")], "key int, n int, t string").coalesce(1)
    for before, after in (("[", "]"), ('{"list":[', "]}")):
        landed = boards._landed(rows, "key", F.struct("n", "t"), before, after)
        assert "collect_list(struct" not in plan_text(landed)
        assert sorted(r.payload for r in landed.collect()) == sorted(before + x + after for x in ('{"n":10,"t":"a"},{"n":11}', '{"n":20,"t":"b"}'))


def test_html_fragments(spark):
    from listwright.functions import text as X

    made = {"": "", "plain  text": "plain text", "a <SCRIPT>x</SCRIPT> b": "a b", "&l<style>x</style>t;b&gt;": "<b>", "<p>a</p>\t<p> b</p>": "a\nb", "x &amp;lt; y": "x &lt; y", "1 < 2": "1 < 2"}
    rows = spark.createDataFrame([*made.items(), (None, None)], "html string, text string")
    assert all(r.got == r.text for r in rows.select("text", X.html_to_text(F.col("html")).alias("got")).collect())
    assert "CASE WHEN" in plan_text(rows.select(X.html_to_text(F.col("html"))))
