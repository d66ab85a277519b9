"""Rule tables: input and expected rows, one action per table."""

import datetime as dt

from pyspark.sql import functions as F

from listwright.functions import dates, keys, text

D = dt.date


def values(spark, rows, schema, column):
    got = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}").select("i", column.alias("v")).orderBy("i").collect()
    return [r.v for r in got]


def test_titles(spark):
    cases = [("재무회계 담당자", True), ("고객감사 이벤트", False), ("내부 감사 담당", True), ("IR 매니저", True), ("hiring manager", False), ("ir담당", False), ("재무 시스템 개발 담당자", False), ("Tax Manager", True), ("급여 담당", False), ("재무 공시", True), ("세무조정 담당자 채용", True), (None, False), ("", False)]
    assert values(spark, [(t,) for t, _ in cases], "t string", F.coalesce(text.title_accepted(F.col("t")), F.lit(False))) == [e for _, e in cases]


def test_companies(spark):
    cases = [("넥슨게임즈", "", True), ("NEXON", None, True), ("람정제주", "게임", False), ("회사", "카지노 딜러", False), ("회사", "게임 회계", True), (None, None, False)]
    assert values(spark, [c[:2] for c in cases], "n string, c string", text.company_accepted(F.col("n"), F.col("c"))) == [c[2] for c in cases]


def test_experience(spark):
    cases = [
        ("경력 3년 ~ 5년", None, (3, 5)), ("1~3년차", None, (1, 3)), ("5년 이상", None, (5, None)), ("3년↑", None, (3, None)), ("5년 이하", None, (0, 5)), ("3년 전후", None, (2, 4)), ("대리급", None, (3, None)), ("과장급 이상", None, (6, None)),
        ("과장 급여대장", None, (0, None)), ("2024-2025년", None, (0, None)), ("계약기간 3-5년", None, (0, None)), ("관련 경력 3-5년", None, (3, 5)), ("본문", "회계 (5~15년)", (5, 15)), ("본문", "신입 회계", (0, 1)), ("경력 경력 5년 ↓", None, (0, 5)), ("경력 경력 무관(신입포함)", None, (0, None)),
    ]
    df = spark.createDataFrame([(i, b, t) for i, (b, t, _) in enumerate(cases)], "i int, b string, t string")
    got = text.with_experience(df, F.col("b"), F.coalesce("t", F.lit(""))).orderBy("i").collect()
    assert [tuple(r.experience) for r in got] == [c[2] for c in cases]


def test_work_types_and_salary(spark):
    cases = [("전면재택 가능", "풀재택"), ("주 2회 재택", "하이브리드 (주2~3회 재택)"), ("재택 불가", "전면출근"), ("판교 근무", "미확인")]
    assert values(spark, [(t,) for t, _ in cases], "t string", text.work_type(F.col("t"))) == [e for _, e in cases]
    pay = [("연봉 5,000 ~ 6,000만원", (5000, 6000)), ("4,500만원 이상", (4500, None)), ("내규", (None, None))]
    assert [tuple(v) for v in values(spark, [(t,) for t, _ in pay], "t string", text.salary(F.col("t")))] == [e for _, e in pay]


def test_badges(spark):
    cases = [("~ 07/31(금)", D(2026, 7, 31)), ("D-3", D(2026, 7, 12)), ("오늘마감", D(2026, 7, 9)), ("내일 마감", D(2026, 7, 10)), ("상시채용", None), ("채용시", None), ("", None), (None, None), ("~02/30", None)]
    assert values(spark, [(t,) for t, _ in cases], "t string", dates.badge_date(F.col("t"), F.lit(D(2026, 7, 9)))) == [e for _, e in cases]
    assert values(spark, [("~01/15",)], "t string", dates.badge_date(F.col("t"), F.lit(D(2026, 12, 20)))) == [D(2027, 1, 15)]


def test_dates(spark):
    today = F.lit(D(2026, 7, 9))
    assert values(spark, [("2026-08-01T00:00:00",), ("2028-01-01",), ("soon",), (None,)], "t string", dates.due_date(F.col("t"), today)) == [D(2026, 8, 1), None, None, None]
    assert values(spark, [("1784122620",), ("2026-07-01 10:00",), ("",), (None,)], "t string", dates.posted_date(F.col("t"), today)) == ["2026-07-15", "2026-07-01", "2026-07-09", "2026-07-09"]
    assert values(spark, [("2026-07-05",), ("x",)], "t string", dates.month_day(F.col("t"), F.lit("?"))) == ["7/5", "?"]


def test_content_keys(spark):
    same = [("컴투스", "[컴투스홀딩스] 재무관리 팀장", "컴투스 홀딩스", "재무관리 팀장", True), ("A", "[신입] 회계", "A", "[경력] 회계", False), ("NX3GAMES", "회계", "㈜엔엑스쓰리게임즈", "회계", True), ("A", "회계", "B", "회계", False)]
    one, two = keys.content_key(F.col("a"), F.col("b")), keys.content_key(F.col("c"), F.col("d"))
    assert values(spark, [s[:4] for s in same], "a string, b string, c string, d string", one == two) == [s[4] for s in same]
    assert values(spark, [("스마일", "[스마일] 회계"), ("스마일", "[스마일]"), ("스마일", "[다른] 회계")], "c string, t string", keys.display_title(F.col("c"), F.col("t"))) == ["회계", "[스마일]", "[다른] 회계"]


def test_bodies(spark):
    long = "담당업무 " + "가" * 500
    cases = [(long, "제목만", True), (long, long + "나", False), ("가" * 300, "가" * 50, False), ("가" * 900, "가" * 300, True), (long, "가" * 400, False), (None, "x", False)]
    assert values(spark, [c[:2] for c in cases], "o string, n string", text.body_degraded(F.col("o"), F.col("n"))) == [c[2] for c in cases]
    assert values(spark, [("a  b\n2026-07-01 10:30 5000",)], "t string", text.for_diff(F.col("t"))) == ["a b   5000"]
    html = "<p>한 줄</p><script>x()</script><style>p{}</style><div>a &amp; b</div>\n\n"
    assert values(spark, [(html,)], "t string", text.html_to_text(F.col("t"))) == ["한 줄\na & b"]


def test_dictionaries(spark):
    assert values(spark, [("SAP, Excel 우대",), ("없음",)], "t string", text.tools(F.col("t"))) == ["EXCEL, SAP", None]
    from listwright.config import DEFAULT

    assert values(spark, [("AICPA 우대",)], "t string", text.tags(F.col("t"), DEFAULT.certificates)) == [["CPA", "AICPA"]]


def test_classify_makes_lower_case_once_for_each_text(spark):
    from listwright.config import DEFAULT
    from listwright.plans.classify import classify

    rows = spark.createDataFrame([(1, "넥슨", "회계", "SAP 경 력 3 년 이상\n연봉 3,0 00 ~ 4,000 만 원\n자격요건\n- 공인회계사 우대함\n기업뉴스 CTA"), (2, "x", "세무", None)], "id long, company_name string, title string, raw_html string")
    out = classify(rows, DEFAULT)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(_both") == 1 and plan.count("locate(기업뉴스") == 1
    got = {r.job_id: r for r in out.collect()}
    assert (got[1].min_experience, got[1].salary_min, got[1].salary_max, got[1].tools_used, got[1].key_requirements, got[1].preferred_certifications) == (3, 3000, 4000, "SAP", ["공인회계사 우대함"], ["CPA"])
    assert (got[2].min_experience, got[2].salary_min, got[2].tools_used, got[2].key_requirements, got[2].primary_category) == (0, None, None, [], "세무")
