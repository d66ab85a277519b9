"""Queries: rule filters and text features."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from listwright.functions import dates as T
from listwright.functions import text as X
from listwright.operators import sections as S

from .registry import query
from .views import LATIN, posts, table, with_views

SQUEEZED = "regexp_replace(raw, '\\s+', '', 'g')"
WORD_IN = "regexp_matches(lower(title), '(^|[^\\p{L}\\p{N}_])in([^\\p{L}\\p{N}_]|$)')"


@query(with_views(f"SELECT id, NOT regexp_matches(lower(title), 'idiot|clown|&') AND (regexp_matches(title, 'The|Of') OR regexp_matches(lower(title), 'ment|eau') OR regexp_matches(title, '(er|in)\\s?and') OR {WORD_IN}) AS accepted FROM v_post", "v_post"))
def keyword_filter(spark, sf_dir):
    return posts(spark, sf_dir).select("id", X.title_accepted(F.col("title"), LATIN.titles).alias("accepted"))


@query("SELECT p_partkey, NOT (regexp_matches(lower(p_name), 'gizmo') OR regexp_matches(lower(p_type || ' ' || p_brand), 'gizmo|promo')) AND (regexp_matches(lower(p_name), 'small|red|brand#1') OR regexp_matches(lower(p_type || ' ' || p_brand), 'small|red|brand#1')) AS accepted, NOT (regexp_matches(lower(p_type), 'gizmo') OR regexp_matches(lower(p_name), 'gizmo|idiot|clown|&')) AS platform_ok FROM part")
def two_column_filter(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", X.company_accepted(F.col("p_name"), F.concat_ws(" ", "p_type", "p_brand"), LATIN.companies).alias("accepted"), X.platform_accepted(F.col("p_type"), F.col("p_name"), LATIN.companies, LATIN.titles).alias("platform_ok"))


@query("SELECT p_partkey, reason, reason <> '' AS accepted FROM (SELECT p_partkey, concat_ws(', ', CASE WHEN regexp_matches(lower(p_name), 'small|red|old') THEN 'name:' || regexp_extract(lower(p_name), '(small|red|old)', 1) END, CASE WHEN regexp_matches(lower(p_type), 'small|red|old') THEN 'type:' || regexp_extract(lower(p_type), '(small|red|old)', 1) END) AS reason FROM part)")
def filter_reason(spark, sf_dir):
    reason = X.filter_reason({"name": F.col("p_name"), "type": F.col("p_type")}, ("small", "red", "old"))
    return table(spark, sf_dir, "part").select("p_partkey", reason.alias("reason")).withColumn("accepted", F.col("reason") != "")


@query(with_views(f"SELECT id, regexp_matches({SQUEEZED}, 'licensed|andthe|delala') AS marked, length(raw) >= 120 AND regexp_matches({SQUEEZED}, 'licensed|andthe|delala') AS body_ok FROM v_post", "v_post"))
def marker_flag(spark, sf_dir):
    return posts(spark, sf_dir).select("id", X.has_markers(F.col("raw"), LATIN.body_markers).alias("marked"), X.body_accepted(F.col("raw"), LATIN).alias("body_ok"))


NAV = "contains(raw, 'the ')::INT + contains(raw, 'and ')::INT + contains(raw, 'la ')::INT + contains(raw, 'de ')::INT + contains(raw, 'der ')::INT >= 2"
BOILER = f"(NOT regexp_matches({SQUEEZED}, 'licensed|andthe|delala') AND NOT regexp_matches({SQUEEZED}, 'theand|ofthe') AND {NAV})"


@query(with_views(f"SELECT id, {BOILER} AS boilerplate FROM v_post", "v_post"))
def boilerplate_flag(spark, sf_dir):
    return posts(spark, sf_dir).select("id", X.is_boilerplate(F.col("raw"), LATIN).alias("boilerplate"))


@query(with_views(f"SELECT id, length(CASE WHEN {BOILER} THEN title ELSE raw END) AS body_len FROM v_post", "v_post"))
def boilerplate_reset(spark, sf_dir):
    return posts(spark, sf_dir).select("id", F.length(F.when(X.is_boilerplate(F.col("raw"), LATIN), F.col("title")).otherwise(F.col("raw"))).alias("body_len"))


@query("SELECT source, sha256(text) AS body, count(*) AS n FROM documents GROUP BY ALL HAVING count(*) > 1")
def same_body_audit(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("source", F.sha2("text", 256).alias("body")).agg(F.count("*").alias("n")).where("n > 1")


CONTACT = LATIN.contact


@query(f"SELECT doc_id AS id, p - 1 AS pos FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS p FROM documents) WHERE regexp_matches(line, '{CONTACT}')")
def contact_lines(spark, sf_dir):
    return S.lines_of(posts(spark, sf_dir), "id", "raw").where(X.matches(F.col("line"), LATIN.contact)).select("id", "pos")


@query("SELECT o_orderkey, NOT regexp_matches(badge, 'closed\\s*\\(~') AS open FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'closed (~05/01)' WHEN o_orderkey % 5 = 1 THEN 'books closed' ELSE o_orderpriority END AS badge FROM orders)")
def badge_exclude(spark, sf_dir):
    k = F.col("o_orderkey") % 5
    badge = F.when(k == 0, "closed (~05/01)").when(k == 1, "books closed").otherwise(F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").select("o_orderkey", (~X.matches(badge, LATIN.closed_badge)).alias("open"))


@query(with_views("SELECT id, CASE WHEN regexp_matches(lower(raw), 'ationth|on\\s+the\\s+in') THEN 'remote' WHEN regexp_matches(lower(raw), 'de\\s+la|und\\s+der') THEN 'hybrid' WHEN regexp_matches(lower(raw), 'of\\s+and|ciónes') THEN 'site' ELSE 'unknown' END AS work_type, CASE WHEN regexp_matches(lower(title), 'tax|eau') THEN 'tax' WHEN regexp_matches(lower(title), 'tion|treasury') THEN 'treasury' ELSE 'accounting' END AS category FROM v_post", "v_post"))
def rule_class(spark, sf_dir):
    return posts(spark, sf_dir).select("id", X.work_type(F.col("raw"), LATIN).alias("work_type"), X.category(F.col("title"), LATIN).alias("category"))


PHRASES = "CASE o_orderkey % 9 WHEN 0 THEN 'exp' || a || 'y~' || b || 'y' WHEN 1 THEN a || '~' || b || 'th' WHEN 2 THEN 'exp:' || a || '-' || b || 'y' WHEN 3 THEN a || 'yplus' WHEN 4 THEN a || 'ymost' WHEN 5 THEN a || 'yabout' WHEN 6 THEN 'exp' || a || 'y' WHEN 7 THEN 'expany' ELSE 'none' || a END"
RANGE = f"o AS (SELECT o_orderkey, (o_custkey % 50)::INT AS a, (o_orderkey % 60)::INT AS b FROM orders), q AS (SELECT *, {PHRASES} AS phrase FROM o)"


def _phrases(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 50).cast("int").alias("a"), (F.col("o_orderkey") % 60).cast("int").alias("b"))
    forms = ["concat('exp', a, 'y~', b, 'y')", "concat(a, '~', b, 'th')", "concat('exp:', a, '-', b, 'y')", "concat(a, 'yplus')", "concat(a, 'ymost')", "concat(a, 'yabout')", "concat('exp', a, 'y')", "'expany'", "concat('none', a)"]
    return o.withColumn("phrase", F.expr("CASE o_orderkey % 9 " + " ".join(f"WHEN {i} THEN {f}" for i, f in enumerate(forms)) + " END"))


@query(with_views("SELECT o_orderkey, CASE o_orderkey % 9 WHEN 0 THEN a WHEN 3 THEN a WHEN 4 THEN 0 WHEN 5 THEN greatest(0, a - 1) WHEN 6 THEN a WHEN 7 THEN 0 WHEN 8 THEN NULL ELSE CASE WHEN a <= b AND b <= 40 THEN a END END AS min_years, CASE o_orderkey % 9 WHEN 4 THEN a WHEN 5 THEN a + 1 WHEN 3 THEN NULL WHEN 6 THEN NULL WHEN 7 THEN NULL WHEN 8 THEN NULL ELSE CASE WHEN a <= b AND b <= 40 THEN b END END AS max_years FROM q", more=RANGE))
def range_extract(spark, sf_dir):
    """A range that fails the guard falls through: its first form still names a lower bound by the last rule."""
    y = X.experience_phrase(F.col("phrase"), False, LATIN, year="y", anchor="exp", none=("expany",), over="plus", under="most", about="about", nth="th")
    return _phrases(spark, sf_dir).select("o_orderkey", y.alias("y")).select("o_orderkey", "y.min_years", "y.max_years")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 3000 + o_custkey % 100 WHEN o_orderkey % 3 = 1 THEN 4000 + o_custkey % 100 END::INT AS salary_min, CASE WHEN o_orderkey % 3 = 0 THEN 5000 END::INT AS salary_max FROM orders")
def money_range(spark, sf_dir):
    k = F.col("o_orderkey") % 3
    t = F.when(k == 0, F.concat(F.lit("pay 3,0"), F.lpad((F.col("o_custkey") % 100).cast("string"), 2, "0"), F.lit(" ~ 5,000만원"))).when(k == 1, F.concat(F.lit("4,0"), F.lpad((F.col("o_custkey") % 100).cast("string"), 2, "0"), F.lit("만원 이상"))).otherwise("by rule")
    return table(spark, sf_dir, "orders").select("o_orderkey", X.salary(t).alias("s")).select("o_orderkey", "s.salary_min", "s.salary_max")


def _first(markers, expr="raw"):
    return "least(" + ", ".join(f"nullif(instr({expr}, '{m}'), 0)" for m in markers) + ")"


SECTION = f"s AS (SELECT id, raw, {_first(LATIN.requirement_start)} AS a FROM v_post), e AS (SELECT id, raw, a, " + "least(" + ", ".join(f"CASE WHEN instr(substr(raw, a + 1), '{m}') > 0 THEN a + instr(substr(raw, a + 1), '{m}') END" for m in LATIN.requirement_end) + ") AS z FROM s)"


@query(with_views("SELECT id, CASE WHEN a IS NOT NULL THEN substr(raw, a, least(coalesce(z, length(raw) + 1) - a, 2000)) END AS section FROM e", "v_post", more=SECTION))
def section_slice(spark, sf_dir):
    return posts(spark, sf_dir).select("id", X.requirement_section(F.col("raw"), LATIN).alias("section"))


@query(with_views(f"SELECT id, md5(CASE WHEN {_first(LATIN.tail_markers)} IS NOT NULL THEN left(raw, {_first(LATIN.tail_markers)} - 1) ELSE raw END) AS head_md5 FROM v_post", "v_post"))
def tail_cut(spark, sf_dir):
    return posts(spark, sf_dir).select("id", F.md5(X.without_tail(F.col("raw"), LATIN)).alias("head_md5"))


TAGS = "nullif(array_to_string(list_sort(list_filter([" + ", ".join(f"CASE WHEN contains(lower(raw), '{w}') THEN '{w.upper()}' END" for w in LATIN.tools) + "], lambda x: x IS NOT NULL)), ', '), '')"
CERTS = "concat_ws(',', CASE WHEN regexp_matches(lower(raw), 'ation|eur') THEN 'A' END, CASE WHEN regexp_matches(lower(raw), 'ich |ung') THEN 'B' END, CASE WHEN regexp_matches(lower(raw), 'ción') THEN 'C' END)"


@query(with_views(f"SELECT id, {TAGS} AS tools, {CERTS} AS certificates FROM v_post", "v_post"))
def dict_tags(spark, sf_dir):
    return posts(spark, sf_dir).select("id", X.tools(F.col("raw"), LATIN.tools).alias("tools"), F.array_join(X.tags(F.col("raw"), LATIN.certificates), ",").alias("certificates"))


LINES = "l0 AS (SELECT doc_id AS id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents), l AS (SELECT id, pos, trim(CASE WHEN pos % 5 = 0 THEN CASE (pos // 5) % 3 WHEN 0 THEN 'Requirements' WHEN 1 THEN 'Preferences' ELSE 'Other' END WHEN pos % 3 = 1 THEN '- ' || line ELSE line END) AS line FROM l0), h AS (SELECT *, CASE WHEN contains(line, 'Requirements') THEN 'req' WHEN contains(line, 'Preferences') THEN 'pref' WHEN contains(line, 'Other') THEN 'none' END AS header FROM l), w AS (SELECT id, pos, line, header, coalesce(last_value(header IGNORE NULLS) OVER (PARTITION BY id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'none') AS section FROM h)"


def _lines(spark, sf_dir):
    lines = S.lines_of(posts(spark, sf_dir), "id", "raw")
    header = F.element_at(F.array(F.lit("Requirements"), F.lit("Preferences"), F.lit("Other")), (F.floor(F.col("pos") / 5) % 3 + 1).cast("int"))
    return lines.withColumn("line", F.when(F.col("pos") % 5 == 0, header).when(F.col("pos") % 3 == 1, F.concat(F.lit("- "), "line")).otherwise(F.col("line")))


@query(with_views("SELECT id, pos, section FROM w WHERE header IS NULL", more=LINES))
def section_lines(spark, sf_dir):
    return S.section_lines(_lines(spark, sf_dir), "id", LATIN).select("id", "pos", "section")


@query(with_views("SELECT id, section, array_to_string(list(line ORDER BY pos), '|') AS bullets FROM (SELECT *, row_number() OVER (PARTITION BY id, section ORDER BY pos) AS n FROM (SELECT id, pos, section, trim(regexp_replace(line, '^[-*•\\s\\d.]+', '')) AS line FROM w WHERE header IS NULL AND section <> 'none' AND regexp_matches(line, '^([-*•]|[1-5]\\.)')) WHERE length(line) > 5 AND length(line) < 100 AND NOT regexp_matches(line, '" + CONTACT + "')) WHERE n <= 5 GROUP BY id, section", more=LINES))
def section_bullets(spark, sf_dir):
    """One fold over the lines of each body; the plan has no exchange."""
    header = F.array(F.lit("Requirements"), F.lit("Preferences"), F.lit("Other"))
    line = lambda x, i: F.when(i % 5 == 0, F.get(header, F.floor(i / 5).cast("int") % 3)).when(i % 3 == 1, F.concat(F.lit("- "), x)).otherwise(x)
    found = posts(spark, sf_dir).select("id", S.bullets_of(F.transform(F.split("raw", "\n"), line), LATIN).alias("b"))
    each = F.array(*[F.struct(F.lit(s).alias("section"), F.col(f"b.{s}").alias("bullets")) for s in ("req", "pref")])
    return found.select("id", F.explode(each).alias("e")).where(F.size("e.bullets") > 0).select("id", "e.section", F.array_join("e.bullets", "|").alias("bullets"))


@query("SELECT p_partkey, '1. ' || p_brand || ' ' || p_type || ' 직무 - ''' || p_name || ''' 채용 공고' || chr(10) || '2. 근무 요건: x | ' || CASE WHEN p_size % 4 = 0 AND p_size % 7 = 1 THEN '신입 지원 가능' WHEN p_size % 4 > 0 AND p_size % 7 > 0 THEN '경력 ' || (p_size % 4) || '~' || (p_size % 7) || '년' WHEN p_size % 4 > 0 THEN '경력 ' || (p_size % 4) || '년 이상' ELSE '경력 무관 (신입 지원 가능)' END || chr(10) || '3. 요구 직무 도구 및 핵심 역량: ' || coalesce(CASE WHEN p_size % 2 = 0 THEN 'SAP' END, '공고에 명시 없음') AS summary FROM part")
def summary_text(spark, sf_dir):
    s = F.col("p_size")
    return table(spark, sf_dir, "part").select("p_partkey", X.summary(F.col("p_brand"), F.col("p_type"), F.col("p_name"), F.lit("x"), s % 4, s % 7, F.when(s % 2 == 0, "SAP")).alias("summary"))


@query("SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN DATE '1998-06-15' + (o_custkey % 40)::INT WHEN 1 THEN DATE '1998-06-15' WHEN 2 THEN DATE '1998-06-16' WHEN 3 THEN CASE WHEN datediff('day', DATE '1998-06-15', make_date(1998, month(o_orderdate), least(day(o_orderdate), 28))) < -300 THEN make_date(1999, month(o_orderdate), least(day(o_orderdate), 28)) ELSE make_date(1998, month(o_orderdate), least(day(o_orderdate), 28)) END END AS deadline FROM orders", dates="deadline")
def badge_date(spark, sf_dir):
    k, d = F.col("o_orderkey") % 5, F.to_date("o_orderdate")
    badge = F.when(k == 0, F.concat(F.lit("D-"), F.col("o_custkey") % 40)).when(k == 1, "오늘마감").when(k == 2, "내일 마감").when(k == 3, F.concat(F.lit("~ "), F.lpad(F.month(d).cast("string"), 2, "0"), F.lit("/"), F.least(F.day(d), F.lit(28)), F.lit("(x)"))).otherwise("~13/45")
    return table(spark, sf_dir, "orders").select("o_orderkey", T.badge_date(badge, F.to_date(F.lit("1998-06-15"))).alias("deadline"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 17 <> 0 AND datediff('day', DATE '1998-06-15', o_orderdate::DATE) <= 365 THEN o_orderdate::DATE END AS due FROM orders", dates="due")
def due_cap(spark, sf_dir):
    t = F.when(F.col("o_orderkey") % 17 == 0, "soon-ish!!").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
    return table(spark, sf_dir, "orders").select("o_orderkey", T.due_date(t, F.to_date(F.lit("1998-06-15"))).alias("due"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN 'open' ELSE month(o_orderdate) || '/' || day(o_orderdate) END AS label FROM orders")
def md_label(spark, sf_dir):
    t = F.when(F.col("o_orderkey") % 17 == 0, "unknown").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return table(spark, sf_dir, "orders").select("o_orderkey", T.month_day(t, F.lit("open")).alias("label"))


@query(with_views("SELECT id, trim(CASE WHEN regexp_matches(title, '\\s+(?:new|D-?\\d+|the)\\b') THEN string_split_regex(title, '\\s+(?:new|D-?\\d+|the)\\b')[1] ELSE title END) AS shown FROM v_post", "v_post"))
def title_cut(spark, sf_dir):
    return posts(spark, sf_dir).select("id", X.title_cut(F.col("title"), r"\s+(?:new|D-?\d+|the)\b").alias("shown"))


@query(with_views("SELECT id, min_years, max_years FROM (SELECT p.id, CASE WHEN p.id % 4 = 0 THEN p.id % 30 WHEN p.id % 4 = 1 THEN p.id % 20 WHEN p.id % 4 = 2 THEN 0 ELSE 0 END::INT AS min_years, CASE WHEN p.id % 4 = 0 THEN p.id % 30 + 2 WHEN p.id % 4 = 2 THEN 1 END::INT AS max_years FROM v_post p)", "v_post"))
def scoped_extract(spark, sf_dir):
    i = F.col("id")
    title = F.when(i % 4 == 0, F.concat(F.lit("회계 ("), i % 30, F.lit("~"), i % 30 + 2, F.lit("년)"))).when(i % 4 == 2, "신입 회계").otherwise("회계 담당")
    body = F.when(i % 4 == 1, F.concat(F.lit("경력 경력 "), i % 20, F.lit("년 이상"))).otherwise("본문")
    rows = posts(spark, sf_dir).select("id", title.alias("t"), body.alias("b"))
    return X.with_experience(rows, F.concat_ws("\n", "t", "b"), F.col("t"), name="y").select("id", "y.min_years", "y.max_years")


@query(with_views("SELECT id, CASE WHEN regexp_matches(lower(title), 'tax|eau') THEN 'tax' WHEN regexp_matches(lower(title), 'tion|treasury') THEN 'treasury' ELSE 'accounting' END AS category, " + TAGS.replace("lower(raw)", "lower(title || chr(10) || raw)") + " AS tools, " + CERTS.replace("lower(raw)", f"lower(title || chr(10) || (CASE WHEN {_first(LATIN.tail_markers)} IS NOT NULL THEN left(raw, {_first(LATIN.tail_markers)} - 1) ELSE raw END))") + " AS certificates FROM v_post", "v_post"))
def classify(spark, sf_dir):
    from listwright.plans.classify import classify as run

    return run(posts(spark, sf_dir).select("id", F.col("company").alias("company_name"), "title", F.col("raw").alias("raw_html")), LATIN).select(F.col("job_id").alias("id"), F.col("primary_category").alias("category"), F.col("tools_used").alias("tools"), F.array_join("preferred_certifications", ",").alias("certificates"))


RANKED = ("과장급 이상", "대리 이상 우대", "과장 급여대장 담당", "부장급", "주임 급", "차장 이상", "차장님과 협업")


@query("SELECT o_orderkey, [6, 3, 0, 12, 2, 9, 0][o_orderkey % 7 + 1]::INT AS min_years, NULL::INT AS max_years FROM orders")
def rank_fallback(spark, sf_dir):
    """Years by rank, where nothing else names any: a rank with its suffix or with 'or above', not a word that begins with it."""
    rank = F.get(F.array(*[F.lit(x) for x in RANKED]), (F.col("o_orderkey") % 7).cast("int"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("회계 담당\n"), rank).alias("body"), F.lit("회계 담당").alias("title"))
    return X.with_experience(rows, F.col("body"), F.col("title"), name="y").select("o_orderkey", "y.min_years", "y.max_years")


OPENING = "concat(CASE id % 6 WHEN 0 THEN concat('경력 경력 ', id % 20, '년 이상') WHEN 1 THEN '신입 환영' WHEN 2 THEN '과장급 이상' WHEN 3 THEN 'open' WHEN 4 THEN '경력 3년 ~ 5년' ELSE '5년 이하' END, chr(10), CASE id % 3 WHEN 0 THEN '연봉 3,000 ~ 5,000만원' WHEN 1 THEN '4,500만원 이상' ELSE 'by rule' END, chr(10), 'Requirements', chr(10), '- needs ledger ', id % 7, chr(10), 'Preferences', chr(10), '* audit exam ', id % 5, chr(10), '2. mail a@b.co now', chr(10), 'Other', chr(10), raw)"
BOTH, HEAD = "lower(title || chr(10) || raw)", f"lower(title || chr(10) || (CASE WHEN {_first(LATIN.tail_markers)} IS NOT NULL THEN left(raw, {_first(LATIN.tail_markers)} - 1) ELSE raw END))"
WHOLE = f"""d AS (SELECT id, company, title, {OPENING} AS raw, id % 50 AS n FROM v_post),
f AS (SELECT *, CASE WHEN regexp_matches(lower(title), 'tax|eau') THEN 'tax' WHEN regexp_matches(lower(title), 'tion|treasury') THEN 'treasury' ELSE 'accounting' END AS category,
  CASE id % 6 WHEN 0 THEN id % 20 WHEN 2 THEN 6 WHEN 4 THEN 3 ELSE 0 END::INT AS low, CASE id % 6 WHEN 1 THEN 1 WHEN 4 THEN 5 WHEN 5 THEN 5 END::INT AS high,
  CASE id % 3 WHEN 0 THEN 3000 WHEN 1 THEN 4500 END::INT AS salary_min, CASE id % 3 WHEN 0 THEN 5000 END::INT AS salary_max,
  CASE WHEN regexp_matches({BOTH}, 'ationth|on\\s+the\\s+in') THEN 'remote' WHEN regexp_matches({BOTH}, 'de\\s+la|und\\s+der') THEN 'hybrid' WHEN regexp_matches({BOTH}, 'of\\s+and|ciónes') THEN 'site' ELSE 'unknown' END AS work_type,
  CASE WHEN n = 12 THEN 200 WHEN n IN (1, 4) OR n BETWEEN 10 AND 19 OR n BETWEEN 40 AND 49 THEN 100 WHEN n = 3 THEN 300 END::INT AS revenue, {TAGS.replace("lower(raw)", BOTH)} AS tools, {CERTS.replace("lower(raw)", HEAD)} AS certificates,
  concat_ws(',', CASE WHEN regexp_matches({HEAD}, 'and|und') THEN 'S1' END, CASE WHEN regexp_matches({HEAD}, 'que') THEN 'S2' END, CASE WHEN regexp_matches({HEAD}, 'zzz') THEN 'S3' END) AS skills FROM d)"""
ASKED = "CASE WHEN low = 0 AND high = 1 THEN '신입 지원 가능' WHEN low > 0 AND coalesce(high, 0) > 0 THEN '경력 ' || low || '~' || high || '년' WHEN low > 0 THEN '경력 ' || low || '년 이상' ELSE '경력 무관 (신입 지원 가능)' END"


@query(with_views(f"""SELECT id AS job_id, category AS primary_category, low AS min_experience, high AS max_experience, salary_min, salary_max, work_type, revenue AS company_revenue, (revenue // 10)::INT AS company_size, 'needs ledger ' || (id % 7) AS key_requirements, 'audit exam ' || (id % 5) AS preferred_skills, tools AS tools_used,
'1. ' || company || ' ' || category || ' 직무 - ''' || title || ''' 채용 공고' || chr(10) || '2. 근무 요건: ' || work_type || ' | ' || {ASKED} || chr(10) || '3. 요구 직무 도구 및 핵심 역량: ' || coalesce(tools, '공고에 명시 없음') AS ai_summary,
certificates AS preferred_certifications, skills AS preferred_skills_tags FROM f""", "v_post", more=WHOLE))
def category_rows(spark, sf_dir):
    """All 15 columns of the classifier; lists are joined by '|' or ','."""
    from listwright.plans.classify import classify as run

    rules = replace(LATIN, presets=(("co 1", 100, 10), ("co 12", 200, 20), ("co 3 x", 300, 30)), preset_fallbacks=(("co4", "co 1"),))
    rows = run(posts(spark, sf_dir).select("id", F.col("company").alias("company_name"), "title", F.expr(OPENING).alias("raw_html")), rules)
    texts = {c: F.array_join(c, sep) for c, sep in (("key_requirements", "|"), ("preferred_skills", "|"), ("preferred_certifications", ","), ("preferred_skills_tags", ","))}
    return rows.withColumns(texts)


@query("SELECT p_partkey, p_size, p_type FROM part WHERE contains(p_name, 'bolt') AND p_type IN ('SMALL', 'LARGE') AND p_size % 10 <= 6 AND coalesce(CASE WHEN p_size % 3 <> 0 THEN p_size % 10 + 3 END, 99) >= 4")
def faceted_search(spark, sf_dir):
    from listwright.plans.classify import faceted

    rows = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_type", F.col("p_name").alias("text"), F.col("p_type").alias("category"), (F.col("p_size") % 10).alias("min_experience"), F.when(F.col("p_size") % 3 != 0, F.col("p_size") % 10 + 3).alias("max_experience"))
    return faceted(rows, "bolt", ("SMALL", "LARGE"), 4, 6).select("p_partkey", "p_size", "p_type")
