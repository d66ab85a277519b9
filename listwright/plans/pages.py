"""Queries: landed pages."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from listwright.functions.text import found, html_to_text as to_text, still_accepted
from listwright.sources import pages as P
from listwright.sources.registry import aliases_of, source_registry

from .registry import query
from .views import LATIN, table

CLEAN = "regexp_replace(html, '(?is)<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>', '', 'g')"
PLAIN = "trim(regexp_replace(regexp_replace({x}, '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g'))"


def _text(html: str) -> str:
    """SQL of html_to_text for html without scripts."""
    out = f"regexp_replace({html}, '(?s)<!--.*?-->|<[^>]*>', chr(10), 'g')"
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        out = f"replace({out}, '{entity}', '{char}')"
    return f"regexp_replace(regexp_replace(regexp_replace({out}, '[ \\t]+', ' ', 'g'), ' ?\\n[ \\n]*', chr(10), 'g'), '^[ \\n]+|[ \\n]+$', '', 'g')"


TEXT = _text(CLEAN)
BLOCK = '(?is)<(?:div|section|article)\\b[^>]*class="[^"]*ad[^"]*"[^>]*>(.*?)</(?:div|section|article)>'


@query(f"SELECT page_id, md5({TEXT}) AS text_md5 FROM pages")
def html_to_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.md5(to_text(F.col("html"))).alias("text_md5"))


@query(f"""WITH b AS (SELECT page_id, contains({CLEAN}, '<article>') AS there, regexp_extract_all({CLEAN}, '(?is)<p>(.*?)</p>', 1) AS blocks FROM pages),
r AS (SELECT page_id, unnest(blocks) AS block, generate_subscripts(blocks, 1) - 1 AS pos FROM b WHERE there),
n AS (SELECT page_id, pos, nullif(regexp_extract(block, '(th[a-z]{{3,}})', 1), '') AS native_no, {PLAIN.format(x="regexp_extract(block, '^([^,.]*)', 1)")} AS title, {PLAIN.format(x="regexp_extract(block, '^(.{0,12})', 1)")} AS own FROM r),
o AS (SELECT *, row_number() OVER (PARTITION BY page_id, native_no ORDER BY pos) AS k FROM n WHERE native_no IS NOT NULL)
SELECT page_id, 'ok' AS state, pos, native_no, title, CASE WHEN own = title THEN '' ELSE own END AS company FROM o WHERE k = 1
UNION ALL SELECT page_id, CASE WHEN there THEN 'empty' ELSE 'failed' END, NULL, NULL, NULL, NULL FROM b WHERE page_id NOT IN (SELECT page_id FROM o)""")
def listing_rows(spark, sf_dir):
    out = P.listing_rows(table(spark, sf_dir, "pages"), "<article>", r"(?is)<p>(.*?)</p>", r"(th[a-z]{3,})", r"^([^,.]*)", r"^(.{0,12})", F.to_date(F.lit("2024-01-15")))
    return out.select("page_id", "state", "pos", "native_no", "title", "company")


@query(f"""WITH a AS (SELECT page_id, unnest(regexp_extract_all({CLEAN}, '(?is)(<a\\s[^>]*>.*?</a>)', 1)) AS a, generate_subscripts(regexp_extract_all({CLEAN}, '(?is)(<a\\s[^>]*>.*?</a>)', 1), 1) - 1 AS pos FROM pages),
n AS (SELECT page_id, pos, nullif(regexp_extract(regexp_extract(a, '(?i)href="([^"]*)"', 1), '^/([a-z]+)', 1), '') AS native_no, {PLAIN.format(x="a")} AS title FROM a)
SELECT page_id, pos, native_no, title FROM (SELECT *, row_number() OVER (PARTITION BY page_id, native_no ORDER BY pos) AS k FROM n WHERE native_no IS NOT NULL) WHERE k = 1""")
def anchor_rows(spark, sf_dir):
    return P.anchor_rows(table(spark, sf_dir, "pages"), r"^/([a-z]+)", F.to_date(F.lit("2024-01-15")), LATIN).select("page_id", "pos", "native_no", "title")


@query(f"WITH b AS (SELECT page_id, unnest(regexp_extract_all({CLEAN}, '{BLOCK}', 1)) AS block FROM pages), t AS (SELECT page_id, {_text('block')} AS t FROM b), r AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY length(t) DESC, t DESC) AS k FROM t) SELECT p.page_id, CASE WHEN length(r.t) > 40 THEN r.t ELSE '' END AS body FROM pages p LEFT JOIN r ON p.page_id = r.page_id AND r.k = 1")
def largest_block(spark, sf_dir):
    return P.largest_block(table(spark, sf_dir, "pages"), "ad", 40)


@query(f"SELECT page_id, coalesce(nullif({PLAIN.format(x='regexp_extract(html, ' + chr(39) + '(?is)<h1[^>]*>(.*?)</h1>' + chr(39) + ', 1)')}, ''), url) AS title FROM pages")
def title_coalesce(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", P.corrected_title(F.col("html"), r"^(.*)$", F.col("url")).alias("title"))


@query("SELECT page_id, nullif(regexp_extract(url, '/([a-z]{2})/', 1), '') AS section, nullif(regexp_extract(url, '/(\\d+)', 1), '')::BIGINT AS native_no, nullif(regexp_extract(url, '[?&]page=(\\d+)', 1), '')::INT AS page FROM pages")
def url_ids(spark, sf_dir):
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", found(u, "/([a-z]{2})/").alias("section"), found(u, r"/(\d+)").cast("long").alias("native_no"), found(u, r"[?&]page=(\d+)").cast("int").alias("page"))


@query("WITH p AS (SELECT page_id, regexp_extract(url, '/([a-z]{2})/', 1) AS source, lower(regexp_replace(regexp_extract(html, '(?is)<title>(.*?)</title>', 1), '\\s+', '', 'g')) AS t FROM pages), a(source, alias) AS (VALUES ('en', 'the'), ('de', 'sch'), ('de', 'ung'), ('fr', 'eau')) SELECT page_id, source FROM p WHERE EXISTS (SELECT 1 FROM a WHERE a.source = p.source AND contains(p.t, a.alias))")
def guardrail_semi(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", "/([a-z]{2})/", 1).alias("source"), F.regexp_extract("html", "(?is)<title>(.*?)</title>", 1).alias("page_title"))
    aliases = spark.createDataFrame([("en", "The"), ("de", "S ch"), ("de", "ung"), ("fr", "eau")], "source string, alias string")
    return P.guarded(pages, aliases).select("page_id", "source")


@query("SELECT page_id, (200 + page_id % 230) IN (403, 405, 429) OR contains(lower(left(html, 1000)), 'hetion') OR contains(lower(left(html, 1000)), 'satisfied') AS blocked FROM pages")
def blocked_pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", P.blocked(200 + F.col("page_id") % 230, F.col("html"), ("hetion", "satisfied")).alias("blocked"))


NESTED = "CASE page_id % 3 WHEN 0 THEN replace(replace(replace(html, '<article>', '<article><div class=\"mainContent\" data-x=\"a>b\"><div>'), '</h1>', '</h1><div class=sideContent><div>side</div> x</div>'), '</article>', '</div>tail</div></article>') WHEN 1 THEN replace(replace(html, '<article>', '<div class=\"Content_a\"><article>'), '</article>', '</article></div></div><div class=\"Content_b\">last') ELSE html END"


@query(rf"""WITH h AS (SELECT page_id, regexp_replace(regexp_replace({NESTED}, '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'g'), '(?s)<!--.*?-->', '', 'g') AS html FROM pages),
p AS (SELECT page_id, regexp_extract_all(html, '(</?[A-Za-z](?:[^>"'']+|"[^"]*"|''[^'']*'')*>)', 1) AS tags, string_split_regex(html, '</?[A-Za-z](?:[^>"'']+|"[^"]*"|''[^'']*'')*>') AS pieces FROM h),
e AS (SELECT page_id, unnest(tags) AS tag, generate_subscripts(tags, 1) AS pos FROM p),
m AS (SELECT page_id, unnest(pieces) AS piece, generate_subscripts(pieces, 1) - 1 AS pos FROM p),
l AS (SELECT page_id, pos, length({_text('piece')}) AS n FROM m),
k AS (SELECT e.page_id, e.pos, lower(regexp_extract(tag, '^</?([A-Za-z][A-Za-z0-9]*)', 1)) AS kind, starts_with(tag, '</') AS ends, contains(regexp_extract(tag, '(?is)\sclass\s*=\s*("[^"]*"|''[^'']*''|[^\s>]+)', 1), 'Content') AND NOT starts_with(tag, '</') AS wanted, tag, n FROM e JOIN l USING (page_id, pos)),
b AS (SELECT *, sum(n) OVER (PARTITION BY page_id ORDER BY pos) - n AS before, sum(n) OVER (PARTITION BY page_id) AS whole FROM k),
d AS (SELECT *, sum(CASE WHEN ends THEN -1 ELSE 1 END) OVER (PARTITION BY page_id, kind ORDER BY pos) + ends::INT AS depth FROM b WHERE kind NOT IN ('area', 'base', 'br', 'col', 'embed', 'hr', 'img', 'input', 'link', 'meta', 'source', 'track', 'wbr') AND NOT suffix(tag, '/>')),
x AS (SELECT *, lead(pos) OVER w AS stop, coalesce(lead(before) OVER w, whole) - before AS size FROM d WINDOW w AS (PARTITION BY page_id, kind, depth ORDER BY pos)),
r AS (SELECT * FROM x WHERE wanted QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY size DESC, pos) = 1),
t AS (SELECT page_id, {_text("array_to_string(pieces[r.pos + 1:coalesce(r.stop, len(pieces))], chr(10))")} AS t FROM p LEFT JOIN r USING (page_id))
SELECT page_id, CASE WHEN length(t) > 80 THEN t ELSE '' END AS body FROM t""")
def nested_block(spark, sf_dir):
    """Blocks in blocks, one that is never closed, an end without a start, a quoted >."""
    return P.nested_block(table(spark, sf_dir, "pages").select("page_id", F.expr(NESTED).alias("html")), "Content")


BOARDS = (("en", "The Board", "html", "1"), ("de", "Ung Haus", "html", "2"), ("fr", "Eau", "html", "3"), ("es", "Ción", "html", "4"))


@query("WITH g AS (SELECT * FROM (VALUES ('en', 'The Board', ['theboard', 'the']), ('de', 'Ung Haus', ['unghaus', 'sch', 'ung']), ('fr', 'Eau', ['eau']), ('es', 'Ción', ['ción'])) AS g(source, company, aliases)), p AS (SELECT regexp_extract(url, '/([a-z]{2})/', 1) AS source, lower(regexp_replace(regexp_extract(html, '(?is)<title>(.*?)</title>', 1), '\\s+', '', 'g')) AS t FROM pages) SELECT g.source, g.company, len(g.aliases)::INT AS n_aliases, count(p.source) AS n_pages, count(*) FILTER (len(list_filter(g.aliases, lambda a: contains(p.t, a))) > 0) AS n_kept FROM g LEFT JOIN p ON p.source = g.source GROUP BY ALL")
def registry_guard(spark, sf_dir):
    """The registry as a table: of each board, how many of its pages pass the guardrail on its names."""
    registry = source_registry(spark, BOARDS, {"en": ("The",), "de": ("S ch", "ung")})
    pages = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", "/([a-z]{2})/", 1).alias("source"), F.regexp_extract("html", "(?is)<title>(.*?)</title>", 1).alias("page_title"))
    count = lambda rows, name: rows.groupBy("source").agg(F.count("*").alias(name))
    both = registry.join(count(pages, "n_pages"), "source", "left").join(count(P.guarded(pages, aliases_of(registry)), "n_kept"), "source", "left")
    return both.select("source", "company", F.size("aliases").alias("n_aliases"), F.coalesce("n_pages", F.lit(0)).alias("n_pages"), F.coalesce("n_kept", F.lit(0)).alias("n_kept"))


@query(rf"""WITH c AS (SELECT page_id, coalesce(nullif({PLAIN.format(x="regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")}, ''), url) AS title, html FROM pages), t AS (SELECT *, {_text(CLEAN)} AS body FROM c)
SELECT page_id, title, NOT regexp_matches(lower(title), 'idiot|clown|&') AND (regexp_matches(title, 'The|Of') OR regexp_matches(lower(title), 'ment|eau') OR regexp_matches(title, '(er|in)\s?and') OR regexp_matches(lower(title), '(^|[^\p{{L}}\p{{N}}_])in([^\p{{L}}\p{{N}}_]|$)')) AND ((NOT regexp_matches(lower(title), 'gizmo|promo') AND regexp_matches(lower(title), 'small|red|brand#1')) OR regexp_matches(lower(body), 'tion|zez')) AS accepted FROM t""")
def recheck_corrected(spark, sf_dir):
    """Filters once more, on the title that the page gives in place of the card's."""
    title = P.corrected_title(F.col("html"), r"^(.*)$", F.col("url"))
    rows = table(spark, sf_dir, "pages").select("page_id", title.alias("title"), to_text(F.col("html")).alias("body"))
    rules = replace(LATIN, body_allow=("tion", "zez"))
    return rows.select("page_id", "title", still_accepted(F.lit("board"), F.col("title"), F.col("body"), rules).alias("accepted"))
