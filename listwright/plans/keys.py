"""Queries: dedup, keys, lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from listwright.functions.keys import company_key, display_title as shown, source_rank
from listwright.operators import dedup as D
from listwright.operators import lookups as L

from .registry import query
from .views import LATIN, posts, table, with_views

RANK = "CASE WHEN lower(source) IN ('src1', 'src3', 'src5') THEN 1 ELSE 0 END"
TITLED = "t AS (SELECT id, source, company, CASE WHEN id % 3 = 0 THEN '[co ' || (id % 50) || ' plus] ' || title WHEN id % 3 = 1 THEN '[new] ' || title ELSE title END AS title, 'u/' || id AS url FROM v_post)"
KEYED = f"""{TITLED}, k0 AS (SELECT *, replace(lower(company), ' ', '') AS own, regexp_extract(title, '^\\[([^\\[\\]]{{1,30}})\\]\\s*', 1) AS h0, trim(regexp_replace(title, '^\\[([^\\[\\]]{{1,30}})\\]\\s*', '')) AS rest FROM t),
k1 AS (SELECT *, replace(lower(h0), ' ', '') AS hint FROM k0), k2 AS (SELECT *, length(hint) >= 2 AND (contains(hint, own) OR contains(own, hint)) AS fits FROM k1),
k AS (SELECT id, source, url, title, CASE WHEN fits AND length(hint) > length(own) THEN hint ELSE own END AS company_key, lower(regexp_replace(translate(CASE WHEN fits AND rest <> '' THEN rest ELSE trim(title) END, '[]', '  '), '\\s+', '', 'g')) AS title_key FROM k2)"""


def _titled(spark, sf_dir):
    short = F.col("title")
    title = F.when(F.col("id") % 3 == 0, F.concat(F.lit("[co "), F.col("id") % 50, F.lit(" plus] "), short)).when(F.col("id") % 3 == 1, F.concat(F.lit("[new] "), short)).otherwise(short)
    return posts(spark, sf_dir).select("id", "source", F.col("company").alias("company_name"), title.alias("title"), F.concat(F.lit("u/"), "id").alias("origin_url"), F.col("id").alias("ingest_seq"))


@query(with_views("SELECT id, company_key, title_key FROM k", "v_post", more=KEYED))
def content_key(spark, sf_dir):
    from listwright.functions.keys import content_key as key

    return _titled(spark, sf_dir).select("id", key(F.col("company_name"), F.col("title"), LATIN).alias("k")).select("id", F.col("k.company").alias("company_key"), F.col("k.title").alias("title_key"))


@query(with_views(f"""SELECT company_key, title_key, arg_min(id, rank * 1000000000000 + id) AS id, min(id) AS first_seq, (SELECT string_agg(source || '=' || url, ',' ORDER BY rank, id) FROM (SELECT source, rank, min(id) AS id, arg_min(url, id) AS url FROM r x WHERE x.company_key = r.company_key AND x.title_key = r.title_key GROUP BY source, rank)) AS sources FROM r GROUP BY company_key, title_key""", "v_post", more=f"{KEYED}, r AS (SELECT *, {RANK} AS rank FROM k)"))
def content_merge(spark, sf_dir):
    m = D.content_merge(_titled(spark, sf_dir), LATIN)
    return m.select(F.col("key.company").alias("company_key"), F.col("key.title").alias("title_key"), "id", "first_seq", F.array_join(F.transform("sources", lambda s: F.concat_ws("=", s["source"], s["origin_url"])), ",").alias("sources"))


@query(with_views(f"SELECT id, source, {RANK} AS rank FROM v_post", "v_post"))
def source_ranks(spark, sf_dir):
    return posts(spark, sf_dir).select("id", "source", source_rank(F.col("source"), LATIN).alias("rank"))


@query(with_views("SELECT id, CASE WHEN id % 3 = 1 THEN title WHEN trim(title) = '' THEN title WHEN id % 3 = 0 AND 'co' || (id % 50) || 'plus' = replace(lower(company), ' ', '') THEN title ELSE title END AS shown FROM (SELECT id, company, trim(title) AS title FROM t)", "v_post", more=TITLED))
def display_title(spark, sf_dir):
    return _titled(spark, sf_dir).select("id", shown(F.col("company_name"), F.col("title"), LATIN).alias("shown"))


@query("SELECT s_suppkey, replace(lower(regexp_replace('(주) ' || s_name || ' 주식회사', '\\s+', '', 'g')), '(주)', '').replace('주식회사', '') AS company FROM supplier")
def norm_company(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select("s_suppkey", company_key(F.concat(F.lit("(주) "), "s_name", F.lit(" 주식회사"))).alias("company"))


@query("SELECT o_orderkey, l_linenumber, l_shipmode FROM (SELECT l_orderkey AS o_orderkey, l_linenumber, l_linestatus AS l_shipmode, row_number() OVER (PARTITION BY l_orderkey ORDER BY (l_returnflag = 'N')::INT, l_linenumber, l_partkey, l_suppkey, l_linestatus) AS r FROM lineitem WHERE l_orderkey % 7 <> 0) WHERE r = 1 UNION ALL SELECT NULL, l_linenumber, l_linestatus FROM lineitem WHERE l_orderkey % 7 = 0")
def native_dedup(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.when(F.col("l_orderkey") % 7 != 0, F.col("l_orderkey")).alias("o_orderkey"), "l_linenumber", F.col("l_linestatus").alias("l_shipmode"), "l_returnflag", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_linestatus").alias("seq"))
    return D.native_dedup(rows, "o_orderkey", F.col("l_returnflag") == "N", "seq").select("o_orderkey", "l_linenumber", "l_shipmode")


@query("SELECT user_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value, min(event_id) AS first_seq FROM events GROUP BY user_id")
def last_wins(spark, sf_dir):
    return D.last_wins(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value"), "user_id", "event_id").select("user_id", "event_type", "value", "first_seq")


@query("SELECT event_type, user_id, event_id, place FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS place FROM (SELECT user_id, arg_min(event_type, event_id) AS event_type, min(event_id) AS event_id FROM events WHERE value > 5 GROUP BY user_id)) WHERE place <= 15")
def topk_per_group(spark, sf_dir):
    e = table(spark, sf_dir, "events").where("value > 5").select("user_id", "event_type", "event_id")
    return D.top_per_group(D.first_by(e, ["user_id"], [F.col("event_id")]), "event_type", F.col("event_id"), 15).select("event_type", "user_id", "event_id", "place")


CAPPED = """h AS (SELECT event_type AS source, (event_id % 4 + 1)::INT AS keyword, user_id AS item, min(event_id) AS pos FROM events GROUP BY ALL),
l AS (SELECT source, keyword, list(item ORDER BY pos, item) AS items FROM h GROUP BY ALL),
s AS (SELECT DISTINCT source FROM h),
r AS (SELECT source, 0 AS keyword, []::BIGINT[] AS taken, []::BIGINT[] AS own FROM s
  UNION ALL SELECT r.source, r.keyword + 1, list_concat(r.taken, list_filter(coalesce(l.items, []), lambda x: NOT list_contains(r.taken, x))[:15]), list_filter(coalesce(l.items, []), lambda x: NOT list_contains(r.taken, x))[:15]
  FROM r LEFT JOIN l ON l.source = r.source AND l.keyword = r.keyword + 1 WHERE r.keyword < 4)"""


@query("WITH RECURSIVE " + CAPPED + " SELECT r.source, r.keyword, h.item, h.pos FROM (SELECT source, keyword, unnest(own) AS item FROM r) r JOIN h USING (source, keyword, item)")
def capped_keywords(spark, sf_dir):
    """Four keywords, asked one after the other, 15 new users each."""
    hits = table(spark, sf_dir, "events").select(F.col("event_type").alias("source"), (F.col("event_id") % 4 + 1).cast("int").alias("keyword"), F.col("event_id").alias("pos"), F.col("user_id").alias("item"))
    return D.capped_by_keyword(hits, 15, 4)


CLOSED = "c AS (SELECT 'co ' || (o_custkey % 40) AS company, 'job ' || (o_orderkey % 30) AS title, o_orderdate AS seen FROM orders WHERE o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '1996-01-01'), a AS (SELECT 'co ' || (o_custkey % 40) AS company, 'job ' || (o_orderkey % 30) AS title, o_orderdate AS seen FROM orders WHERE o_orderstatus <> 'F' AND o_orderdate >= TIMESTAMP '1995-12-01')"


def _jobs(spark, sf_dir, where, name):
    return table(spark, sf_dir, "orders").where(where).select(F.concat(F.lit("co "), F.col("o_custkey") % 40).alias("company_name"), F.concat(F.lit("job "), F.col("o_orderkey") % 30).alias("title"), F.col("o_orderdate").alias(name))


@query(with_views("SELECT replace(company, ' ', '') AS company_key, replace(title, ' ', '') AS title_key, max(c.seen)::DATE AS closed_on FROM c JOIN (SELECT company, title, min(seen) AS first FROM a GROUP BY ALL) f USING (company, title) GROUP BY company, title, first HAVING max(c.seen) < first AND datediff('day', max(c.seen)::DATE, first::DATE) >= 2", more=CLOSED), dates="closed_on")
def repost_flags(spark, sf_dir):
    r = D.repost_flags(_jobs(spark, sf_dir, "o_orderstatus <> 'F' and o_orderdate >= timestamp'1995-12-01'", "first_seen_at"), _jobs(spark, sf_dir, "o_orderstatus = 'F' and o_orderdate < timestamp'1996-01-01'", "closed_at"), LATIN)
    return r.select(F.col("key.company").alias("company_key"), F.col("key.title").alias("title_key"), "closed_on")


@query(with_views("SELECT company AS company_name, title, max(seen)::DATE AS closed_on FROM c GROUP BY ALL", more=CLOSED), dates="closed_on")
def closed_history(spark, sf_dir):
    return _jobs(spark, sf_dir, "o_orderstatus = 'F' and o_orderdate < timestamp'1996-01-01'", "closed_at").groupBy("company_name", "title").agg(F.to_date(F.max("closed_at")).alias("closed_on"))


@query("SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01')")
def new_entities(spark, sf_dir):
    return L.new_entities(table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate"), "o_custkey", "o_orderdate", F.lit("1999-01-01").cast("timestamp"))


NAMES = "n AS (SELECT DISTINCT CASE WHEN s_suppkey % 4 = 0 THEN 'NATION_' || (s_suppkey % 25) WHEN s_suppkey % 4 = 1 THEN '㈜ NATION_' || (s_suppkey % 25) WHEN s_suppkey % 4 = 2 THEN s_name || 'NATION_' || (s_suppkey % 25) ELSE s_name END AS name FROM supplier)"


@query(with_views("SELECT name, arg_min(n_name, tier * 1000 + n_nationkey) AS preset, min(tier) AS tier FROM (SELECT name, n_name, n_nationkey, CASE WHEN name = n_name THEN 1 WHEN replace(replace(name, '㈜', ''), ' ', '') = n_name THEN 2 WHEN contains(replace(replace(name, '㈜', ''), ' ', ''), n_name) OR contains(n_name, replace(replace(name, '㈜', ''), ' ', '')) THEN 3 END AS tier FROM n, nation) WHERE tier IS NOT NULL GROUP BY name", more=NAMES))
def tiered_lookup(spark, sf_dir):
    k = F.col("s_suppkey") % 4
    nation = F.concat(F.lit("NATION_"), F.col("s_suppkey") % 25)
    names = table(spark, sf_dir, "supplier").select(F.when(k == 0, nation).when(k == 1, F.concat(F.lit("㈜ "), nation)).when(k == 2, F.concat("s_name", nation)).otherwise(F.col("s_name")).alias("name"))
    presets = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("ord"), F.col("n_name").alias("preset"))
    return L.tiered_lookup(names, presets)


WIDE = "n AS (SELECT DISTINCT p_name || ' ' || p_brand AS name FROM part), p AS (SELECT min(p_partkey) AS ord, p_name AS preset FROM part GROUP BY p_name UNION ALL SELECT p_partkey, p_name || ' ' || p_brand || ' ' || p_partkey FROM part)"


@query(with_views("SELECT name, arg_min(preset, (CASE WHEN name = preset THEN 1 WHEN replace(name, ' ', '') = replace(preset, ' ', '') THEN 2 ELSE 3 END, ord, preset)) AS preset, min(CASE WHEN name = preset THEN 1 WHEN replace(name, ' ', '') = replace(preset, ' ', '') THEN 2 ELSE 3 END) AS tier FROM n JOIN p ON contains(replace(name, ' ', ''), replace(preset, ' ', '')) OR contains(replace(preset, ' ', ''), replace(name, ' ', '')) GROUP BY name", more=WIDE))
def gram_lookup(spark, sf_dir):
    """A dimension that grows with the table: every part is a preset, shorter or longer than the names."""
    part = table(spark, sf_dir, "part")
    names = part.select(F.concat_ws(" ", "p_name", "p_brand").alias("name"))
    short = part.groupBy(F.col("p_name").alias("preset")).agg(F.min("p_partkey").alias("ord"))
    long = part.select(F.concat_ws(" ", "p_name", "p_brand", F.col("p_partkey").cast("string")).alias("preset"), F.col("p_partkey").alias("ord"))
    return L.tiered_lookup(names, short.unionByName(long))
