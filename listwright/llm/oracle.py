"""DuckDB SQL of the queries that SQL expresses over whole tables."""

from __future__ import annotations

from .mixing import BINS
from .url_filter import LISTED_WORDS, RULES

_WORD = r"[^\x20\x09-\x0D]+"

MIX = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::BIGINT AS size,
    -ln((('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '#' || md5(coalesce(text, '')))), 1, 12))::BIGINT::DOUBLE + 0.5) / {float(1 << 48)!r})
      / CASE WHEN n_chars >= 500 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS key
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
  FROM d GROUP BY source),
c AS (SELECT *, source_size * 2.0::DOUBLE AS cap FROM s),
l AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM c),
t AS (
  SELECT source, source_size, least(cap, coalesce((SELECT arg_min(level, (cap / w)) FROM l x WHERE x.level * x.w <= x.cap) * w, cap)) AS target FROM l),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END::BIGINT AS epochs,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY floor(least((1.0::DOUBLE - exp(-d.key)) * {BINS}, {BINS - 1})), d.key, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS prior
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, epochs * size + greatest(0, least(size, floor(target)::BIGINT - epochs * source_size - prior)) AS taken FROM p
"""


def _rules() -> str:
    ordered = sorted(RULES, key=lambda r: (-len(r[0] + r[1]), r[0], r[1]))
    fits = [(f"(host = '{h}' OR suffix(host, '.{h}')) AND prefix(path, '{p}')", h + p, v) for h, p, v in ordered]
    rule = "CASE " + " ".join(f"WHEN {c} THEN '{r}'" for c, r, _ in fits) + " END"
    verdict = "CASE " + " ".join(f"WHEN {c} THEN '{v}'" for c, _, v in fits)
    listed = "|".join(LISTED_WORDS)
    return f"{rule} AS rule, {verdict} WHEN regexp_matches(host, '(^|[.-])({listed})([.-]|$)') THEN 'block' ELSE 'allow' END AS verdict"


URLS = rf"""
WITH p AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages)
SELECT page_id, host, path, {_rules()} FROM p
"""

DECONTAM = r"""
WITH w AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
i AS (
  SELECT item_id, 10 AS n, array_to_string(words[k:k + 9], ' ') AS gram FROM w, unnest(range(1, len(words) - 8)) AS t(k) WHERE len(words) >= 10
  UNION SELECT item_id, len(words), array_to_string(words, ' ') FROM w WHERE len(words) BETWEEN 1 AND 9),
d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words FROM documents),
n AS (SELECT DISTINCT n FROM i),
g AS (SELECT doc_id, k, n.n, array_to_string(words[k:k + n.n - 1], ' ') AS gram FROM d, n, unnest(range(1, len(words) - n.n + 2)) AS t(k)),
h AS (SELECT g.doc_id, g.k, g.n, i.item_id FROM g JOIN i ON g.n = i.n AND g.gram = i.gram),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM h, unnest(range(k, k + n)) AS t(p) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256 FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(m.n_items, 0) AS n_items, coalesce(m.items_sha256, sha256('')) AS items_sha256, coalesce(c.n_hit > 0, false) AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN m USING (doc_id)
"""

NEAR_DUP = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(words[k:k + 3], ' ') AS shingle FROM d, unnest(range(1, len(words) - 2)) AS t(k) WHERE len(words) >= 4
  UNION SELECT doc_id, array_to_string(words, ' ') || chr(10) FROM d WHERE len(words) BETWEEN 1 AND 3),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * common >= 80 * (x.n + y.n - common)),
r AS (SELECT doc_id AS a, doc_id AS root FROM d UNION SELECT e.b, r.root FROM r JOIN e ON r.a = e.a WHERE r.root < e.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, q.root AS component_id, q.root = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(root) AS root FROM r GROUP BY a) q ON q.a = d.doc_id
"""

REPEATS = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents),
w AS (SELECT doc_id, k, md5(array_to_string(words[k:k + 49], ' ')) AS h FROM d, unnest(range(1, len(words) - 48)) AS t(k) WHERE len(words) >= 50),
f AS (SELECT h, min(doc_id) AS first FROM w GROUP BY h),
g AS (SELECT DISTINCT doc_id, p FROM w JOIN f USING (h), unnest(range(k, k + 50)) AS t(p) WHERE first < doc_id),
x AS (SELECT doc_id, count(*) AS n_removed, list(p) AS gone FROM g GROUP BY doc_id)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(x.n_removed, 0) AS n_removed,
  sha256(array_to_string(CASE WHEN x.gone IS NULL THEN d.words ELSE (SELECT coalesce(list(v ORDER BY p), []) FROM (SELECT unnest(d.words) AS v, generate_subscripts(d.words, 1) AS p) WHERE NOT list_contains(x.gone, p)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN x USING (doc_id)
"""

DIVERGENCE = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
o AS (SELECT row, lang, source, unnest(terms) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM o GROUP BY ALL HAVING count(DISTINCT row) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM o JOIN k USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS terms, sum(total) AS words FROM k GROUP BY lang),
s AS (SELECT lang, source, sum(n) AS own FROM c GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(s.own, 0) + 5 * v.terms))::BIGINT AS p,
    (1 + (1000000000::HUGEINT * (k.total + 5)) // (v.words + 5 * v.terms))::BIGINT AS q
  FROM g JOIN k ON g.lang = k.lang JOIN v ON v.lang = g.lang LEFT JOIN s ON s.lang = g.lang AND s.source = g.source
    LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
e AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
x AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(e.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN e ON e.lang = a.lang AND e.source = a.source AND e.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM x QUALIFY part = 'pair' OR rank <= 50
"""

# CRC-32 of the UTF-8 bytes of '<doc_id>:<run>', of which only the run has letters beyond ASCII, by the usual table of 256 remainders.
SPELLING = r"""
WITH RECURSIVE t AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) AS r(i)),
o AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS doc, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
r AS (SELECT doc, run, count(*) AS n FROM o WHERE length(run) >= 7 GROUP BY ALL),
b AS (
  SELECT *, flatten(list_transform(string_split(doc || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [192 + (unicode(c)::BIGINT >> 6), 128 + (unicode(c)::BIGINT & 63)] END)) AS bytes FROM r),
h AS (SELECT doc, run, n, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM b, t),
w AS (
  SELECT word, sum(n)::BIGINT AS n FROM (SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM h)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
g AS (SELECT word, n, i, left(word, i::INT) AS a, substr(word, i::INT + 2) AS z FROM w, unnest(range(length(word))) AS u(i)),
l AS (
  SELECT x.word, y.word AS near, y.n AS near_n FROM g x JOIN g y ON x.i = y.i AND x.a = y.a AND x.z = y.z AND x.word <> y.word
  UNION SELECT g.word, w.word, w.n FROM g JOIN w ON w.word = g.a || g.z UNION SELECT w.word, g.word, g.n FROM g JOIN w ON w.word = g.a || g.z),
m AS (SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS best, max(near_n) AS best_n FROM l GROUP BY word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * w.n THEN best END AS form, CASE WHEN best_n >= 10 * w.n THEN best_n END AS form_n FROM w LEFT JOIN m USING (word)),
p AS (SELECT word, form AS root FROM f WHERE form IS NOT NULL UNION SELECT p.word, f.form FROM p JOIN f ON p.root = f.word WHERE f.form IS NOT NULL),
q AS (SELECT p.word, p.root FROM p JOIN f ON f.word = p.root WHERE f.form IS NULL)
SELECT f.word, f.form, coalesce(q.root, f.word) AS root, f.n, f.n_near, f.form_n FROM f LEFT JOIN q USING (word)
"""

ORACLE_SQL = {"op2_mix_sources": MIX, "op3_url_filter": URLS, "op10_decontamination": DECONTAM, "op1_minhash_near_dedup": NEAR_DUP, "op7_substring_dedup": REPEATS, "op12_source_divergence": DIVERGENCE, "op13_spelling_variants": SPELLING}
