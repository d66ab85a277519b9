"""License scans, source divergence and spelling variants against brute force, with odd rows."""

import collections
import random
import re
import re._parser as regex_parser
import zlib

import pytest
from pyspark.sql import functions as F

from listwright.llm import divergence, html_text, licenses, spelling

DOCS = "doc_id long, text string, lang string, source string"


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def clashing(df, *names):
    return df.withColumns({n: F.lit("clash") for n in names})


# Licenses


def sample(pattern):
    """A short text that the pattern matches."""

    def of(tree):
        out = ""
        for op, arg in tree:
            name = str(op)
            if name == "LITERAL":
                out += chr(arg)
            elif name == "SUBPATTERN":
                out += of(arg[-1])
            elif name == "BRANCH":
                out += of(arg[1][0])
            elif name in ("MAX_REPEAT", "MIN_REPEAT"):
                out += of(arg[2]) * arg[0]
            elif name == "IN":
                kind, value = arg[0]
                out += {"LITERAL": lambda v: chr(v), "CATEGORY": lambda v: "1" if "DIGIT" in str(v) else "x", "NEGATE": lambda v: "x"}[str(kind)](value)
            else:
                raise AssertionError(name)
        return out

    return of(regex_parser.parse(pattern))


def test_rules_are_gated_by_words_that_they_match():
    own = licenses.rules()
    assert len(own) > 300 and len({r.pattern for r in own}) > 300
    for r in own:
        text = sample(r.pattern)
        assert re.fullmatch(r.pattern, text, re.ASCII), r
        assert r.keyword and r.keyword in text, r
        assert any(s in f" {text} " for s in licenses.STEMS), r
        assert any(d[5] == r.label for d in licenses.Scanner([r]).scan(f"x {text} y")), r


def brute_settled(found):
    kept = []
    for d in sorted((d for d in found if not d[4]), key=lambda d: (d[3], d[0] - d[1], d[2], d[0])):
        if not any((k[0] <= d[0] and d[1] <= k[1]) or (d[0] <= k[0] and k[1] <= d[1]) for k in kept):
            kept.append(d)
    return sorted(kept + [d for d in found if d[4]])


@pytest.mark.parametrize("seed", range(4))
def test_overlaps_are_settled_as_by_comparing_all(seed):
    rng = random.Random(seed)
    for _ in range(200):
        found = []
        for i in range(rng.randint(0, 14)):
            start = rng.randrange(20)
            found.append((start, start + rng.randint(1, 8), i, rng.randrange(4), rng.random() < 0.2, f"l{i % 5}", 0.5))
        assert licenses.settle(found) == brute_settled(found)


NOTICES = ["Licensed under CC BY-NC 4.0.", "the GNU General Public License, version 3", "All rights\nreserved", "Released under the MIT License", "CC-BY", "cc by cc by", "general public", "licensed under the Apache License, Version 2.0", "SPDX-License-Identifier: MPL-2.0"]


def license_docs(rng, n):
    filler = ["some", "Words", "of", "text", "example", "replace", "É", "a cc", "by"]
    return [" ".join(x for _ in range(rng.randint(0, 12)) for x in (rng.choice(filler), rng.choice(NOTICES) if rng.random() < 0.3 else "and")) for _ in range(n)]


def brute_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(text))
    met = []
    for phrase, label in licenses.BASE:
        p = phrase.split()
        met += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    starts = [i for i, _ in met]
    return len(words), len(met), min(starts, default=None), max(starts, default=None), sorted({x for _, x in met})


def test_license_scan(spark):
    rng = random.Random(5)
    texts = [*license_docs(rng, 120), None, "", " .\n", "cc by " * 30000]
    docs = clashing(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), "joined", "label", "start", "rule")
    got = {r.doc_id: r for r in licenses.scan_licenses(docs).collect()}
    whole = licenses.Scanner(licenses.rules())
    for i, text in enumerate(texts):
        r = got[i]
        base = [d for d in r.detections if d.base]
        starts = [d.start for d in base]
        assert (r.n_words, len(base), min(starts, default=None), max(starts, default=None), sorted({d.label for d in base})) == brute_base(text)
        joined = " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(text)))
        assert [(d.start, d.end, d.label) for d in r.detections] == [(d[0], d[1], d[5]) for d in whole.scan(joined)]
        assert r.joined == r.label == r.start == r.rule == "clash"
    named = {d.label for r in got.values() for d in r.detections}
    assert {"cc-by-nc-4.0", "gpl-3.0", "mit", "apache-2.0", "mpl-2.0", "reserved"} <= named
    assert licenses.scan_licenses(docs.limit(0)).count() == 0
    twice = licenses.scan_licenses(docs.where("doc_id = 3").union(docs.where("doc_id = 3"))).collect()
    assert len(twice) == 2 and twice[0] == twice[1]


# Divergence


def brute_divergence(rows, least, most):
    terms = collections.defaultdict(lambda: collections.defaultdict(collections.Counter))
    seen = collections.defaultdict(collections.Counter)
    for _, text, lang, source in rows:
        own = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", fold(text))
        terms[lang or ""][source or ""].update(own)
        seen[lang or ""].update(set(own))
    out = []
    for lang, groups in terms.items():
        kept = sorted(t for t, n in seen[lang].items() if n >= least)
        v = len(kept)
        whole = collections.Counter()
        for c in groups.values():
            whole.update({t: c[t] for t in kept})
        price = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[x] for x in kept) + 5 * v) for t in kept}  # noqa: B023, E731
        p, q = {s: price(c) for s, c in groups.items()}, price(whole)
        for s in groups:
            pairs = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in groups if o != s)
            gains = sorted((q[t] - p[s][t], t) for t in kept if groups[s][t] and p[s][t] > q[t])[:most]
            out += [(lang, s, part, x, -n, i + 1) for part, found in (("pair", pairs), ("term", gains)) for i, (n, x) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("block", [5, 40, 10**6])
def test_source_divergence(spark, block):
    rng = random.Random(block)
    vocabulary = [f"t{chr(97 + i % 26)}{chr(97 + i // 26)}é" for i in range(60)]
    rows = [(i, " ".join(rng.choices(vocabulary, [1 / (k + 1) for k in range(60)], k=rng.randint(0, 30))), rng.choice(["en", "fr"]), f"s{rng.randrange(5)}") for i in range(150)]
    rows += [(None, None, None, None), (7, "", None, "a"), (8, "one two", "xx", "alone"), (9, "A1b-C", "en", None), (9, "A1b-C", "en", None), (10, "zz " * 40000, "en", "s1")]
    docs = clashing(spark.createDataFrame(rows, DOCS), "term", "n", "total", "block", "item", "value", "rank")
    got = divergence.source_divergence(docs, least_docs=3, most_terms=10, block_entries=block)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == brute_divergence(rows, 3, 10)


def test_divergence_of_nothing(spark):
    assert divergence.source_divergence(spark.createDataFrame([], DOCS)).count() == 0


def test_equal_subtrees_are_one_node():
    import numpy as np

    counts = np.array([[3, 0, 0, 0, 3, 0, 0, 0], [3, 0, 0, 0, 1, 0, 0, 0], [0] * 8])
    tree, place = np.nonzero(counts)
    forest = divergence.Forest(tree, place, counts[tree, place], 3, 3)
    assert [len(left) for left, _ in forest.halves] == [3, 3, 3] and forest.root[2] == 0  # zero, with 3, with 1; then both roots
    walk = forest.walk(np.zeros(2, np.int64), np.array([0, 0]), np.array([1, 2]))
    total = walk.price(np.abs(walk.counts[0] - walk.counts[1]), np.add)[0][walk.top]
    assert total.tolist() == [2, 6]
    assert len(walk.counts[0]) == 4  # of 16 pairs of leaves: (0, 0), (3, 3), (3, 1), (3, 0)


# Spelling


def brute_words(rows, least_chars=7):
    n = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = fold(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += len(run) >= least_chars
    return {w: c for w, c in n.items() if c >= 2}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_forms(words):
    out = {}
    for w, n in words.items():
        around = [x for x in words if near(w, x)]
        best = min(around, key=lambda x: (-words[x], x), default=None)
        form = best if best and words[best] >= 10 * n else None
        out[w] = [form, w, n, len(around), words[form] if form else None]
    for w, r in out.items():
        while out[r[1]][0]:
            r[1] = out[r[1]][0]
    return {w: tuple(r) for w, r in out.items()}


def test_corpus_words(spark):
    rng = random.Random(2)
    base = ["Kilometer", "réservés", "naïveté", "ÀÉÎÕÜßÿ", "x" * 500, "shorter", "sixsix"]
    rows = [(i, " ".join(rng.choices(base, k=20)) + "9Kilometer_kilometer") for i in range(80)]
    rows += [(None, "Kilometer kilometer"), (3, None), (4, ""), (5, " -- "), (6, "longword " * 20000), (6, "longword longword")]
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string"), "doc", "run", "h", "word", "n")
    got = {r.word: r.n for r in spelling.corpus_words(docs).collect()}
    assert got == brute_words(rows) and any(len(w) == 499 for w in got)


@pytest.mark.parametrize("shard", [3, 50, 4096])
def test_variant_groups(spark, shard):
    rng = random.Random(shard)
    words = {}
    for _ in range(60):
        w = "".join(rng.choices("eiantrsuéq", k=rng.randint(7, 9)))
        words[w] = rng.choice([2, 30, 400, 5000])
        for _ in range(6):
            i, c = rng.randrange(len(w)), rng.choice("eiansxyé")
            other = rng.choice([w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :]])
            words[other] = rng.choice([2, 3, 30, 400])
    words |= {"a" * 300: 100, "a" * 301: 2, "aaaa": 5, "aaab": 50, "b": 3}
    chain = ["kilometr", "kilometer", "kilometern", "kilometerns"]
    words |= {w: 2 * 10**i for i, w in enumerate(chain)}
    df = clashing(spark.createDataFrame(list(words.items()), "word string, n long"), "shard", "form", "root", "near")
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variant_groups(df, shard_words=shard).collect()}
    assert got == brute_forms(words)
    assert got["kilometr"][1] == "kilometerns"


def test_variants_of_nothing(spark):
    assert spelling.variant_groups(spark.createDataFrame([], "word string, n long")).count() == 0


def test_the_search_spends_a_surplus_and_a_deficit():
    """Letters of one group leave all counts alone; words out of budget are never compared."""
    import pyarrow as pa

    held = pa.RecordBatch.from_pydict({"shard": ["s"] * 4, "asks": [False] * 4, "word": ["teaspoon", "teaspeon", "teaspxxn", "noopsaet"], "n": [1, 2, 3, 4]})
    trie = spelling.Trie([held])
    rows = spelling.letters(pa.chunked_array([["teaspaon", "teaspoon"]]))
    asking, found = trie.near(rows, 1, 1)
    names = trie.table.column("word").to_pylist()
    assert sorted((int(a), names[b]) for a, b in zip(asking, found, strict=True)) == [(0, "teaspeon"), (0, "teaspoon")]


# Pages


LONG = "A paragraph of the article that is long enough to be taken for text by any window."
PARAGRAPHS = [f"{LONG} {i}" for i in range(6)]


def as_html(paragraphs):
    return "".join(f"<p>{p}</p>" for p in paragraphs)


@pytest.mark.parametrize("stray", ['<p title=5">', "<p class=it's>", '<td width=5">', "<p data-x='5\">", '<p title = "a>b">', "<p title='\">\">'>", '<p "x>'])
def test_stray_quotes_in_attributes(stray):
    body = as_html(PARAGRAPHS)
    tag = stray[1:].split()[0]
    page = f"<body><article>{as_html(PARAGRAPHS[:2])}{stray}{PARAGRAPHS[2]}</{tag}>{as_html(PARAGRAPHS[3:])}</article></body>"
    got = html_text.main_text(page)
    if stray == "<p title='\">\">'>" or '="' in stray or "= " in stray or stray in ('<p title=5">', "<p class=it's>", '<td width=5">', "<p data-x='5\">", '<p "x>'):
        assert got == "\n".join(PARAGRAPHS)
    assert html_text.main_text(f"<article>{body}</article>") == "\n".join(PARAGRAPHS)


def test_unclosed_dropped_elements():
    whole, body = "\n".join(PARAGRAPHS), as_html(PARAGRAPHS)
    menu = "<ul><li><a href=x>one</a></li><li><a href=y>two</a></li></ul>"
    assert html_text.main_text(f"<body><nav>{menu}<main>{body}</main></body>") == whole
    assert html_text.main_text(f"<body><nav>{menu}</nav><aside>side text <article>{body}</article></body>") == whole
    assert html_text.main_text(f"<body><div>{body}</div><footer>foot</body>").startswith(whole)
    assert html_text.main_text(f"<body><nav>{menu}<nav>{menu}</nav><main>{body}</main></body>") == whole
    assert html_text.main_text(f"<body><main>{body}</main><aside><article>{LONG * 30}</article></aside></body>") == whole  # closed: all of it goes


def test_an_article_is_whole():
    cells = "".join("<tr>" + "".join(f"<td>{r * 4 + c}</td>" for c in range(4)) + "</tr>" for r in range(8))
    short = "<h1>T</h1><p>x</p><p>y</p>"
    for element in ("article", "main"):
        got = html_text.main_text(f"<body><nav><a href=a>menu</a></nav><{element}>{short}{as_html(PARAGRAPHS)}<table>{cells}</table></{element}><footer>foot</footer></body>")
        assert got == "\n".join(["T", "x", "y", *PARAGRAPHS, *map(str, range(32))])
    linked = f"<article><h2><a href=x>Title in a link</a></h2>{as_html(PARAGRAPHS)}<ul><li><a href=a>more</a></li><li><a href=b>and more</a></li></ul></article>"
    assert html_text.main_text(linked) == "\n".join(["Title in a link", *PARAGRAPHS])


def test_names_in_camel_case():
    whole, body = "\n".join(PARAGRAPHS), as_html(PARAGRAPHS)
    for name in ("siteFooter", "commentList", "adBox", "relatedPosts"):
        assert html_text.main_text(f"<body><article>{body}<div class='{name}'><p>{LONG} elsewhere</p></div></article></body>") == whole
    for name in ("articleHeader", "noSidebar", "hasSidebar"):
        assert html_text.main_text(f"<body><div class='{name}'>{body}</div></body>") == whole


def brute_stretches(sizes, window):
    """Surge and dive by the definition: from a high window both ways to where windows dive."""
    blocks = [sum(sizes[i : i + window]) for i in range(max(1, len(sizes) - window + 1))]
    surge, dive = min(html_text.SURGE, max(blocks) / 2), min(html_text.DIVE, max(blocks) / 8)
    out = set()
    for i, b in enumerate(blocks):
        if b and b >= surge and b >= dive:
            begin = end = i
            while begin and blocks[begin - 1] and blocks[begin - 1] >= dive:
                begin -= 1
            while end + 1 < len(blocks) and blocks[end + 1] and blocks[end + 1] >= dive:
                end += 1
            out.add((begin, min(end + window, len(sizes))))
    return sorted(out)


def test_stretches_by_definition():
    rng = random.Random(9)
    for _ in range(300):
        sizes = [rng.choice([0, 0, 1, 5, 40, 200]) for _ in range(rng.randint(1, 30))]
        for window in (1, 3, 5):
            if any(sizes):
                assert html_text._stretches(sizes, window) == brute_stretches(sizes, window)


# Names


INTERNAL = ["_key", "_bin", "_s", "_cut", "_n", "_left", "_before", "_epochs", "_prior", "_hit", "_listed", "_scan", "_guess", "_id", "_text", "_joined", "_HIT"]


def test_columns_named_like_intermediate_ones_stay(spark):
    from listwright.llm import lang_id, mixing, near_dup, secret_scan, url_filter

    rows = [(i, f"some words of text number {i} and more of them password=hunter{i}x " * 3, "en", f"s{i % 2}", 90) for i in range(8)] + [(8, None, "en", None, 0)]
    docs = spark.createDataFrame(rows, f"{DOCS}, n_chars long")
    named = docs.withColumns({c: F.concat(F.lit(f"{c}:"), F.col("doc_id")) for c in INTERNAL[:-1]})
    urls = spark.createDataFrame([(1, "https://x.com/en/1"), (2, None)], "doc_id long, url string")
    model = lang_id.learn(docs)
    runs = {
        "mix": lambda d: mixing.mix_sources(d, [3.0, 1.0]), "url": lambda d: url_filter.judge_urls(d), "secret": lambda d: secret_scan.scan_secrets(d, labelled=[("password=abcdef1", 9, 16, True), ("name=plainword", 5, 14, False)] * 6),
        "language": lambda d: lang_id.predict(d, model), "near": lambda d: near_dup.drop_near_duplicates(d), "license": lambda d: licenses.scan_licenses(d),
    }
    for name, run in runs.items():
        plain, given = (urls, urls.withColumns({c: F.concat(F.lit(f"{c}:"), F.col("doc_id")) for c in INTERNAL[:9]}).withColumn("_HIT", F.concat(F.lit("_HIT:"), F.col("doc_id")))) if name == "url" else (docs, named)
        out = run(given)
        own = [c for c in given.columns if c not in plain.columns]
        got = out.collect()
        assert got and all(r[c] == f"{c}:{r.doc_id}" for r in got for c in own), name
        rest = [c for c in out.columns if c not in own]
        assert sorted(map(str, out.select(*rest).collect())) == sorted(map(str, run(plain).select(*rest).collect())), name
    assert lang_id.predict(docs.limit(0), model).count() == 0
