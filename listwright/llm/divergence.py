"""How sources of a language differ in their terms, priced on hash-consed segment trees.

Terms of a language are dealt into blocks by a hash; in a block, a term's id is its place by falling
total count. Each source has a segment tree of its counts over the ids; equal subtrees of counts, of
whatever source, are one node. Two trees are walked together from their roots, and each distinct pair
of nodes is priced once. A whole tree's price is the sum over blocks, which Spark adds up.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .spelling import LOWER, UPPER
from .store import keep

SCALE = 1_000_000_000
NO_LETTER = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
BLOCK_ENTRIES = 8192  # counts of a block, on average
WALK = 1 << 21  # pairs of trees walked at once, times leaves


def term_counts(docs: DataFrame, least_docs: int = 30) -> DataFrame:
    """(lang, term, total, sources array of (source, n)) of terms in least_docs documents of the language or more.

    docs (lang, source, text); nulls are ''. Terms are runs without ASCII characters that are no
    letters, only A-Z lower-cased. Each row is a document.
    """
    low = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    rows = docs.select(_plain("lang"), _plain("source"), F.split(low, NO_LETTER).alias("terms"))
    # All terms of a document, and after them each of them once more: the places tell which is which.
    twice = rows.select("lang", "source", F.size("terms").alias("size"), F.posexplode(F.concat("terms", F.array_distinct("terms"))).alias("at", "term")).where("term <> ''")
    counts = twice.groupBy("lang", "source", "term").agg(F.count_if(F.col("at") < F.col("size")).alias("n"), F.count_if(F.col("at") >= F.col("size")).alias("docs"))
    by_term = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("sources"))
    return by_term.where(F.col("docs") >= least_docs).select("lang", "term", "total", "sources")


def _plain(column: str):
    return F.coalesce(column, F.lit("")).alias(column)


def source_divergence(docs: DataFrame, least_docs: int = 30, most_terms: int = 50, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """(lang, source, part, item, value, rank) of docs (lang, source, text).

    A source's share of a term is p = 1 + floor(SCALE * (n + 5) / (N + 5 V)): n its count, N the sum of
    n and V the number of kept terms of the language; q is the same of the whole language. Part pair: each other
    source of the language, value the sum of |p - q'| over all kept terms. Part term: terms of the source with
    p > q, value p - q, the most_terms largest. Ranks from 1, ties by item. A source without terms has pairs;
    a language with one source has none; an empty table gives no rows.

    The result has a row for each ordered pair of sources of a language, so pairs are made in full; a task
    holds the counts of one block. Only the table of languages may be broadcast, by Spark's own size check.
    """
    kept = keep(term_counts(docs, least_docs), "divergence-terms")
    size = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum(F.size("sources")).alias("entries"), F.sum("total").alias("words"))
    known = docs.select(_plain("lang"), _plain("source")).distinct()
    entry = kept.select("lang", "term", "total", F.explode("sources").alias("s")).select("lang", "term", "total", "s.source", "s.n")
    own = entry.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    heads = known.join(own, ["lang", "source"], "left").join(size, "lang", "left").na.fill(0, ["own", "terms", "entries", "words"])
    parts = F.greatest(F.lit(1), F.ceil(F.col("entries") / block_entries)).cast("int")
    heads = keep(heads.withColumn("parts", parts), "divergence-groups")
    langs = keep(heads.groupBy("lang").agg(F.max("parts").alias("parts")), "divergence-langs")
    entries = kept.join(langs, "lang").withColumn("block", F.pmod(F.xxhash64("term"), "parts").cast("int")).select("lang", "block", "term", "total", F.explode("sources").alias("s"))
    entries = entries.select("lang", "block", "term", "total", "s.source", "s.n")
    heads = heads.select("lang", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("block"), "source", "own", "terms", "words")
    price = lambda a, b: price_block(a, b, most_terms)
    priced = entries.groupBy("lang", "block").cogroup(heads.groupBy("lang", "block")).applyInPandas(price, "lang string, part string, source string, item string, value long")
    priced = keep(priced, "divergence-prices")
    return _ranked(priced, most_terms)


def _ranked(priced: DataFrame, most_terms: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = priced.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"))))
    pairs = pairs.select("lang", both.alias("e"), "value").select("lang", "e.source", F.lit("pair").alias("part"), "e.item", "value").withColumn("rank", place)
    terms = priced.where("part = 'term'").select("lang", "source", "part", "item", "value").withColumn("rank", place).where(F.col("rank") <= most_terms)
    return pairs.unionByName(terms)


def share(count: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * count / whole) in exact steps of three digits."""
    out, rest = count // whole, count % whole
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // whole, rest % whole
    return out + 1


class Forest:
    """Hash-consed segment trees over 2**depth leaves. Node 0 of each level is the subtree of zeros."""

    def __init__(self, tree: np.ndarray, place: np.ndarray, count: np.ndarray, trees: int, depth: int):
        """count of each leaf that is not zero, in order of tree and place."""
        values, node = np.unique(count, return_inverse=True)
        self.counts = np.concatenate([[0], values]).astype(np.int64)
        self.halves: list[tuple[np.ndarray, np.ndarray]] = []  # of the nodes of each level, leaves first
        node = node + 1
        for _ in range(depth):
            right, place = place & 1, place >> 1
            new = np.ones(len(place), bool)
            new[1:] = (place[1:] != place[:-1]) | (tree[1:] != tree[:-1])
            at = np.cumsum(new) - 1
            half = np.zeros((2, int(new.sum())), np.int64)
            half[right, at] = node
            width = int(node.max(initial=0)) + 1
            pairs, node = np.unique(half[0] * width + half[1], return_inverse=True)
            self.halves.append((np.concatenate([[0], pairs // width]), np.concatenate([[0], pairs % width])))
            node, tree, place = node + 1, tree[new], place[new]
        self.root = np.zeros(trees, np.int64)
        self.root[tree] = node

    def walk(self, kind: np.ndarray, a: np.ndarray, b: np.ndarray) -> Walk:
        """The trees a and b of each row together; rows of one kind have the same prices."""
        return Walk(self, kind, self.root[a], self.root[b])


class Walk:
    """Distinct (kind, node, node) of each level, from the roots of pairs of trees to the leaves."""

    def __init__(self, forest: Forest, kind: np.ndarray, a: np.ndarray, b: np.ndarray):
        self.top, (kind, a, b) = _distinct(kind, a, b)
        self.steps = []  # from the top: places of both halves in the level below
        for left, right in reversed(forest.halves):
            place, (kind, below_a, below_b) = _distinct(np.tile(kind, 2), np.concatenate([left[a], right[a]]), np.concatenate([left[b], right[b]]))
            self.steps.append((place[: len(a)], place[len(a) :]))
            a, b = below_a, below_b
        self.kind, self.counts = kind, (forest.counts[a], forest.counts[b])

    def price(self, leaves: np.ndarray, join: np.ufunc) -> list[np.ndarray]:
        """Prices of each level's pairs, from the top, with leaves at the bottom."""
        out = [leaves]
        for left, right in reversed(self.steps):
            out.append(join(out[-1][left], out[-1][right]))
        return out[::-1]


def _distinct(kind: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    high, low = int(a.max(initial=0)) + 1, int(b.max(initial=0)) + 1
    codes, place = np.unique((kind * high + a) * low + b, return_inverse=True)
    return place, (codes // (high * low), codes // low % high, codes % low)


def price_block(entries: pd.DataFrame, heads: pd.DataFrame, most_terms: int = 50) -> pd.DataFrame:
    """Prices of one block of a language: (lang, part, source, item, value).

    entries (term, total, source, n) of its terms, heads (lang, source, own, terms, words) of all sources.
    A pair of sources has one row, at the one that comes first."""
    heads = heads.sort_values("source")
    lang, sources, n = heads["lang"].iloc[0] if len(heads) else "", heads["source"].to_numpy(object), len(heads)
    terms = entries[["term", "total"]].drop_duplicates("term").sort_values(["total", "term"], ascending=[False, True])
    names, totals = terms["term"].to_numpy(object), terms["total"].to_numpy(np.int64)
    depth = max(0, int(len(names) - 1).bit_length())
    tree = entries["source"].map({s: i for i, s in enumerate(sources)}).to_numpy(np.int64)
    place = entries["term"].map({t: i for i, t in enumerate(names)}).to_numpy(np.int64)
    tree, place = np.concatenate([tree, np.full(len(names), n)]), np.concatenate([place, np.arange(len(names))])
    count = np.concatenate([entries["n"].to_numpy(np.int64), totals])
    order = np.lexsort([place, tree])
    forest = Forest(tree[order], place[order], count[order], n + 1, depth)
    smooth = 5 * heads["terms"].to_numpy(np.int64)
    whole = np.append(heads["own"].to_numpy(np.int64) + smooth, (heads["words"].to_numpy(np.int64) + smooth)[:1])
    first, second = np.triu_indices(n, 1)
    value = np.zeros(len(first), np.int64)
    most = max(1, WALK >> depth)
    for i in range(0, len(first) if len(names) else 0, most):
        value[i : i + most] = _apart(forest, whole, first[i : i + most], second[i : i + most], (1 << depth) - len(names))
    out = [pd.DataFrame({"part": "pair", "source": sources[first], "item": sources[second], "value": value})]
    for s in range(n if len(names) else 0):
        at, gain = _gains(forest, whole, s, n, depth)
        best = sorted(range(len(at)), key=lambda i: (-gain[i], names[at[i]]))[:most_terms]
        out.append(pd.DataFrame({"part": "term", "source": sources[s], "item": names[at[best]], "value": gain[best]}))
    return pd.concat(out).assign(lang=lang)[["lang", "part", "source", "item", "value"]]


def _apart(forest: Forest, whole: np.ndarray, a: np.ndarray, b: np.ndarray, unused: int) -> np.ndarray:
    """Sums of |p - q| of pairs of trees, without the leaves past the last term."""
    kinds, kind = np.unique(np.stack([whole[a], whole[b]]), axis=1, return_inverse=True)
    walk = forest.walk(kind.reshape(-1), a, b)
    gap = lambda x, y, k: np.abs(share(x + 5, kinds[0][k]) - share(y + 5, kinds[1][k]))
    total = walk.price(gap(*walk.counts, walk.kind), np.add)[0][walk.top]
    return total - unused * gap(np.zeros(len(a), np.int64), np.zeros(len(a), np.int64), kind.reshape(-1))


def _gains(forest: Forest, whole: np.ndarray, source: int, lang: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and gains p - q of the source's terms where it is over zero, only through nodes that have one."""
    walk = forest.walk(np.zeros(1, np.int64), np.array([source]), np.array([lang]))
    own, all_ = walk.counts
    gain = np.where(own > 0, share(own + 5, whole[source]) - share(all_ + 5, whole[lang]), 0)
    best = walk.price(np.maximum(gain, 0), np.maximum)
    at, node = np.zeros(1, np.int64), walk.top
    for (left, right), below in zip(walk.steps, best[1:], strict=True):
        at, node = np.concatenate([2 * at, 2 * at + 1]), np.concatenate([left[node], right[node]])
        at, node = at[below[node] > 0], node[below[node] > 0]
    return (at, gain[node]) if depth or gain[node].max(initial=0) > 0 else (at[:0], gain[:0])
