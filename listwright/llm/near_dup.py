"""MinHash near-duplicates by a signature-coordinate inverted join.

Documents are sets of k-word shingles. Each distinct set is a node. A node's signature has
COORDS minima; it is posted under its PREFIX rarest coordinate-value pairs only (two nodes with
MATCHES equal coordinates share SHARED of them), so values that very many documents have are
skipped; they are merged afterwards, for pairs that collide. Pairs that agree on MATCHES
coordinates are confirmed on their full sets.

Groups are never expanded into all pairs: every member of a posting list is first compared
with the list's head, the node whose values are most common and which thus is in the middle of
its group; components come from those links. Nodes of lists that still hold several
components meet a second time, under exact coordinates: the rarest of their shingles, as many as
nodes over the threshold must share one of, with the place of each. They are joined across
components under the first shingle they share, where its places still allow the threshold, and
confirmed likewise.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import clash_free, drop_kept, keep, small_batches
from .words import Words, grams, mix, slices, within_rows

COORDS, MATCHES = 96, 59  # at similarity 0.8 a pair agrees on fewer than 59 with probability 8e-6
SHARED = 6  # of a pair's equal coordinates, so many are in both prefixes
PREFIX = COORDS - MATCHES + SHARED
SLOTS = 1 << 16
FIRST = 16
BROADCAST_IDS = 1_000_000

_rng = np.random.Generator(np.random.PCG64(7))
_MULT = _rng.integers(0, 2**32, COORDS, dtype=np.uint32) | np.uint32(1)
_ADD = _rng.integers(0, 2**32, COORDS, dtype=np.uint32)
_FEW = np.uint64(0xA24BAED4963EE407)


def _shingles(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all rows, and the offsets of each row's."""
    words = Words(column, fold=True)
    h, first = words.hashes(), words.first
    count = np.diff(first)
    g = grams(h, k)[within_rows(first, k)]
    row = np.repeat(np.arange(len(count)), np.maximum(count - k + 1, 0))
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        whole = [mix(np.array([sum(int(x) * pow(int(_FEW), j + 1, 2**64) for j, x in enumerate(h[first[i] : first[i + 1]])) % 2**64], np.uint64))[0] for i in short]
        g, row = np.concatenate([g, np.array(whole, np.uint64)]), np.concatenate([row, short])
    order = np.lexsort((g, row))
    g, row = g[order], row[order]
    fresh = np.ones(len(g), bool)
    fresh[1:] = (g[1:] != g[:-1]) | (row[1:] != row[:-1])
    g, row = g[fresh], row[fresh]
    return g, np.searchsorted(row, np.arange(len(count) + 1))


def _set_keys(g: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two order-free 64-bit keys of each row's set."""
    n = len(offsets) - 1
    one, two = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        one[full] = np.add.reduceat(mix(g + np.uint64(1)), offsets[:-1][full])
        two[full] = np.add.reduceat(mix(g ^ _FEW), offsets[:-1][full])
    return mix(one).view(np.int64), two.view(np.int64)


def _signatures(g: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    out = np.zeros((n, COORDS), np.uint32)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        low, at = (g >> np.uint64(32)).astype(np.uint32), offsets[:-1][full]
        for j in range(COORDS):
            out[full, j] = np.minimum.reduceat(low * _MULT[j] + _ADD[j], at)
    return out


def _sign(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            g, offsets = _shingles(part.column("text"), k)
            one, two = _set_keys(g, offsets)
            signed = pa.array(_signatures(g, offsets).ravel().view(np.int32))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_key"), pa.array(np.diff(offsets).astype(np.int64)), pa.array(one), pa.array(two), pa.ListArray.from_arrays(pa.array(np.arange(0, len(signed) + 1, COORDS, dtype=np.int32)), signed)],
                names=["doc_id", "text_key", "n", "node", "check", "sig"],
            )


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            g, offsets = _shingles(part.column("text"), k)
            one, _ = _set_keys(g, offsets)
            yield pa.RecordBatch.from_arrays([pa.array(one), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(g.view(np.int64)))], names=["node", "shingles"])


def _tokens(batch: pa.RecordBatch) -> np.ndarray:
    """Coordinate-value pairs, COORDS for each row."""
    flat = batch.column("sig").flatten().to_numpy(zero_copy_only=False).view(np.uint32).reshape(-1, COORDS)
    return mix(flat.astype(np.uint64) | (np.arange(COORDS, dtype=np.uint64) << np.uint64(32)))


def _loads(rows: DataFrame, values: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """How often values fall in each of SLOTS slots: a sketch of bounded size over all rows."""

    def count(batches):
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            total += np.bincount((values(batch).ravel() & np.uint64(SLOTS - 1)).astype(np.int64), minlength=SLOTS)
        slot = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(total[slot])], names=["slot", "load"])

    found = rows.mapInArrow(count, "slot int, load long").groupBy("slot").agg(F.sum("load").alias("load")).toArrow()
    loads = np.zeros(SLOTS, np.uint32)
    loads[found["slot"].to_numpy()] = np.minimum(found["load"].to_numpy(), 2**24 - 1)
    return loads


def _ranks(values: np.ndarray, loads: np.ndarray) -> np.ndarray:
    """Rarest first; equal values have equal ranks everywhere."""
    return (loads[(values & np.uint64(len(loads) - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(40)) | (values >> np.uint64(24))


def _postings(classes: DataFrame) -> DataFrame:
    """(token, node, n, common): each node under its PREFIX least loaded pairs."""
    loads = _loads(classes.select("sig"), _tokens)

    def post(batches):
        for batch in batches:
            if batch.num_rows:
                token = _tokens(batch)
                prefix = np.take_along_axis(token, np.argpartition(_ranks(token, loads), PREFIX - 1, axis=1)[:, :PREFIX], axis=1)
                common = loads[(token & np.uint64(SLOTS - 1)).astype(np.int64)].sum(axis=1, dtype=np.int64)
                rows = np.repeat(np.arange(batch.num_rows), PREFIX)
                yield pa.RecordBatch.from_arrays([pa.array(prefix.ravel().view(np.int64)), batch.column("node").take(pa.array(rows)), batch.column("n").take(pa.array(rows)), pa.array(common[rows])], names=["token", "node", "n", "common"])

    return classes.where("n > 0").select("node", "n", "sig").mapInArrow(post, "token long, node long, n long, common long")


def _shingle_postings(sets: DataFrame, percent: int) -> DataFrame:
    """(shingle, node, root, n, place): each node under its rarest shingles, n - need + 1 of them,
    where need is the least overlap with any set over the threshold."""
    flat = lambda batch: batch.column("shingles").flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    loads = _loads(sets.select("shingles"), flat)

    def post(batches):
        for batch in batches:
            g = flat(batch)
            n = batch.column("shingles").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((_ranks(g, loads), row))
            place = np.arange(len(g)) - np.repeat(np.cumsum(n) - n, n)
            prefix = place < (n - -(-n * percent // 100) + 1)[row]
            rows = pa.array(row[prefix])
            yield pa.RecordBatch.from_arrays([pa.array(g[order][prefix].view(np.int64)), batch.column("node").take(rows), batch.column("root").take(rows), pa.array(n[row[prefix]]), pa.array(place[prefix])], names=["shingle", "node", "root", "n", "place"])

    return sets.select("node", "root", "shingles").mapInArrow(post, "shingle long, node long, root long, n long, place long")


def _close(n: str, m: str, percent: int) -> Column:
    """Sizes that still allow the similarity."""
    return 100 * F.least(F.col(n), F.col(m)) >= percent * F.greatest(F.col(n), F.col(m))


def _sets_of(nodes: DataFrame, classes: DataFrame, documents: DataFrame, k: int) -> DataFrame:
    """(node, shingles) of nodes, from one text each: by doc_id, or by text_key where no row of a node has one."""
    wanted = keep(nodes.join(classes.select("node", "pick", "lead"), "node").select("pick", F.when(F.col("pick").isNull(), F.col("lead")).alias("lead")).distinct(), "picks")
    short = lambda keys: F.broadcast(keys) if keys.count() <= BROADCAST_IDS else keys
    texts = documents.select("doc_id", "text").join(short(wanted.where("pick is not null").select(F.col("pick").alias("doc_id")).distinct()), "doc_id", "left_semi").select("text")
    unnamed = wanted.where("pick is null").select(F.col("lead").alias("text_key")).distinct()
    if not unnamed.isEmpty():
        rows = documents.where("doc_id is null").select(F.xxhash64("text").alias("text_key"), "text")
        texts = texts.unionByName(rows.join(short(unnamed), "text_key", "left_semi").dropDuplicates(["text_key"]).select("text"))
    return texts.mapInArrow(lambda batches: _sets(batches, k), "node long, shingles array<long>").dropDuplicates(["node"])


def _alike(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b), those whose full sets are over the threshold.

    Sets travel as 31 bits of each shingle first, with as many shared ones allowed for as can have
    become equal by that; the pairs that are left are compared on all bits.
    """

    def over(pairs: DataFrame, sets: DataFrame, slack: Column) -> DataFrame:
        sets = sets.join(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "node", "left_semi")
        side = lambda x: sets.select(F.col("node").alias(x), F.col("shingles").alias(f"set_{x}"), F.col("n").alias(f"n_{x}"))
        both = F.size(F.array_intersect("set_a", "set_b")) + slack
        return pairs.join(side("a"), "a").join(side("b"), "b").where(100 * both >= percent * (F.col("n_a") + F.col("n_b") - both)).select("a", "b")

    n = F.size("shingles").cast("long").alias("n")
    short = sets.select("node", n, F.expr("transform(shingles, x -> int(x & 2147483647))").alias("shingles"))
    wide = F.greatest("n_a", "n_b").cast("double")
    near = keep(over(pairs, short, 2 + F.ceil(wide * wide / float(1 << 29))), "near-sets")
    return over(near, sets.select("node", n, "shingles"), F.lit(0))


def _confirm(pairs: DataFrame, classes: DataFrame, documents: DataFrame, k: int, percent: int) -> DataFrame:
    """Of pairs (head, node), those that agree on MATCHES coordinates and then on full sets.

    The coordinates that the postings skip are merged here, for colliding pairs alone.
    """
    of = lambda x: classes.select(F.col("node").alias(x), F.col("sig").alias(f"sig_{x}"))
    same = F.aggregate(F.zip_with("sig_a", "sig_b", lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda s, x: s + x)
    agreed = pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", same.alias("same")).where(f"same >= {MATCHES}")
    likely = keep(agreed.select("a", "b"), "likely")
    nodes = likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct()
    sets = keep(_sets_of(nodes, classes, documents, k), "sets")
    links = keep(_alike(likely, sets, percent), "links")
    drop_kept(likely, sets)
    return links


def _across(lists: DataFrame, roots: DataFrame, classes: DataFrame, documents: DataFrame, k: int, percent: int) -> DataFrame:
    """Links between components among the nodes with SHARED lists that hold several components."""
    open_lists = lists.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = open_lists.groupBy("token").agg(F.min("root").alias("r"), F.max("root").alias("s")).where("r < s").select("token")
    rest = open_lists.join(several, "token").groupBy("node", "root").count().where(f"count >= {SHARED}")
    rest = keep(rest.select("node", "root"), "rest")
    sets = keep(_sets_of(rest.select("node"), classes, documents, k).join(rest, "node"), "sets")
    every = keep(_shingle_postings(sets, percent), "posts")
    mixed = every.groupBy("shingle").agg(F.min("root").alias("r"), F.max("root").alias("s")).where("r < s").select("shingle")
    some = keep(every.join(mixed, "shingle"), "posts")
    drop_kept(every, rest)
    # With each posting its node's FIRST shared shingles: two nodes meet under the first common one, not under all.
    firsts = some.groupBy("node").agg(F.slice(F.array_sort(F.collect_list(F.struct("place", "shingle"))), 1, FIRST)["shingle"].alias("first"))
    firsts = firsts.select("node", F.transform("first", lambda x: F.hash(x)).alias("first"))  # 32 bits tell FIRST values apart
    posts = keep(some.join(firsts, "node"), "posts")
    x, y = posts.alias("x"), posts.alias("y")
    need = F.expr(f"{percent} * (x.n + y.n)")
    reach = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))  # overlap, if this shingle is the first shared
    shared = F.array_intersect("x.first", "y.first")
    here = (F.size(shared) == 0) | (F.hash("x.shingle") == F.get(shared, 0))
    pairs = x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.root") != F.col("y.root")) & (reach * (100 + percent) >= need) & here)
    pairs = keep(pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct(), "across")
    links = keep(_alike(pairs, sets.select("node", "shingles"), percent), "links")
    drop_kept(some, posts, pairs, sets)
    return links


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node in links (a, b).

    Alternating large-star and small-star rounds; a star's centre is joined with its rays, so a
    large star is spread by the join and never gathered. Ends when a round changes nothing.
    """
    edges = keep(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    mark = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = mark(edges)
    while before[0]:
        ways = edges.union(edges.select("v", "u"))
        least = ways.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = ways.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        last, edges = edges, keep(small, "edges")
        after = mark(edges)
        drop_kept(last)
        if after == before:
            break
        before = after
    return edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node").union(edges.select("v", F.col("v").alias("root")).distinct())


def _apart(rows: DataFrame) -> DataFrame:
    """rows with another node where sets with different check values have one; as good as none, even in 1e10 sets."""
    narrow = rows.select("node", "check")
    twice = keep(narrow.groupBy("node").agg(F.min("check").alias("c"), F.max("check").alias("d")).where("c < d").select("node"), "clashes")
    if twice.isEmpty():
        return rows
    return rows.join(twice.withColumn("_twice", F.lit(True)), "node", "left").withColumn("node", F.when(F.col("_twice"), F.xxhash64("node", "check")).otherwise(F.col("node"))).drop("_twice")


def near_duplicates(documents: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, text_key, component_id, kept.

    documents needs doc_id and text; other columns are ignored. Null and blank texts have an
    empty set, size 0, and are linked with nothing. Texts of fewer than k words have one
    shingle, the whole sequence. Rows with equal sets share a component, repeated rows too.
    component_id is the smallest non-null doc_id of the component; rows without doc_id are linked
    like others. kept: doc_id equals component_id; in a component without any doc_id, the rows of
    the text with the smallest text_key. An empty table gives an empty result.
    """
    small_batches(documents.sparkSession)
    rows = keep(documents.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(lambda batches: _sign(batches, k), "doc_id long, text_key long, n long, node long, check long, sig array<int>"), "signed")
    rows = _apart(rows)
    classes = keep(rows.where("n > 0").groupBy("node", "check", "n").agg(F.min("doc_id").alias("pick"), F.min("text_key").alias("lead"), F.first("sig").alias("sig")), "classes")
    postings = _postings(classes)
    heads = postings.groupBy("token").agg(F.max(F.struct("common", "node", "n")).alias("head"), F.count("*").alias("nodes")).where("nodes > 1").select("token", "head")
    lists = keep(postings.join(heads, "token").select("token", "node", "n", F.col("head.node").alias("head"), F.col("head.n").alias("head_n")), "lists")
    stars = lists.where((F.col("node") != F.col("head")) & _close("n", "head_n", percent)).select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    links = _confirm(stars, classes, documents, k, percent)
    roots = keep(components(links), "roots")
    more = _across(lists, roots, classes, documents, k, percent)
    drop_kept(lists)
    if not more.isEmpty():
        roots = components(links.union(more))
    named = classes.select("node", "check", "n", "pick", "lead").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = named.groupBy("root").agg(F.min("pick").alias("component_id"), F.min("lead").alias("lead"))
    named = named.drop("lead").join(smallest, "root").select("node", "check", "n", "component_id", "lead")
    own = rows.select("doc_id", "text_key", "n", "node", "check")
    out = own.where("n > 0").join(named, ["node", "check", "n"]).unionByName(own.where("n = 0").withColumn("component_id", F.col("doc_id")).withColumn("lead", F.col("text_key")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "text_key", "component_id", (F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("component_id").isNotNull() | F.col("text_key").eqNullSafe(F.col("lead")))).alias("kept"))


@clash_free("_key", "_id", "_text")
def drop_near_duplicates(documents: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """documents without near-duplicates: of each component the document with the smallest id.

    Rows that repeat an id and its text stay once. Of a component
    without any doc_id one row stays. Columns are those of documents.
    """
    key = ["doc_id", "text_key"]
    near = keep(near_duplicates(documents, k, percent).select(*key, "kept"), "near")
    gone = keep(near.where("not kept").select(*key).distinct(), "gone")
    twice = keep(near.where("kept").groupBy(*key).count().where("count > 1").select(*key), "twice")
    rows = documents.withColumn("_key", F.xxhash64("text"))

    def among(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        keys = keys.toDF("_id", "_text")
        keys = F.broadcast(keys) if keys.count() <= BROADCAST_IDS else keys
        return rows.join(keys, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("_key").eqNullSafe(F.col("_text")), how)

    rows = among(rows, gone, "left_anti")
    if not twice.isEmpty():
        rows = among(rows, twice, "left_anti").unionByName(among(rows, twice, "left_semi").dropDuplicates(["doc_id", "_key"]))
    return rows.drop("_key")
