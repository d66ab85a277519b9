"""Spelling variants: words one edit apart, found in tries of letter-group counts.

A word is a vector: how often it has letters of each group. One inserted, deleted or replaced
letter adds at most one to one count and takes at most one from another. Words of a shard (equal
length and equal first counts) are arranged by their successive counts; a depth-first search
follows the counts that a budget of one surplus and one deficit allows; words at the leaves are
compared letter by letter.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import drop_kept, keep

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = "A-Za-zÀ-ÿ"
#: Letters of each group, the most telling first; all other letters are the last group.
GROUPS = ("ei", "an", "ot", "rs", "ul", "dc", "mg", "hp", "bf", "vk", "jqw", "xyz")
SHARD_WORDS = 4096  # about as many words has a trie
LEAF_WORDS = 32
PROBES = 1 << 15  # searched at once
MOST_BYTES = 4 << 20  # compared at once


def corpus_words(docs: DataFrame, least_chars: int = 7, least: int = 2, slip_every: int = 31) -> DataFrame:
    """(word, n): words of least_chars letters or more that occur least times or more.

    docs (doc_id, text). Words are maximal runs of Latin letters, only A-Z lower-cased. Where slip_every
    divides the CRC-32 h of '<doc_id>:<run>', the run loses its letter h % length. A null text has
    no words; a null doc_id is an empty one. Repeated rows count each time.
    """
    run = F.regexp_extract_all("text", F.lit(f"([{LETTERS}]{{{least_chars},}})"), F.lit(1))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(run).alias("run"))
    low = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, LOWER)).otherwise(F.col("run"))
    runs = runs.select("doc", low.alias("run")).withColumn("h", F.crc32(F.concat("doc", F.lit(":"), "run")))
    at = (F.col("h") % F.length("run")).cast("int")
    slipped = F.concat(F.substring("run", F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    words = runs.select(F.when(F.col("h") % slip_every == 0, slipped).otherwise(F.col("run")).alias("word")).where(F.length("word") >= least_chars)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def _first_counts(levels: int) -> list[Column]:
    """The length of a word and its counts of the first groups."""
    size = F.length("word")
    return [size, *[size - F.length(F.translate("word", g, "")) for g in GROUPS[:levels]]]


def _steps(levels: int) -> list[tuple[int, ...]]:
    """How the length and the first counts of a word may differ from those of one that is not shorter."""
    out = []
    for longer in (0, 1):
        for step in itertools.product((-1, 0, 1), repeat=levels):
            if step.count(1) <= 1 and step.count(-1) <= 1 - longer:
                out.append((longer, *step))
    return out


def near_pairs(words: DataFrame, total: int, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(word, n, near, near_n): each pair of words that differ by one letter inserted, deleted or
    replaced, once; near is the longer one, or the later in code-point order.

    words (word unique, n) is read several times; total is its number of rows. Shards with many words are
    split by a hash and asked once for each part; those that ask are streamed past the trie, so memory is
    bounded by shard_words and PROBES. No candidate is dropped.
    """
    levels = min(len(GROUPS), max(1, math.ceil(math.log(max(1.0, total / (8 * shard_words)), 4))))
    own = _first_counts(levels)
    name = lambda step: F.concat_ws(",", *[c + d for c, d in zip(own, step, strict=True)])
    at_home = words.withColumn("shard", name((0,) * (levels + 1)))
    sizes = keep(at_home.groupBy("shard").agg(F.ceil(F.count("*") / shard_words).cast("int").alias("parts")), "spelling-shards")
    part = lambda p: F.concat_ws("#", "shard", p)
    held = at_home.join(sizes, "shard").select(part(F.pmod(F.xxhash64("word"), "parts")).alias("shard"), F.lit(False).alias("asks"), "word", "n")
    asked = words.select(F.explode(F.array(*[name(s) for s in _steps(levels)])).alias("shard"), "word", "n").join(sizes, "shard")
    asked = asked.select("shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("p"), "word", "n").select(part("p").alias("shard"), F.lit(True).alias("asks"), "word", "n")
    rows = held.unionByName(asked).repartition("shard").sortWithinPartitions("shard", "asks")
    return rows.mapInArrow(_search, "word string, n long, near string, near_n long")


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of shard, a shard's own words first."""
    shard, held, asks, trie, waiting = None, [], [], None, 0
    for batch in batches:
        names = batch.column("shard").to_numpy(zero_copy_only=False)
        flags = batch.column("asks").to_numpy(zero_copy_only=False)
        edges = np.flatnonzero((names[1:] != names[:-1]) | (flags[1:] != flags[:-1])) + 1
        for a, b in itertools.pairwise([0, *edges, batch.num_rows]):
            if a == b:
                continue
            if names[a] != shard:
                if asks and held:  # a part of a shard may have no word
                    yield from _ask(trie or Trie(held), asks)
                shard, held, asks, trie, waiting = names[a], [], [], None, 0
            if held or not flags[a]:
                (asks if flags[a] else held).append(batch.slice(a, b - a))
            waiting += (b - a) * bool(flags[a])
            if waiting >= PROBES and held:
                trie = trie or Trie(held)
                yield from _ask(trie, asks)
                asks, waiting = [], 0
    if asks and held:
        yield from _ask(trie or Trie(held), asks)


def _ask(trie: Trie, asks: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the words of asks: those as long as the trie's, and those with one letter less."""
    table = pa.Table.from_batches(asks)
    size = pc.utf8_length(table.column("word")).to_numpy()
    for less in (0, 1):
        chosen = table.filter(pa.array(size == trie.width - less)).combine_chunks()
        if chosen.num_rows:
            asking, found = trie.near(letters(chosen.column("word")), 1, 1 - less)
            if len(asking):
                mine, theirs = chosen.take(pa.array(asking)), trie.table.take(pa.array(found))
                for one, other in zip(mine.to_batches(), theirs.combine_chunks().to_batches(), strict=True):
                    yield pa.RecordBatch.from_arrays([one.column("word"), one.column("n"), other.column("word"), other.column("n")], ["word", "n", "near", "near_n"])


def letters(words: pa.ChunkedArray) -> np.ndarray:
    """Words of one length as rows of Latin-1 bytes."""
    width = len(words[0].as_py())
    rows = np.empty((len(words), width), np.uint8)
    plain = pc.equal(pc.binary_length(words), width)
    mask = plain.to_numpy()
    rows[mask] = _bytes(pc.filter(words, plain)).reshape(-1, width)
    other = pc.filter(words, pc.invert(plain)).to_pylist()
    rows[~mask] = np.frombuffer("".join(other).encode("latin-1"), np.uint8).reshape(-1, width)
    return rows


def _bytes(words: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(pc.binary_join(pa.ListArray.from_arrays([0, len(c)], c), "")[0].as_py().encode() for c in words.chunks), np.uint8)


_GROUP = np.full(256, len(GROUPS), np.uint8)
for _i, _g in enumerate(GROUPS):
    for _c in _g:
        _GROUP[ord(_c)] = _i
_BITS = np.uint64(1) << (4 * _GROUP.astype(np.uint64))


def group_counts(rows: np.ndarray) -> np.ndarray:
    """How many letters of each group (a row of the result) each row has."""
    groups = np.arange(len(GROUPS) + 1)
    if rows.shape[1] < 16:  # all counts of a row in one number
        packed = _BITS[rows].sum(axis=1)
        return ((packed >> (4 * groups[:, None]).astype(np.uint64)) & np.uint64(15)).astype(np.int8)
    own = _GROUP[rows]
    return np.stack([(own == g).sum(axis=1, dtype=np.int32) for g in groups])


class Trie:
    """Words of one length, by their successive letter-group counts. A node is a range of the words
    in that order; its children are the ranges of equal next count."""

    def __init__(self, held: list[pa.RecordBatch]):
        table = pa.Table.from_batches(held).combine_chunks()
        rows = letters(table.column("word"))
        counts = group_counts(rows)
        order = np.lexsort(counts[::-1])
        self.table = table.take(pa.array(order)).combine_chunks()
        self.rows, self.columns, self.width = rows[order], np.ascontiguousarray(counts[:, order]), rows.shape[1]

    def near(self, rows: np.ndarray, surplus: int, deficit: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of rows and of words of the trie that are one edit apart; of rows of the trie's
        length, only words later in order."""
        counts, who = group_counts(rows), np.arange(len(rows))
        leaves = self._descend(counts, 0, len(self.rows), 0, who, np.full(len(rows), surplus, counts.dtype), np.full(len(rows), deficit, counts.dtype))
        out, some, size = [], [], 0
        most = max(1, MOST_BYTES // self.width)
        for pair in leaves:
            some.append(pair)
            size += len(pair[0])
            if size >= most:
                out.append(self._verified(rows, some, most))
                some, size = [], 0
        if some:
            out.append(self._verified(rows, some, most))
        none = np.zeros(0, np.int64)
        return (np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])) if out else (none, none)

    def _descend(self, counts, lo, hi, level, who, surplus, deficit) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(asking, word) of the leaves that the budgets reach, depth first. who: columns of counts that
        have reached the node lo:hi with what is left of their surplus and deficit."""
        if hi - lo <= LEAF_WORDS or level == len(counts):
            for a in range(0, len(who), 4096):
                some = slice(a, a + 4096)
                more, less = (np.repeat(x[some, None], hi - lo, axis=1) for x in (surplus, deficit))  # what is left of the budgets
                for column, own in zip(self.columns[level:, lo:hi], counts[level:, who[some]], strict=True):
                    apart = column[None, :] - own[:, None]
                    more -= np.maximum(apart, 0)
                    less += np.minimum(apart, 0)
                asking, word = np.nonzero((more >= 0) & (less >= 0))
                if len(asking):
                    yield who[some][asking], lo + word
            return
        column, own = self.columns[level, lo:hi], counts[level, who]
        for a, b in itertools.pairwise([0, *(np.flatnonzero(np.diff(column)) + 1), hi - lo]):
            apart = column[a] - own
            fits = (apart <= surplus) & (-apart <= deficit)
            if fits.any():
                d = apart[fits]
                yield from self._descend(counts, lo + a, lo + b, level + 1, who[fits], surplus[fits] - np.maximum(d, 0), deficit[fits] + np.minimum(d, 0))

    def _verified(self, rows: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]], most: int) -> tuple[np.ndarray, np.ndarray]:
        asking, word = np.concatenate([a for a, _ in pairs]), np.concatenate([b for _, b in pairs])
        ok = np.zeros(len(asking), bool)
        for i in range(0, len(asking), most):
            one, other = rows[asking[i : i + most]], self.rows[word[i : i + most]]
            place = np.arange(len(one))
            if one.shape[1] == other.shape[1]:
                differs = one != other
                first = differs.argmax(axis=1)
                ok[i : i + most] = (differs.sum(axis=1) == 1) & (other[place, first] > one[place, first])
            else:  # other has one letter more: equal before it, and equal after it
                ahead = one != other[:, :-1]
                first = np.where(ahead.any(axis=1), ahead.argmax(axis=1), one.shape[1])
                behind = one != other[:, 1:]
                last = np.where(behind.any(axis=1), one.shape[1] - 1 - behind[:, ::-1].argmax(axis=1), -1)
                ok[i : i + most] = last < first
        return asking[ok], word[ok]


def variant_groups(words: DataFrame, ratio: int = 10, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of words (word unique, not empty, of characters up to U+00FF; n).

    n_near counts the words one edit away. A word's form is the one of them with the largest n (ties: the
    smallest in code-point order) if that n is ratio times its own or more, else null. root is the end of
    the chain of forms, the word itself if it has none. An empty table gives an empty result.
    """
    words = keep(words.select("word", "n"), "spelling-words")
    pairs = near_pairs(words, words.count(), shard_words)
    ends = F.array(F.struct("word", F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("to")).alias("to")), F.struct(F.col("near").alias("word"), F.struct((-F.col("n")).alias("less"), F.col("word").alias("to")).alias("to")))
    best = pairs.select(F.explode(ends).alias("e")).groupBy("e.word").agg(F.count("*").alias("n_near"), F.min("e.to").alias("best"))
    fits = -F.col("best.less") >= ratio * F.col("n")
    formed = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(fits, F.col("best.to")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n"))
    formed = keep(formed, "spelling-forms")
    return formed.join(_roots(formed), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(formed: DataFrame) -> DataFrame:
    """(word, root) of words with a form. n grows by the ratio along a chain, so that chains are short
    and have no cycle; each round doubles the steps taken."""
    at = keep(formed.where("form is not null").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("end"))
        moved = keep(at.join(further, "root", "left").select("word", F.coalesce("end", "root").alias("root"), F.col("end").isNotNull().alias("moved")), "spelling-roots")
        drop_kept(at)
        at = moved
        if at.where("moved").isEmpty():
            return at.select("word", "root")
