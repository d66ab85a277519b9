"""Substring dedup with repeated-phrase automata.

A window is WINDOW consecutive words. The smallest hash among the K-word phrases of a window
chooses its anchor, so equal windows have equal anchors. Anchors whose hash is in two texts or
more are written out as words and confirmed: a phrase recurs if two texts have the same words.
Confirmed phrases are compiled into Aho-Corasick automata, one for each shard of texts, and every
text with such a phrase is streamed through its shard's automaton, which locates all occurrences.
Only windows anchored at a located phrase are compared, by 128 bits of hash: first inside the shard,
where all but the first of equal windows are settled, then the shards' firsts as rows, by the
smallest id of each window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import drop_kept, keep, small_batches
from .words import Words, grams, mix, slices, window_min, within_rows

WINDOW, K = 50, 8
SHARD_CHARS = 2_000_000
LAST = 2**63 - 1  # stands for a missing doc_id: after all others
_PLACE = np.uint64((1 << 24) - 1)
_OTHER = np.uint64(0x94D049BB133111EB)
TEXT = ["tkey", "tcheck"]
NOTHING = hashlib.sha256(b"").hexdigest()


def _anchored(words: Words, window: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(phrase hashes, starts of windows, place of each window's anchor) over all rows."""
    h = words.hashes()
    g = grams(h, k)
    starts = np.flatnonzero(within_rows(words.first, window))
    if not len(starts):
        return g, starts, starts
    # Within 16M words of a slice: 40 bits of hash, then the rightmost of equal ones first.
    ranks = (g & ~_PLACE) | (_PLACE - (np.arange(len(g), dtype=np.uint64) & _PLACE))
    least = window_min(ranks, window - k + 1)[starts]
    low = (_PLACE - (least & _PLACE)).astype(np.int64)
    places = (starts & ~int(_PLACE)) | low
    places[places < starts] += int(_PLACE) + 1
    return g, starts, places


def _survey(batches: Iterator[pa.RecordBatch], window: int, k: int) -> Iterator[pa.RecordBatch]:
    """Per document: words, digest of all of them, and its distinct anchors."""
    for batch in batches:
        for part in slices(batch, "text"):
            words = Words(part.column("text"))
            g, starts, places = _anchored(words, window, k)
            cut = np.searchsorted(starts, words.first)
            anchors = [np.unique(g[places[cut[i] : cut[i + 1]]]).view(np.int64) for i in range(part.num_rows)]
            digests = [hashlib.sha256(b" ".join((x or "").encode().split())).hexdigest() for x in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("id"), part.column("tkey"), part.column("tcheck"), part.column("n_chars"), pa.array(np.diff(words.first).astype(np.int64)), pa.array(digests), pa.array(anchors, pa.list_(pa.int64()))],
                names=["doc_id", "id", "tkey", "tcheck", "n_chars", "n_words", "all_sha256", "anchors"],
            )


def _streams(texts: list[str], words: Words) -> tuple[list[str], list[np.ndarray]]:
    """Each text as words between single spaces, and where each word starts in it."""
    streams, bounds = [], []
    for text in texts:
        own = (text or "").encode().split()
        streams.append(" " + b" ".join(own).decode() + " ")
        size = np.fromiter((len(w) for w in streams[-1].split(" ")[1:-1] if own), np.int64, len(own))
        bounds.append(np.cumsum(size + 1) - size)
    return streams, bounds


def _spell(batches: Iterator[pa.RecordBatch], window: int, k: int) -> Iterator[pa.RecordBatch]:
    """(shard, phrase): the words of each text's recurring anchors, each phrase once for a text."""
    for batch in batches:
        for part in slices(batch, "text"):
            words = Words(part.column("text"))
            g, _, places = _anchored(words, window, k)
            places = np.unique(places)
            row = np.searchsorted(words.first, places, "right") - 1
            streams, bounds = _streams(part.column("text").to_pylist(), words)
            wanted = [np.array(x or [], np.int64).view(np.uint64) for x in part.column("anchors").to_pylist()]
            shards, out = part.column("shard").to_pylist(), []
            for i in np.unique(row).tolist():
                own = places[row == i]
                own = own[np.isin(g[own], wanted[i])] - words.first[i]
                ends = np.append(bounds[i], len(streams[i]))
                out += [(shards[i], phrase) for phrase in {streams[i][ends[j] - 1 : ends[j + k]] for j in own.tolist()}]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True) if out else [[]] * 2, (pa.int64(), pa.string()), strict=True)], names=["shard", "phrase"])


_SPOTS = "id long, tkey long, tcheck long, settled array<int>, starts array<int>, hashes array<long>, checks array<long>"


def _locate(texts: pa.Table, phrases: pa.Table, window: int, k: int) -> pa.Table:
    """Windows of one shard by text: starts of settled repeats; starts and hashes of the first of each kind."""
    automaton = ahocorasick.Automaton()
    for phrase in phrases.column("phrase").to_pylist():
        automaton.add_word(phrase, len(phrase))
    out: list[tuple] = []
    if len(automaton) and texts.num_rows:
        automaton.make_automaton()
        texts = texts.sort_by([("id", "ascending"), ("tkey", "ascending"), ("tcheck", "ascending")]).combine_chunks()
        words = Words(texts.column("text").combine_chunks())
        _, starts, places = _anchored(words, window, k)
        cut = np.searchsorted(starts, words.first)
        streams, bounds = _streams(texts.column("text").to_pylist(), words)
        one = words.hashes()
        one, two = grams(one, window).view(np.int64), grams(mix(one ^ _OTHER), window).view(np.int64)
        first: dict[tuple[int, int], int] = {}
        ids, keys, checks = (texts.column(c).to_pylist() for c in ("id", "tkey", "tcheck"))
        for i in range(texts.num_rows):
            found = np.fromiter((end - size + 2 for end, size in automaton.iter(streams[i])), np.int64)
            spots = np.unique(np.searchsorted(bounds[i], found)) + words.first[i]
            s, p = starts[cut[i] : cut[i + 1]], places[cut[i] : cut[i + 1]]
            s = s[np.isin(p, spots)]
            if not len(s):
                continue
            earlier = np.fromiter((first.setdefault(x, ids[i]) for x in zip(one[s].tolist(), two[s].tolist(), strict=True)), np.int64, len(s))
            settled = earlier < ids[i]
            local = (s - words.first[i]).astype(np.int32)
            out.append((ids[i], keys[i], checks[i], local[settled], local[~settled], one[s[~settled]], two[s[~settled]]))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]
    return pa.table([pa.array(x, t) for x, t in zip(zip(*out, strict=True) if out else [[]] * 7, kinds, strict=True)], names=["id", *TEXT, "settled", "starts", "hashes", "checks"])


def _repeats(spots: DataFrame) -> DataFrame:
    """Per text: starts of all windows that a smaller id has."""
    opened = spots.select("id", *TEXT, F.inline(F.arrays_zip("starts", "hashes", "checks")))
    firsts = opened.groupBy("hashes", "checks").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").drop("last")
    later = opened.join(firsts, ["hashes", "checks"]).where("id > first").groupBy(*TEXT).agg(F.collect_list("starts").alias("starts"))
    every = later.unionByName(spots.where(F.size("settled") > 0).select(*TEXT, F.col("settled").alias("starts")))
    return every.groupBy(*TEXT).agg(F.flatten(F.collect_list("starts")).alias("starts"))


def _strip(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for key, check, text, starts in zip(*(batch.column(c).to_pylist() for c in (*TEXT, "text", "starts")), strict=True):
            words = text.encode().split()
            steps = np.zeros(len(words) + 1, np.int64)
            at = np.unique(np.array(starts, np.int64))
            np.add.at(steps, at, 1)
            np.add.at(steps, at + window, -1)
            stays = np.cumsum(steps[:-1]) == 0
            kept = b" ".join(w for w, x in zip(words, stays.tolist(), strict=True) if x)
            out.append((key, check, int((~stays).sum()), hashlib.sha256(kept).hexdigest(), kept.decode()))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True) if out else [[]] * 5, kinds, strict=True)], names=[*TEXT, "n_removed", "kept_sha256", "kept"])


def remove_repeats(documents: DataFrame, window: int = WINDOW, k: int = K, with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (and, with_text, kept).

    documents needs doc_id and text; other columns are ignored. A word goes if a window over it
    also starts in a document with a smaller doc_id; windows are judged on the input. Null, empty
    and short texts lose nothing. Rows without doc_id come after all others and are not before
    one another; repeated rows are not before one another either. kept: null if nothing went.
    A shard holds about SHARD_CHARS characters of texts in one worker, or its longest text.
    """
    small_batches(documents.sparkSession)
    keyed = documents.select("doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("id"), F.xxhash64("text").alias("tkey"), F.xxhash64(F.lit(1), "text").alias("tcheck"), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"), "text")
    base = keep(keyed.mapInArrow(lambda b: _survey(b, window, k), "doc_id long, id long, tkey long, tcheck long, n_chars long, n_words long, all_sha256 string, anchors array<long>"), "survey")
    texts = keep(base.groupBy(*TEXT).agg(F.min("id").alias("rep"), F.first("n_chars").alias("n_chars"), F.first("anchors").alias("anchors")), "texts")
    posted = texts.select(*TEXT, "rep", "n_chars", F.explode("anchors").alias("anchor"))
    recurring = posted.groupBy("anchor").count().where("count > 1").select("anchor")
    wanted = keep(posted.join(recurring, "anchor").groupBy(*TEXT, F.col("rep").alias("id"), "n_chars").agg(F.collect_list("anchor").alias("anchors")), "wanted")
    chars = wanted.agg(F.sum("n_chars")).first()[0] or 0
    shards = max(1, -(-chars // SHARD_CHARS))
    shard = F.pmod(F.xxhash64("tkey"), F.lit(shards)).alias("shard")
    chosen = keyed.select("id", *TEXT, "text").join(wanted.drop("n_chars"), ["id", *TEXT]).dropDuplicates(TEXT)
    chosen = keep(chosen.select(shard, "id", *TEXT, "text", "anchors"), "chosen")
    spelled = chosen.select("shard", "text", "anchors").mapInArrow(lambda b: _spell(b, window, k), "shard long, phrase string")
    spelled = keep(spelled.groupBy("phrase", "shard").count(), "spelled")
    confirmed = spelled.groupBy("phrase").agg(F.sum("count").alias("texts")).where("texts > 1").select("phrase")
    phrases = spelled.join(confirmed, "phrase").select("shard", "phrase")
    spots = chosen.drop("anchors").groupBy("shard").cogroup(phrases.groupBy("shard")).applyInArrow(lambda x, y: _locate(x, y, window, k), _SPOTS)
    spots = keep(spots, "spots")
    gone = keep(_repeats(spots), "gone")
    stripped = chosen.select(*TEXT, "text").join(gone, TEXT).mapInArrow(lambda b: _strip(b, window), "tkey long, tcheck long, n_removed long, kept_sha256 string, kept string")
    stripped = keep(stripped if with_text else stripped.drop("kept"), "stripped")
    drop_kept(spelled, spots, gone, wanted, chosen)
    rows = base.drop("anchors").join(texts.select(*TEXT, "rep"), TEXT).join(stripped, TEXT, "left")
    copy = (F.col("id") > F.col("rep")) & (F.col("n_words") >= window)
    return rows.select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(NOTHING)).otherwise(F.coalesce("kept_sha256", "all_sha256")).alias("kept_sha256"),
        *([F.when(copy, F.lit("")).otherwise(F.col("kept")).alias("kept")] if with_text else []),
    )
