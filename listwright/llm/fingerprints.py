"""Document fingerprints by winnowing.

Rolling hashes of K code points; in each window of W hashes the smallest is chosen, the
rightmost of equal ones; choices are kept with their positions. Two texts that share a passage
of W + K - 1 code points share a fingerprint at the same place of it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import drop_kept, keep, small_batches
from .words import mix, window_min

K, W = 8, 16
PART_BYTES = 8 << 20  # of text in a sorted part, about
MOST_PARTS = 1 << 18  # bounds sent to the executors (2 MB); beyond 2 TB parts have more bytes instead
ROW_BYTES = 32  # that a row counts beside its text
SLICES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_POINT = np.uint64(0xBF58476D1CE4E5B9)


def rolling(points: np.ndarray, k: int = K) -> np.ndarray:
    """32-bit hashes of points[i:i+k], k a power of two, by doubling."""
    h, size = (points.astype(np.uint64) + np.uint64(1)) * _POINT, 1
    while size < k:
        h = h[: len(h) - size] * np.uint64(pow(_BASE, size, 2**64)) + h[size:]
        size *= 2
    return mix(h) >> np.uint64(32)


def winnow(text: str, k: int = K, w: int = W) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) in text order. Texts of fewer than k code points are padded with
    zeros to one gram; shorter texts than a window have one choice; '' has none."""
    if not text:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(points) < k:
        points = np.concatenate([points, np.zeros(k - len(points), np.uint32)])
    h = rolling(points, k)
    last = np.uint64(2**32 - 1)
    keys = h << np.uint64(32) | (last - np.arange(len(h), dtype=np.uint64))  # equal hashes: rightmost is smallest
    chosen = window_min(keys, min(w, len(keys)))
    chosen = chosen[np.flatnonzero(np.diff(chosen, prepend=np.uint64(0)) != 0)]
    return (chosen >> np.uint64(32)).astype(np.uint32), (last - (chosen & last)).astype(np.int64)


def likeness(one: np.ndarray, two: np.ndarray) -> float:
    """Shared share of all distinct hashes; 1 for two empty fingerprints."""
    a, b = np.unique(one), np.unique(two)
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def digest(hashes: np.ndarray) -> str:
    """The fingerprint as text: 8 hex digits for each choice."""
    return hashes.astype(">u4").tobytes().hex()


def edited(text: str, following: str) -> str:
    """text with its last third (rounded down) replaced by as much of the start of following."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def _parts(documents: DataFrame, part_bytes: int) -> tuple[np.ndarray, dict[int | None, int]]:
    """(greatest id of each part in rising order, number of slices of each id with more than a part's bytes).

    Bytes by id are written in ranges of ids; a running sum in each range, after the sum of the
    ranges before it, gives each id its part. Both results have about MOST_PARTS rows at most.
    """
    bytes_ = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + ROW_BYTES
    by_id = documents.select("doc_id", bytes_.alias("bytes")).groupBy("doc_id").agg(F.sum("bytes").alias("bytes"))
    by_id = keep(by_id.repartitionByRange("doc_id").withColumn("range", F.spark_partition_id()), "ids")
    ranges = by_id.groupBy("range").agg(F.sum("bytes").alias("bytes"))  # a row per shuffle partition
    limit = max(part_bytes, -(-(ranges.agg(F.sum("bytes")).first()[0] or 0) // MOST_PARTS))
    before = F.coalesce(F.sum("bytes").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.sum("bytes").over(Window.partitionBy("range").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, 0)) - F.col("bytes")
    placed = by_id.join(F.broadcast(ranges.select("range", before.alias("before"))), "range").where("doc_id IS NOT NULL")
    placed = placed.select("doc_id", F.floor((F.col("before") + inside) / limit).alias("part"))
    bounds = placed.groupBy("part").agg(F.max("doc_id").alias("last")).toPandas()["last"].to_numpy(np.int64)
    heavy = by_id.where(F.col("bytes") > limit).select("doc_id", F.least(F.lit(SLICES), F.ceil(F.col("bytes") / limit)).alias("n")).collect()
    drop_kept(by_id)
    return np.sort(bounds), {r.doc_id: r.n for r in heavy}


def with_next_text(documents: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """(part, halo, doc_id, text) in sorted partitions where the next text is in the row below.

    Rows are dealt into parts, ranges of doc_id with part_bytes of text each, and sorted in descending
    order inside each. An id with more text than a part (or null) has parts of its own, by ranges of
    a hash of the text. Every part also gets, as a halo row at its end, the first row of the part that
    follows it; the last part gets the first row of all. What is sent to the executors is a number or
    two for each part, of which there are about MOST_PARTS at most; larger inputs have larger parts.
    """
    bounds, heavy = _parts(documents, part_bytes)
    own = sorted(x for x in heavy if x is not None)
    bounds = np.unique(np.array([*bounds[:-1], *own, *(x - 1 for x in own)], np.int64))
    held = documents.sparkSession.sparkContext.broadcast((bounds, np.array(own, np.int64), np.array([heavy[x] for x in own], np.int64), heavy.get(None, 1)))

    @F.pandas_udf("long")
    def part(doc_id: pd.Series, tie: pd.Series) -> pd.Series:
        bounds, own, slices, unnamed = held.value
        known = doc_id.notna().to_numpy()
        ids = doc_id.fillna(0).to_numpy(np.int64)
        number = np.where(known, np.searchsorted(bounds, ids), -1)
        at = np.minimum(np.searchsorted(own, ids), max(len(own) - 1, 0))
        many = np.where(known, np.where(own[at] == ids, slices[at], 1) if len(own) else 1, unnamed)
        share = (tie.to_numpy(np.int64).astype(np.float64) + 2.0**63) / 2.0**64  # greater hashes come first, in greater parts
        return pd.Series(number * SLICES + np.minimum((share * many).astype(np.int64), many - 1))

    tie = F.xxhash64("text")
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(part("doc_id", tie).alias("part"), "doc_id", "text")
    tops = keep(rows.groupBy("part").agg(F.max(F.struct("doc_id", tie.alias("tie"))).alias("top")), "tops")  # a row per part: see MOST_PARTS
    upward = Window.orderBy("part")
    lowest = F.min("part").over(upward.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    to = tops.select(F.col("part").alias("p"), "top", F.coalesce(F.lead("part").over(upward), lowest).alias("to"))
    first = rows.join(F.broadcast(to), (F.col("part") == F.col("p")) & F.col("doc_id").eqNullSafe(F.col("top.doc_id")) & (tie == F.col("top.tie")))
    first = first.groupBy("to").agg(F.max(F.struct("text", "doc_id")).alias("head"))
    halo = keep(first.select(F.col("to").alias("part"), F.col("head.doc_id").alias("doc_id"), F.col("head.text").alias("text"), F.lit(True).alias("halo")), "halo")
    both = rows.withColumn("halo", F.lit(False)).unionByName(halo)
    return both.repartition("part").sortWithinPartitions("part", "halo", F.col("doc_id").desc_nulls_last(), F.xxhash64("text").desc(), F.col("text").desc())


def fingerprint_documents(documents: DataFrame, k: int = K, w: int = W, part_bytes: int = PART_BYTES) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, positions.

    documents needs doc_id and text; other columns are ignored. Null counts as the empty text, of
    which the fingerprint is empty. The next document is the one below in descending order of
    doc_id (null ids last, equal ids by text); after the last comes the first, so a single document
    follows itself. Repeated rows follow one another. Likeness is that of sets of hashes. A worker
    holds two texts at a time, a few dozen bytes for each code point; none is cut.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row above: it waits for its next text
        for batch in batches:
            out = []
            for part, halo, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("part", "halo", "doc_id", "text")), strict=True):
                own = winnow(text, k, w)
                if held and held[0] == part:
                    _, before_id, before, print_ = held
                    changed = edited(before, text)
                    other = winnow(changed, k, w)[0]
                    out.append((before_id, len(before), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), digest(print_[0]), digest(other), likeness(print_[0], other), likeness(print_[0], own[0]), print_[1]))
                held = None if halo else (part, doc_id, text, own)
                if len(out) == 256:
                    yield _rows(out)
                    out = []
            if out:
                yield _rows(out)

    small_batches(documents.sparkSession)
    return with_next_text(documents, part_bytes).select("part", "halo", "doc_id", "text").mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, positions array<long>")


def _rows(out: list[tuple]) -> pa.RecordBatch:
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "positions"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
