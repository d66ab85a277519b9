"""Words of Arrow text columns as numpy arrays: offsets and 64-bit hashes.

A word is a run of bytes other than 0x20 and 0x09-0x0D. All functions work on slices of a
record batch so that memory stays within a few times SLICE_BYTES or the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 256 << 10
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]
_STEP = np.uint64(0x9E3779B97F4A7C15)
WORD_STEP = np.uint64(0xD1342543DE82EF95)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of about size bytes of text each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(sizes) // size
    edges = np.flatnonzero(np.diff(part, prepend=-1))
    for a, b in zip(edges, [*edges[1:], batch.num_rows], strict=True):
        yield batch.slice(a, b - a)


class Words:
    """Words of a text column. first[i]:first[i+1] are the words of row i."""

    def __init__(self, column: pa.Array, fold: bool = False):
        texts = pc.fill_null(column, "")
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
        n = len(texts)
        raw = texts.buffers()
        offsets = np.frombuffer(raw[1], width)[texts.offset : texts.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
        whole = np.frombuffer(raw[2], np.uint8) if n and raw[2] is not None else np.zeros(0, np.uint8)
        self.data = whole[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        inside = ~_SPACE[self.data]
        joined = np.zeros(len(self.data) + 1, bool)  # joined[i]: bytes i-1 and i belong to one word
        joined[1:-1] = inside[1:] & inside[:-1] if len(self.data) else False
        joined[offsets] = False
        self.start = np.flatnonzero(inside & ~joined[:-1])
        self.end = np.flatnonzero(inside & ~joined[1:]) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.fold = fold
        self._inside = inside

    def hashes(self) -> np.ndarray:
        """A hash of each word's bytes; A-Z count as a-z if fold."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        length = self.end - self.start
        begin = np.cumsum(length) - length
        value = (_FOLDED if self.fold else _BYTE)[self.data[self._inside]]
        place = np.arange(len(value)) - np.repeat(begin, length)
        value *= powers(_STEP, int(length.max()))[place]
        return mix(np.add.reduceat(value, begin) + length.astype(np.uint64))


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of h[i:i+k] for each i (len(h)-k+1 values), whatever row the words are from."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    n = len(h)
    p = powers(WORD_STEP, k)[::-1]
    if k <= 8:
        total = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            total += h[j : n - k + 1 + j] * p[j]
        return mix(total)
    # Horner prefixes: total(i) = H(i+k) - H(i) * step**k, with H built from weighted sums.
    up = powers(WORD_STEP, n + 1)
    inverse = np.uint64(pow(int(WORD_STEP), -1, 2**64))
    weighted = np.zeros(n + 1, np.uint64)
    np.cumsum(h * up[:n], out=weighted[1:])
    return mix((weighted[k:] - weighted[:-k]) * powers(inverse, n + 1)[: n - k + 1])


def within_rows(first: np.ndarray, k: int) -> np.ndarray:
    """For grams(h, k): whether the k words starting at i are of one row; k words or more."""
    total = int(first[-1])
    ok = np.zeros(max(total - k + 1, 0), bool)
    counts = np.maximum(np.diff(first) - k + 1, 0)
    starts = np.repeat(first[:-1], counts) + (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts))
    ok[starts] = True
    return ok


def window_min(keys: np.ndarray, w: int) -> np.ndarray:
    """Minimum of keys[i:i+w] for each i (len(keys)-w+1 values), by doubling."""
    out, width = keys, 1
    while width * 2 <= w:
        out = np.minimum(out[: len(out) - width], out[width:])
        width *= 2
    rest = w - width
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out
