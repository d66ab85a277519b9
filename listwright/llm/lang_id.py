"""Language ID by prediction by partial matching (PPM).

For every language a tree of byte contexts, up to ORDER bytes long, is learned from labelled
texts and then frozen. A text's code length under a language is the sum over its bytes of
-log2 p: the longest context that the tree knows predicts the byte (method C: count /
(count of the context + its distinct bytes)), or is left by an escape to the next shorter one,
in which the bytes of the longer one are excluded; below order 0 all bytes are alike. The
language with the shortest code wins. Trees are sparse: sorted arrays of the contexts and the
(context, byte) pairs that were met. Each distinct run of ORDER + 1 bytes of a slice of texts is
coded once for each language and counts as often as it is there.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import clash_free, small_batches
from .words import slices

ORDER = 4
PER_LANG, LANG_BYTES = 800, 8 << 20  # pieces and bytes of a language that training takes, about
ALL_BYTES = 32 << 20  # of all languages together, about: with more languages each has fewer
PIECE = 16 << 10  # bytes of a text that are taken or left together
SLICE = 1 << 20  # bytes of text whose distinct runs are coded at once
START = 10  # the byte that stands before a text


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _fold(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z, all digits as one."""
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    out[48:58] = 48
    return out[data]


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = pc.fill_null(column, "")
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    raw, n = texts.buffers(), len(texts)
    offsets = np.frombuffer(raw[1], width)[texts.offset : texts.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
    data = np.frombuffer(raw[2], np.uint8)[offsets[0] : offsets[-1]] if n and raw[2] is not None else np.zeros(0, np.uint8)
    return _fold(data), offsets - offsets[0]


def _contexts(symbols: np.ndarray, offsets: np.ndarray, start: int, base: int, order: int) -> np.ndarray:
    """For each byte the number of (its order predecessors, it) in base base."""
    out = symbols.astype(np.int64)
    place = np.arange(len(symbols)) - np.repeat(offsets[:-1], np.diff(offsets))
    for back in range(1, order + 1):
        before = np.full(len(symbols), start, np.int64)
        before[back:] = symbols[:-back] if back < len(symbols) else symbols[:0]
        before[place < back] = start
        out += before * base**back
    return out


@dataclass(frozen=True)
class Tree:
    """One language. By context length k: sorted pairs (k + 1 bytes) with their counts; sorted contexts
    with their total, distinct bytes, and the count in the next shorter context of those bytes."""

    pairs: list[np.ndarray]
    counts: list[np.ndarray]
    contexts: list[np.ndarray]
    totals: list[np.ndarray]
    distinct: list[np.ndarray]
    shadowed: list[np.ndarray]

    @staticmethod
    def of(grams: np.ndarray, n: np.ndarray, order: int) -> Tree:
        pairs, counts, contexts, totals, distinct, shadowed = [], [], [], [], [], []
        for k in range(order + 1):
            pair, at = np.unique(grams % 256 ** (k + 1), return_inverse=True)
            count = np.bincount(at, weights=n, minlength=len(pair)).astype(np.int64)
            context, at = np.unique(pair // 256, return_inverse=True)
            pairs.append(pair)
            counts.append(count)
            contexts.append(context)
            totals.append(np.bincount(at, weights=count, minlength=len(context)).astype(np.int64))
            distinct.append(np.bincount(at, minlength=len(context)).astype(np.int32))
            below = counts[k - 1][np.searchsorted(pairs[k - 1], pair % 256**k)] if k else np.zeros(len(pair))
            shadowed.append(np.bincount(at, weights=below, minlength=len(context)).astype(np.int64))
        return Tree(pairs, counts, contexts, totals, distinct, shadowed)

    def bits(self, grams: np.ndarray, base: int) -> np.ndarray:
        """Code length of the last byte of each gram after the bytes before it."""
        cost = np.zeros(len(grams))
        left = np.arange(len(grams))  # not coded yet
        gone_n, gone_q = np.zeros(len(grams)), np.zeros(len(grams), np.int64)  # counts and number of excluded bytes
        for k in range(len(self.pairs) - 1, -1, -1):
            if not len(left) or not len(self.pairs[k]):
                continue
            own = grams[left] % 256 ** (k + 1)
            at = np.minimum(np.searchsorted(self.contexts[k], own // 256), len(self.contexts[k]) - 1)
            known = self.contexts[k][at] == own // 256
            i, at, own = left[known], at[known], own[known]
            n, q = self.totals[k][at] - gone_n[i], self.distinct[k][at] - gone_q[i]
            escape = np.where(gone_q[i] + q < base, q, 0)  # nothing is left to escape to if all bytes were met
            place = np.minimum(np.searchsorted(self.pairs[k], own), len(self.pairs[k]) - 1)
            met = self.pairs[k][place] == own
            weight = np.where(met, self.counts[k][place], escape)
            new = q > 0
            cost[i[new]] += np.log2((n + escape)[new] / np.maximum(weight[new], 1))
            gone_n[i], gone_q[i] = self.shadowed[k][at], self.distinct[k][at]
            coded = np.zeros(len(grams), bool)
            coded[i[met]] = True
            left = left[~coded[left]]
        cost[left] += np.log2(np.maximum(base - gone_q[left], 1))
        return cost


@dataclass(frozen=True)
class Model:
    """Trees by language; symbol maps a byte to itself, or to one byte for all that were not met."""

    langs: list[str]
    symbol: np.ndarray
    base: int
    order: int
    trees: list[Tree]

    def bits(self, column: pa.Array) -> np.ndarray:
        """Code length of each text under each language."""
        data, offsets = _bytes(column)
        out = np.zeros((len(offsets) - 1, len(self.langs)))
        full = np.flatnonzero(np.diff(offsets))
        if len(full):
            grams, at = np.unique(_contexts(self.symbol[data], offsets, START, 256, self.order), return_inverse=True)
            for i, tree in enumerate(self.trees):
                out[full, i] = np.add.reduceat(tree.bits(grams, self.base)[at], offsets[:-1][full])
        return out


def _cut(data: np.ndarray, offsets: np.ndarray, chosen: list[list[int]], piece: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The chosen pieces of each text, as texts of their own, about SLICE bytes at a time."""
    spans = [(a + i * piece, min(a + (i + 1) * piece, b)) for a, b, own in zip(offsets[:-1], offsets[1:], chosen, strict=True) for i in own]
    step = max(1, SLICE // piece)
    for at in range(0, len(spans), step):
        own = spans[at : at + step]
        yield np.concatenate([data[a:b] for a, b in own]), np.cumsum([0, *(b - a for a, b in own)])


def training_sample(documents: DataFrame, per_lang: int = PER_LANG, lang_bytes: int = LANG_BYTES, all_bytes: int = ALL_BYTES, piece: int = PIECE) -> DataFrame:
    """(lang, text, chosen): texts with the numbers of their pieces that training takes.

    A language's distinct texts are divided into pieces of that many bytes; a hash of text and number
    takes about per_lang of them and about lang_bytes, or its even part of all_bytes if that is less. One piece
    of every language that has a letter or sign is always taken, so none is unlearned, however few and long its texts are.
    """
    labelled = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~is_held_out(F.col("doc_id"))).select("lang", "text", F.xxhash64("text").alias("key"))
    key, size = F.col("key"), F.octet_length("text")
    pieces = lambda n: F.greatest(F.ceil(n / piece), F.lit(1)).cast("int")
    texts = labelled.groupBy("lang", "key").agg(F.max(size).alias("bytes"))
    totals = texts.groupBy("lang").agg(F.sum(pieces(F.col("bytes"))).alias("pieces"), F.greatest(F.sum("bytes"), F.lit(1)).alias("bytes"), F.min(F.when(F.col("bytes") > 0, F.col("key"))).alias("least"))
    part = F.least(F.lit(float(lang_bytes)), F.lit(float(all_bytes)) / F.count("*").over(Window.partitionBy()))  # over a row per language
    share = totals.select("lang", "least", F.least(F.lit(float(per_lang)) / F.col("pieces"), part / F.col("bytes")).alias("share"))
    taken = lambda i: (F.pmod(F.xxhash64(key, i), F.lit(1 << 62)) < F.col("share") * float(1 << 62)) | ((i == 0) & (key == F.col("least")))
    rows = labelled.join(F.broadcast(share), "lang")  # one row per language
    rows = rows.select("lang", "text", F.filter(F.sequence(F.lit(0), pieces(size) - 1), taken).alias("chosen"))
    return rows.where(F.size("chosen") > 0).distinct()


def learn(documents: DataFrame, order: int = ORDER, per_lang: int = PER_LANG, lang_bytes: int = LANG_BYTES, all_bytes: int = ALL_BYTES) -> Model:
    """A model from labelled documents outside the held-out part.

    What is counted is training_sample's: equal texts once, whole texts of up to PIECE bytes, pieces of
    longer ones. A language's tree is built in one task, from no more than its sample; all have
    contexts up to order bytes. The driver gets the trees, which all_bytes bounds whatever the number of
    documents and languages: at most 44 bytes of tree for a byte of the sample and each context length. Without
    labelled rows the model has no language.
    """
    small_batches(documents.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                lang = np.array(part.column("lang").to_pylist(), object)
                for name in sorted(set(lang)):
                    own = part.filter(pa.array(lang == name))
                    for data, offsets in _cut(*_bytes(own.column("text")), own.column("chosen").to_pylist(), PIECE):
                        gram, n = np.unique(_contexts(data, offsets, START, 256, order), return_counts=True)
                        yield pa.RecordBatch.from_arrays([pa.array([name] * len(gram), pa.string()), pa.array(gram), pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        tree = Tree.of(frame["gram"].to_numpy(np.int64), frame["n"].to_numpy(), order)
        return pd.DataFrame({"lang": frame["lang"].iloc[:1].to_numpy(), "tree": [pickle.dumps(tree)]})

    sample = training_sample(documents, per_lang, lang_bytes, all_bytes)
    grams = sample.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    built = {r.lang: pickle.loads(bytes(r.tree)) for r in grams.groupBy("lang").applyInPandas(build, "lang string, tree binary").collect()}
    langs = sorted(built)
    used = np.zeros(256, bool)
    used[START] = True
    for tree in built.values():
        used[tree.pairs[0]] = True  # every byte is the last of a run
    symbol = np.arange(256)
    if not used.all():
        symbol[~used] = np.flatnonzero(~used)[0]
    return Model(langs, symbol, int(used.sum()) + 1, order, [built[x] for x in langs])


@clash_free("_guess")
def predict(documents: DataFrame, model: Model) -> DataFrame:
    """documents with lang_pred, score and bits_per_byte.

    documents needs text; clashing lang_pred, score or bits_per_byte columns are replaced. score is
    the language's share of the probability that all languages give the text; bits_per_byte is the
    length of its code for a byte of the text, small for texts like those learned (null for 'und'). Null texts, texts
    without a letter, and all texts if no language was learned, are 'und' with score 0. Equal
    code lengths go to the language first in code-point order. Repeated rows are scored alike. A
    slice of texts, or one text of any length, takes about 50 times its bytes in a worker.
    """
    small_batches(documents.sparkSession)
    rows = documents.drop("lang_pred", "score", "bits_per_byte")
    held = documents.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang string, score double, bits double>")
    def guess(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = held.value
        for texts in column:
            batch = pa.RecordBatch.from_arrays([texts], names=["text"])
            langs, scores, rates = [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0)]
            for part in slices(batch, "text", SLICE):
                bits = own.bits(part.column("text"))
                langs.append(bits.argmin(axis=1))
                scores.append(1 / np.exp2(bits.min(axis=1, keepdims=True) - bits).sum(axis=1))
                length = pc.fill_null(pc.binary_length(part.column("text")), 0).to_numpy(zero_copy_only=False)
                rates.append(bits.min(axis=1) / np.maximum(length, 1))
            lang = pa.array(own.langs, pa.string()).take(pa.array(np.concatenate(langs)))
            yield pa.StructArray.from_arrays([lang, pa.array(np.concatenate(scores)), pa.array(np.concatenate(rates))], names=["lang", "score", "bits"])

    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if not model.langs:
        return rows.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0), "bits_per_byte": F.lit(None).cast("double")})
    rows = rows.withColumn("_guess", guess("text"))
    return rows.withColumns({"lang_pred": F.when(lettered, F.col("_guess.lang")).otherwise("und"), "score": F.when(lettered, F.col("_guess.score")).otherwise(0.0), "bits_per_byte": F.when(lettered, F.col("_guess.bits"))}).drop("_guess")
