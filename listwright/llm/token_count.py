"""Token counts as an exact histogram of encoded lengths.

Documents are reduced to (n_tokens, n_docs) before anything is shuffled for totals. Suffix sums
over the distinct lengths then answer, for every context limit, how many documents reach it and
how many tokens truncation leaves.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import small_batches

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: how byte-level BPE splits a text before merging.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
MAX_VOCABULARY = 64 << 20
#: White space as SPLIT means it. A run of LONG_RUN of them before other text makes SPLIT backtrack, one
#: frame of the stack for each, so such runs are cut where SPLIT cuts them: before their last character.
BLANK = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_RUN = 4096

_encodings: dict[bytes, object] = {}


def read_vocabulary(path: str) -> bytes:
    """The ranks file; it is sent to the executors, so its size is checked."""
    with open(path, "rb") as f:
        found = f.read(MAX_VOCABULARY + 1)
    if len(found) > MAX_VOCABULARY:
        raise ValueError(f"{path} has over {MAX_VOCABULARY} bytes")
    return found


def encoding(ranks: bytes, split: str = SPLIT):
    """A tiktoken encoding of 'base64 rank' lines, made once in a process."""
    import hashlib

    import tiktoken

    key = hashlib.sha256(ranks + split.encode()).digest()
    if key not in _encodings:
        _encodings[key] = tiktoken.Encoding("ranks", pat_str=split, mergeable_ranks={base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}, special_tokens={})
    return _encodings[key]


def tokens_in(own, text: str, split: str = SPLIT, long_run: int = LONG_RUN) -> int:
    """Number of tokens of the whole text."""
    total = at = 0
    if split == SPLIT:
        for run in re.finditer(f"[{BLANK}]{{{long_run},}}", text):
            if run.end() < len(text):
                total += len(own.encode_ordinary(text[at : run.start()])) + len(own.encode_ordinary(text[run.start() : run.end() - 1]))
                at = run.end() - 1
    return total + len(own.encode_ordinary(text[at:]))


def count_tokens(documents: DataFrame, vocabulary: str = VOCABULARY, split: str = SPLIT) -> DataFrame:
    """documents with n_tokens of the whole text; null and empty texts have 0.

    A clashing n_tokens column is replaced. Strings of special tokens are ordinary text. A text
    of any length is encoded whole, one at a time; repeated rows are counted alike.
    """
    small_batches(documents.sparkSession)
    held = documents.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    @F.pandas_udf("long")
    def count(column: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = encoding(held.value, split)
        for texts in column:
            yield texts.map(lambda text: tokens_in(own, text, split) if text else 0).astype("int64")

    return documents.drop("n_tokens").withColumn("n_tokens", count("text"))


def length_histogram(counted: DataFrame) -> DataFrame:
    """One row per distinct n_tokens: n_docs, tokens, docs_ge, tokens_ge, total_if_truncated, share_below.

    docs_ge and tokens_ge are suffix sums over lengths of at least n_tokens; total_if_truncated is
    what all documents hold when each is cut at n_tokens; share_below is the share of shorter
    documents. Repeated rows count each. An empty table gives no rows. The windowed table has one
    row per distinct length, at most the longest document's.
    """
    hist = counted.groupBy("n_tokens").agg(F.count("*").alias("n_docs")).withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    up = Window.orderBy("n_tokens")
    ge, below = up.rowsBetween(0, Window.unboundedFollowing), up.rowsBetween(Window.unboundedPreceding, -1)
    docs_ge, docs_below, tokens_below = F.sum("n_docs").over(ge), F.coalesce(F.sum("n_docs").over(below), F.lit(0)), F.coalesce(F.sum("tokens").over(below), F.lit(0))
    return hist.select(
        "n_tokens", "n_docs", "tokens", docs_ge.alias("docs_ge"), F.sum("tokens").over(ge).alias("tokens_ge"), (tokens_below + F.col("n_tokens") * docs_ge).alias("total_if_truncated"), (docs_below / (docs_below + docs_ge)).alias("share_below")
    )


def answer_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, docs_over, truncated_total, kept_total) for each limit from the histogram alone.

    docs_over have more than context_limit tokens; truncated_total cuts them; kept_total drops them.
    Limits without any document have zeros.
    """
    h = F.col("n_tokens")

    def of(limit: int) -> Column:
        over = h > limit
        parts = (F.when(over, F.col("n_docs")).otherwise(0), F.least(h, F.lit(limit)) * F.col("n_docs"), F.when(over, 0).otherwise(F.col("tokens")))
        return F.struct(F.lit(limit).cast("long").alias("context_limit"), *[F.coalesce(F.sum(p), F.lit(0)).alias(a) for p, a in zip(parts, ("docs_over", "truncated_total", "kept_total"), strict=True)])

    return histogram.agg(F.array(*[of(x) for x in sorted(set(limits))]).alias("all")).select(F.inline("all"))


def length_quantiles(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """(share, n_tokens): the smallest length that at least share of the documents do not exceed."""
    reached = (F.col("share_below") + F.col("n_docs") / F.col("docs_ge") * (1 - F.col("share_below"))).alias("upto")
    h = histogram.select("n_tokens", reached)
    return h.select(F.explode(F.array(*[F.struct(F.lit(float(q)).alias("share"), F.when(F.col("upto") >= q - 1e-12, F.col("n_tokens")).alias("n")) for q in shares])).alias("x")).groupBy("x.share").agg(F.min("x.n").alias("n_tokens"))
