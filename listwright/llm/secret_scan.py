"""Secret scans: candidates by pattern, false positives removed by a random forest.

Features of a candidate: its length, how likely its character transitions are in the corpus,
its coverage by dictionary words, whether it is part of a path, address or URL, and the words
beside it. The dictionary is the corpus's most frequent words; what a neighbouring word tells is
learned from the labelled findings, as the log of its odds beside secrets. By default findings are
made by planting secrets and look-alikes into sampled documents, so that neighbours are real.
"""

from __future__ import annotations

import base64
import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import clash_free, keep, small_batches
from .words import slices

SAMPLE_DOCS, CONTEXT_WORDS, FINDINGS = 2000, 40, 8
TREES, DEPTH = 31, 9
KEEP_SCORE = 0.5
SCORED_AT_ONCE = 4096  # candidates of one text
CLASSES = 28  # a-z, digits, the rest
_BLANK, _VALUE = r"[^\S\r\n]*", r"[\w+/=.!@#$%^&*~-]"
_NAME = r"(?:(?<!\w)|(?<=_)|(?<=[a-z])(?=[A-Z]))(?i:passwords?|passwd|passphrase|pwd|passwort|пароль|contraseña|密码|secret|token|credential|auth|api[ _-]?key|key)"
_QUOTED = r"\"(?P<{0}2>[^\"\r\n]+)\"|'(?P<{0}1>[^'\r\n]+)'"
_SCHEME = r"(?!(?i:bearer|basic)[^\S\r\n])"
CANDIDATE = re.compile(
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----.*?(?:-----END [A-Z ]*PRIVATE KEY-----|\Z)"
    # between a user and the host of an address
    r"|://[^\s/:@]*:(?P<login>[^\s/]+)(?=@)"
    # after a name and a sign, on the same line or the next, of any length
    rf"|{_NAME}[\"']?{_BLANK}(?:->|=>|:=|[=:]){_BLANK}(?:\r?\n{_BLANK})?(?:{_QUOTED.format('told')}|{_SCHEME}[\"']?(?P<told>{_VALUE}+))"
    # after a name alone
    rf"|{_NAME}[^\S\r\n]+(?:(?i:is)[^\S\r\n]+)?(?:{_QUOTED.format('named')}|[\"']?(?P<named>{_VALUE}{{4,}}))"
    rf"|(?:(?<=[=:])|[=:]){_BLANK}[\"']?{_SCHEME}(?P<assigned>{_VALUE}{{4,}})"
    r"|(?<![A-Za-z0-9])(?i:bearer|basic)[^\S\r\n]+[\"']?(?P<bearer>[A-Za-z0-9_+/=.-]{8,})"
    r"|(?<![A-Za-z0-9_+/.-])[A-Za-z0-9_+/-][A-Za-z0-9_+/.-]{14,}[A-Za-z0-9_+/-]={0,2}",
    re.S,
)
BEFORE, AFTER = 3, 2  # neighbouring words
LEAST_SEEN = 8  # findings beside which a word must be before it tells anything
DICTIONARY_WORDS, LEAST_COUNT = 5000, 3
#: Names of secrets in planted findings.
SECRET_WORDS = "token secret password passwd pwd key apikey api_key api-key access_key secret_key client_secret auth authorization bearer credential Passwort пароль contraseña 密码".split()
#: Words of placeholders, which a corpus need not have.
PLACEHOLDERS = "placeholder change changeme example sample test dummy your here insert value name user admin login mail www com org net http https html index null none true false default foo bar baz xxx abc password token secret key required".split()
_CLASS = np.full(256, 27, np.uint8)
_CLASS[97:123] = np.arange(26)
_CLASS[65:91] = np.arange(26)
_CLASS[48:58] = 26
FEATURES = ("length", "transitions", "coverage", "digits", "upper", "entropy", "symbols", "hex", "path", "address", "assigned", "quoted", "word_before", "words_before", "words_after", "block")
_NEAR = re.compile(r"[^\W\d_]+|\d+")


@dataclass(frozen=True)
class Corpus:
    """What is known before training: transitions between character classes, and frequent words."""

    transitions: np.ndarray
    words: frozenset[str]


def corpus_statistics(documents: DataFrame, most_words: int = DICTIONARY_WORDS) -> Corpus:
    """log2 probabilities of a character class after another and the most_words most frequent words of
    3 to 12 letters that are there LEAST_COUNT times, both counted over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES * CLASSES, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                texts = pc.fill_null(part.column("text"), "")
                data = np.frombuffer("\n".join(texts.to_pylist()).encode(), np.uint8)
                c = _CLASS[data].astype(np.int64)
                total += np.bincount(c[:-1] * CLASSES + c[1:], minlength=CLASSES * CLASSES)
                words = pc.list_flatten(pc.split_pattern_regex(pc.ascii_lower(texts), r"[^a-z0-9_+/=-]+"))
                found = pc.value_counts(words.filter(pc.match_substring_regex(words, "^[a-z]{3,12}$")))
                yield pa.RecordBatch.from_arrays([found.field("values").cast(pa.string()), found.field("counts")], names=["item", "n"])
        pairs = [str(i) for i in range(len(total))]
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(total)], names=["item", "n"])

    got = keep(documents.select("text").mapInArrow(count, "item string, n long").groupBy("item").agg(F.sum("n").alias("n")), "statistics")
    pairs = got.where(F.col("item").rlike("^[0-9]")).toPandas()  # 784 rows
    n = np.ones(CLASSES * CLASSES)
    n[pairs["item"].astype(int)] += pairs["n"]
    n = n.reshape(CLASSES, CLASSES)
    top = got.where(~F.col("item").rlike("^[0-9]") & (F.col("n") >= LEAST_COUNT)).orderBy(F.desc("n"), "item").limit(most_words).collect()
    return Corpus(np.log2(n / n.sum(axis=1, keepdims=True)), frozenset([r["item"] for r in top] + PLACEHOLDERS))


def _coverage(word: str, words: frozenset[str]) -> float:
    """Share of the characters under dictionary words of three letters or more, longest first."""
    covered = at = 0
    low = word.lower()
    while at < len(low):
        size = next((k for k in range(min(12, len(low) - at), 2, -1) if low[at : at + k] in words), 0)
        covered += size
        at += size or 1
    return covered / max(1, len(low))


def _neighbours(text: str, start: int, end: int) -> tuple[list[str], list[str]]:
    """The BEFORE words before a candidate, nearest last, and the AFTER words after it, however long."""
    reach, before = 64, []
    while True:  # most often the first look is enough
        at = max(0, start - reach)
        before = list(_NEAR.finditer(text[at:start].lower()))
        if at == 0 or len(before) > BEFORE:
            break
        reach *= 4
    after = []
    for word in _NEAR.finditer(text, end):
        after.append(word[0].lower())
        if len(after) == AFTER:
            break
    return [w[0] for w in before[-BEFORE:]], after


def _features(text: str, start: int, end: int, corpus: Corpus, odds: dict[str, float]) -> list[float]:
    own = text[start:end]
    raw = np.frombuffer(own.encode(), np.uint8)
    c = _CLASS[raw]
    likely = float(corpus.transitions[c[:-1], c[1:]].mean()) if len(c) > 1 else 0.0
    counts = np.unique(raw, return_counts=True)[1] / max(1, len(raw))
    before, after = _neighbours(text, start, end)
    blank = text.rfind(" ", 0, start)  # the nearest; line breaks are sought after it alone, not in the whole text
    line = text[max(text.rfind("\n", blank + 1, start), blank) + 1 : start]  # what is joined to it
    at = start
    while at and text[at - 1] in " \t\r\n\"'":
        at -= 1
    lead = text[at - 1 : at] if at else ""
    arrow = text[max(0, at - 2) : at] in ("->", "=>")
    told = [odds.get(w, 0.0) for w in before] or [0.0]
    n = max(1, len(own))
    return [
        float(end - start),
        likely,
        _coverage(own, corpus.words),
        sum(x.isdigit() for x in own) / n,
        sum(x.isupper() for x in own) / n,
        float(-(counts * np.log2(counts)).sum()),
        sum(not x.isalnum() for x in own) / n,
        float(re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", own) is not None),
        float(own.count("/") + own.count("\\") + (re.search(r"\w/$|://\S*$", line) is not None)),
        float(text[start - 1 : start] == "@" or text[end : end + 1] == "@" or "@" in own or re.fullmatch(r"[0-9.-]+", own) is not None),
        float(arrow or (lead in ("=", ":") and lead != "")),
        float(text[start - 1 : start] in ("\"", "'") and start > 0),
        told[-1],
        max(told) + min(told),
        sum(odds.get("> " + w, 0.0) for w in after),
        float(own.startswith("-----BEGIN")),
    ]


def neighbour_odds(findings: list[tuple[str, int, int, bool]], least: int = LEAST_SEEN) -> dict[str, float]:
    """log2 odds of a secret beside each word that least findings or more have; '> ' marks words after."""
    seen: dict[str, list[int]] = {}
    for text, a, b, secret in findings:
        before, after = _neighbours(text, a, b)
        for word in {*before, *("> " + w for w in after)}:
            seen.setdefault(word, [0, 0])[secret] += 1
    total = [max(1, sum(f[3] == bool(k) for f in findings)) for k in (0, 1)]
    return {w: math.log2((n[1] + 2) / total[1]) - math.log2((n[0] + 2) / total[0]) for w, n in seen.items() if sum(n) >= least}


def _random(rng: random.Random, letters: str, n: int) -> str:
    return "".join(rng.choice(letters) for _ in range(n))


def planted(rng: random.Random, neighbour: str) -> tuple[str, str, bool]:
    """(passage, the finding in it, whether it is a secret): one labelled finding."""
    hexa, alnum, digits = "0123456789abcdef", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "0123456789"
    letters = alnum[:52]
    if rng.random() < 0.1:  # key blocks, with a placeholder as the look-alike
        kind, secret = rng.choice(("", "RSA ", "EC ", "OPENSSH ")), rng.random() < 0.7
        body = "\n".join(base64.b64encode(rng.randbytes(48)).decode() for _ in range(rng.randint(3, 26))) if secret else rng.choice(("YOUR KEY HERE", "...", "<key>", "insert your private key here"))
        value = f"-----BEGIN {kind}PRIVATE KEY-----\n{body}\n-----END {kind}PRIVATE KEY-----"
        return value, value, secret
    if rng.random() < 0.1:  # tokens after their scheme
        secret = rng.random() < 0.6
        value = _random(rng, rng.choice((letters, letters[:26], alnum)), rng.randint(12, 110)) if secret else rng.choice(("YOUR_TOKEN", "your_token_here", "authentication", *3 * ((re.sub(r"\W", "", neighbour) * 8)[: max(8, len(neighbour))] or "neighbour",)))
        return rng.choice(("the bearer {v}", "a bearer {v}", "Bearer {v}") if not secret and rng.random() < 0.7 else ("Authorization: Bearer {v}", "Bearer {v}", "authorization: bearer {v}", "Authorization: Basic {v}")).format(v=value), value, secret
    if rng.random() < 0.12:  # named in prose, without a sign
        secret, name = rng.random() < 0.5, rng.choice(("password", "secret", "token", "api key", "Password", "passphrase"))
        word = re.sub(r"\W", "", neighbour) or "neighbour"
        value = rng.choice((_random(rng, alnum, rng.randint(8, 24)), word + str(rng.randint(10, 9999)) + rng.choice(("", "secret", word[:4])), _random(rng, letters[:26], rng.randint(50, 90)) + _random(rng, alnum, 8))) if secret else rng.choice((word, "manager", "policy", "protected", "garden", "required", "economy"))
        return rng.choice(("{n} {v}", "{n} is {v}", '{n} "{v}"') if secret else ("{n} {v}", "{n} is {v}")).format(n=name, v=value), value, secret
    if rng.random() < 0.06:  # logins in addresses, with ports as the look-alike
        secret, host = rng.random() < 0.6, rng.choice(("db", "cache.internal", "10.0.0.7"))
        value = rng.choice((_random(rng, alnum, rng.randint(4, 24)), _random(rng, letters[:26], 6) + _random(rng, digits, 2))) if secret else f"{rng.randint(1000, 9999)}/{re.sub(r'[^a-z]', '', neighbour.lower()) or 'word'}"
        scheme = rng.choice(("postgres", "mysql", "redis", "https", "amqp"))
        return f"{scheme}://user:{value}@{host}/main" if secret else f"{scheme}://{host}:{value}", value, secret
    if rng.random() < 0.5:
        value = rng.choice(
            [
                lambda: _random(rng, hexa, rng.choice((32, 40, 40, 40, 64))),
                lambda: _random(rng, hexa, 40).upper(),
                lambda: "AKIA" + _random(rng, "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16),
                lambda: "ghp_" + _random(rng, alnum, 36),
                lambda: "sk-" + _random(rng, alnum, rng.choice((32, 48))),
                lambda: base64.b64encode(rng.randbytes(rng.choice((24, 30, 48)))).decode(),
                lambda: "eyJ" + _random(rng, alnum, 33) + "." + _random(rng, alnum, 60) + "." + _random(rng, alnum, 43),
                lambda: _random(rng, alnum + "!@#$%^&*", rng.randint(12, 20)),
                lambda: _random(rng, alnum, rng.randint(4, 11)),
                lambda: _random(rng, letters[:26], rng.randint(4, 7)) + _random(rng, digits, rng.randint(1, 3)),
                lambda: _random(rng, letters, rng.randint(10, 24)),
                lambda: _random(rng, alnum, rng.choice((3, 3, 4))),
                lambda: (re.sub(r"\W", "", neighbour) or "word") + _random(rng, digits, rng.randint(1, 4)) + rng.choice(("", *letters[:26], *"!#$")),
                lambda: (re.sub(r"\W", "", neighbour) or "word").title() + _random(rng, digits, rng.randint(1, 4)) + rng.choice(("", *"!#$")),
                lambda: _random(rng, "абвгдежзиклмнопрстуфхцчшыэюя", rng.randint(5, 9)) + _random(rng, digits, 2),
            ]
        )()
        name = rng.choice(SECRET_WORDS)
        form = rng.choice(['{n} = "{v}"', "{n}={v}", "{n}: {v}", "{n}:  {v}", "{n} =   {v}", "{n} = '{v}'", 'NAME_{n}="{v}"', '"{n}": "{v}"', "{n} -> {v}", "{n} => {v}", "{n}:\n  {v}"])
        name = name.upper() if rng.random() < 0.3 else name
        return form.format(n=name, v=value), value, True
    kind = rng.randrange(14)
    word = re.sub(r"\W", "", neighbour) or "word"
    value = [
        lambda: f"{word}.{rng.randint(1, 99)}@mail{rng.randint(1, 9)}.example.com",
        lambda: ".".join(str(rng.randint(100, 255)) for _ in range(4)) + "." * 0,
        lambda: _random(rng, digits, rng.randint(16, 20)),
        lambda: "-".join(_random(rng, hexa, k) for k in (8, 4, 4, 4, 12)),
        lambda: _random(rng, hexa, rng.choice((32, 40, 64))),
        lambda: f"/{word}/{rng.randint(1, 999)}/{word}-{rng.randint(1, 99)}.html",
        lambda: f"{word}-{word}-{rng.randint(1, 99)}.{rng.randint(1, 99)}.tar.gz",
        lambda: f"20{rng.randint(10, 30)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}T{rng.randint(10, 23)}:{rng.randint(10, 59)}:{rng.randint(10, 59)}Z".replace(":", "-"),
        lambda: rng.choice(("YOUR_TOKEN_HERE", "your_api_key_here", "changeme_changeme1", "example_token_value", "<insert_token_here>", "xxxxxxxxxxxxxxxx1111")),
        lambda: f"www.{word}.example.com/{word}{rng.randint(1, 999)}",
        lambda: (word * 12)[:18] + str(rng.randint(1, 99)) * rng.randint(0, 1),
        lambda: (word * 4)[: max(4, len(word))],
        lambda: _random(rng, digits, rng.randint(4, 9)),
        lambda: rng.choice(("none", "null", "true", "required", "example", "changeme", "password", "your_password", "xxxx", "test")),
    ][kind]()
    if kind in (4, 3):
        form = rng.choice(("commit {v}", "sha1 {v}", "checksum: {v}", "md5: {v}", "uuid {v}", "id={v}", "sha256: {v}", "digest = \"{v}\""))
    elif kind in (11, 12):
        form = rng.choice(("note: {v}", "title:  {v}", "name = {v}", "id={v}", "build: {v}", f"{word}: {{v}}", f"{word} = {{v}}"))
    elif kind in (8, 13):
        form = rng.choice(('token = "{v}"', "password={v}", "api_key: {v}"))
    else:
        form = rng.choice(("{v}", "{v}", "{v}", "{v},", "({v})", "ref: {v}", "id={v}"))
    return form.format(v=value), value, False


def labelled_findings(documents: DataFrame, sample_docs: int = SAMPLE_DOCS, seed: int = 11) -> list[tuple[str, int, int, bool]]:
    """(text, start, end, label): planted in about sample_docs documents, FINDINGS in each.

    The sample is chosen by a hash of doc_id and holds at most 2 * sample_docs rows, each
    CONTEXT_WORDS words from a place in the text that a hash chooses: neighbours of the findings.
    It trains the classifier and does nothing else.
    """
    total = documents.count()
    words = F.split("text", r"[\x20\x09-\x0D]+")
    at = F.pmod(F.xxhash64("doc_id", F.lit("place")), F.greatest(F.lit(1), F.size(words) - (CONTEXT_WORDS - 1))).cast("int") + 1
    rows = documents.where(F.col("text").isNotNull()).select("doc_id", F.array_join(F.slice(words, at, CONTEXT_WORDS), " ").alias("text"))
    rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) <= int((1 << 20) * min(1.0, sample_docs / max(1, total))))
    # Rows of one doc_id hash alike, so the limit bounds a table of repeated ids.
    out = []
    for row in rows.orderBy(F.xxhash64("doc_id"), "text").limit(2 * sample_docs).collect():
        rng = random.Random(f"{seed}:{row.doc_id}")
        words = row.text.split() or ["word"]
        for _ in range(FINDINGS):
            at = rng.randrange(len(words) + 1)
            passage, value, secret = planted(rng, rng.choice(words))
            before = " ".join(words[:at])
            text = f"{before} {passage} {' '.join(words[at:])}"
            start = text.index(value, len(before))
            out.append((text, start, start + len(value), secret))
    return out


class Forest:
    """Classification trees on bootstrap samples, with a random part of the features per split."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 5):
        rng = np.random.Generator(np.random.PCG64(seed))
        grown = [self._grow(x[at], y[at], depth, rng) for at in (rng.integers(0, len(y), len(y)) for _ in range(trees))] if len(y) else []
        nodes: list[tuple[int, float, int, int]] = []
        self.depth, self.roots = depth, np.array([self._flat(tree, nodes) for tree in grown], int)
        self.feature, self.value, self.below, self.above = (np.array(c) for c in zip(*nodes, strict=True)) if nodes else [np.empty(0)] * 4

    def _flat(self, tree, nodes: list[tuple[int, float, int, int]]) -> int:
        """The place of a tree's root in nodes: feature, cut or vote, place of each side."""
        at = len(nodes)
        nodes.append((0, tree, at, at) if isinstance(tree, float) else (0, 0.0, 0, 0))
        if not isinstance(tree, float):
            nodes[at] = (tree[0], tree[1], self._flat(tree[2], nodes), self._flat(tree[3], nodes))
        return at

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int, rng: np.random.Generator):
        if not depth or len(y) < 6 or y.min() == y.max():
            return float(y.mean())
        best = (np.inf, 0, 0.0)
        for f in rng.choice(x.shape[1], max(2, int(x.shape[1] ** 0.5) + 1), replace=False):
            order = np.argsort(x[:, f], kind="stable")
            v, ones = x[order, f], np.cumsum(y[order])
            cut = np.flatnonzero(v[1:] > v[:-1]) + 1
            if len(cut):
                left, right = ones[cut - 1], ones[-1] - ones[cut - 1]
                gini = left * (1 - left / cut) + right * (1 - right / (len(y) - cut))
                k = int(gini.argmin())
                best = min(best, (float(gini[k]), int(f), float((v[cut[k]] + v[cut[k] - 1]) / 2)))
        if best[0] == np.inf:
            return float(y.mean())
        side = x[:, best[1]] <= best[2]
        return best[1], best[2], self._grow(x[side], y[side], depth - 1, rng), self._grow(x[~side], y[~side], depth - 1, rng)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Mean vote for each row; without labelled findings every candidate is taken for a secret."""
        if not self.roots.size:
            return np.ones(len(x))
        at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        for _ in range(self.depth):  # leaves lead to themselves
            low = np.take_along_axis(x, self.feature[at], axis=1) <= self.value[at]
            at = np.where(low, self.below[at], self.above[at])
        return self.value[at].mean(axis=1)


@dataclass(frozen=True)
class Scanner:
    corpus: Corpus
    odds: dict[str, float]
    forest: Forest


def train(documents: DataFrame, labelled: list[tuple[str, int, int, bool]] | None = None) -> Scanner:
    """Statistics over all texts, then odds of neighbours and a forest from labelled findings."""
    corpus = corpus_statistics(documents)
    findings = labelled_findings(documents) if labelled is None else labelled
    # Odds and forest learn from different findings, or chance neighbours would tell the forest the labels.
    half = len(findings) // 2
    odds, rest = neighbour_odds(findings[:half]), findings[half:]
    x = np.array([_features(text, a, b, corpus, odds) for text, a, b, _ in rest]).reshape(-1, len(FEATURES))
    return Scanner(corpus, odds, Forest(x, np.array([float(f[3]) for f in rest])))


def find_secrets(text: str, scanner: Scanner, keep_score: float = KEEP_SCORE) -> tuple[int, list[tuple[int, int, float]]]:
    """Number of candidates, and (start, end, score) of those that are secrets."""
    found = [m.span(m.lastgroup or 0) for m in CANDIDATE.finditer(text)]
    secrets = []
    for at in range(0, len(found), SCORED_AT_ONCE):
        some = found[at : at + SCORED_AT_ONCE]
        scores = scanner.forest.scores(np.array([_features(text, a, b, scanner.corpus, scanner.odds) for a, b in some]))
        secrets += [(a, b, s) for (a, b), s in zip(some, scores.tolist(), strict=True) if s >= keep_score]
    return len(found), secrets


@clash_free("_scan")
def scan_secrets(documents: DataFrame, labelled: list[tuple[str, int, int, bool]] | None = None, mask: str = "[secret]") -> DataFrame:
    """documents with n_candidates, secrets (array of start, end, score) and redacted.

    documents needs doc_id and text; clashing result columns are replaced. Offsets are code
    points. redacted is the whole text with each secret replaced by mask. Null texts have no
    candidates and stay null; empty texts stay empty; repeated rows are scanned alike. A worker
    holds one text of any length and its masked copy; candidates of any length are judged whole.
    A value after a name of a secret and a sign may have any length and stand on the next line; after
    a name alone or another sign it has 4 characters or more, beside neither 16 or more. A value with
    blanks is whole only in quotes.
    """
    small_batches(documents.sparkSession)
    rows = documents.drop("n_candidates", "secrets", "redacted")
    held = documents.sparkSession.sparkContext.broadcast(train(documents, labelled))

    @F.pandas_udf("struct<n_candidates long, secrets array<struct<start: int, end: int, score: double>>, redacted string>")
    def scan(column: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scanner = held.value
        for texts in column:
            out = []
            for text in texts:
                n, secrets = find_secrets(text or "", scanner)
                clean, at = [], 0
                for a, b, _ in secrets:
                    clean += [text[at:a], mask]
                    at = b
                out.append((n, [{"start": a, "end": b, "score": s} for a, b, s in secrets], None if text is None else "".join([*clean, text[at:]])))
            yield pd.DataFrame(out, columns=["n_candidates", "secrets", "redacted"])

    return rows.withColumn("_scan", scan("text")).select(*rows.columns, "_scan.n_candidates", "_scan.secrets", "_scan.redacted")
