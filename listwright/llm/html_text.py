"""Main text of HTML pages by line-block distribution.

Markup is stripped into lines, one per block element. The lines of a part of the page (the body,
an article or main element, a block named like a menu or an advert) are one sequence; parts
within it are left out of it and are no gap. Text lengths, without link text, are summed over
sliding windows of its lines. A stretch surges where a window is high and runs, both ways, to
where windows dive. Lengths weigh more in articles and less in named blocks; the part with the
heaviest stretch gives the text.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import small_batches

WINDOW = 3
SURGE, DIVE = 80, 12  # characters in a window; on pages of short lines a half and an eighth of the highest
PENALTY, BOOST = 0.1, 2.0  # weight of lengths in a named block, and in an article
RIVAL = 0.25  # stretches of one part, and like articles, with this share of the heaviest are text too
_MARK = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*)(?:>|\Z)", re.S)
_SPACE = re.compile(r"\s+")
_NAMED = re.compile(r"""(?:^|\s)(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")  # also of camel case
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)

#: Element names.
RAW = frozenset("script style noscript template textarea iframe title svg xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
DROPPED = frozenset("nav footer aside menu select button dialog head object canvas".split())
ARTICLES = frozenset(("article", "main"))
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
#: Elements whose lines are an article's own, however short; menus are made of others.
SOLID = (*HEADINGS, "p", "td", "th", "caption", "pre", "blockquote", "figcaption", "dt", "dd")
#: Words of class, id and role names that make a block unlikely to be the article.
NOT_TEXT = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs topbar toolbar header masthead footer sidebar side aside widget comment comments disqus reply replies respond discussion reactions notice notices cookie cookies consent gdpr popup modal overlay alert share sharing social related recommended recommendations newsletter subscribe subscription signup login search searchbox form pagination pager copyright skip complementary contentinfo dialog".split()
)


#: Words by which a name tells of a layout or a state, not of the block itself.
LAYOUT = frozenset("no not without with has hide category tag open closed enabled disabled off".split())
OF_ARTICLE = frozenset("article entry post story content text title".split())


@dataclass
class Part:
    """A part of the page: its enclosing part, its article or main element if it is one, and its weight."""

    parent: int
    kind: str
    in_article: bool
    weight: float


def _named(attributes: str) -> bool:
    """Whether a name calls the block something other than the article: 'sidebar', not 'no-sidebar' or 'article-header'."""
    for a, b, c in _NAMED.findall(attributes):
        for name in (a or b or c).split():
            words = [w.lower() for w in _WORD.findall(name)]
            found = NOT_TEXT.intersection(words)
            if found and LAYOUT.isdisjoint(words) and not (found == {"header"} and not OF_ARTICLE.isdisjoint(words)):
                return True
    return False


def _unclosed(page: str, name: str) -> frozenset[int]:
    """Where the start tags of a name are that have no end of their own."""
    opened: list[int] = []
    for mark in re.finditer(rf"<(/?){name}(?=[\s/>])", page, re.I):
        if not mark[1]:
            opened.append(mark.start())
        elif opened:
            opened.pop()
    return frozenset(opened)


def lines_of(page: str) -> tuple[list[tuple[str, int, int, bool]], list[Part]]:
    """(text, characters outside links, part, whether in a solid element) per line in page order, and the parts."""
    out: list[tuple[str, int, int, bool]] = []
    parts = [Part(-1, "", False, 1.0)]
    text: list[tuple[str, bool]] = []
    stack: list[tuple[str, bool, int]] = []  # open elements, with whether they start a dropped block, and the part around them
    opened_names: Counter[str] = Counter()  # of the stack: an end without a start is seen without a search
    dropped = links = part = at = 0
    unclosed: dict[str, frozenset[int]] = {}
    article = re.compile(r"<(?:main|article)(?=[\s/>])", re.I)

    def linked() -> bool:
        return links > 0 and not any(opened_names[h] for h in HEADINGS)  # a title is text, linked or not

    def squeezed(pieces) -> str:
        return _SPACE.sub(" ", entities.unescape("".join(pieces))).strip()

    def flush() -> None:
        line = squeezed(x for x, _ in text)
        if line:
            size = len(squeezed(x for x, is_link in text if not is_link)) if any(is_link for _, is_link in text) else len(line)
            out.append((line, size, part, any(opened_names[x] for x in SOLID)))
        text.clear()

    def leave(opened: tuple[str, bool, int]) -> None:
        nonlocal dropped, links, part
        name, skips, around = opened
        if around != part:
            flush()
        dropped, links, part = dropped - skips, links - (name == "a"), around
        opened_names[name] -= 1

    while at < len(page):
        mark = _MARK.search(page, at)
        if not dropped:
            text.append((page[at : mark.start() if mark else len(page)], linked()))
        if not mark:
            break
        at = mark.end()
        if mark[1] and not dropped:
            text.append((entities.escape(mark[1], False), linked()))
        if not mark[3]:
            continue
        close, name, attributes = mark[2], mark[3].lower(), mark[4]
        if name == "br" and not dropped:
            text.append((" ", linked()))
        if name in BLOCKS and not dropped:
            flush()
        if close:
            depth = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name) if opened_names[name] else None
            if depth is not None and (not dropped or name in BLOCKS or depth == len(stack) - 1):
                while len(stack) > depth:
                    leave(stack.pop())
            continue
        if name in RAW and not attributes.rstrip().endswith("/"):
            end = re.compile(rf"</{re.escape(name)}\s*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name in DROPPED and not dropped:
            if name not in unclosed:
                unclosed[name] = _unclosed(page, name)
            if mark.start() in unclosed[name]:  # it ends where an article starts; without one it is empty
                flush()
                start = article.search(page, at)
                at = start.start() if start else at
                continue
        if name in VOID or attributes.rstrip().endswith("/") and name not in BLOCKS:
            continue
        if name == "p" or name in BLOCKS and stack and stack[-1][0] == "p":
            while stack and stack[-1][0] in ("p", "b", "i", "em", "strong", "a", "span", "u", "font"):  # a block ends an open paragraph
                leave(stack.pop())
        skips = not dropped and (name in DROPPED or bool(_HIDDEN.search(attributes)) and name not in ("html", "body"))
        around = parts[part]
        aside = name == "form" or name == "header" and not around.in_article or name not in ("html", "body") and _named(attributes)
        stack.append((name, skips, part))
        opened_names[name] += 1
        links += name == "a"
        if skips:
            flush()
        elif not dropped and (aside or name in ARTICLES):
            flush()
            inside = around.in_article or name in ARTICLES
            weight = PENALTY if aside else BOOST if inside and not around.in_article else 1.0
            parts.append(Part(part, "" if aside else name, inside, around.weight * weight))
            part = len(parts) - 1
        dropped += skips
    if not dropped:
        flush()
    return out, parts


def _joined(lines: list[tuple[str, int, int, bool]], parts: list[Part]) -> list[int]:
    """Part that each part is read with: the main element's for its only article, if that has the most text."""
    sizes = [0] * len(parts)
    for _, size, part, _ in lines:
        sizes[part] += size
    with_ = list(range(len(parts)))
    like = Counter((x.parent, x.kind) for x in parts)
    for i, part in enumerate(parts):
        around = parts[part.parent].kind if i else ""
        if part.kind and around and part.kind != around:
            if like[part.parent, part.kind] == 1 and sizes[i] >= sizes[part.parent]:
                with_[i] = with_[part.parent]
    return with_


def _stretches(sizes: list[int], window: int) -> list[tuple[int, int]]:
    """[surge, dive) over the lines of one part."""
    blocks = [sum(sizes[i : i + window]) for i in range(max(1, len(sizes) - window + 1))]
    top = max(blocks)
    surge, dive = min(SURGE, top / 2), min(DIVE, top / 8)
    out, i = [], 0
    while i < len(blocks):
        begin = i
        while i < len(blocks) and blocks[i] and blocks[i] >= dive:
            i += 1
        if begin < i and max(blocks[begin:i]) >= surge:
            out.append((begin, min(i - 1 + window, len(sizes))))
        i += begin == i
    return out


def main_text(page: str, window: int = WINDOW) -> str:
    """Lines of the article joined by newlines; '' if the page has no text."""
    lines, parts = lines_of(page)
    with_ = _joined(lines, parts)
    places: dict[int, list[int]] = {}
    for i, (_, _, part, _) in enumerate(lines):
        places.setdefault(with_[part], []).append(i)
    found: list[tuple[float, int, int, int]] = []  # weight of the text, part, first and last line
    for part, own in places.items():
        sizes = [lines[i][1] for i in own]
        if not any(sizes):  # nothing but links
            sizes = [1] * len(own) if len(places) == 1 else sizes
        runs = _stretches(sizes, window)
        if not runs:
            continue
        heavy = max(sum(sizes[a:b]) for a, b in runs)
        # An article is not divided: where it surges, all of it is text.
        runs = [r for r in runs if parts[part].kind or sum(sizes[r[0] : r[1]]) >= RIVAL * heavy]
        begin, end = runs[0][0], runs[-1][1]
        if parts[part].kind:  # its own short lines at either end belong to it, lines of links don't
            own_lines = [k for k, i in enumerate(own) if sizes[k] and (lines[i][3] or begin <= k < end)]
            begin, end = own_lines[0], own_lines[-1] + 1
        found.append((heavy * parts[part].weight, part, own[begin], own[end - 1]))
    if not found:
        return ""
    best, chosen, _, _ = max(found, key=lambda x: x[0])
    like = parts[chosen]
    kept = [(part, begin, end) for weight, part, begin, end in found if part == chosen or like.kind and weight >= RIVAL * best and (parts[part].kind, parts[part].parent, parts[part].weight) == (like.kind, like.parent, like.weight)]
    return "\n".join(lines[i][0] for part, begin, end in kept for i in places[part] if begin <= i <= end)


def extract_main_text(pages: DataFrame, window: int = WINDOW) -> DataFrame:
    """pages with text and n_chars (code points).

    pages needs html; clashing text or n_chars columns are replaced. Null or empty html, and
    pages without text, give an empty text and 0. Broken markup is read up to its end; repeated
    rows give equal texts.
    """

    small_batches(pages.sparkSession)

    @F.pandas_udf("string")
    def extract(column: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages_ in column:
            yield pages_.map(lambda page: main_text(page, window) if page else "")

    rows = pages.drop("text", "n_chars").withColumn("text", extract("html"))
    return rows.withColumn("n_chars", F.length("text").cast("long"))
