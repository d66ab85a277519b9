"""License scans: ordered signature rules over the words of a text.

A rule is a regular expression over lower-case words joined by one space each. Rules are gated by
keywords: a text without any stem never leaves the JVM, and a rule runs only where its keyword occurs.
Overlapping detections are settled by the rules' priority: one that lies within another, or holds it,
goes if its priority is the worse. Detections of base phrases always stay.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spelling import LOWER, UPPER
from .store import clash_free, small_batches

NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: str  # over words and single spaces; it starts and ends at words
    keyword: str  # occurs in every text that the pattern matches
    priority: int  # 0 is settled first
    weight: float  # how sure a detection is, 0 to 1
    base: bool = False


#: Phrases and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Names of licenses. (label, names as patterns, versions with the pattern of each)
_V = r"(?: version| v)? ?"
FAMILIES = (
    ("gpl", (r"gnu general public licen[cs]e", r"gnu gpl", r"gpl"), (("1.0", "1(?: 0)?"), ("2.0", "2(?: 0)?"), ("3.0", "3(?: 0)?"))),
    ("lgpl", (r"gnu (?:lesser|library) general public licen[cs]e", r"gnu lgpl", r"lgpl"), (("2.0", "2(?: 0)?"), ("2.1", "2 1"), ("3.0", "3(?: 0)?"))),
    ("agpl", (r"gnu affero general public licen[cs]e", r"gnu agpl", r"agpl", r"affero general public licen[cs]e"), (("1.0", "1(?: 0)?"), ("3.0", "3(?: 0)?"))),
    ("gfdl", (r"gnu free documentation licen[cs]e", r"gfdl", r"gnu fdl"), (("1.1", "1 1"), ("1.2", "1 2"), ("1.3", "1 3"))),
    ("apache", (r"apache(?: software)? licen[cs]e", r"apache"), (("1.0", "1 0"), ("1.1", "1 1"), ("2.0", "2(?: 0)?"))),
    ("mpl", (r"mozilla public licen[cs]e", r"mpl"), (("1.0", "1 0"), ("1.1", "1 1"), ("2.0", "2(?: 0)?"))),
    ("epl", (r"eclipse public licen[cs]e", r"epl"), (("1.0", "1(?: 0)?"), ("2.0", "2(?: 0)?"))),
    ("cddl", (r"common development and distribution licen[cs]e", r"cddl"), (("1.0", "1 0"), ("1.1", "1 1"))),
    ("eupl", (r"european union public licen[cs]e", r"eupl"), (("1.0", "1 0"), ("1.1", "1 1"), ("1.2", "1 2"))),
    ("artistic", (r"(?:perl )?artistic licen[cs]e",), (("1.0", "1(?: 0)?"), ("2.0", "2(?: 0)?"))),
    ("afl", (r"academic free licen[cs]e",), (("2.1", "2 1"), ("3.0", "3(?: 0)?"))),
    ("osl", (r"open software licen[cs]e",), (("1.0", "1(?: 0)?"), ("2.1", "2 1"), ("3.0", "3(?: 0)?"))),
    ("bsl", (r"boost software licen[cs]e",), (("1.0", "1(?: 0)?"),)),
    ("lppl", (r"latex project public licen[cs]e", r"lppl"), (("1.2", "1 2"), ("1.3c", "1 3c?"))),
    ("ofl", (r"(?:sil )?open font licen[cs]e",), (("1.0", "1 0"), ("1.1", "1 1"))),
    ("php", (r"php licen[cs]e",), (("3.0", "3 0"), ("3.01", "3 01"))),
    ("python", (r"python(?: software foundation)? licen[cs]e", r"psf licen[cs]e"), (("2.0", "2(?: 0)?"),)),
    ("zpl", (r"zope public licen[cs]e",), (("1.1", "1 1"), ("2.0", "2 0"), ("2.1", "2 1"))),
    ("cecill", (r"cecill(?: [abc])?(?: licen[cs]e)?",), (("1.0", "1 0"), ("2.0", "2 0"), ("2.1", "2 1"))),
    ("apsl", (r"apple public source licen[cs]e",), (("1.0", "1 0"), ("2.0", "2 0"))),
    ("cpl", (r"common public licen[cs]e",), (("1.0", "1 0"),)),
    ("ipl", (r"ibm public licen[cs]e",), (("1.0", "1 0"),)),
    ("spl", (r"sun public licen[cs]e",), (("1.0", "1 0"),)),
    ("npl", (r"netscape public licen[cs]e",), (("1.0", "1 0"), ("1.1", "1 1"))),
    ("qpl", (r"q public licen[cs]e",), (("1.0", "1 0"),)),
    ("ms-pl", (r"microsoft public licen[cs]e", r"ms pl"), ()),
    ("ms-rl", (r"microsoft reciprocal licen[cs]e", r"ms rl"), ()),
    ("odbl", (r"open (?:data commons open )?database licen[cs]e", r"odbl"), (("1.0", "1 0"),)),
    ("odc-by", (r"open data commons attribution licen[cs]e", r"odc by"), (("1.0", "1 0"),)),
    ("pddl", (r"public domain dedication and licen[cs]e", r"pddl"), (("1.0", "1 0"),)),
    ("mulan", (r"mulan (?:psl|permissive software licen[cs]e)",), (("1.0", "1(?: 0)?"), ("2.0", "2(?: 0)?"))),
    ("wtfpl", (r"do what the fuck you want to public licen[cs]e", r"wtfpl"), (("2.0", "2"),)),
    ("unlicense", (r"the unlicen[cs]e", r"unlicen[cs]e"), ()),
    ("mit", (r"(?:the )?mit licen[cs]e", r"(?:the )?expat licen[cs]e"), ()),
    ("isc", (r"(?:the )?isc licen[cs]e",), ()),
    ("x11", (r"(?:the )?x11 licen[cs]e",), ()),
    ("zlib", (r"(?:the )?zlib(?: libpng)? licen[cs]e",), ()),
    ("libpng", (r"(?:the )?libpng licen[cs]e",), ()),
    ("ncsa", (r"university of illinois(?: ncsa)? open source licen[cs]e", r"ncsa open source licen[cs]e"), ()),
    ("postgresql", (r"(?:the )?postgresql licen[cs]e",), ()),
    ("ruby", (r"(?:the )?ruby licen[cs]e",), ()),
    ("vim", (r"(?:the )?vim licen[cs]e",), ()),
    ("openssl", (r"(?:the )?openssl licen[cs]e",), ()),
    ("curl", (r"(?:the )?curl licen[cs]e",), ()),
    ("unicode", (r"unicode(?: data files and software)? licen[cs]e(?: agreement)?",), ()),
    ("blueoak", (r"blue oak model licen[cs]e",), (("1.0", "1 0"),)),
    ("sspl", (r"server side public licen[cs]e", r"sspl"), (("1.0", "1(?: 0)?"),)),
    ("busl", (r"business source licen[cs]e",), (("1.1", "1 1"),)),
    ("elastic", (r"elastic licen[cs]e",), (("1.0", "1(?: 0)?"), ("2.0", "2(?: 0)?"))),
    ("commons-clause", (r"commons clause(?: licen[cs]e)?",), ()),
    ("openrail", (r"(?:creativeml )?open ?rail(?: [ms])?(?: licen[cs]e)?",), ()),
    ("llama", (r"llama(?: [23])? community licen[cs]e",), ()),
    ("beerware", (r"beer ?ware licen[cs]e",), ()),
    ("json", (r"(?:the )?json licen[cs]e",), ()),
)
# Licenses by clauses and Creative Commons elements, with their short and long names.
BSD_CLAUSES = (("bsd-0-clause", r"(?:0|zero)"), ("bsd-1-clause", r"(?:1|one)"), ("bsd-2-clause", r"(?:2|two)"), ("bsd-3-clause", r"(?:3|three)"), ("bsd-4-clause", r"(?:4|four)"))
CC_ELEMENTS = (
    ("cc-by-nc-nd", "by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?"), ("cc-by-nc-sa", "by nc sa", "attribution non ?commercial share ?alike"), ("cc-by-nc", "by nc", "attribution non ?commercial"),
    ("cc-by-nd", "by nd", "attribution no ?deriv(?:ative)?s?(?: works)?"), ("cc-by-sa", "by sa", "attribution share ?alike"), ("cc-by", "by", "attribution"),
)
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
# Wording of grants and notices. (label, pattern, priority, weight)
WORDING = (
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy of this software", 0, 0.95),
    ("x11", r"permission to use copy modify distribute and sell this software and its documentation for any purpose", 0, 0.9),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose with or without fee", 0, 0.95),
    ("bsd", r"redistribution and use in source and binary forms with or without modification are permitted", 0, 0.95),
    ("bsd-3-clause", r"neither the name of (?:\S+ ){1,12}nor the names of its contributors may be used", 0, 0.9),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software", 0, 0.9),
    ("zlib", r"this software is provided as is without any express or implied warranty in no event will the authors", 0, 0.9),
    ("apache-2.0", r"you may not use this file except in compliance with the licen[cs]e", 0, 0.8),
    ("gpl", r"you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e", 0, 0.95),
    ("lgpl", r"you can redistribute it and or modify it under the terms of the gnu lesser general public licen[cs]e", 0, 0.95),
    ("agpl", r"you can redistribute it and or modify it under the terms of the gnu affero general public licen[cs]e", 0, 0.95),
    ("mpl-2.0", r"this source code form is subject to the terms of the mozilla public licen[cs]e", 0, 0.95),
    ("unlicense", r"this is free and unencumbered software released into the public domain", 0, 0.95),
    ("cc0", r"has (?:waived|dedicated) (?:\S+ ){0,8}(?:all copyright|to the public domain)", 2, 0.7),
    ("cc0", r"creative commons (?:cc0|zero)(?: 1 0)?(?: universal)?(?: public domain dedication)?", 1, 0.95),
    ("cc0", r"cc0(?: 1 0)?(?: universal)?", 2, 0.85),
    ("cc-pdm", r"public domain mark(?: 1 0)?", 1, 0.85),
    ("public-domain", r"(?:released|placed|dedicated) (?:in|into|to) the public domain", 1, 0.8),
    ("public-domain", r"(?:is|are) in the public domain", 2, 0.7),
    ("proprietary", r"proprietary and confidential", 1, 0.9),
    ("proprietary", r"unauthori[sz]ed (?:copying|reproduction|use|distribution) (?:\S+ ){0,6}(?:is )?(?:strictly )?prohibited", 1, 0.85),
    ("proprietary", r"may not be (?:copied|reproduced|redistributed|republished) (?:\S+ ){0,8}without (?:the )?(?:prior |express |written )*(?:permission|consent)", 1, 0.85),
    ("proprietary", r"no part of this (?:publication|book|work|document) may be reproduced", 1, 0.9),
    ("proprietary", r"for internal use only", 1, 0.7),
    ("proprietary", r"end user licen[cs]e agreement", 1, 0.8),
    ("reserved", r"todos los derechos reservados", 1, 0.9),
    ("reserved", r"tous droits réservés", 1, 0.9),
    ("reserved", r"alle rechte vorbehalten", 1, 0.9),
    ("reserved", r"tutti i diritti riservati", 1, 0.9),
    ("reserved", r"some rights reserved", 1, 0.8),
    ("non-commercial", r"(?:for )?non ?commercial (?:use|purposes|research)(?: only)?", 2, 0.6),
    ("research-only", r"(?:for )?(?:academic|research) (?:use|purposes) only", 2, 0.6),
    ("copyright", r"copyright (?:c )?(?:19|20)\d\d(?: (?:19|20)\d\d)?", 3, 0.6),
    ("copyright", r"copyright (?:holders?|owners?|notice)", 3, 0.4),
    ("dual", r"dual licen[cs]ed under", 2, 0.6),
    ("permissive", r"(?:free|permitted) to (?:copy|share|redistribute)(?: and (?:copy|share|redistribute|adapt|modify))? (?:this|the) (?:work|material|text|article)", 3, 0.5),
)
#: Every text that a rule matches has one of these; a blank stands for either end of a word.
STEMS = (
    "licen", "rights reserved", "derechos", "droits", "rechte", "diritti", "copyright", "public domain", "cc by", "cc0", "commons", "gpl", " mpl", "gfdl", " fdl", " epl", "cddl", "eupl", "lppl", " ms pl", " ms rl", "odbl", " odc by", "pddl", "mulan", "wtfpl", "cecill", "sspl", " rail", "openrail",
    "apache", "bsd", "spdx", "permission to use", "hereby granted", "redistribut", "neither the name", "advertising materials", "provided as is", "unencumbered", "waived", "dedicated", "proprietary", "unauthori", "may not be", "no part of this", "internal use only", "commercial", "purposes only", "use only", " to copy", " to share",
)


def _literal(pattern: str) -> str:
    """The longest run of plain characters that every match has, not counting the word license."""
    while "(" in pattern:
        pattern = re.sub(r"\([^()]*\)(?:[?*+]|\{[^}]*\})?", "\0", pattern)
    runs = re.sub(r"(?:\[[^\]]*\]|\\\S)[?*+]?|.\?", "\0", pattern).split("\0")
    return max(runs, key=lambda r: len(r.replace("licen", "").strip()))


def rule(label: str, pattern: str, priority: int, weight: float, base: bool = False) -> Rule:
    return Rule(label, pattern, _literal(pattern), priority, weight, base)


def rules() -> list[Rule]:
    """All rules in order: base phrases, wording, then names, the longer forms first."""
    out = [rule(label, phrase, 0, 0.8, True) for phrase, label in BASE]
    out += [rule(*w) for w in WORDING]
    for label, names, versions in FAMILIES:
        tag = rf"spdx licen[cs]e identifier {label.replace('-', ' ')}"
        for v, number in versions:
            out.append(rule(f"{label}-{v}", rf"{tag} {number}(?: only| or later)?", 0, 1.0))
            out += [rule(f"{label}-{v}", rf"{name}{_V}{number}(?: only| or (?:any )?later(?: version)?)?", 1, 0.95) for name in names]
        out.append(rule(label, tag, 1, 0.95))
        out += [rule(label, name, 2, 0.8) for name in names if name != "apache"]
        out += [rule(label, rf"under (?:the )?(?:terms of (?:the )?)?{name}", 2, 0.9) for name in names]
    for label, clauses in BSD_CLAUSES:
        out += [rule(label, rf"bsd {clauses} clause(?: licen[cs]e)?", 1, 0.95), rule(label, rf"{clauses} clause bsd(?: licen[cs]e)?", 1, 0.95), rule(label, rf"spdx licen[cs]e identifier bsd {clauses} clause", 0, 1.0)]
    out += [rule("bsd", r"(?:new |simplified |modified |revised |original )?bsd(?: style)? licen[cs]e", 2, 0.85), rule("bsd", r"under (?:the )?bsd", 2, 0.8)]
    for label, short, long in CC_ELEMENTS:
        for v in CC_VERSIONS:
            number = v.replace(".", " ")
            out += [rule(f"{label}-{v}", rf"{named}(?: licen[cs]e)? {number}(?: international| unported| generic)?(?: licen[cs]e)?", 1, 0.95) for named in (f"cc {short}", f"creative commons {long}")]
            out += [rule(f"{label}-{v}", rf"creativecommons org licen[cs]es {short} {number}", 0, 1.0), rule(f"{label}-{v}", rf"spdx licen[cs]e identifier cc {short} {number}", 0, 1.0)]
        out += [rule(label, rf"{named}(?: licen[cs]e)?", 2, 0.85) for named in (f"cc {short}", f"creative commons {long}")]
    return out + [rule("cc", r"creative commons licen[cs]e", 3, 0.6), rule("license", r"licen[cs]ed under (?:the )?(?:\S+ ){1,4}licen[cs]e", 4, 0.5), rule("license", r"terms of (?:the|this) licen[cs]e", 4, 0.4)]


def settle(found: Sequence[tuple]) -> list[tuple]:
    """Of detections (start, end, order, priority, base, ..), those that stay, by start.

    By priority, longer before shorter, then by the rules' order: one goes if it lies within one that stays,
    or holds one. Base detections stay and, being exempt, hide nothing."""
    starts: list[int] = []  # of those that stay; as none holds another, their ends are in the same order
    ends: list[int] = []
    kept = [d for d in found if d[4]]
    for d in sorted((d for d in found if not d[4]), key=lambda d: (d[3], d[0] - d[1], d[2], d[0])):
        before, after = bisect_right(starts, d[0]), bisect_left(starts, d[0])
        if (before and ends[before - 1] >= d[1]) or (after < len(starts) and ends[after] <= d[1]):
            continue
        kept.append(d)
        starts.insert(after, d[0])
        ends.insert(after, d[1])
    return sorted(kept)


class Scanner:
    def __init__(self, own: Sequence[Rule]):
        self.by_keyword: dict[str, list] = {}
        for order, r in enumerate(own):
            self.by_keyword.setdefault(r.keyword, []).append((order, r, re.compile(rf"(?<!\S)(?:{r.pattern})(?!\S)", re.ASCII)))

    def scan(self, text: str) -> list[tuple]:
        """(start, end, order, priority, base, label, weight) of a text of words joined by one space:
        places of words, end excluded. Matches of one rule don't overlap; those of base phrases can't."""
        found = []
        for keyword, gated in self.by_keyword.items():
            if keyword not in text:
                continue
            for order, r, pattern in gated:
                place = word = 0
                for m in pattern.finditer(text):
                    word += text.count(" ", place, m.start())
                    place = m.start()
                    found.append((word, word + m.group().count(" ") + 1, order, r.priority, r.base, r.label, r.weight))
        return settle(found)


def words_of(text: Column) -> Column:
    """Lower-case words (only A-Z change) joined by one space; empty for null."""
    low = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.trim(F.regexp_replace(low, NO_WORD, " "))


@clash_free("_joined")
def scan_licenses(docs: DataFrame, own: Sequence[Rule] | None = None, stems: Sequence[str] = STEMS, text: str = "text", words: str = "n_words", detections: str = "detections") -> DataFrame:
    """docs with the number of words of its text and its detections, array of struct(start, end, label,
    weight, base), in order of start; places are words from 0, end excluded.

    A null or empty text has no words and no detections. Columns named words and detections are
    replaced, all others stay as they are; repeated rows are judged alike; no row is dropped. stems:
    every text that a rule matches has one of them.
    """
    small_batches(docs.sparkSession)
    given = list(rules() if own is None else own)
    kind = "array<struct<start:bigint,end:bigint,label:string,weight:double,base:boolean>>"

    @F.pandas_udf(kind)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(given)
        for texts in batches:
            yield texts.map(lambda t: [{"start": s, "end": e, "label": label, "weight": w, "base": base} for s, e, _, _, base, label, w in scanner.scan(t)] if t else [])

    joined = "_joined"
    rows = docs.withColumn(joined, words_of(F.col(text)))
    padded = F.concat(F.lit(" "), joined, F.lit(" "))
    met = F.lit(False)
    for stem in stems:
        met = met | F.contains(padded, F.lit(stem))
    n = F.when(F.col(joined) == "", 0).otherwise(F.length(joined) - F.length(F.replace(F.col(joined), F.lit(" "), F.lit(""))) + 1)
    return rows.withColumns({words: n.cast("long"), detections: scan(F.when(met, F.col(joined)))}).drop(joined)
