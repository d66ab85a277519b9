"""Column expressions over texts: filters, markers, extraction. No Python runs per row."""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listwright.config import DEFAULT, CompanyRules, Rules, TitleRules

# A doubled label and its value, the unit of salaries, what ends a title's name.
LABEL, SALARY_UNIT = r"경력[\s|]*경력[\s]*([^\n|]{1,24})", "만원"
LABELLED, YEARS_NAMED = "경력", ("년", "경", "신")  # without them there is no label; no years, whatever the blanks
TITLE_META = r"\s+(?:new|경력무관|신입|경력|D-?\d+|상시채용|수시채용|채용시)\b"
U = "(?U)"  # Unicode \s, \d, \b as in the rules


def any_of(words: Sequence[str]) -> str:
    """One alternation of quoted words."""
    return "|".join(re.sub(r"([\\.^$|?*+()\[\]{}-])", r"\\\1", w) for w in words)


def matches(text: Column, pattern: str) -> Column:
    """False for null."""
    return F.coalesce(text.rlike(U + pattern), F.lit(False))


def has_any(text: Column, words: Sequence[str]) -> Column:
    """Whether a text contains one of the words, as they stand; false for null. The text is computed
    once and searched for each word, which is many times faster than one alternation at every place."""
    return F.coalesce(let(text, lambda t: _any(t, words)), F.lit(False)) if words else F.lit(False)


def _any(text: Column, words: Sequence[str]) -> Column:
    return reduce(operator.or_, [F.contains(text, F.lit(w)) for w in words], F.lit(False))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, U + r"^\s+|\s+$", "")


def squeeze(text: Column) -> Column:
    """Without any white space."""
    return F.regexp_replace(text, U + r"\s+", "")


def found(text: Column, pattern: str, group: int = 1) -> Column:
    """The group, or null where the pattern or the group is not met."""
    return F.nullif(F.regexp_extract(text, U + pattern, group), F.lit(""))


def title_accepted(title: Column, rules: TitleRules = DEFAULT.titles) -> Column:
    low = F.lower(title)
    accepted = has_any(title, rules.allow_exact) | has_any(low, rules.allow_any_case)
    for p in rules.patterns:
        accepted = accepted | matches(title, p)
    for w in rules.whole_words:
        accepted = accepted | matches(low, rf"\b{any_of([w])}\b")
    return ~has_any(low, rules.deny) & accepted


def company_accepted(name: Column, context: Column, rules: CompanyRules = DEFAULT.companies) -> Column:
    name, context = F.lower(F.coalesce(name, F.lit(""))), F.lower(F.coalesce(context, F.lit("")))
    return ~(has_any(name, rules.deny) | has_any(context, [*rules.deny, *rules.deny_context])) & (has_any(name, rules.allow) | has_any(context, rules.allow))


def platform_accepted(company: Column, title: Column, companies: CompanyRules = DEFAULT.companies, titles: TitleRules = DEFAULT.titles) -> Column:
    company, title = F.lower(F.coalesce(company, F.lit(""))), F.lower(F.coalesce(title, F.lit("")))
    return ~(has_any(company, companies.deny) | has_any(title, [*companies.deny, *titles.deny]))


def still_accepted(company: Column, title: Column, body: Column, rules: Rules = DEFAULT) -> Column:
    """Whether a listing whose title and company were corrected still belongs here: by its title, and by
    its company or title or a word of the body."""
    return title_accepted(title, rules.titles) & (company_accepted(company, title, rules.companies) | has_any(F.lower(body), rules.body_allow))


def filter_reason(columns: dict[str, Column], words: Sequence[str]) -> Column:
    """'name:word' of the first hit in each column, joined by ', '; empty if none."""
    parts = [F.when(has_any(F.lower(c), words), F.concat(F.lit(f"{k}:"), F.regexp_extract(F.lower(c), U + f"({any_of(words)})", 1))) for k, c in columns.items()]
    return F.concat_ws(", ", *parts)


def has_markers(text: Column, markers: Sequence[str] = DEFAULT.body_markers) -> Column:
    return has_any(squeeze(F.coalesce(text, F.lit(""))), markers)


def body_accepted(text: Column, rules: Rules = DEFAULT) -> Column:
    return F.coalesce(F.length(text) >= rules.body_least_chars, F.lit(False)) & has_markers(text, rules.body_markers)


def is_boilerplate(text: Column, rules: Rules = DEFAULT) -> Column:
    hits = sum((F.coalesce(text.contains(w), F.lit(False)).cast("int") for w in rules.navigation), F.lit(0))
    return ~has_markers(text, rules.body_markers) & ~has_markers(text, rules.extra_body_markers) & (hits >= 2)


def has_body(title: Column, raw_len: Column, more: int = 60) -> Column:
    return F.coalesce(raw_len, F.lit(0)) > F.coalesce(F.length(title), F.lit(0)) + more


def for_diff(text: Column) -> Column:
    """Without dates, clock times and runs of white space, so that only real changes differ."""
    out = F.regexp_replace(F.coalesce(text, F.lit("")), U + r"\s+", " ")
    out = F.regexp_replace(out, r"\d{4}[-.]\d{1,2}[-.]\d{1,2}", "")
    return strip(F.regexp_replace(out, r"\b\d{1,2}:\d{2}\b", ""))


def body_degraded(old: Column, new: Column, rules: Rules = DEFAULT) -> Column:
    n, m = F.coalesce(F.length(old), F.lit(0)), F.coalesce(F.length(new), F.lit(0))
    lost = has_markers(old, rules.body_markers) & ~has_markers(new, rules.body_markers) & (m < n * rules.degraded_ratio)
    return (m < n) & (lost | ((n >= rules.collapse_least_chars) & (m * rules.collapse_factor <= n)))


def first_rule(text: Column, rules: Sequence[tuple[str, Sequence[str]]], otherwise: str) -> Column:
    """The name of the first rule with a pattern in the text."""
    first = lambda t: F.coalesce(*[F.when(matches(t, "|".join(f"(?:{p})" for p in patterns)), F.lit(name)) for name, patterns in rules], F.lit(otherwise))
    return let(text, first)


def work_type(text: Column, rules: Rules = DEFAULT) -> Column:
    return first_rule(F.lower(text), rules.work_types, rules.work_type_unknown)


def category(title: Column, rules: Rules = DEFAULT) -> Column:
    return first_rule(F.lower(title), [(n, [any_of(w)]) for n, w in rules.categories], rules.category_default)


def earliest(text: Column, markers: Sequence[str], start: Column | None = None) -> Column:
    """1-based place of the first marker (after start), null if none is met."""
    found_at = lambda m: F.locate(m, text) if start is None else let(F.call_function("locate", F.lit(m), text, start), lambda at: F.when(at > 0, at))
    places = [F.when(F.contains(text, F.lit(m)), found_at(m)) for m in markers]  # contains is several times faster than locate
    return F.least(*places) if len(places) > 1 else places[0]


def requirement_section(text: Column, rules: Rules = DEFAULT) -> Column:
    """From the earliest start marker to the nearest end marker; null if there is none."""
    upto = lambda start: F.coalesce(earliest(text, rules.requirement_end, start + 1), F.length(text) + 1)
    section = let(earliest(text, rules.requirement_start), lambda start: F.substring(text, start, F.least(upto(start) - start, F.lit(rules.requirement_chars))))
    return let(section, lambda s: F.when(matches(s, r"\S"), s))


def without_tail(text: Column, rules: Rules = DEFAULT) -> Column:
    cut = earliest(text, rules.tail_markers)
    return F.when(cut.isNotNull(), F.substring(text, F.lit(1), cut - 1)).otherwise(text)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once however often use refers to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def years(low: Column, high: Column) -> Column:
    return F.struct(low.cast("int").alias("min_years"), high.cast("int").alias("max_years"))


def _number(text: Column, pattern: str, group: int = 1) -> Column:
    return found(text, pattern, group).try_cast("int")


def experience_phrase(text: Column, bare_range: bool = False, rules: Rules = DEFAULT, year: str = "년", anchor: str = "경력", none: Sequence[str] = ("경력무관", "경력년수무관"), over: str = "이상|차이상|↑", under: str = "이하|차이하|↓", about: str = "내외|전후", nth: str = "년차") -> Column:
    """struct(min_years, max_years) of the first rule met in a text without blanks, else null."""

    def between(pattern: str) -> Column:
        # The text is searched once; both numbers are taken from the short match.
        pair = lambda m: F.struct(_number(m, pattern, 1).alias("low"), _number(m, pattern, 2).alias("high"))
        return let(let(found(text, pattern, 0), pair), lambda p: F.when((p["low"] <= p["high"]) & (p["high"] <= rules.most_years), years(p["low"], p["high"])))

    def one(pattern: str, of: Callable[[Column], Column]) -> Column:
        return let(_number(text, pattern), lambda n: F.when(n.isNotNull(), of(n)))

    first = F.when(has_any(text, none), years(F.lit(0), F.lit(None)))
    out = [
        between(rf"(\d+){year}[~-](\d+){year}"),
        between(rf"(\d+)[~-](\d+){nth}"),
        between(rf"{anchor}[^\d]{{0,3}}(\d+)[~-](\d+){year}"),
        *([between(rf"(\d+)[~-](\d+){year}")] if bare_range else []),
        one(rf"(\d+){year}(?:{over})", lambda n: years(n, F.lit(None))),
        one(rf"(\d+){year}(?:{under})", lambda n: years(F.lit(0), n)),
        one(rf"(\d+){year}(?:{about})", lambda n: years(F.greatest(F.lit(0), n - 1), n + 1)),
        one(rf"{anchor}(\d+){year}", lambda n: years(n, F.lit(None))),
    ]
    named = F.contains(text, F.lit(year)) | F.contains(text, F.lit(nth))  # else no pattern can match: most texts are searched once
    return F.coalesce(first, F.when(named, F.coalesce(*out)))


def with_experience(rows: DataFrame, text: Column, title: Column, rules: Rules = DEFAULT, name: str = "experience") -> DataFrame:
    """rows with struct(min_years, max_years), from the narrowest scope that names any: title,
    label, body if it is for newcomers, requirement section, body, rank; else (0, null).

    Each scope is a column of its own first, so that no plan repeats the work on a scope.
    """
    tight = lambda c: F.replace(c, F.lit(" "), F.lit(""))
    newcomer = lambda c: F.col(c).contains("신입") & ~F.col(c).contains("경력")
    rows = rows.withColumns({"_text": text, "_titled": tight(title), "_label": tight(F.when(F.contains(text, F.lit(LABELLED)), found(text, LABEL)))})
    ranks = [F.when(F.contains("_text", F.lit(r)) & matches(F.col("_text"), rf"{r}\s?급(?!여)|{r}\s?이상"), years(F.lit(n), F.lit(None))) for r, n in rules.ranks]
    entry, open_ = years(F.lit(0), F.lit(1)), years(F.lit(0), F.lit(None))
    phrase = lambda c, bare: experience_phrase(F.col(c), bare, rules)
    narrow = [F.coalesce(F.when(newcomer("_titled"), entry), phrase("_titled", True)), F.coalesce(phrase("_label", True), F.when(F.col("_label").contains("무관"), open_))]
    wide = [F.when(newcomer("_body"), entry), phrase("_section", False), phrase("_body", False), F.coalesce(*ranks, open_)]
    # A wider scope is made and searched only where the narrower ones name nothing.
    widen = lambda rows, step: rows.withColumn("_asked", F.when(F.col("_asked").isNotNull(), F.col("_asked")).otherwise(step))
    rows = widen(rows.withColumn("_asked", narrow[0]), narrow[1])
    open_yet = F.col("_asked").isNull() & _any(F.col("_text"), YEARS_NAMED)
    rows = rows.withColumns({"_section": F.when(open_yet, tight(requirement_section(F.col("_text"), rules))), "_body": F.when(open_yet, tight(F.col("_text")))})
    for step in wide:
        rows = widen(rows, step)
    return rows.withColumn(name, F.col("_asked")).drop("_asked", "_text", "_titled", "_label", "_section", "_body")


def salary(text: Column, unit: str = SALARY_UNIT, over: str = "이상") -> Column:
    """struct(salary_min, salary_max); both null if none is named."""
    pair = lambda a, b: F.struct(a.cast("int").alias("salary_min"), b.cast("int").alias("salary_max"))

    def read(tight: Column) -> Column:
        low, high, least = (_number(tight, rf"(\d+)[~-](\d+){unit}", 1), _number(tight, rf"(\d+)[~-](\d+){unit}", 2), _number(tight, rf"(\d+){unit}{over}"))
        return F.coalesce(F.when(low.isNotNull() & high.isNotNull(), pair(low, high)), pair(least, F.lit(None)))

    named = F.contains(text, F.lit(unit[0]))  # else there is no unit, with blanks or without
    lines = F.array_join(F.filter(F.split(text, "\n"), lambda x: F.contains(x, F.lit(unit[0]))), "\n")  # no amount spans lines
    return F.coalesce(F.when(named, let(F.regexp_replace(lines, "[, ]", ""), read)), pair(F.lit(None), F.lit(None)))


def tools(text: Column, words: Sequence[str] = DEFAULT.tools) -> Column:
    """Words met, upper-cased, sorted, joined by ', '; null if none."""
    return let(F.lower(text), lambda low: tools_in(low, words))


def tools_in(low: Column, words: Sequence[str] = DEFAULT.tools) -> Column:
    """tools of a text in lower case."""
    met = F.filter(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(low, w))
    return F.nullif(F.array_join(F.array_sort(F.array_distinct(F.transform(met, F.upper))), ", "), F.lit(""))


def tags(text: Column, dictionary: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """Keys with a word in the text, in dictionary order."""
    return let(F.lower(text), lambda low: tags_in(low, dictionary))


def tags_in(low: Column, dictionary: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """tags of a text in lower case."""
    return F.array_compact(F.array(*[F.when(_any(low, words), F.lit(key)) for key, words in dictionary]))


def summary(company: Column, kind: Column, title: Column, work: Column, low: Column, high: Column, used: Column) -> Column:
    asked = F.when((low == 0) & (high == 1), F.lit("신입 지원 가능")).when((low > 0) & (F.coalesce(high, F.lit(0)) > 0), F.concat(F.lit("경력 "), low, F.lit("~"), high, F.lit("년"))).when(low > 0, F.concat(F.lit("경력 "), low, F.lit("년 이상"))).otherwise("경력 무관 (신입 지원 가능)")
    return F.concat_ws("\n", F.concat(F.lit("1. "), company, F.lit(" "), kind, F.lit(" 직무 - '"), title, F.lit("' 채용 공고")), F.concat(F.lit("2. 근무 요건: "), work, F.lit(" | "), asked), F.concat(F.lit("3. 요구 직무 도구 및 핵심 역량: "), F.coalesce(used, F.lit("공고에 명시 없음"))))


def title_cut(title: Column, pattern: str = TITLE_META) -> Column:
    """The title before its meta text."""
    return strip(F.element_at(F.split(title, U + pattern, 2), 1))


def html_to_text(html: Column) -> Column:
    """Text lines of a page: scripts and styles dropped, one line per text node, no blank lines.

    Scripts and tags are searched for only where the page has their first characters."""
    out = F.when(_any(html, ("<s", "<S")), F.regexp_replace(html, r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>", "")).otherwise(html)
    out = F.when(_any(html, ("<",)), F.regexp_replace(out, r"(?s)<!--.*?-->|<[^>]*>", "\n")).otherwise(html)
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    out = F.regexp_replace(out, r"[ \t]+", " ")
    return F.when(html == "", html).otherwise(F.regexp_replace(F.regexp_replace(out, r" ?\n[ \n]*", "\n"), r"^[ \n]+|[ \n]+$", ""))
