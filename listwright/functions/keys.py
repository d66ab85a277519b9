"""Column expressions that make companies and titles comparable."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from listwright.config import DEFAULT, Rules

from .text import found, squeeze, strip


# Fixed value: a name in brackets ahead of a title.
BRACKETED = r"^\[([^\[\]]{1,30})\]\s*"


def _without(text: Column, parts: tuple[str, ...]) -> Column:
    for p in parts:
        text = F.replace(text, F.lit(p), F.lit(""))
    return text


def company_key(name: Column, rules: Rules = DEFAULT) -> Column:
    """Without white space and legal forms, lower case, aliases unified; '' for null."""
    key = _without(F.lower(squeeze(F.coalesce(name, F.lit("")))), rules.legal_forms)
    for alias, real in rules.company_aliases:
        key = F.when(key == alias, F.lit(real)).otherwise(key)
    return key


def preset_key(name: Column, rules: Rules = DEFAULT) -> Column:
    """Without legal forms and blanks, case kept."""
    return F.replace(strip(_without(F.coalesce(name, F.lit("")), rules.legal_forms)), F.lit(" "), F.lit(""))


def content_key(company: Column, title: Column, rules: Rules = DEFAULT) -> Column:
    """struct(company, title): equal for one listing, whatever source it is from.

    A leading [hint] that contains the company's name, or is contained in it, is taken off the
    title, and the longer name is the company's key. Other brackets are unwrapped.
    """
    own, name = company_key(company, rules), strip(F.coalesce(title, F.lit("")))
    hint = company_key(found(name, BRACKETED), rules)
    rest = strip(F.regexp_replace(name, "(?U)" + BRACKETED, ""))
    fits = (F.length(hint) >= 2) & (own != "") & (F.contains(hint, own) | F.contains(own, hint))
    shown = F.when(fits & (rest != ""), rest).otherwise(name)
    return F.struct(F.when(fits & (F.length(hint) > F.length(own)), hint).otherwise(own).alias("company"), F.lower(squeeze(F.translate(shown, "[]", "  "))).alias("title"))


def display_title(company: Column, title: Column, rules: Rules = DEFAULT) -> Column:
    """The title without a leading [company], unless nothing remains."""
    title = strip(F.coalesce(title, F.lit("")))
    rest = strip(F.regexp_replace(title, "(?U)" + BRACKETED, ""))
    same = company_key(found(title, BRACKETED), rules) == company_key(company, rules)
    return F.when(F.coalesce(same, F.lit(False)) & (rest != ""), rest).otherwise(title)


def source_rank(source: Column, rules: Rules = DEFAULT) -> Column:
    """0 for official sources, 1 for search platforms."""
    return F.lower(F.coalesce(source, F.lit(""))).isin(*rules.platforms).cast("int")
