"""Landed HTML pages as listing rows, by patterns over flat markup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listwright.config import DEFAULT, Rules
from listwright.functions.dates import badge_date
from listwright.functions.keys import company_key
from listwright.functions.text import found, html_to_text, let, matches, strip, title_cut

TAG = r"<[^>]*>"


def plain(html: Column) -> Column:
    """One line of text of a fragment."""
    return strip(F.regexp_replace(F.regexp_replace(html, TAG, " "), r"(?U)\s+", " "))


def without_scripts(html: Column) -> Column:
    return F.regexp_replace(html, r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>", "")


def listing_rows(pages: DataFrame, container: str, block: str, number: str, title: str, company: str, today: Column) -> DataFrame:
    """(page_id, state, pos, native_no, title, company, deadline): rows of listing fragments.

    state is 'failed' if the container is missing, 'empty' if it has no row, else 'ok'; failed and
    empty pages give one row without values. block has one group, the row's markup. A number
    counts once in a page. A company equal to the title is blank.
    """
    html = without_scripts(F.col("html"))
    p = pages.select("page_id", matches(html, container).alias("there"), F.regexp_extract_all(html, F.lit(block), F.lit(1)).alias("blocks"))
    rows = p.select("page_id", "there", F.posexplode_outer(F.when(F.col("there"), F.col("blocks"))).alias("pos", "block"))
    name = plain(F.regexp_extract("block", title, 1))
    own = plain(F.regexp_extract("block", company, 1))
    rows = rows.select("page_id", "there", "pos", found(F.col("block"), number).alias("native_no"), name.alias("title"), F.when(own == name, "").otherwise(own).alias("company"), badge_date(plain(F.col("block")), today).alias("deadline"))
    once = F.row_number().over(Window.partitionBy("page_id", "native_no").orderBy("pos"))
    good = F.col("native_no").isNotNull()
    rows = rows.withColumns({"once": once, "rows": F.sum(good.cast("int")).over(Window.partitionBy("page_id"))})
    state = F.when(~F.col("there"), "failed").when(F.col("rows") == 0, "empty").otherwise("ok")
    lone = F.row_number().over(Window.partitionBy("page_id").orderBy("pos"))
    rows = rows.withColumns({"state": state, "lone": lone}).where((good & (F.col("once") == 1)) | ((F.col("state") != "ok") & (F.col("lone") == 1)))
    blank = lambda c: F.when(F.col("state") == "ok", F.col(c)).alias(c)
    return rows.select("page_id", "state", *[blank(c) for c in ("pos", "native_no", "title", "company", "deadline")])


def anchor_rows(pages: DataFrame, href: str, today: Column, rules: Rules = DEFAULT) -> DataFrame:
    """(page_id, pos, native_no, title, deadline): first anchor of each number, closed ones left out.

    href has one group, the number.
    """
    html = without_scripts(F.col("html"))
    a = pages.select("page_id", F.posexplode(F.regexp_extract_all(html, F.lit(r"(?is)(<a\s[^>]*>.*?</a>)"), F.lit(1))).alias("pos", "a"))
    a = a.select("page_id", "pos", found(F.regexp_extract("a", r'(?i)href="([^"]*)"', 1), href).alias("native_no"), plain(F.col("a")).alias("label"))
    a = a.where(F.col("native_no").isNotNull() & ~matches(F.col("label"), rules.closed_badge))
    a = a.withColumn("n", F.row_number().over(Window.partitionBy("page_id", "native_no").orderBy("pos"))).where("n = 1")
    return a.select("page_id", "pos", "native_no", title_cut(F.col("label")).alias("title"), badge_date(F.col("label"), today).alias("deadline"))


def largest_block(pages: DataFrame, name: str, least: int = 80) -> DataFrame:
    """(page_id, body): the longest text among un-nested blocks whose class contains name; '' if short."""
    pattern = rf'(?is)<(?:div|section|article)\b[^>]*class="[^"]*{name}[^"]*"[^>]*>(.*?)</(?:div|section|article)>'
    b = pages.select("page_id", F.explode_outer(F.regexp_extract_all(without_scripts(F.col("html")), F.lit(pattern), F.lit(1))).alias("block"))
    b = b.select("page_id", F.coalesce(html_to_text(F.col("block")), F.lit("")).alias("text"))
    best = b.groupBy("page_id").agg(F.max(F.struct(F.length("text").alias("n"), "text")).alias("best"))
    return best.select("page_id", F.when(F.col("best.n") > least, F.col("best.text")).otherwise("").alias("body"))


#: A tag, with quoted attribute values in which > is a character.
QUOTED_TAG = r"""</?[A-Za-z](?:[^>"']+|"[^"]*"|'[^']*')*>"""
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")


def nested_block(pages: DataFrame, name: str, least: int = 80) -> DataFrame:
    """(page_id, body): the longest text among elements whose class contains name, however they are
    nested in each other or in elements of their kind; '' if it has least characters or fewer, or if there is none.

    A start tag's depth is the number of elements of its kind that are open after it; its end is the next end
    tag of its kind and depth, or the end of the page. Elements of other kinds that are not closed
    properly don't matter. Texts are measured without the white space around each piece; ties
    go to the first. Only places and lengths of tags are exploded and sorted, by page; texts stay in their rows.
    page_id is unique; a null html has no block.
    """
    html = F.regexp_replace(without_scripts(F.col("html")), r"(?s)<!--.*?-->", "")
    p = pages.select("page_id", F.regexp_extract_all(html, F.lit(f"({QUOTED_TAG})"), F.lit(1)).alias("tags"), F.split(html, QUOTED_TAG).alias("pieces"))
    lengths = F.transform(F.slice("pieces", 2, F.greatest(F.size("pieces"), F.lit(1))), lambda x: F.length(html_to_text(x)))
    e = p.select("page_id", F.posexplode(F.arrays_zip("tags", lengths.alias("lengths"))).alias("pos", "t")).select("page_id", "pos", F.col("t.tags").alias("tag"), F.col("t.lengths").alias("n"))
    kind, ends = F.lower(F.regexp_extract("tag", r"^</?([A-Za-z][A-Za-z0-9]*)", 1)), F.col("tag").startswith("</")
    classes = F.regexp_extract("tag", r"""(?is)\sclass\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", 1)
    e = e.select("page_id", "pos", "n", kind.alias("kind"), ends.alias("ends"), (F.contains(classes, F.lit(name)) & ~ends).alias("wanted"), (kind.isin(*VOID) | F.col("tag").endswith("/>")).alias("alone"))
    page = Window.partitionBy("page_id").orderBy("pos")
    e = e.withColumn("before", F.sum("n").over(page) - F.col("n"))  # text ahead of the tag, from the first tag on
    e = e.withColumn("whole", F.sum("n").over(Window.partitionBy("page_id"))).where("not alone")
    same = Window.partitionBy("page_id", "kind").orderBy("pos")
    depth = F.sum(F.when(F.col("ends"), -1).otherwise(1)).over(same)
    e = e.withColumn("depth", F.when(F.col("ends"), depth + 1).otherwise(depth))
    pair = Window.partitionBy("page_id", "kind", "depth").orderBy("pos")
    e = e.withColumns({"end": F.lead("pos").over(pair), "upto": F.coalesce(F.lead("before").over(pair), "whole")}).where("wanted")
    size = F.col("upto") - F.col("before")
    best = e.groupBy("page_id").agg(F.max_by(F.struct("pos", "end"), F.struct(size.alias("size"), (-F.col("pos")).alias("first"))).alias("b"))
    j = p.select("page_id", "pieces").join(best, "page_id", "left")
    upto = F.coalesce(F.col("b.end"), F.size("pieces") - 1)
    text = let(F.array_join(F.slice("pieces", F.col("b.pos") + 2, upto - F.col("b.pos")), "\n"), html_to_text)
    return j.select("page_id", F.coalesce(F.when(F.length(text) > least, text), F.lit("")).alias("body"))


def corrected_title(html: Column, title_pattern: str, card: Column) -> Column:
    """h1, else the pattern's group in <title>, else the card's value; h2 is never used."""
    h1 = F.nullif(plain(F.regexp_extract(html, r"(?is)<h1\b[^>]*>(.*?)</h1>", 1)), F.lit(""))
    head = found(plain(F.regexp_extract(html, r"(?is)<title\b[^>]*>(.*?)</title>", 1)), title_pattern)
    return F.coalesce(h1, head, card)


def guarded(pages: DataFrame, aliases: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """pages (source, page_title, ..) whose title contains an alias (source, alias) of its source."""
    known = aliases.select("source", company_key(F.col("alias"), rules).alias("_alias")).where("_alias <> ''")
    titled = pages.withColumn("_title", company_key(F.col("page_title"), rules))
    return titled.join(known, (titled["source"] == known["source"]) & F.contains("_title", "_alias"), "left_semi").drop("_title")


def blocked(status: Column, body: Column, fingerprints: tuple[str, ...] = ("satisfied", "generated by cloudfront")) -> Column:
    """A refused response: by status, or by a fingerprint in the first 1,000 characters."""
    seen = F.lower(F.left(F.coalesce(body, F.lit("")), F.lit(1000)))
    by_text = F.lit(False)
    for f in fingerprints:
        by_text = by_text | seen.contains(f)
    return F.coalesce(status.isin(403, 405, 429), F.lit(False)) | by_text
