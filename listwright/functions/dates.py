"""Column expressions for deadlines and dates; bad input gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import found, matches


# The forms of a badge.
DAYS_LEFT, MONTH_DAY, CLOSES_TODAY, CLOSES_TOMORROW = r"\bD-(\d+)\b", r"~\s*(\d{1,2})\s*/\s*(\d{1,2})", r"오늘\s*마감", r"내일\s*마감"


def badge_date(text: Column, today: Column) -> Column:
    """'D-3', 'closes today', 'closes tomorrow' or '~ 07/31' as a date; other badges are null."""
    left = found(text, DAYS_LEFT).try_cast("int")
    month, day = found(text, MONTH_DAY, 1), found(text, MONTH_DAY, 2)
    of = lambda year: F.try_to_date(F.concat_ws("-", year, month, day), "yyyy-M-d")
    this = F.when(month.isNotNull(), of(F.year(today)))
    return (
        F.when(left.isNotNull(), F.date_add(today, left))
        .when(matches(text, CLOSES_TODAY), today)
        .when(matches(text, CLOSES_TOMORROW), F.date_add(today, 1))
        .when(F.datediff(this, today) < -300, of(F.year(today) + 1))
        .otherwise(this)
    )


def due_date(text: Column, today: Column, most_days: int = 365) -> Column:
    """The date part of an ISO due time, if it is not too far ahead."""
    due = F.when(F.length(text) >= 10, F.try_to_date(F.left(text, F.lit(10)), "yyyy-MM-dd"))
    return F.when(F.datediff(due, today) <= most_days, due)


def posted_date(text: Column, today: Column, zone: str = "Asia/Seoul") -> Column:
    """An epoch of nine digits or more in the zone's calendar, else the text before a blank; else today."""
    head = F.element_at(F.split(F.trim(F.coalesce(text, F.lit(""))), " "), 1)
    epoch = F.when(head.rlike(r"^\d{9,11}$"), head.try_cast("long"))
    day = F.date_format(today, "yyyy-MM-dd")
    return F.when((head == "") | head.rlike(r"^\d{12,}$"), day).when(epoch.isNotNull(), F.date_format(F.from_utc_timestamp(F.timestamp_seconds(epoch), zone), "yyyy-MM-dd")).otherwise(head)


def month_day(text: Column, otherwise: Column) -> Column:
    """'7/5' of a text that starts with an ISO date, else the fallback."""
    d = F.try_to_date(F.left(text, F.lit(10)), "yyyy-MM-dd")
    return F.when(d.isNotNull(), F.concat_ws("/", F.month(d), F.day(d))).otherwise(otherwise)


def days_left_label(days: Column, today: str = "오늘 마감!") -> Column:
    return F.when(days == 0, F.lit(today)).otherwise(F.concat(F.lit("D-"), days))
