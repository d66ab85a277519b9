"""Column expressions over sorted arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_upto(values: Column, x: Column) -> Column:
    """How many elements of an ascending array are x or less, by halving: about log2(size) steps for
    each row. Null if the array or x is null."""
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size(values) + F.lit(1))).cast("int"))
    whole = F.struct(F.lit(0).alias("low"), F.size(values).alias("high"))

    def halve(s: Column, _: Column) -> Column:
        middle = F.shiftright(s["low"] + s["high"], 1)
        unsettled, upto = s["low"] < s["high"], F.get(values, middle) <= x
        return F.struct(F.when(unsettled & upto, middle + 1).otherwise(s["low"]).alias("low"), F.when(unsettled & ~upto, middle).otherwise(s["high"]).alias("high"))

    return F.when(values.isNotNull() & x.isNotNull(), F.aggregate(rounds, whole, halve, lambda s: s["low"]))


def count_between(values: Column, after: Column, before: Column) -> Column:
    """How many elements of an ascending array of dates lie strictly between two dates; 0 for nulls."""
    return F.greatest(F.coalesce(count_upto(values, F.date_sub(before, 1)) - count_upto(values, after), F.lit(0)), F.lit(0))
