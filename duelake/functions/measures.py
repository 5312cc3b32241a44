"""Aggregate expressions of the gold tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(value: Column, digits: int) -> Column:
    return F.round(value, digits)


def rounded_mean(value: Column, digits: int) -> Column:
    """Mean over the non-null values, rounded half up."""
    return rounded(F.avg(value), digits)


def safe_ratio(part: Column, whole: Column, digits: int = 3) -> Column:
    """``part / whole`` as a double; null when ``whole`` is null or zero."""
    return F.round(part.cast("double") / F.nullif(whole, F.lit(0)), digits)


def count_true(flag: Column) -> Column:
    return F.count_if(flag)


def count_false(flag: Column) -> Column:
    return F.count_if(~flag)


def rows() -> Column:
    return F.count(F.lit(1))


def true_share(flag: Column) -> Column:
    """Share of rows whose flag is true, as ``decimal(5,3)``; null counts as false.

    Equals ``round(avg(CASE WHEN flag THEN 1.0 ELSE 0.0 END), 3)``: the decimal
    mean is first rounded to five places, then to three, both half up.  It is
    computed from two exact counts because the decimal sum behind ``avg`` holds
    eleven integer digits only and overflows on groups beyond 10^11 rows.
    """
    hits, total = F.count_if(flag), rows()
    fifth = F.call_function("div", hits * 200000 + total, total * 2)
    third = F.call_function("div", fifth + 50, F.lit(100))
    return (third.cast("decimal(20,0)") / F.lit(1000)).cast("decimal(5,3)")
