"""Row filters of the ingestion stage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelake import fixed_values as fixed
from duelake.functions.text import contains_any


def scope_condition(
    name: Column,
    start_date: Column,
    first_year: int = fixed.SCOPE_FIRST_YEAR,
    last_year: int = fixed.SCOPE_LAST_YEAR,
    reject: Sequence[str] = fixed.SCOPE_REJECT_TOKENS,
    accept: Sequence[str] = fixed.SCOPE_ACCEPT_TOKENS,
) -> Column:
    """Year window, then reject tokens, then accept tokens.

    A start date decides the year alone; only without one is a year looked for
    in the name.  Tokens are plain substrings of the upper-cased name.
    """
    years = [str(y) for y in range(first_year, last_year + 1)]
    in_window = F.when(
        start_date.isNotNull(), F.year(start_date).between(first_year, last_year)
    ).otherwise(contains_any(name, years))
    upper = F.upper(name)
    return F.coalesce(in_window & ~contains_any(upper, reject) & contains_any(upper, accept), F.lit(False))


def completed(df: DataFrame, status: str = "status") -> DataFrame:
    return df.where(F.lower(F.col(status)) == fixed.COMPLETED_STATUS)


def not_ingested(df: DataFrame, existing: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Rows whose key is not in the existing key set; a null key never exists."""
    names = [keys] if isinstance(keys, str) else list(keys)
    return df.join(existing.select(*names), names, "left_anti")


def unless_present(df: DataFrame, target: DataFrame) -> DataFrame:
    """All of ``df`` while ``target`` has no row, else nothing."""
    return df.where(~target.limit(1).select(F.lit(1).alias("hit")).exists())


def first_stale_page(
    events: DataFrame,
    in_scope: Column,
    first_year: int = fixed.SCOPE_FIRST_YEAR,
    page: str = "page",
    start_date: str = "start_date",
) -> DataFrame:
    """One row, ``stop``: the first page of only old, dated, out-of-scope events.

    An undated event keeps its page from being a stop; null when no page stops.
    """
    dated_before = F.col(start_date).isNotNull() & (F.year(start_date) < first_year)
    return (
        events.groupBy(page)
        .agg(F.every(dated_before).alias("all_old"), F.count_if(in_scope).alias("wanted"))
        .where(F.col("all_old") & (F.col("wanted") == 0))
        .agg(F.min(page).alias("stop"))
    )


def before_cutoff(
    events: DataFrame,
    in_scope: Column,
    first_year: int = fixed.SCOPE_FIRST_YEAR,
    page: str = "page",
    start_date: str = "start_date",
    keep_stop: bool = False,
) -> DataFrame:
    """Drop the first stale page and all later ones.

    ``keep_stop`` keeps the stale page itself: it was read, though not used.
    """
    stop = first_stale_page(events, in_scope, first_year, page, start_date).scalar()
    read = F.col(page) <= stop if keep_stop else F.col(page) < stop
    return events.where(F.coalesce(read, F.lit(True)))


def at_least(df: DataFrame, array: str, n: int) -> DataFrame:
    """Rows whose array has ``n`` or more elements; a null array has none."""
    return df.where(F.coalesce(F.size(array), F.lit(0)) >= n)
