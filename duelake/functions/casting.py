"""Cast rules: strict, lenient, and the coercions record contracts allow."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRUE_WORDS = ("true", "t", "yes", "y", "on", "1")
FALSE_WORDS = ("false", "f", "no", "n", "off", "0")
ISO_DAY = r"^\d{4}-\d{2}-\d{2}([T ]00:00(:00(\.0+)?)?)?$"


def strict_casts(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Cast in place; under ANSI a value that does not fit fails the job."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in casts.items()})


def lenient_casts(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Cast in place; a value that does not fit becomes null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in casts.items()})


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to ``schema``: its columns, order and types; absent columns are null."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def whole_number(value: Column, source: T.DataType) -> Column:
    """An integer, or text that spells one; ``12.0`` is whole, ``12.7`` is null."""
    if isinstance(source, T.IntegralType):
        return value.cast("bigint")
    if isinstance(source, T.BooleanType):
        return value.cast("int").cast("bigint")
    text = value.cast("string")
    return F.coalesce(text.try_cast("bigint"), F.regexp_replace(F.trim(text), r"\.0+$", "").try_cast("bigint"))


def real_number(value: Column, source: T.DataType) -> Column:
    return value.cast("double") if isinstance(source, T.NumericType) else F.trim(value.cast("string")).try_cast("double")


def calendar_day(value: Column, source: T.DataType) -> Column:
    """A date, or ISO text for one (a midnight time part is allowed)."""
    if isinstance(source, T.DateType):
        return value
    text = value.cast("string")
    return F.when(text.rlike(ISO_DAY), F.substring(text, 1, 10)).try_cast("date")


def truth_value(value: Column, source: T.DataType) -> Column:
    if isinstance(source, T.BooleanType):
        return value
    word = F.lower(value.cast("string"))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)
