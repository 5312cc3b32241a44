"""Primary-key gate, keep-last and id sets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class Split(NamedTuple):
    """A table after its key gate: the rows to publish and the rows to quarantine."""

    clean: DataFrame
    violations: DataFrame


def any_null(columns: Sequence[str]) -> Column:
    return reduce(or_, (F.col(c).isNull() for c in columns), F.lit(False))


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order``, nulls smallest.

    ``order`` has to be total within a key for the result to be repeatable.
    The filter on the row number lets Spark cut each key to one row per task
    before the exchange, so a key that holds a third of the input still sends
    only one row per task to the task that decides.
    """
    if not order:
        raise ValueError("keep_last needs an order: Spark rows have no position of their own")
    newest_first = [F.col(c).desc_nulls_last() for c in order]
    rank = "__rank"
    return (
        df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first)))
        .where(F.col(rank) == 1)
        .drop(rank)
    )


def pk_gate(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> Split:
    """Rows with any null key column are violations; of the rest the last per key stays.

    Dropped duplicates are not violations: only an incomplete key is.
    """
    broken = any_null(keys)
    return Split(keep_last(df.where(~broken), keys, order), df.where(broken))


#: Marks the rows of a flagged frame whose key is incomplete.
VIOLATION = "_violation"


def pk_flagged(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Both sides of ``pk_gate`` in one frame and one pass: the last row of every key and all violations, marked.

    Each violation is a group of its own, so the row-number filter keeps it and nulls do not meet in one task.
    """
    own = "__own"
    broken = any_null(keys)
    marked = df.withColumns({VIOLATION: broken, own: F.when(broken, F.monotonically_increasing_id())})
    return keep_last(marked, [*keys, own], order).drop(own)


def real_id(column: Column) -> Column:
    """An id that names something: neither null nor zero."""
    return column.isNotNull() & (column != 0)


def distinct_ids(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """The set of real ids found in any of the columns, from one scan."""
    return (
        df.select(F.explode(F.array(*[F.col(c) for c in columns])).alias(name))
        .where(real_id(F.col(name)))
        .distinct()
    )
