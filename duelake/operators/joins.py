"""Key resolution and event context.

No join carries a broadcast hint: adaptive execution broadcasts a side once its
measured size is under the session threshold, and splits skewed partitions of
the large side otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duelake.operators.keys import VIOLATION, keep_last
from duelake.session import many_tasks


def resolve_event(series: DataFrame, events: DataFrame, bring: Sequence[str] = ("region",)) -> DataFrame:
    """Attach ``event_id`` and more by the event's name; unknown names stay null."""
    named = events.select(
        F.col("name").alias("event_name"), F.col("event_id").cast("bigint").alias("event_id"), *bring
    )
    return series.join(named, "event_name", "left").select(
        *series.columns, "event_id", *[c for c in named.columns if c not in ("event_name", "event_id")]
    )


def attach(facts: DataFrame, context: DataFrame, on: str = "match_id") -> DataFrame:
    """Left join of a fact with its match context; fact columns come first."""
    brought = [c for c in context.columns if c != on]
    return facts.join(context, on, "left").select(*facts.columns, *brought)


def attach_all(facts: DataFrame, context: DataFrame, on: str = "match_id") -> DataFrame:
    """``attach`` where a key may meet many context rows, so that the result is far larger than both sides.

    Adaptive execution merges partitions by the bytes that come in, and a few tasks would then make all of the result.  A
    number of partitions that is given is left as it is.
    """
    parts = many_tasks(facts.sparkSession)
    return attach(facts.repartition(parts, on), context.repartition(parts, on), on)


def last_context(context: DataFrame, on: str, order: Sequence[str]) -> DataFrame:
    """The context row a keep-last gate after the join would have kept.

    The rows go through an exchange of their own: adaptive execution then knows the size of what the gate left, not of what went
    into it, and broadcasts a small context where it would shuffle the facts by match.
    """
    return keep_last(context.where(F.col(on).isNotNull()), [on], order).hint("rebalance")


#: Marks the row of a context that keep-last would take for its key.
LAST = "_last"


def marked_context(context: DataFrame, on: str, order: Sequence[str]) -> DataFrame:
    """All context rows that can be met, the last one of each key marked; the order columns go."""
    newest_first = [F.col(c).desc_nulls_last() for c in order]
    rank = F.row_number().over(Window.partitionBy(on).orderBy(*newest_first))
    return context.where(F.col(on).isNotNull()).withColumn(LAST, rank == 1).drop(*order)


def attach_flagged(facts: DataFrame, context: DataFrame, on: str = "match_id") -> DataFrame:
    """``attach`` for a flagged frame in one join: clean rows meet the last context row, violations all of them."""
    brought = [c for c in context.columns if c not in (on, LAST)]
    there = context.withColumnRenamed(on, "__on")
    same = (F.col(on) == F.col("__on")) & (F.col(VIOLATION) | F.col(LAST))
    return facts.join(there, same, "left").select(*facts.columns, *brought)
