"""Exact distinct counts beside sums and means, without a copy of every row for each of them.

Spark plans several distinct counts as one copy of the row for each and one more for the other measures.  Here a
row becomes one narrow row for each further id, and the measures travel with the first id.  They are added up by
group and id, which spreads a hot group over all tasks and merges its rows before the exchange; then each id is one row, so
counting rows counts ids.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelake.functions.measures import rounded


def group_with_distincts(
    df: DataFrame,
    keys: Sequence[str],
    distincts: Mapping[str, str],
    sums: Mapping[str, str],
    means: Mapping[str, tuple[str, int]],
) -> DataFrame:
    """Groups with counts of distinct ids (``distincts``: name -> column), sums (name -> column) and rounded means.

    Null ids are not counted, null measures neither added nor averaged; a group without a value has null.
    """
    first = list(distincts.values())[0]
    measures = list(dict.fromkeys([*sums.values(), *(c for c, _ in means.values())]))
    types = {df.schema[c].dataType for c in distincts.values()}
    as_id = (lambda c: F.col(c)) if len(types) == 1 else (lambda c: F.col(c).cast("string"))

    def row(kind: int, column: str) -> Column:
        carried = [F.col(m) if column == first else F.lit(None).cast(df.schema[m].dataType) for m in measures]
        return F.struct(
            F.lit(kind).alias("_kind"), as_id(column).alias("_id"), *(c.alias(f"_m{i}") for i, c in enumerate(carried))
        )

    rows = df.select(*keys, F.inline(F.array(*(row(kind, c) for kind, c in enumerate(distincts.values())))))
    place = {m: i for i, m in enumerate(measures)}
    by_id = rows.groupBy(*keys, "_kind", "_id").agg(
        *(F.sum(f"_m{i}").alias(f"_s{i}") for i in place.values()),
        *(F.count(f"_m{place[c]}").alias(f"_n{place[c]}") for c in dict.fromkeys(c for c, _ in means.values())),
    )
    counted = [
        F.count_if((F.col("_kind") == kind) & F.col("_id").isNotNull()).alias(name) for kind, name in enumerate(distincts)
    ]
    added = [F.sum(f"_s{place[c]}").alias(name) for name, c in sums.items()]
    averaged = [
        rounded(F.sum(f"_s{place[c]}").cast("double") / F.nullif(F.sum(f"_n{place[c]}"), F.lit(0)), digits).alias(name)
        for name, (c, digits) in means.items()
    ]
    return by_id.groupBy(*keys).agg(*counted, *added, *averaged)
