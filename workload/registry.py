"""Where queries and their SQL counterparts register."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workload.shapes import Shapes, with_shapes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: The SQL of each query before its parts were put in: (statement, named parts).
PARTS: dict[str, tuple[str, dict[str, str]]] = {}


def statement(name: str, **other: str) -> str:
    """A query's SQL with other named parts in place of its own."""
    oracle, selects = PARTS[name]
    return with_shapes(oracle, **{**selects, **other})


def query(name: str, oracle: str | None = None, lists: tuple[str, ...] = (), **selects: str):
    """Register a function of ``Shapes``; ``selects`` are named parts of the SQL.

    ``lists`` names array columns, shown as joined text on both sides so that
    rows compare as plain values.
    """

    def register(build: Callable[[Shapes], DataFrame]):
        def run(spark: SparkSession, directory: str) -> DataFrame:
            df = build(Shapes(spark, directory))
            return df.withColumns({c: F.array_join(c, "|") for c in lists})

        QUERIES[name] = run
        if oracle is not None:
            PARTS[name] = (oracle, selects)
            sql = with_shapes(oracle, **selects)
            if lists:
                joined = ", ".join(f"array_to_string({c}, '|') AS {c}" for c in lists)
                sql = f"SELECT * REPLACE ({joined}) FROM ({sql})"
            ORACLES[name] = sql
        return build

    return register


# ---- SQL fragments ----------------------------------------------------------


def last(source: str, keys: str, order: str, columns: str = "*", where: str = "TRUE") -> str:
    """SELECT of the last row per key; ``order`` lists descending columns."""
    by = ", ".join(f"{c.strip()} DESC NULLS LAST" for c in order.split(","))
    return (
        f"SELECT {columns} FROM {source} WHERE {where} "
        f"QUALIFY ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY {by}) = 1"
    )


def mean(value: str, digits: int) -> str:
    """Rounded mean of whole non-negative values, in exact integers."""
    scale = 10**digits
    k, n = f"CAST(SUM({value}) AS BIGINT)", f"COUNT({value})"
    return f"CASE WHEN {n} = 0 THEN NULL ELSE CAST((2 * {scale} * {k} + {n}) // (2 * {n}) AS DOUBLE) / {scale} END"


def ratio(part: str, whole: str) -> str:
    """Ratio of whole sums to three places, halves away from zero, in exact integers."""
    p, w = f"ABS(CAST({part} AS BIGINT))", f"ABS(CAST({whole} AS BIGINT))"
    size = f"CAST((2000 * {p} + {w}) // (2 * {w}) AS DOUBLE) / 1000"
    return f"CASE WHEN {whole} IS NULL OR {whole} = 0 THEN NULL ELSE SIGN({part}) * SIGN({whole}) * {size} END"


def total(value: str) -> str:
    return f"CAST(SUM({value}) AS BIGINT)"
