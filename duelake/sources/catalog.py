"""Catalog scans, temp views and the ingested listing."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duelake.fixed_values import LISTING_DEFAULTS
from duelake.functions.text import key_part
from duelake.operators.reshape import attribute
from duelake.sources.landed import ORIGIN

# Views registered when no list is given.
DEFAULT_VIEWS = (
    "fact_player_stats",
    "fact_series",
    "fact_map_scores",
    "fact_round_results",
    "fact_map_picks_bans",
    "fact_player_agent_stats",
    "fact_event_standings",
    "dim_events",
    "dim_teams",
    "dim_players",
)


def view_name(table: str) -> str:
    return f"silver_{table}"


def table(spark: SparkSession, database: str, name: str) -> DataFrame:
    return spark.table(f"{database}.{name}")


def register_silver_views(spark: SparkSession, database: str, tables: Sequence[str] | None = None) -> list[str]:
    """Register ``silver_<table>`` views; a table that is missing is left out.

    A view left over from an earlier run is dropped when its table is gone, so
    the gate below never sees a stale one.  Returns the views registered.
    """
    registered = []
    for name in tables or DEFAULT_VIEWS:
        if spark.catalog.tableExists(f"{database}.{name}"):
            table(spark, database, name).createOrReplaceTempView(view_name(name))
            registered.append(view_name(name))
        else:
            spark.catalog.dropTempView(view_name(name))
    return registered


def view_rows(spark: SparkSession, tables: Sequence[str]) -> dict[str, int]:
    """Row count of each view; Parquet answers it from file footers."""
    return {t: spark.table(view_name(t)).count() for t in tables if view_available(spark, t)}


def view_available(spark: SparkSession, table_name: str) -> bool:
    return spark.catalog.tableExists(view_name(table_name))


def build_if_available(
    spark: SparkSession, build: Callable[[], DataFrame], requires: str = ""
) -> DataFrame | None:
    """The built frame, or None when the view it requires is not registered."""
    if requires and not view_available(spark, requires):
        return None
    return build()


def listing(records: DataFrame) -> DataFrame:
    """Id, name and start date of each record, ordered by the id as text.

    Each has a literal default where the record type lacks the attribute.
    Equal ids keep the order the records were read in.
    """

    def text(name: str) -> Column:
        return attribute(records, name, LISTING_DEFAULTS[name]).cast("string").alias(name)

    ties = [c for c in ORIGIN if c in records.columns]
    shown = records.select(text("id"), text("name"), text("start_date"), *ties)
    return shown.orderBy(key_part(F.col("id")), *(ties or ["name", "start_date"])).drop(*ties)
