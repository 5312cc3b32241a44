"""Typed, key-checked silver tables.

Each transform takes a raw frame (all-text scalars or typed bronze columns, see
``sources.landed``) and returns ``Split(clean, violations)``.  ``order`` names
the columns that say which of several rows with one key came last.

Facts are gated before their event context is joined on.  The result is the
same as gating after the join, because the last row of the joined frame for a
key is the last fact row with the last context row; but duplicates are gone
before the join, and the join cannot fan out.  Violations do keep the fan-out.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelake.functions.casting import lenient_casts, strict_casts
from duelake.operators.joins import attach, attach_all, attach_flagged, last_context, marked_context, resolve_event
from duelake.operators.keys import VIOLATION, Split, any_null, keep_last, pk_flagged, pk_gate
from duelake.operators.reshape import flatten_struct
from duelake.registry import SILVER
from duelake.sources.landed import ORIGIN

META = "ingested_at"


def _types(kind: str, names: str) -> dict[str, str]:
    return dict.fromkeys(names.split(), kind)


# Casts that fail the job on bad input, and casts that turn it into null.
STRICT = {
    "dim_events": {"event_id": "bigint", "start_date": "date", "end_date": "date"},
    "dim_teams": {"team_id": "bigint", "is_active": "boolean"},
    "dim_team_roster": {"team_id": "bigint", "is_captain": "boolean"},
    "dim_players": {"player_id": "bigint"},
    "fact_series": {"match_id": "bigint", "match_date": "date"},
    "fact_player_stats": {"match_id": "bigint", "map_index": "int"},
    "fact_map_scores": {"match_id": "bigint", "map_index": "int"},
    "fact_round_results": {"match_id": "bigint", "map_index": "int", "round_number": "int"},
    "fact_map_picks_bans": {"match_id": "bigint"},
    "fact_player_agent_stats": {"player_id": "bigint"},
    "fact_event_standings": {"event_id": "bigint"},
    "fact_team_placements": {"team_id": "bigint"},
    "fact_team_transactions": {"team_id": "bigint"},
}
LENIENT = {
    "dim_team_roster": {"player_id": "bigint"},
    "fact_player_stats": {
        **_types("bigint", "game_id player_id team_id"),
        **_types("int", "acs kills deaths assists fk fd"),
        **_types("float", "rating kast adr hs_pct"),
    },
    "fact_map_scores": {
        **_types("bigint", "game_id team1_id team2_id"),
        **_types("int", "team1_score team2_score team1_attacker_rounds team1_defender_rounds"),
        **_types("int", "team2_attacker_rounds team2_defender_rounds"),
        **_types("boolean", "team1_is_winner team2_is_winner"),
    },
    "fact_round_results": {**_types("int", "score_team1 score_team2"), "winner_team_id": "bigint"},
    "fact_player_agent_stats": {
        **_types("int", "usage_count rounds_played kills deaths assists first_kills first_deaths"),
        **_types("float", "usage_percent rating acs kd adr kast"),
    },
    "fact_event_standings": {"team_id": "bigint"},
    "fact_team_placements": {"event_id": "bigint"},
    "fact_team_transactions": {"player_id": "bigint", "transaction_date": "date"},
}

TEAM_FIELDS = (("name", "name", None), ("id", "team_id", "bigint"), ("score", "series_score", "int"))


class SeriesSplit(NamedTuple):
    """``lookup`` holds every series row's event, before the key gate, in order."""

    clean: DataFrame
    violations: DataFrame
    lookup: DataFrame


def typed(raw: DataFrame, table: str) -> DataFrame:
    """Drop the ingestion stamp, cast, and rename the reserved word ``rating``."""
    df = strict_casts(raw.drop(META), STRICT[table])
    if table in LENIENT:
        df = lenient_casts(df, LENIENT[table])
    return df.withColumnRenamed("rating", "r_rating")


def dimension(raw: DataFrame, table: str, order: Sequence[str] = ORIGIN) -> Split:
    """Cast and gate: all tables that need no event context."""
    split = pk_gate(typed(raw, table), SILVER[table].key, order)
    return Split(split.clean.drop(*order), split.violations.drop(*order))


def dim_events(raw: DataFrame, order: Sequence[str] = ORIGIN) -> Split:
    return dimension(raw, "dim_events", order)


def dim_teams(raw: DataFrame, order: Sequence[str] = ORIGIN) -> Split:
    return dimension(raw, "dim_teams", order)


def dim_team_roster(raw: DataFrame, order: Sequence[str] = ORIGIN) -> Split:
    return dimension(raw, "dim_team_roster", order)


def dim_players(raw: DataFrame, order: Sequence[str] = ORIGIN) -> Split:
    return dimension(raw, "dim_players", order)


def fact_player_agent_stats(raw: DataFrame, order: Sequence[str] = ORIGIN) -> Split:
    return dimension(raw, "fact_player_agent_stats", order)


def fact_event_standings(raw: DataFrame, order: Sequence[str] = ORIGIN) -> Split:
    return dimension(raw, "fact_event_standings", order)


def fact_team_placements(raw: DataFrame, order: Sequence[str] = ORIGIN) -> Split:
    return dimension(raw, "fact_team_placements", order)


def fact_team_transactions(raw: DataFrame, order: Sequence[str] = ORIGIN) -> Split:
    return dimension(raw, "fact_team_transactions", order)


def flat_series(raw: DataFrame) -> DataFrame:
    """Series with both team structs lifted to columns."""
    df = typed(raw, "fact_series")
    for side in ("team1", "team2"):
        df = flatten_struct(df, side, {f"{side}_{out}": (inner, kind) for out, inner, kind in TEAM_FIELDS})
    return df.drop("team1", "team2")


def event_order(events: DataFrame) -> F.Column:
    """Position of an event among its kind: the order of the object keys."""
    return F.concat(F.col("event_id").cast("string"), F.lit(".json"))


def fact_series(raw: DataFrame, events: DataFrame, order: Sequence[str] = ORIGIN) -> SeriesSplit:
    """Series with the event found by name.

    An event name that occurs twice doubles its series in the lookup and the
    violations; the gate keeps the later event.
    """
    flat = flat_series(raw)
    named = events.select("event_id", "name", "region", event_order(events).alias("_event_order"))
    joined = resolve_event(flat, named, bring=("region", "_event_order"))
    full_order = [*order, "_event_order"]
    split = pk_gate(joined, SILVER["fact_series"].key, full_order)
    return SeriesSplit(
        split.clean.drop(*full_order),
        split.violations.drop(*full_order),
        joined.select("match_id", "event_id", "region", *full_order),
    )


def match_fact(raw: DataFrame, table: str, lookup: DataFrame, order: Sequence[str] = ORIGIN) -> Split:
    """Cast, gate and attach ``event_id`` and ``region`` by match.

    ``lookup`` is ``SeriesSplit.lookup``, or any frame with one row per match.
    """
    facts = typed(raw, table)
    context = ["match_id", "event_id", "region"]
    lookup_order = [c for c in lookup.columns if c not in context]
    last = last_context(lookup, "match_id", lookup_order) if lookup_order else lookup
    split = pk_gate(facts, SILVER[table].key, order)
    return Split(
        attach(split.clean.drop(*order), last.select(*context)),
        attach_all(split.violations.drop(*order), lookup.select(*context)),
    )


def fact_player_stats(raw: DataFrame, lookup: DataFrame, order: Sequence[str] = ORIGIN) -> Split:
    return match_fact(raw, "fact_player_stats", lookup, order)


def fact_map_scores(raw: DataFrame, lookup: DataFrame, order: Sequence[str] = ORIGIN) -> Split:
    return match_fact(raw, "fact_map_scores", lookup, order)


def fact_round_results(raw: DataFrame, lookup: DataFrame, order: Sequence[str] = ORIGIN) -> Split:
    return match_fact(raw, "fact_round_results", lookup, order)


def fact_map_picks_bans(raw: DataFrame, lookup: DataFrame, order: Sequence[str] = ORIGIN) -> Split:
    return match_fact(raw, "fact_map_picks_bans", lookup, order)


# ---- the same in one frame, for the jobs ---------------------------------------


def flagged_dimension(raw: DataFrame, table: str, order: Sequence[str] = ORIGIN) -> DataFrame:
    """``dimension`` with clean rows and violations in one frame (``VIOLATION``)."""
    return pk_flagged(typed(raw, table), SILVER[table].key, order).drop(*order)


class FlaggedSeries(NamedTuple):
    """``lookup`` holds every series row's event with the one that counts marked (``LAST``)."""

    rows: DataFrame
    lookup: DataFrame


def named_series(raw: DataFrame, events: DataFrame, order: Sequence[str] = ORIGIN) -> DataFrame:
    """Series joined to the events of their name, before the gate."""
    named = events.select("event_id", "name", "region", event_order(events).alias("_event_order"))
    return resolve_event(flat_series(raw), named, bring=("region", "_event_order"))


def flagged_series(joined: DataFrame, order: Sequence[str] = ORIGIN) -> FlaggedSeries:
    """``fact_series`` with clean rows and violations in one frame, from ``named_series`` (staged: it is read twice)."""
    full_order = [*order, "_event_order"]
    rows = pk_flagged(joined, SILVER["fact_series"].key, full_order).drop(*full_order)
    context = joined.select("match_id", "event_id", "region", *full_order)
    return FlaggedSeries(rows, marked_context(context, "match_id", full_order))


def flagged_match_fact(raw: DataFrame, table: str, lookup: DataFrame, order: Sequence[str] = ORIGIN) -> DataFrame:
    """``match_fact`` with clean rows and violations in one frame, through one join."""
    gated = pk_flagged(typed(raw, table), SILVER[table].key, order).drop(*order)
    return attach_flagged(gated, lookup)


# ---- the older three-table version ------------------------------------------

WIDE_COLUMNS = (
    "event_id event_name region start_date match_id match_date team1_name team2_name "
    "game_id map_index map_name player_id player_name team_id team_short agents r_rating "
    "acs kills deaths assists kast adr hs_pct fk fd"
).split()


class WideSplit(NamedTuple):
    clean: DataFrame
    violations: DataFrame
    series: DataFrame


def flagged_legacy(stats: DataFrame, with_event: DataFrame, order: Sequence[str] = ORIGIN) -> DataFrame:
    """The wide player stats with clean rows and violations in one frame; ``with_event`` is ``legacy_with_event``."""
    context = ["match_id", "match_date", "team1_name", "team2_name", "event_id", "event_name", "region", "start_date"]
    series_order = [c for c in order if c in with_event.columns] + ["_event_order"]
    lookup = marked_context(with_event.select(*context, *series_order), "match_id", series_order)
    gated = pk_flagged(stats, SILVER["fact_player_stats"].key, order).drop(*order)
    return attach_flagged(gated, lookup).select(*WIDE_COLUMNS, VIOLATION)


def legacy_with_event(series: DataFrame, events: DataFrame) -> DataFrame:
    """Series with the events of their name; repeated for every event of it."""
    named = events.select("event_id", "name", "region", "start_date", event_order(events).alias("_event_order"))
    return resolve_event(series, named, bring=("region", "start_date", "_event_order"))


def legacy_events(raw: DataFrame) -> DataFrame:
    """Events cast only: no key gate."""
    return typed(raw, "dim_events")


def legacy_series(raw: DataFrame) -> DataFrame:
    return flat_series(raw)


def legacy_player_stats(raw: DataFrame) -> DataFrame:
    return typed(raw, "fact_player_stats")


def legacy_enriched(
    stats: DataFrame,
    series: DataFrame,
    events: DataFrame,
    order: Sequence[str] = ORIGIN,
) -> WideSplit:
    """Player stats with match and event context, 26 columns, gated on the key.

    ``series`` and ``events`` are not deduplicated here, so the third result
    repeats a series for every event of its name.
    """
    named = events.select("event_id", "name", "region", "start_date", event_order(events).alias("_event_order"))
    with_event = resolve_event(series, named, bring=("region", "start_date", "_event_order"))
    context = ["match_id", "match_date", "team1_name", "team2_name", "event_id", "event_name", "region", "start_date"]
    series_order = [c for c in order if c in series.columns] + ["_event_order"]
    key = SILVER["fact_player_stats"].key
    whole = ~any_null(key)
    clean = attach(
        keep_last(stats.where(whole), key, order).drop(*order),
        last_context(with_event, "match_id", series_order).select(*context),
    )
    violations = attach_all(stats.where(~whole).drop(*order), with_event.select(*context))
    return WideSplit(
        clean.select(*WIDE_COLUMNS), violations.select(*WIDE_COLUMNS), with_event.drop(*series_order)
    )
