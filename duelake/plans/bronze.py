"""Validated bronze records from landed payload tables.

A landed table has one row per fetched payload and ``fetch_seq``, the order in
which payloads arrived.  Each builder returns *flagged attempts*:

``record_key``, ``quarantine_key``, ``_order``, the typed contract columns,
``ingested_at``, ``validation_errors``, ``original_payload``

``sinks.records`` turns attempts into the last valid record per key and the
quarantine envelopes.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelake import fixed_values as fixed
from duelake.functions.casting import whole_number
from duelake.functions.text import path_safe, record_key
from duelake.operators.contracts import ERRORS, Value, valid_members, validate
from duelake.operators.filters import at_least, before_cutoff, completed, not_ingested, scope_condition
from duelake.operators.keys import distinct_ids, real_id
from duelake.operators.reshape import attribute, explode_actions, explode_maps, has_field, positional
from duelake.record_types import CONTRACTS

CARRIED = ("record_key", "quarantine_key", "_order", "ingested_at")

# Payload array -> action type, in the order the running index counts them.
ACTION_LISTS = {"picks": "pick", "bans": "ban", "remaining": "remaining", "map_actions": "map_action"}


@dataclass(frozen=True)
class Landing:
    """The landed payload tables a backfill reads."""

    events: DataFrame
    matches: DataFrame
    series: DataFrame
    series_maps: DataFrame
    standings: DataFrame
    team_info: DataFrame
    roster: DataFrame
    placements: DataFrame
    transactions: DataFrame
    profiles: DataFrame
    agent_stats: DataFrame


@dataclass(frozen=True)
class Scope:
    first_year: int = fixed.SCOPE_FIRST_YEAR
    last_year: int = fixed.SCOPE_LAST_YEAR
    reject: tuple[str, ...] = fixed.SCOPE_REJECT_TOKENS
    accept: tuple[str, ...] = fixed.SCOPE_ACCEPT_TOKENS

    def condition(self) -> Column:
        return scope_condition(
            F.col("name"), F.col("start_date"), self.first_year, self.last_year, self.reject, self.accept
        )


def flag(df: DataFrame, record_type: str, key: Column, *positions: str, quarantine_key: Column | None = None) -> DataFrame:
    """Attach key, arrival order and stamp, then check the contract."""
    keyed = df.withColumns(
        {
            "record_key": key,
            "quarantine_key": key if quarantine_key is None else quarantine_key,
            "_order": F.struct("fetch_seq", *positions),
            "ingested_at": F.current_timestamp(),
        }
    )
    return validate(keyed, CONTRACTS[record_type], carry=CARRIED)


# ---- events and the matches to fetch ----------------------------------------


def scoped_events(events: DataFrame, scope: Scope = Scope()) -> DataFrame:
    """Events on pages before the cut-off that are in scope."""
    condition = scope.condition()
    return before_cutoff(events, condition, scope.first_year).where(condition)


#: Marks the events in scope among those that were read.
IN_SCOPE = "_in_scope"


def seen_events(events: DataFrame, scope: Scope = Scope()) -> DataFrame:
    """Events on pages up to the stale one, those in scope marked; a job stages it and takes all else from it."""
    condition = scope.condition()
    return before_cutoff(events, condition, scope.first_year, keep_stop=True).withColumn(IN_SCOPE, F.coalesce(condition, F.lit(False)))


def in_scope(seen: DataFrame) -> DataFrame:
    """``scoped_events`` from ``seen_events``: a stale page holds no event in scope."""
    return seen.where(IN_SCOPE).drop(IN_SCOPE)


def count_seen(seen: DataFrame) -> DataFrame:
    """``event_counts`` from ``seen_events``."""
    return seen.agg(
        F.count(F.lit(1)).alias("events_total"),
        F.count_if(IN_SCOPE).alias("events_in_scope"),
        F.count_if(~F.col(IN_SCOPE)).alias("events_skipped"),
    )


def event_attempts(events: DataFrame, scope: Scope = Scope()) -> DataFrame:
    return scoped_event_attempts(scoped_events(events, scope))


def scoped_event_attempts(scoped: DataFrame) -> DataFrame:
    df = scoped.withColumnRenamed("id", "event_id")
    typed_id = whole_number(F.col("event_id"), df.schema["event_id"].dataType)
    return flag(df, "events", record_key(F.coalesce(typed_id.cast("string"), F.col("event_id").cast("string"))), "page")


def candidate_matches(matches: DataFrame, events_in_scope: DataFrame) -> DataFrame:
    """Ids of completed matches of in-scope events, each once."""
    ids = events_in_scope.select(F.col("id").alias("event_id"))
    return completed(matches).join(ids, "event_id", "left_semi").select("match_id").distinct()


def wanted_matches(candidates: DataFrame, existing_series: DataFrame | None) -> DataFrame:
    """Candidates whose series is not in bronze yet."""
    if existing_series is None:
        return candidates
    keyed = candidates.withColumn("record_key", record_key("match_id"))
    return not_ingested(keyed, existing_series, "record_key").drop("record_key")


def usable_series(series: DataFrame, wanted: DataFrame) -> DataFrame:
    """Landed series of wanted matches that name two sides.

    A match without one is missing, and so are its actions and maps.
    """
    two = at_least(series, "teams", 2).where(positional(F.col("teams"), 0).isNotNull() & positional(F.col("teams"), 1).isNotNull())
    return two.join(wanted, "match_id", "left_semi")


def maps_of(series_maps: DataFrame, series: DataFrame) -> DataFrame:
    return series_maps.join(series.select("match_id"), "match_id", "left_semi")


# ---- match records ----------------------------------------------------------


def _field(df: DataFrame, path: str, column: Column) -> Column:
    return column if has_field(df.schema, path) else F.lit(None)


def series_attempts(series: DataFrame) -> DataFrame:
    """Match header with its two sides widened by position."""

    def side(index: int) -> Column:
        team = positional(F.col("teams"), index)
        return F.struct(
            team["name"].alias("name"),
            team["id"].alias("team_id"),
            team["short"].alias("short"),
            team["country"].alias("country"),
            team["score"].alias("series_score"),
        )

    df = series.select(
        "fetch_seq",
        "match_id",
        F.col("event").alias("event_name"),
        "event_phase",
        "status_note",
        "best_of",
        F.col("date").alias("match_date"),
        "patch",
        side(0).alias("team1"),
        side(1).alias("team2"),
    )
    return flag(df, "series", record_key("match_id"))


def action_attempts(series: DataFrame) -> DataFrame:
    """Picks, bans, remaining maps and other map actions as rows."""
    df = explode_actions(series, ACTION_LISTS, ["fetch_seq", "match_id"]).withColumn("action", F.col("action_type"))
    return flag(df, "map_picks_bans", record_key("match_id", "action_type", "action_idx"), "action_idx")


def player_rows(series_maps: DataFrame) -> DataFrame:
    maps = explode_maps(series_maps, ["fetch_seq", "match_id"], ["game_id", "map_name", "players"])
    return maps.select(
        "fetch_seq", "match_id", "map_index", "game_id", "map_name", F.posexplode("players").alias("player_pos", "p")
    )


# Player payload attribute -> record attribute, where they differ.
PLAYER_NAMES = {"name": "player_name", "r": "rating", "k": "kills", "d": "deaths", "a": "assists"}


def player_stat_attempts(series_maps: DataFrame) -> DataFrame:
    """One record per map and player."""
    rows = player_rows(series_maps)
    inner = rows.schema["p"].dataType.fieldNames()
    df = rows.select(
        "fetch_seq",
        "match_id",
        "map_index",
        "game_id",
        "map_name",
        "player_pos",
        *[F.col("p")[n].alias(PLAYER_NAMES.get(n, n)) for n in inner],
    )
    return flag(
        df,
        "player_stats",
        record_key("match_id", "map_index", "player_name"),
        "map_index",
        "player_pos",
        quarantine_key=record_key("match_id", "map_index", F.lit(fixed.UNKNOWN)),
    )


SCORE_ATTRIBUTES = ("id", "name", "short", "score", "attacker_rounds", "defender_rounds", "is_winner")


def map_score_attempts(series_maps: DataFrame) -> DataFrame:
    """One record per map that has two sides, widened by position."""
    header = ["fetch_seq", "match_id"]
    maps = at_least(explode_maps(series_maps, header, ["game_id", "map_name", "teams"]), "teams", 2)
    wide = [
        _field(maps, f"teams.{a}", positional(F.col("teams"), i)[a]).alias(f"team{i + 1}_{a}")
        for i in (0, 1)
        for a in SCORE_ATTRIBUTES
    ]
    df = maps.select(*header, "map_index", "map_name", "game_id", *wide)
    return flag(df, "map_scores", record_key("match_id", "map_index"), "map_index")


def round_attempts(series_maps: DataFrame) -> DataFrame:
    """One record per map and round; 0 where rounds carry no number at all, and a null number is rejected."""
    maps = explode_maps(series_maps, ["fetch_seq", "match_id"], ["rounds"])
    df = maps.select("fetch_seq", "match_id", "map_index", F.posexplode("rounds").alias("round_pos", "r")).select(
        "fetch_seq", "match_id", "map_index", "round_pos", "r.*"
    )
    df = df.withColumn("round_number", attribute(df, "round_number", 0))
    return flag(
        df,
        "round_results",
        record_key("match_id", "map_index", "round_number"),
        "map_index",
        "round_pos",
        quarantine_key=record_key("match_id", "map_index", F.lit(fixed.UNKNOWN)),
    )


# ---- ids met on the way, and the records fetched for them ---------------------


def team_ids(series: DataFrame) -> DataFrame:
    sides = series.select(positional(F.col("teams"), 0)["id"].alias("a"), positional(F.col("teams"), 1)["id"].alias("b"))
    return distinct_ids(sides, ["a", "b"], "team_id")


def player_ids(series_maps: DataFrame) -> DataFrame:
    """Real player ids of all maps; only the id column of the payload is read."""
    per_map = series_maps.select(F.explode("maps.players").alias("players"))
    ids = per_map.select(F.explode("players.player_id").alias("player_id"))
    return ids.where(real_id(F.col("player_id"))).distinct()


def unseen(ids: DataFrame, column: str, existing: DataFrame | None) -> DataFrame:
    """Ids that have no record of their own yet."""
    if existing is None:
        return ids
    keyed = ids.withColumn("record_key", record_key(column))
    return not_ingested(keyed, existing, "record_key").drop("record_key")


def standing_attempts(standings: DataFrame, events_in_scope: DataFrame) -> DataFrame:
    """Standings of in-scope events; the stage is not part of the key."""
    ids = events_in_scope.select(F.col("id").alias("event_id"))
    place = F.coalesce(attribute(standings, "place", fixed.UNKNOWN).cast("string"), F.lit(fixed.NULL_IN_KEY))
    df = standings.join(ids, "event_id", "left_semi").withColumn("place", place)
    return flag(df, "event_standings", record_key("event_id", path_safe(F.col("place"))))


def team_info_attempts(team_info: DataFrame, ids: DataFrame) -> DataFrame:
    return flag(team_info.join(ids, "team_id", "left_semi"), "team_info", record_key("team_id"))


def rosters(roster: DataFrame, ids: DataFrame) -> DataFrame:
    """Team rosters reduced to their valid members; a team with none is left out."""
    contract = CONTRACTS["team_roster"]
    team = {"team_id": Value(F.col("team_id"), roster.schema["team_id"].dataType)}
    members = valid_members(F.col("members"), roster.schema["members"].dataType, contract, team)
    return (
        roster.join(ids, "team_id", "left_semi")
        .select(
            record_key("team_id").alias("record_key"),
            F.struct("fetch_seq").alias("_order"),
            F.current_timestamp().alias("ingested_at"),
            members.alias("members"),
        )
        .where(F.size("members") > 0)
    )


def roster_attempts(roster: DataFrame, ids: DataFrame) -> DataFrame:
    """``rosters`` in the shape of the other builders: nothing left to reject."""
    kept = rosters(roster, ids)
    return kept.select(
        "record_key",
        F.col("record_key").alias("quarantine_key"),
        "_order",
        "ingested_at",
        "members",
        F.array().cast("array<string>").alias(ERRORS),
        F.lit(None).cast("string").alias("original_payload"),
    )


def placement_attempts(placements: DataFrame, ids: DataFrame) -> DataFrame:
    df = placements.join(ids, "team_id", "left_semi")
    key = record_key("team_id", attribute(df, "event_id", fixed.UNKNOWN))
    return flag(df, "team_placements", key)


def transaction_attempts(transactions: DataFrame, ids: DataFrame) -> DataFrame:
    df = transactions.join(ids, "team_id", "left_semi")
    key = record_key("team_id", attribute(df, "player_id", fixed.UNKNOWN), attribute(df, "date", fixed.UNKNOWN))
    keyed = df.withColumn("transaction_key", key).withColumnRenamed("date", "transaction_date")
    return flag(keyed, "team_transactions", F.col("transaction_key"))


def profile_attempts(profiles: DataFrame, ids: DataFrame) -> DataFrame:
    return flag(profiles.join(ids, "player_id", "left_semi"), "player_profiles", record_key("player_id"))


def agent_stat_attempts(agent_stats: DataFrame, ids: DataFrame) -> DataFrame:
    df = agent_stats.join(ids, "player_id", "left_semi")
    return flag(df, "player_agent_stats", record_key("player_id", attribute(df, "agent", fixed.UNKNOWN)))


def event_counts(events: DataFrame, scope: Scope = Scope()) -> DataFrame:
    """Events read, in scope and skipped; the stale page was read, so it counts."""
    condition = scope.condition()
    seen = before_cutoff(events, condition, scope.first_year, keep_stop=True)
    return seen.agg(
        F.count(F.lit(1)).alias("events_total"),
        F.count_if(condition).alias("events_in_scope"),
        F.count_if(~condition).alias("events_skipped"),
    )


def series_counts(candidates: DataFrame, wanted: DataFrame, usable: DataFrame) -> Mapping[str, DataFrame]:
    """Frames whose row counts are the skipped and missing series."""
    return {
        "series_skipped": candidates.join(wanted, "match_id", "left_anti"),
        "series_missing": wanted.join(usable.select("match_id"), "match_id", "left_anti"),
    }
