"""One declaration per table: layer, primary key, partitions, write order."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Table:
    name: str
    layer: str
    key: tuple[str, ...]
    partitions: tuple[str, ...] = ()
    source: str = ""
    # (column, descending) pairs of the published order
    order: tuple[tuple[str, bool], ...] = ()


#: Partition columns whose values grow with the input.  A folder and a file for each of their values would make the writes and
#: listings of a table cost files and not rows, so tables split by one are clustered: files in bounded number, sorted by
#: the partition columns, which the catalog states as ``CLUSTER BY``.
GROWING = ("event_id",)


def clustered(partitions) -> bool:
    """Whether a table of these partition columns is clustered by them and not split into a folder for each value."""
    return any(c in GROWING for c in partitions)


def _silver(name, source, key, partitions=()):
    return Table(name, "silver", tuple(key.split()), tuple(partitions), source)


def _gold(name, key, partitions=(), order=()):
    return Table(name, "gold", tuple(key.split()), tuple(partitions), order=tuple(order))


SILVER = {
    t.name: t
    for t in (
        _silver("dim_events", "events", "event_id", ["region"]),
        _silver("dim_teams", "team_info", "team_id"),
        _silver("dim_team_roster", "team_roster", "team_id player_id"),
        _silver("dim_players", "player_profiles", "player_id"),
        _silver("fact_series", "series", "match_id", ["event_id"]),
        _silver("fact_player_stats", "player_stats", "match_id game_id player_id", ["event_id", "map_name"]),
        _silver("fact_map_scores", "map_scores", "match_id game_id", ["event_id"]),
        _silver("fact_round_results", "round_results", "match_id map_index round_number", ["event_id"]),
        _silver("fact_map_picks_bans", "map_picks_bans", "match_id action_type map team", ["event_id"]),
        _silver("fact_player_agent_stats", "player_agent_stats", "player_id agent"),
        _silver("fact_event_standings", "event_standings", "event_id stage_path place", ["event_id"]),
        _silver("fact_team_placements", "team_placements", "team_id event_id"),
        _silver("fact_team_transactions", "team_transactions", "team_id player_id transaction_date"),
    )
}

# Partitioning of the three tables of the legacy silver job.
LEGACY_PARTITIONS = {
    "dim_events": ("region",),
    "fact_series": ("event_id",),
    "fact_player_stats": ("event_id", "map_name"),
}

GOLD = {
    t.name: t
    for t in (
        _gold("player_performance", "event_id region player_id player_name team_id team_short", ["event_id"]),
        _gold("player_map_performance", "player_id player_name team_id team_short map_name"),
        _gold("agent_meta", "map_name agent", ["map_name"], [("map_name", False), ("pick_count", True)]),
        _gold(
            "agent_player_affinity",
            "player_id player_name team_id team_short agent",
            order=[("player_id", False), ("maps_played", True)],
        ),
        _gold(
            "team_standings",
            "event_id event_name region team_id team_name",
            ["event_id"],
            [("event_id", False), ("matches_won", True)],
        ),
        _gold(
            "team_map_performance",
            "team_id team_name map_name",
            order=[("team_id", False), ("maps_played", True)],
        ),
        _gold("match_summary", "match_id", ["event_id"], [("match_date", True)]),
    )
}
