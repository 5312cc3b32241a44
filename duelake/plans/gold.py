"""Gold aggregate tables over silver frames.

Each builder takes its silver inputs as frames.  Dimension names and map counts
join after the aggregation, not before it: the keys of a silver table are
unique, so the numbers are the same, the join moves groups instead of rows, and
no aggregation inherits a partitioning by one hot event or team.

``ordered=True`` returns rows in the published order, with the remaining key
columns as tie-breakers so a single hot value does not land in one range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duelake.fixed_values import DRAW_LABEL
from duelake.functions.measures import count_false, count_true, rounded_mean, rows, safe_ratio, true_share
from duelake.functions.sides import decide_winner, pick_side, won_flag
from duelake.operators.distincts import group_with_distincts
from duelake.operators.reshape import explode_values, unpivot_sides
from duelake.registry import GOLD
from duelake.sinks.tables import ordering
from duelake.sources.catalog import view_name

SIDES = (("team1", "team2"), ("team2", "team1"))


def in_order(df: DataFrame, table: str) -> DataFrame:
    spec = GOLD[table]
    named = {c for c, _ in spec.order}
    return df.orderBy(*ordering(spec.order), *[c for c in spec.key if c not in named]) if spec.order else df


def _finish(df: DataFrame, table: str, ordered: bool) -> DataFrame:
    return in_order(df, table) if ordered else df


def _named(groups: DataFrame, dimension: DataFrame, key: str, name: str, totals: list[str]) -> DataFrame:
    """Groups with the names of a dimension, as if the rows had been joined before they were grouped.

    A name that a key has in several rows counts its rows that often; shares, means and distinct counts
    stay.  Names are counted first, so a repeated dimension row adds no row here.
    """
    names = dimension.groupBy(key, F.col("name").alias(name)).agg(F.count("*").alias("_times"))
    times = F.coalesce("_times", F.lit(1))
    joined = groups.join(names, key, "left")
    return joined.withColumns({c: F.col(c) * times for c in totals}).drop("_times")


def player_performance(stats: DataFrame, events: DataFrame, ordered: bool = True) -> DataFrame:
    """Player totals and means per event."""
    keys = ["event_id", "region", "player_id", "player_name", "team_id", "team_short"]
    grouped = group_with_distincts(
        stats.where(F.col("event_id").isNotNull() & F.col("player_id").isNotNull()),
        keys,
        distincts={"matches_played": "match_id", "maps_played": "game_id"},
        sums={
            "total_kills": "kills",
            "total_deaths": "deaths",
            "total_assists": "assists",
            "total_first_kills": "fk",
            "total_first_deaths": "fd",
        },
        means={
            "avg_rating": ("r_rating", 3),
            "avg_acs": ("acs", 1),
            "avg_kast": ("kast", 3),
            "avg_adr": ("adr", 1),
            "avg_hs_pct": ("hs_pct", 3),
        },
    )
    first, death = F.col("total_first_kills"), F.col("total_first_deaths")
    per_event = grouped.withColumns(
        {"kd_ratio": safe_ratio(F.col("total_kills"), F.col("total_deaths")), "fk_rate": safe_ratio(first, first + death)}
    )
    measures = (
        "player_id player_name team_id team_short matches_played maps_played avg_rating avg_acs total_kills total_deaths "
        "total_assists kd_ratio avg_kast avg_adr avg_hs_pct total_first_kills total_first_deaths fk_rate"
    ).split()
    totals = [c for c in measures if c.startswith("total_")]
    named = _named(per_event, events, "event_id", "event_name", totals).select("event_id", "event_name", "region", *measures)
    return _finish(named, "player_performance", ordered)


def player_map_performance(stats: DataFrame, ordered: bool = True) -> DataFrame:
    """Player totals and means per map over all events."""
    result = (
        stats.where(F.col("player_id").isNotNull() & F.col("map_name").isNotNull())
        .groupBy("player_id", "player_name", "team_id", "team_short", "map_name")
        .agg(
            F.countDistinct("game_id").alias("maps_played"),
            rounded_mean(F.col("r_rating"), 3).alias("avg_rating"),
            rounded_mean(F.col("acs"), 1).alias("avg_acs"),
            F.sum("kills").alias("total_kills"),
            F.sum("deaths").alias("total_deaths"),
            safe_ratio(F.sum("kills"), F.sum("deaths")).alias("kd_ratio"),
            rounded_mean(F.col("kast"), 3).alias("avg_kast"),
            rounded_mean(F.col("adr"), 1).alias("avg_adr"),
            rounded_mean(F.col("hs_pct"), 3).alias("avg_hs_pct"),
        )
    )
    return _finish(result, "player_map_performance", ordered)


def agent_meta(stats: DataFrame, map_scores: DataFrame, ordered: bool = True) -> DataFrame:
    """Picks, means and win share per map and agent.

    A pick whose winner is unknown counts as not won, it is not left out.  The
    winner is looked up before the agents are exploded, on fewer rows.
    """
    picks = stats.where(F.col("map_name").isNotNull() & (F.size("agents") > 0)).select(
        "match_id", "game_id", "map_name", "team_id", "r_rating", "acs", "agents"
    )
    winners = map_scores.select("match_id", "game_id", "team1_id", "team1_is_winner", "team2_id", "team2_is_winner")
    judged = picks.join(winners, ["match_id", "game_id"], "left").select(
        "map_name",
        "agents",
        "r_rating",
        "acs",
        pick_side(
            F.col("team_id"), F.col("team1_id"), F.col("team1_is_winner"), F.col("team2_id"), F.col("team2_is_winner")
        ).alias("won"),
    )
    result = (
        explode_values(judged, "agents", "agent")
        .groupBy("map_name", "agent")
        .agg(
            rows().alias("pick_count"),
            rounded_mean(F.col("r_rating"), 3).alias("avg_rating"),
            rounded_mean(F.col("acs"), 1).alias("avg_acs"),
            true_share(F.col("won")).alias("win_rate"),
        )
    )
    return _finish(result, "agent_meta", ordered)


def agent_player_affinity(stats: DataFrame, ordered: bool = True) -> DataFrame:
    """Totals and means per player and agent."""
    result = (
        explode_values(stats.where(F.col("player_id").isNotNull()), "agents", "agent")
        .groupBy("player_id", "player_name", "team_id", "team_short", "agent")
        .agg(
            rows().alias("maps_played"),
            rounded_mean(F.col("r_rating"), 3).alias("avg_rating"),
            rounded_mean(F.col("acs"), 1).alias("avg_acs"),
            F.sum("kills").alias("total_kills"),
            F.sum("deaths").alias("total_deaths"),
            safe_ratio(F.sum("kills"), F.sum("deaths")).alias("kd_ratio"),
        )
    )
    return _finish(result, "agent_player_affinity", ordered)


def series_sides(series: DataFrame) -> DataFrame:
    """One row per team and match; the other side's score is what was lost."""
    return unpivot_sides(
        series,
        ["match_id", "event_id", "event_name", "region"],
        [
            {
                "team_id": F.col(f"{own}_id"),
                "team_name": F.col(f"{own}_name"),
                "maps_won": F.col(f"{own}_score"),
                "maps_lost": F.col(f"{other}_score"),
                "match_won": won_flag(F.col(f"{own}_score"), F.col(f"{other}_score")),
            }
            for own, other in SIDES
        ],
        present="team_id",
    )


def team_standings(series: DataFrame, ordered: bool = True) -> DataFrame:
    """Match and map record per team and event.

    A draw or an unknown score counts as a match lost by both teams.
    """
    result = (
        series_sides(series.where(F.col("event_id").isNotNull()))
        .groupBy("event_id", "event_name", "region", "team_id", "team_name")
        .agg(
            F.count("match_id").alias("matches_played"),
            F.sum("match_won").alias("matches_won"),
            F.sum(1 - F.col("match_won")).alias("matches_lost"),
            safe_ratio(F.sum("match_won"), F.count("match_id")).alias("match_win_rate"),
            F.sum("maps_won").alias("maps_won"),
            F.sum("maps_lost").alias("maps_lost"),
            safe_ratio(F.sum("maps_won"), F.sum("maps_won") + F.sum("maps_lost")).alias("map_win_rate"),
        )
    )
    return _finish(result, "team_standings", ordered)


def map_sides(map_scores: DataFrame) -> DataFrame:
    """One row per team and map, with both sides' round counts; unknown counts are 0."""

    def count(column: str) -> F.Column:
        return F.coalesce(F.col(column), F.lit(0))

    return unpivot_sides(
        map_scores,
        ["map_name"],
        [
            {
                "team_id": F.col(f"{own}_id"),
                "is_winner": F.col(f"{own}_is_winner"),
                "att_rounds_won": count(f"{own}_attacker_rounds"),
                "def_rounds_won": count(f"{own}_defender_rounds"),
                "opp_att_rounds": count(f"{other}_attacker_rounds"),
                "opp_def_rounds": count(f"{other}_defender_rounds"),
            }
            for own, other in SIDES
        ],
        present="team_id",
    )


def team_map_performance(map_scores: DataFrame, teams: DataFrame, ordered: bool = True) -> DataFrame:
    """Win rate and round shares per team and map.

    The attack share is own attack rounds over both teams' attack rounds, and
    likewise for defence.
    """
    won, lost = count_true(F.col("is_winner")), count_false(F.col("is_winner"))
    att, deff = F.sum("att_rounds_won"), F.sum("def_rounds_won")
    per_map = (
        map_sides(map_scores.where(F.col("map_name").isNotNull()))
        .groupBy("team_id", "map_name")
        .agg(
            rows().alias("maps_played"),
            won.alias("maps_won"),
            lost.alias("maps_lost"),
            safe_ratio(won, rows()).alias("map_win_rate"),
            att.alias("total_att_rounds_won"),
            deff.alias("total_def_rounds_won"),
            safe_ratio(att, att + F.sum("opp_att_rounds")).alias("att_round_win_rate"),
            safe_ratio(deff, deff + F.sum("opp_def_rounds")).alias("def_round_win_rate"),
        )
    )
    measures = [c for c in per_map.columns if c not in ("team_id", "map_name")]
    totals = [c for c in measures if c.startswith(("total_", "maps_"))]
    named = _named(per_map, teams, "team_id", "team_name", totals).select("team_id", "team_name", "map_name", *measures)
    return _finish(named, "team_map_performance", ordered)


def match_summary(series: DataFrame, map_scores: DataFrame, ordered: bool = True) -> DataFrame:
    """Result of each match with the number of its maps (0 when it has none)."""
    maps = map_scores.groupBy("match_id").agg(F.countDistinct("game_id").alias("total_maps_played"))
    s1, s2 = F.col("team1_score"), F.col("team2_score")
    result = (
        series.where(F.col("match_id").isNotNull())
        .join(maps, "match_id", "left")
        .select(
            "match_id",
            "event_id",
            "event_name",
            "region",
            "match_date",
            "best_of",
            "patch",
            "team1_id",
            "team1_name",
            s1.alias("team1_maps_won"),
            "team2_id",
            "team2_name",
            s2.alias("team2_maps_won"),
            decide_winner(s1, s2, F.col("team1_id"), F.col("team2_id"), F.lit(None)).alias("winner_id"),
            decide_winner(s1, s2, F.col("team1_name"), F.col("team2_name"), F.lit(DRAW_LABEL)).alias("winner_name"),
            F.coalesce("total_maps_played", F.lit(0)).alias("total_maps_played"),
        )
        .distinct()
    )
    return _finish(result, "match_summary", ordered)


# table -> (builder, silver inputs in argument order)
BUILDERS = {
    "player_performance": (player_performance, ("fact_player_stats", "dim_events")),
    "player_map_performance": (player_map_performance, ("fact_player_stats",)),
    "agent_meta": (agent_meta, ("fact_player_stats", "fact_map_scores")),
    "agent_player_affinity": (agent_player_affinity, ("fact_player_stats",)),
    "team_standings": (team_standings, ("fact_series",)),
    "team_map_performance": (team_map_performance, ("fact_map_scores", "dim_teams")),
    "match_summary": (match_summary, ("fact_series", "fact_map_scores")),
}


def from_views(spark: SparkSession, table: str, ordered: bool = True) -> DataFrame:
    """Build a gold table from the registered ``silver_*`` views."""
    builder, inputs = BUILDERS[table]
    return builder(*[spark.table(view_name(i)) for i in inputs], ordered=ordered)
