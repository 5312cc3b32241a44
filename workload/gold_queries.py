"""Gold tables over gated silver frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelake.operators.joins import attach, resolve_event
from duelake.operators.keys import keep_last
from duelake.plans import gold
from workload.registry import last, mean, query, ratio, total
from workload.shapes import Shapes

GATE_MAPS = ["match_id", "game_id"]
GATE_STATS = ["match_id", "game_id", "player_id"]
# A total order on lineitem rows.
GATE_ORDER = ["l_partkey", "l_suppkey", "l_extendedprice"]
LINES = ", ".join(GATE_ORDER)


def silver_series(s: Shapes) -> DataFrame:
    return resolve_event(s["fx_series"], s["fx_events"])


def silver_maps(s: Shapes) -> DataFrame:
    return keep_last(s["fx_map_scores"], GATE_MAPS, GATE_ORDER)


def silver_stats(s: Shapes) -> DataFrame:
    stats = s["fx_player_stats"].where(F.col("player_id").isNotNull())
    gated = keep_last(stats, GATE_STATS, GATE_ORDER)
    return attach(gated, silver_series(s).select("match_id", "event_id", "region"))


SQL = {
    "series": "SELECT f.*, e.event_id, e.region FROM {fx_series} f LEFT JOIN {fx_events} e ON f.event_name = e.name",
    "maps": last("{fx_map_scores}", "match_id, game_id", LINES),
    "gated": last("{fx_player_stats}", "match_id, game_id, player_id", LINES, where="player_id IS NOT NULL"),
    "stats": "SELECT g.*, s.event_id, s.region FROM {gated} g LEFT JOIN {series} s USING (match_id)",
}


QUERY_SQL = {
    "team_standings": f"""
    SELECT event_id, event_name, region, team_id, team_name, COUNT(match_id) AS matches_played,
           {total('win')} AS matches_won, {total('1 - win')} AS matches_lost, {ratio('SUM(win)', 'COUNT(match_id)')} AS match_win_rate,
           {total('own')} AS maps_won, {total('other')} AS maps_lost, {ratio('SUM(own)', '(SUM(own) + SUM(other))')} AS map_win_rate
    FROM (
        SELECT *, team1_id AS team_id, team1_name AS team_name, team1_score AS own, team2_score AS other,
               CASE WHEN team1_score > team2_score THEN 1 ELSE 0 END AS win FROM {{series}}
        UNION ALL
        SELECT *, team2_id, team2_name, team2_score, team1_score, CASE WHEN team2_score > team1_score THEN 1 ELSE 0 END
        FROM {{series}}
    ) WHERE team_id IS NOT NULL AND event_id IS NOT NULL
    GROUP BY event_id, event_name, region, team_id, team_name"""
}


@query("team_standings", QUERY_SQL["team_standings"], **SQL)
def team_standings(s: Shapes) -> DataFrame:
    return gold.team_standings(silver_series(s))


@query(
    "team_map_performance",
    f"""
    SELECT t.team_id, n.name AS team_name, map_name, COUNT(*) AS maps_played,
           COUNT(*) FILTER (won) AS maps_won, COUNT(*) FILTER (NOT won) AS maps_lost,
           {ratio('COUNT(*) FILTER (won)', 'COUNT(*)')} AS map_win_rate,
           {total('att')} AS total_att_rounds_won, {total('def')} AS total_def_rounds_won,
           {ratio('SUM(att)', '(SUM(att) + SUM(oatt))')} AS att_round_win_rate,
           {ratio('SUM(def)', '(SUM(def) + SUM(odef))')} AS def_round_win_rate
    FROM (
        SELECT map_name, team1_id AS team_id, team1_is_winner AS won,
               COALESCE(team1_attacker_rounds, 0) AS att, COALESCE(team1_defender_rounds, 0) AS def,
               COALESCE(team2_attacker_rounds, 0) AS oatt, COALESCE(team2_defender_rounds, 0) AS odef FROM {{maps}}
        UNION ALL
        SELECT map_name, team2_id, team2_is_winner,
               COALESCE(team2_attacker_rounds, 0), COALESCE(team2_defender_rounds, 0),
               COALESCE(team1_attacker_rounds, 0), COALESCE(team1_defender_rounds, 0) FROM {{maps}}
    ) t LEFT JOIN {{teams}} n ON t.team_id = n.team_id
    WHERE t.team_id IS NOT NULL AND map_name IS NOT NULL
    GROUP BY t.team_id, n.name, map_name""",
    teams="SELECT DISTINCT team2_id AS team_id, team2_name AS name FROM {fx_series} WHERE team2_id <> 7",
    **SQL,
)
def team_map_performance(s: Shapes) -> DataFrame:
    # Team 7 is kept out of the dimension: its name must come out null.
    teams = s["fx_series"].where("team2_id <> 7").selectExpr("team2_id as team_id", "team2_name as name").distinct()
    return gold.team_map_performance(silver_maps(s), teams)


@query(
    "match_summary",
    """
    SELECT s.match_id, event_id, event_name, region, match_date, best_of, patch,
           team1_id, team1_name, team1_score AS team1_maps_won, team2_id, team2_name, team2_score AS team2_maps_won,
           CASE WHEN team1_score > team2_score THEN team1_id WHEN team2_score > team1_score THEN team2_id END AS winner_id,
           CASE WHEN team1_score > team2_score THEN team1_name WHEN team2_score > team1_score THEN team2_name
                ELSE 'Draw' END AS winner_name,
           (SELECT COUNT(DISTINCT m.game_id) FROM {maps} m WHERE m.match_id = s.match_id) AS total_maps_played
    FROM {series} s""",
    **SQL,
)
def match_summary(s: Shapes) -> DataFrame:
    return gold.match_summary(silver_series(s), silver_maps(s))


PERFORMANCE = f"""
    {mean('r_rating', 3)} AS avg_rating, {mean('acs', 1)} AS avg_acs,
    {total('kills')} AS total_kills, {total('deaths')} AS total_deaths, {ratio('SUM(kills)', 'SUM(deaths)')} AS kd_ratio"""
DETAIL = f"{mean('kast', 3)} AS avg_kast, {mean('adr', 1)} AS avg_adr, {mean('hs_pct', 3)} AS avg_hs_pct"


@query(
    "player_performance",
    f"""
    SELECT s.event_id, e.name AS event_name, s.region, player_id, player_name, team_id, team_short,
           COUNT(DISTINCT match_id) AS matches_played, COUNT(DISTINCT game_id) AS maps_played,
           {PERFORMANCE}, {total('assists')} AS total_assists, {DETAIL},
           {total('fk')} AS total_first_kills, {total('fd')} AS total_first_deaths,
           {ratio('SUM(fk)', '(SUM(fk) + SUM(fd))')} AS fk_rate
    FROM {{stats}} s LEFT JOIN {{fx_events}} e ON s.event_id = e.event_id
    WHERE s.event_id IS NOT NULL AND player_id IS NOT NULL
    GROUP BY s.event_id, e.name, s.region, player_id, player_name, team_id, team_short""",
    **SQL,
)
def player_performance(s: Shapes) -> DataFrame:
    return gold.player_performance(silver_stats(s), s["fx_events"])


@query(
    "player_map_performance",
    f"""
    SELECT player_id, player_name, team_id, team_short, map_name, COUNT(DISTINCT game_id) AS maps_played, {PERFORMANCE}, {DETAIL}
    FROM {{gated}} WHERE map_name IS NOT NULL
    GROUP BY player_id, player_name, team_id, team_short, map_name""",
    **SQL,
)
def player_map_performance(s: Shapes) -> DataFrame:
    return gold.player_map_performance(silver_stats(s))


@query(
    "agent_meta",
    f"""
    SELECT map_name, agent, COUNT(*) AS pick_count, {mean('r_rating', 3)} AS avg_rating, {mean('acs', 1)} AS avg_acs,
           CAST(((((200000 * COUNT(*) FILTER (won) + COUNT(*)) // (2 * COUNT(*))) + 50) // 100) / 1000.0 AS DECIMAL(5,3)) AS win_rate
    FROM (
        SELECT p.map_name, p.agent, p.r_rating, p.acs,
               CASE WHEN p.team_id = m.team1_id THEN m.team1_is_winner
                    WHEN p.team_id = m.team2_id THEN m.team2_is_winner END AS won
        FROM (SELECT *, UNNEST(agents) AS agent FROM {{gated}}) p
        LEFT JOIN {{maps}} m ON p.match_id = m.match_id AND p.game_id = m.game_id
    ) WHERE map_name IS NOT NULL AND agent IS NOT NULL
    GROUP BY map_name, agent""",
    **SQL,
)
def agent_meta(s: Shapes) -> DataFrame:
    return gold.agent_meta(silver_stats(s), silver_maps(s))


@query(
    "agent_player_affinity",
    f"""
    SELECT player_id, player_name, team_id, team_short, agent, COUNT(*) AS maps_played, {PERFORMANCE}
    FROM (SELECT *, UNNEST(agents) AS agent FROM {{gated}}) WHERE agent IS NOT NULL
    GROUP BY player_id, player_name, team_id, team_short, agent""",
    **SQL,
)
def agent_player_affinity(s: Shapes) -> DataFrame:
    return gold.agent_player_affinity(silver_stats(s))


@query(
    "unpivot_series",
    """
    SELECT match_id, event_id, event_name, region, team1_id AS team_id, team1_name AS team_name, team1_score AS maps_won,
           team2_score AS maps_lost, CAST(COALESCE(team1_score > team2_score, FALSE) AS INT) AS match_won
    FROM {series} WHERE team1_id IS NOT NULL
    UNION ALL
    SELECT match_id, event_id, event_name, region, team2_id, team2_name, team2_score, team1_score,
           CAST(COALESCE(team2_score > team1_score, FALSE) AS INT)
    FROM {series} WHERE team2_id IS NOT NULL""",
    **SQL,
)
def unpivot_series(s: Shapes) -> DataFrame:
    return gold.series_sides(silver_series(s))


@query(
    "unpivot_map_scores",
    """
    SELECT map_name, team1_id AS team_id, team1_is_winner AS is_winner,
           COALESCE(team1_attacker_rounds, 0) AS att_rounds_won, COALESCE(team1_defender_rounds, 0) AS def_rounds_won,
           COALESCE(team2_attacker_rounds, 0) AS opp_att_rounds, COALESCE(team2_defender_rounds, 0) AS opp_def_rounds
    FROM {fx_map_scores} WHERE team1_id IS NOT NULL
    UNION ALL
    SELECT map_name, team2_id, team2_is_winner, COALESCE(team2_attacker_rounds, 0), COALESCE(team2_defender_rounds, 0),
           COALESCE(team1_attacker_rounds, 0), COALESCE(team1_defender_rounds, 0)
    FROM {fx_map_scores} WHERE team2_id IS NOT NULL""",
)
def unpivot_map_scores(s: Shapes) -> DataFrame:
    return gold.map_sides(s["fx_map_scores"])
