"""Bronze records from landed payloads: scope, contracts, keys, quarantine, counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelake.operators.contracts import ERRORS, rejected, tally
from duelake.plans import bronze
from duelake.session import shared_folder
from duelake.sinks.records import last_accepted
from workload import payloads
from workload.registry import last, query
from workload.shapes import Shapes

SCOPE = bronze.Scope(first_year=2023, last_year=2028)


class Backfill:
    """The chain of a backfill over the derived landing tables, lazily."""

    def __init__(self, s: Shapes):
        self.shapes = s
        self.landing = payloads.landing(s)
        # Matches shipped late count as ingested before.
        late = s["lineitem"].where("l_shipdate >= '2001-06-01'")
        existing = late.select(F.col("l_orderkey").cast("string").alias("record_key"))
        self.events = bronze.scoped_events(self.landing.events, SCOPE)
        self.candidates = bronze.candidate_matches(self.landing.matches, self.events)
        self.wanted = bronze.wanted_matches(self.candidates, existing)
        self.series = bronze.usable_series(self.landing.series, self.wanted)
        self.maps = bronze.maps_of(self.landing.series_maps, self.series)

    @property
    def teams(self) -> DataFrame:
        return bronze.team_ids(self.series)

    @property
    def players(self) -> DataFrame:
        return bronze.player_ids(self.maps)

    @property
    def staged_teams(self) -> DataFrame:
        return self.shapes.landed("team_ids", lambda _: self.teams)

    @property
    def staged_players(self) -> DataFrame:
        """The ids written first, as ``jobs.ingest`` does: their files tell how few they are.

        Before a join Spark knows of lazy ids only that they come from large payloads, and shuffles the other side by id.
        """
        return self.shapes.landed("player_ids", lambda _: self.players)


def records(flagged: DataFrame) -> DataFrame:
    return last_accepted(flagged).drop("quarantine_key", "ingested_at")


def envelopes(flagged: DataFrame) -> DataFrame:
    return rejected(flagged, "quarantine_key").select("record_key", F.array_join(ERRORS, "|").alias("problems"))


SCOPED = """
    {landing_events} WHERE (CASE WHEN start_date IS NOT NULL THEN YEAR(start_date) BETWEEN 2023 AND 2028
                                 ELSE regexp_matches(name, '2023|2024|2025|2026|2027|2028') END)
      AND NOT regexp_matches(UPPER(name), 'CHALLENGERS|ASCENSION|GAME CHANGERS|GC|PROMO')
      AND regexp_matches(UPPER(name), 'PACIFIC|EMEA|AMERICAS|CHINA|MASTERS|CHAMPIONS|LOCK//IN')"""
SQL = {
    "hits": f"SELECT * FROM {SCOPED}",
    "stale": """
        SELECT MIN(page) AS stop FROM (
            SELECT page FROM {landing_events} GROUP BY page HAVING bool_and(start_date IS NOT NULL AND YEAR(start_date) < 2023)
        ) WHERE page NOT IN (SELECT page FROM {hits})""",
    "scoped": "SELECT * FROM {hits} WHERE (SELECT stop IS NULL FROM {stale}) OR page < (SELECT stop FROM {stale})",
    "candidates": "SELECT DISTINCT match_id FROM {landing_matches} WHERE LOWER(status) = 'completed' AND event_id IN (SELECT id FROM {scoped})",
    "wanted": """SELECT match_id FROM {candidates} WHERE match_id NOT IN
        (SELECT l_orderkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-06-01')""",
    "usable": "SELECT * FROM {series_head} WHERE NOT one_team AND match_id IN (SELECT match_id FROM {wanted})",
    "maps": "SELECT u.*, match_id AS m, i FROM {usable} u, RANGE(0, 3) t(i) WHERE i < match_id % 4",
    "players": """
        SELECT maps.*, j, CASE WHEN (m + j) % 23 = 0 THEN NULL ELSE (m + 7 * j) % 320 END AS player_id
        FROM {maps} maps, RANGE(0, 4) r(j)""",
    "team_ids": """
        SELECT DISTINCT CAST(id AS BIGINT) AS team_id FROM (SELECT id1 AS id FROM {usable} UNION ALL SELECT id2 FROM {usable})
        WHERE id IS NOT NULL AND id <> '0'""",
    "player_ids": "SELECT DISTINCT player_id FROM {players} WHERE player_id IS NOT NULL AND player_id <> 0",
}


@query(
    "bronze_events",
    """
    SELECT CAST(id AS STRING) AS record_key, id AS event_id, name, status, region, start_date, end_date, prize
    FROM {scoped} WHERE status IS NOT NULL AND TRIM(name) <> ''""",
    **SQL,
)
def events(s: Shapes) -> DataFrame:
    return records(bronze.event_attempts(s["landing_events"], SCOPE))


@query("bronze_event_counts", """
    SELECT COUNT(*) AS events_total, (SELECT COUNT(*) FROM {scoped}) AS events_in_scope,
           COUNT(*) - (SELECT COUNT(*) FROM {scoped}) AS events_skipped
    FROM {landing_events} WHERE (SELECT stop IS NULL FROM {stale}) OR page <= (SELECT stop FROM {stale})""", **SQL)
def event_counts(s: Shapes) -> DataFrame:
    return bronze.event_counts(s["landing_events"], SCOPE)


@query("bronze_series_counts", """
    SELECT 'series_skipped' AS counter, (SELECT COUNT(*) FROM {candidates}) - (SELECT COUNT(*) FROM {wanted}) AS n
    UNION ALL SELECT 'series_missing', (SELECT COUNT(*) FROM {wanted}) - (SELECT COUNT(*) FROM {usable})""", **SQL)
def series_counts(s: Shapes) -> DataFrame:
    chain = Backfill(s)
    counters = bronze.series_counts(chain.candidates, chain.wanted, chain.series)
    parts = [df.agg(F.lit(name).alias("counter"), F.count(F.lit(1)).alias("n")) for name, df in counters.items()]
    return reduce(DataFrame.union, parts)


SERIES_OK = "status_note IS NOT NULL AND name1 IS NOT NULL AND score2 <> 'n/a'"


@query(
    "bronze_series",
    f"""
    SELECT CAST(match_id AS STRING) AS record_key, match_id, event AS event_name, event_phase, status_note, best_of,
           CAST(date AS DATE) AS match_date, patch, name1 AS team1_name, CAST(id1 AS BIGINT) AS team1_id, CAST(score1 AS BIGINT) AS team1_score,
           name2 AS team2_name, CAST(id2 AS BIGINT) AS team2_id, CAST(score2 AS BIGINT) AS team2_score
    FROM {{usable}} WHERE {SERIES_OK}""",
    **SQL,
)
def series(s: Shapes) -> DataFrame:
    kept = records(bronze.series_attempts(Backfill(s).series))
    sides = [F.col(f"team{n}.{f}").alias(f"team{n}_{a}") for n in (1, 2) for a, f in (("name", "name"), ("id", "team_id"), ("score", "series_score"))]
    return kept.select(*[c for c in kept.columns if not c.startswith("team")], *sides)


@query(
    "bronze_series_quarantine",
    f"""
    SELECT CAST(match_id AS STRING) AS record_key, CONCAT_WS('|',
        CASE WHEN status_note IS NULL THEN 'status_note: required' END,
        CASE WHEN name1 IS NULL THEN 'team1.name: required' END,
        CASE WHEN score2 = 'n/a' THEN 'team2.series_score: not a valid int' END) AS problems
    FROM {{usable}} WHERE NOT ({SERIES_OK})""",
    **SQL,
)
def series_quarantine(s: Shapes) -> DataFrame:
    return envelopes(bronze.series_attempts(Backfill(s).series))


ACTIONS = """
    SELECT match_id, 'pick' AS action_type, i AS idx, name1 AS team, 'map_' || CAST((match_id + i) % 7 AS STRING) AS map
    FROM {usable}, RANGE(0, 3) t(i) WHERE i < match_id % 3
    UNION ALL
    SELECT match_id, 'ban', match_id % 3 + i, CASE WHEN (match_id + i) % 5 <> 0 THEN name2 END, 'map_' || CAST((match_id + i) % 7 AS STRING)
    FROM {usable}, RANGE(0, 4) t(i) WHERE i < match_id % 4
    UNION ALL
    SELECT match_id, 'remaining', match_id % 3 + match_id % 4, NULL, CASE WHEN match_id % 6 <> 0 THEN 'decider' END FROM {usable}
    UNION ALL
    SELECT match_id, 'map_action', match_id % 3 + match_id % 4 + 1, 'admin', 'swap' FROM {usable} WHERE match_id % 9 = 0"""
ACTION_KEY = "CAST(match_id AS STRING) || '_' || action_type || '_' || CAST(idx AS STRING)"


@query("action_rows", "SELECT match_id, CAST(idx AS INT) AS action_idx, action_type, team, map FROM {actions}", actions=ACTIONS, **SQL)
def action_rows(s: Shapes) -> DataFrame:
    from duelake.operators.reshape import explode_actions

    return explode_actions(Backfill(s).series, bronze.ACTION_LISTS, ["match_id"])


@query(
    "bronze_map_picks_bans",
    f"SELECT {ACTION_KEY} AS record_key, match_id, action_type, action_type AS action, team, map FROM {{actions}} WHERE map IS NOT NULL AND team IS NOT NULL",
    actions=ACTIONS,
    **SQL,
)
def map_picks_bans(s: Shapes) -> DataFrame:
    return records(bronze.action_attempts(Backfill(s).series))


@query(
    "bronze_map_picks_bans_quarantine",
    f"SELECT {ACTION_KEY} AS record_key, CONCAT_WS('|', CASE WHEN team IS NULL THEN 'team: required' END, "
    f"CASE WHEN map IS NULL THEN 'map: required' END) AS problems FROM {{actions}} WHERE map IS NULL OR team IS NULL",
    actions=ACTIONS,
    **SQL,
)
def map_picks_bans_quarantine(s: Shapes) -> DataFrame:
    return envelopes(bronze.action_attempts(Backfill(s).series))


STAT_OK = "(m + j) % 19 <> 0 AND (m + j) % 27 <> 0 AND (m + j) % 40 <> 0 AND (m + j) % 33 <> 0"
PLAYER_NAME = "'player_' || CAST((m + 7 * j) % 320 AS STRING)"
GAME_ID = "CASE WHEN (m + i) % 13 = 0 THEN 'TBD' ELSE CAST(m * 10 + i AS STRING) END"


@query(
    "explode_maps_players",
    f"""
    SELECT match_id, CAST(i AS INT) AS map_index, {GAME_ID} AS game_id, 'map_' || CAST(i AS STRING) AS map_name,
           CAST(j AS INT) AS player_pos, player_id FROM {{players}}""",
    **SQL,
)
def explode_maps_players(s: Shapes) -> DataFrame:
    rows = bronze.player_rows(Backfill(s).maps)
    return rows.select("match_id", "map_index", "game_id", "map_name", "player_pos", F.col("p.player_id").alias("player_id"))


@query(
    "bronze_player_stats",
    f"""
    SELECT CAST(m AS STRING) || '_' || CAST(i AS STRING) || '_' || {PLAYER_NAME} AS record_key, m AS match_id, i AS map_index,
           {GAME_ID} AS game_id, 'map_' || CAST(i AS STRING) AS map_name, {PLAYER_NAME} AS player_name, player_id,
           CASE WHEN j < 2 THEN 's1' ELSE 's2' END AS team_short, CAST(CASE WHEN j < 2 THEN id1 ELSE id2 END AS BIGINT) AS team_id,
           ['agent_' || CAST((m + j) % 12 AS STRING)] AS agents, CAST((m + j) % 3 AS DOUBLE) AS rating, (m + j) % 400 AS acs,
           (m + j) % 40 - 1 AS kills, (m * 3 + j) % 30 AS deaths, j AS assists, CAST((m + i) % 101 AS DOUBLE) AS kast,
           CAST(NULL AS DOUBLE) AS adr, CAST(NULL AS DOUBLE) AS hs_pct, (m + j) % 5 - 1 AS fk, j AS fd
    FROM {{players}} WHERE {STAT_OK}""",
    ("agents",),
    **SQL,
)
def player_stats(s: Shapes) -> DataFrame:
    return records(bronze.player_stat_attempts(Backfill(s).maps))


@query(
    "bronze_player_stats_quarantine",
    f"""
    SELECT CAST(m AS STRING) || '_' || CAST(i AS STRING) || '_unknown' AS record_key, CONCAT_WS('|',
        CASE WHEN (m + j) % 19 = 0 THEN 'player_name: must not be blank' END,
        CASE WHEN (m + j) % 27 = 0 THEN 'agents: required' END,
        CASE WHEN (m + j) % 40 = 0 THEN 'kills: must not be negative' END,
        CASE WHEN (m + j) % 33 = 0 THEN 'assists: not a valid int' END) AS problems
    FROM {{players}} WHERE NOT ({STAT_OK})""",
    **SQL,
)
def player_stats_quarantine(s: Shapes) -> DataFrame:
    return envelopes(bronze.player_stat_attempts(Backfill(s).maps))


def _side(n: int) -> str:
    return f"""CAST(id{n} AS BIGINT) AS team{n}_id, name{n} AS team{n}_name, 's{n}' AS team{n}_short, (m + {n} * i) % 14 AS team{n}_score,
           (m + {n}) % 13 AS team{n}_attacker_rounds, (m + i) % 13 AS team{n}_defender_rounds, (m + {n}) % 2 = 0 AS team{n}_is_winner"""


@query(
    "bronze_map_scores",
    f"""
    SELECT CAST(m AS STRING) || '_' || CAST(i AS STRING) AS record_key, m AS match_id, i AS map_index,
           'map_' || CAST(i AS STRING) AS map_name, {GAME_ID} AS game_id, {_side(1)}, {_side(2)}
    FROM {{maps}} WHERE (m + i) % 11 <> 0 AND (m + i) % 8 <> 0""",
    **SQL,
)
def map_scores(s: Shapes) -> DataFrame:
    return records(bronze.map_score_attempts(Backfill(s).maps))


ROUNDS = """
    SELECT maps.*, j, CASE WHEN (m + j) % 14 <> 0 THEN j + 1 END AS round_number,
           (m + j) % 21 <> 0 AND (m + j) % 14 <> 0 AS good FROM {maps} maps, RANGE(0, 3) r(j) WHERE j <= m % 3"""


@query(
    "bronze_round_results",
    """
    SELECT CAST(m AS STRING) || '_' || CAST(i AS STRING) || '_' || CAST(round_number AS STRING) AS record_key, m AS match_id, i AS map_index,
           round_number, CASE WHEN j % 2 = 0 THEN 'attack' ELSE 'defence' END AS winner_side, 'elim' AS method, j AS score_team1,
           CAST(0 AS BIGINT) AS score_team2, CAST(id1 AS BIGINT) AS winner_team_id, 's1' AS winner_team_short, name1 AS winner_team_name
    FROM {rounds} WHERE good""",
    rounds=ROUNDS,
    **SQL,
)
def round_results(s: Shapes) -> DataFrame:
    return records(bronze.round_attempts(Backfill(s).maps))


@query(
    "bronze_round_results_quarantine",
    """
    SELECT CAST(m AS STRING) || '_' || CAST(i AS STRING) || '_unknown' AS record_key, COUNT(*) AS rounds
    FROM {rounds} WHERE NOT good GROUP BY 1""",
    rounds=ROUNDS,
    **SQL,
)
def round_results_quarantine(s: Shapes) -> DataFrame:
    return envelopes(bronze.round_attempts(Backfill(s).maps)).groupBy("record_key").agg(F.count("*").alias("rounds"))


@query(
    "bronze_events_quarantine",
    "SELECT CAST(id AS STRING) AS record_key FROM {scoped} WHERE NOT (status IS NOT NULL AND TRIM(name) <> '')",
    **SQL,
)
def events_quarantine(s: Shapes) -> DataFrame:
    return envelopes(bronze.event_attempts(s["landing_events"], SCOPE)).select("record_key")


@query(
    "bronze_map_scores_quarantine",
    """
    SELECT CAST(m AS STRING) || '_' || CAST(i AS STRING) AS record_key FROM {maps}
    WHERE (m + i) % 8 = 0 AND (m + i) % 11 <> 0""",
    **SQL,
)
def map_scores_quarantine(s: Shapes) -> DataFrame:
    return envelopes(bronze.map_score_attempts(Backfill(s).maps)).select("record_key")


@query("explode_maps_rounds", "SELECT COUNT(*) AS attempts, COUNT(*) FILTER (NOT good) AS bad FROM {rounds}", rounds=ROUNDS, **SQL)
def explode_maps_rounds(s: Shapes) -> DataFrame:
    flagged = bronze.round_attempts(Backfill(s).maps)
    return flagged.agg(F.count(F.lit(1)).alias("attempts"), F.count_if(F.size(ERRORS) > 0).alias("bad"))


@query("bronze_team_ids", "SELECT team_id FROM {team_ids}", **SQL)
def team_ids(s: Shapes) -> DataFrame:
    return Backfill(s).teams.select(F.col("team_id").cast("bigint").alias("team_id"))


@query("bronze_player_ids", "SELECT player_id FROM {player_ids}", **SQL)
def player_ids(s: Shapes) -> DataFrame:
    return Backfill(s).players


@query(
    "bronze_event_standings",
    last(
        "{given}",
        "record_key",
        "fetch_seq",
        "record_key, event_id, stage_path, place, CAST(team_id AS BIGINT) AS team_id, team_name, team_country, prize, note",
        "team_id <> 'none'",
    ),
    given="""
        SELECT * REPLACE (COALESCE(place, 'None') AS place),
               CAST(event_id AS STRING) || '_' || REPLACE(REPLACE(COALESCE(place, 'None'), ' ', '_'), '/', '_') AS record_key
        FROM {landing_standings} WHERE event_id IN (SELECT id FROM {scoped})""",
    **SQL,
)
def event_standings(s: Shapes) -> DataFrame:
    return records(bronze.standing_attempts(s["landing_standings"], Backfill(s).events))


@query(
    "bronze_team_info",
    last(
        "{landing_team_info}",
        "team_id",
        "fetch_seq",
        "CAST(team_id AS STRING) AS record_key, team_id, name, tag, logo_url, country, is_active = 'yes' AS is_active",
        "is_active <> 'maybe' AND team_id IN (SELECT team_id FROM {team_ids})",
    ),
    **SQL,
)
def team_info(s: Shapes) -> DataFrame:
    return records(bronze.team_info_attempts(s["landing_team_info"], Backfill(s).staged_teams))


@query(
    "bronze_team_roster",
    """
    SELECT record_key, CAST(ROW_NUMBER() OVER (PARTITION BY record_key ORDER BY i) - 1 AS INT) AS pos, s_suppkey % 61 AS team_id,
           s_suppkey * 2 + i AS player_id, s_name || '_' || CAST(i AS STRING) AS ign, CAST(NULL AS STRING) AS real_name,
           'XX' AS country, 'player' AS role, i = 0 AS is_captain
    FROM {members} JOIN {newest} USING (s_suppkey)""",
    members="""
        SELECT *, CAST(s_suppkey % 61 AS STRING) AS record_key FROM supplier, RANGE(0, 2) t(i)
        WHERE (s_suppkey + i) % 7 <> 0 AND s_suppkey % 9 <> i AND s_suppkey % 61 IN (SELECT team_id FROM {team_ids})""",
    newest="SELECT MAX(s_suppkey) AS s_suppkey FROM {members} GROUP BY record_key",
    **SQL,
)
def team_roster(s: Shapes) -> DataFrame:
    kept = records(bronze.roster_attempts(payloads.roster_payloads(s), Backfill(s).staged_teams))
    return kept.select("record_key", F.posexplode("members").alias("pos", "m")).select("record_key", "pos", "m.*")


@query(
    "bronze_team_placements",
    last(
        "{landing_placements}",
        "team_id, event_id",
        "fetch_seq",
        "CAST(team_id AS STRING) || '_' || event_id AS record_key, team_id, CAST(event_id AS BIGINT) AS event_id, event_name, year, series, place, prize_money",
        "event_id <> 'n/a' AND team_id IN (SELECT team_id FROM {team_ids})",
    ),
    **SQL,
)
def team_placements(s: Shapes) -> DataFrame:
    return records(bronze.placement_attempts(s["landing_placements"], Backfill(s).staged_teams))


@query(
    "bronze_team_transactions",
    last(
        "{landing_transactions}",
        "team_id, player_id, date",
        "fetch_seq",
        "CAST(team_id AS STRING) || '_' || player_id || '_' || COALESCE(date, 'None') AS record_key, team_id, CAST(player_id AS BIGINT) AS player_id, "
        "ign, real_name, country, action, position, CAST(date AS DATE) AS transaction_date",
        "(date IS NULL OR date <> 'soon') AND team_id IN (SELECT team_id FROM {team_ids})",
    ),
    **SQL,
)
def team_transactions(s: Shapes) -> DataFrame:
    return records(bronze.transaction_attempts(s["landing_transactions"], Backfill(s).staged_teams))


@query(
    "bronze_player_profiles",
    last(
        "{landing_profiles}",
        "player_id",
        "fetch_seq",
        "CAST(player_id AS STRING) AS record_key, player_id, handle, real_name, country, avatar_url, aliases",
        "aliases IS NOT NULL AND player_id IN (SELECT player_id FROM {player_ids})",
    ),
    ("aliases",),
    **SQL,
)
def player_profiles(s: Shapes) -> DataFrame:
    return records(bronze.profile_attempts(s["landing_profiles"], Backfill(s).staged_players))


def _as(kind: str, names: str) -> str:
    return ", ".join(f"CAST({n} AS {kind}) AS {n}" for n in names.split())


@query(
    "bronze_player_agent_stats",
    last(
        "{landing_agent_stats}",
        "player_id, agent",
        "fetch_seq",
        "CAST(player_id AS STRING) || '_' || COALESCE(agent, 'None') AS record_key, player_id, agent, "
        + _as("BIGINT", "usage_count rounds_played kills deaths assists first_kills first_deaths")
        + ", "
        + _as("DOUBLE", "usage_percent rating acs kd adr kast"),
        "acs <> 'bad' AND player_id IN (SELECT player_id FROM {player_ids})",
    ),
    **SQL,
)
def player_agent_stats(s: Shapes) -> DataFrame:
    return records(bronze.agent_stat_attempts(s["landing_agent_stats"], Backfill(s).staged_players))


@query(
    "contract_counters",
    f"""
    SELECT 'events' AS record_type, COUNT(*) FILTER (status IS NOT NULL) AS valid, COUNT(*) FILTER (status IS NULL) AS invalid FROM {{scoped}}
    UNION ALL SELECT 'series', COUNT(*) FILTER ({SERIES_OK}), COUNT(*) FILTER (NOT ({SERIES_OK})) FROM {{usable}}
    UNION ALL SELECT 'map_picks_bans', COUNT(map || team), COUNT(*) - COUNT(map || team) FROM {{actions}}
    UNION ALL SELECT 'player_stats', COUNT(*) FILTER ({STAT_OK}), COUNT(*) FILTER (NOT ({STAT_OK})) FROM {{players}}
    UNION ALL SELECT 'map_scores', COUNT(*) FILTER ((m + i) % 8 <> 0), COUNT(*) FILTER ((m + i) % 8 = 0) FROM {{maps}} WHERE (m + i) % 11 <> 0
    UNION ALL SELECT 'round_results', COUNT(*) FILTER (good), COUNT(*) FILTER (NOT good) FROM {{rounds}}""",
    actions=ACTIONS,
    rounds=ROUNDS,
    **SQL,
)
def contract_counters(s: Shapes) -> DataFrame:
    # The chain is built once: what several types are made from is staged, and each type's counts come with its one pass.
    chain = Backfill(s)
    folder = shared_folder(s.spark, "counters")
    chain.series = staged(chain.series, f"{folder}/series")
    chain.maps = staged(bronze.maps_of(chain.landing.series_maps, chain.series), f"{folder}/maps")
    flagged = {
        "events": bronze.scoped_event_attempts(chain.events),
        "series": bronze.series_attempts(chain.series),
        "map_picks_bans": bronze.action_attempts(chain.series),
        "player_stats": bronze.player_stat_attempts(chain.maps),
        "map_scores": bronze.map_score_attempts(chain.maps),
        "round_results": bronze.round_attempts(chain.maps),
    }
    return reduce(DataFrame.union, [tally(df, name) for name, df in flagged.items()])


def staged(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@query(
    "map_round_rows",
    """
    SELECT m AS match_id, i AS map_index, CAST(round_number AS BIGINT) AS round_number,
           CASE WHEN j % 2 = 0 THEN 'attack' ELSE 'defence' END AS winner_side, CAST(id1 AS BIGINT) AS winner_team_id, good
    FROM {rounds}""",
    rounds=ROUNDS,
    **SQL,
)
def map_round_rows(s: Shapes) -> DataFrame:
    flagged = bronze.round_attempts(Backfill(s).maps).withColumn("good", F.size(ERRORS) == 0)
    return flagged.select("match_id", "map_index", "round_number", "winner_side", "winner_team_id", "good")
