"""Silver tables from raw frames: casts, event context, key gate, violations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelake.operators.joins import attach, resolve_event
from duelake.plans import silver
from duelake.record_types import raw_schema
from duelake.sources.landed import parse_documents
from workload.payloads import raw_series
from workload.registry import last, query
from workload.shapes import Shapes

ORDER = "_key, _pos"


def tries(kind: str, names: str) -> str:
    return ", ".join(f"TRY_CAST({n} AS {kind}) AS {n}" for n in names.split())


# ---- tables without event context -------------------------------------------

TYPED = {
    "dim_events": (
        "raw_events",
        "event_id",
        "CAST(event_id AS BIGINT) AS event_id, name, status, region, CAST(start_date AS DATE) AS start_date, "
        "CAST(end_date AS DATE) AS end_date, prize",
    ),
    "dim_teams": (
        "raw_team_info",
        "team_id",
        "CAST(team_id AS BIGINT) AS team_id, name, tag, logo_url, country, CAST(is_active AS BOOLEAN) AS is_active",
    ),
    "dim_players": (
        "raw_player_profiles",
        "player_id",
        "CAST(player_id AS BIGINT) AS player_id, handle, real_name, country, avatar_url, aliases",
    ),
    "fact_player_agent_stats": (
        "raw_player_agent_stats",
        "player_id, agent",
        "CAST(player_id AS BIGINT) AS player_id, agent, "
        + tries("INT", "usage_count rounds_played kills deaths assists first_kills first_deaths")
        + ", TRY_CAST(rating AS FLOAT) AS r_rating, "
        + tries("FLOAT", "usage_percent acs kd adr kast"),
    ),
    "fact_event_standings": (
        "raw_event_standings",
        "event_id, stage_path, place",
        "CAST(event_id AS BIGINT) AS event_id, stage_path, place, TRY_CAST(team_id AS BIGINT) AS team_id, "
        "team_name, team_country, prize, note",
    ),
    "fact_team_placements": (
        "raw_team_placements",
        "team_id, event_id",
        "CAST(team_id AS BIGINT) AS team_id, TRY_CAST(event_id AS BIGINT) AS event_id, event_name, year, series, place, prize_money",
    ),
    "fact_team_transactions": (
        "raw_team_transactions",
        "team_id, player_id, transaction_date",
        "CAST(team_id AS BIGINT) AS team_id, TRY_CAST(player_id AS BIGINT) AS player_id, ign, real_name, country, action, "
        "position, TRY_CAST(transaction_date AS DATE) AS transaction_date",
    ),
}


def _null_key(keys: str) -> str:
    return " OR ".join(f"{k.strip()} IS NULL" for k in keys.split(","))


def _register_plain(table: str, source: str, keys: str, columns: str) -> None:
    typed = f"SELECT {columns}, _key, _pos FROM {{{source}}}"
    names = "* EXCLUDE (_key, _pos)"
    lists = ("aliases",) if table == "dim_players" else ()

    @query(f"silver_{table}", last("{typed}", keys, ORDER, names, f"NOT ({_null_key(keys)})"), lists, typed=typed)
    def clean(s: Shapes) -> DataFrame:
        return silver.dimension(s[source], table).clean

    @query(f"silver_{table}_violations", f"SELECT {names} FROM {{typed}} WHERE {_null_key(keys)}", lists, typed=typed)
    def violations(s: Shapes) -> DataFrame:
        return silver.dimension(s[source], table).violations


for _table, (_source, _keys, _columns) in TYPED.items():
    _register_plain(_table, _source, _keys, _columns)


ROSTER_SQL = {
    "typed": """
        SELECT CAST(team_id AS BIGINT) AS team_id, TRY_CAST(CASE WHEN i = 0 THEN player1 ELSE player2 END AS BIGINT) AS player_id,
               ign || '_' || CAST(i AS STRING) AS ign, CAST(NULL AS STRING) AS real_name, CAST(NULL AS STRING) AS country,
               'player' AS role, i = 0 AS is_captain, _key, i AS _pos
        FROM {raw_roster_members}, RANGE(0, 2) t(i)"""
}


def roster(s: Shapes) -> DataFrame:
    """Roster documents, each an array of two members, parsed to raw rows."""
    member = (
        "to_json(named_struct('team_id', team_id, 'player_id', player{n}, 'ign', concat(ign, '_{i}'), 'role', 'player', 'is_captain', {c}))"
    )
    first, second = member.format(n=1, i=0, c="true"), member.format(n=2, i=1, c="false")
    documents = s["raw_roster_members"].selectExpr("_key", f"concat('[', {first}, ',', {second}, ']') as value")
    return parse_documents(documents, raw_schema("team_roster"), keep=["_key"])


@query("silver_dim_team_roster", last("{typed}", "team_id, player_id", ORDER, "* EXCLUDE (_key, _pos)", "player_id IS NOT NULL"), **ROSTER_SQL)
def dim_team_roster(s: Shapes) -> DataFrame:
    return silver.dim_team_roster(roster(s)).clean


@query("silver_dim_team_roster_violations", "SELECT * EXCLUDE (_key, _pos) FROM {typed} WHERE player_id IS NULL", **ROSTER_SQL)
def dim_team_roster_violations(s: Shapes) -> DataFrame:
    return silver.dim_team_roster(roster(s)).violations


# ---- series and the facts of a match -----------------------------------------

SERIES_SQL = {
    "typed_series": """
        SELECT CAST(match_id AS BIGINT) AS match_id, event_name, event_phase, status_note, best_of,
               CAST(match_date AS DATE) AS match_date, patch, team1_name, CAST(team1_id AS BIGINT) AS team1_id,
               CAST(team1_score AS INT) AS team1_score,
               CASE WHEN NOT no_team2 THEN team2_name END AS team2_name,
               CASE WHEN NOT no_team2 THEN CAST(team2_id AS BIGINT) END AS team2_id,
               CASE WHEN NOT no_team2 THEN CAST(team2_score AS INT) END AS team2_score, _key, _pos
        FROM {raw_series}""",
    "with_event": """
        SELECT s.*, e.event_id, e.region, CONCAT(CAST(e.event_id AS STRING), '.json') AS _ev
        FROM {typed_series} s LEFT JOIN {raw_named_events} e ON s.event_name = e.name""",
    "lookup": "SELECT match_id, event_id, region, _key, _pos, _ev FROM {with_event}",
    "clean_series": last("{with_event}", "match_id", "_key, _pos, _ev", where="match_id IS NOT NULL"),
}
HIDE = "EXCLUDE (_key, _pos, _ev)"


def series_split(s: Shapes) -> silver.SeriesSplit:
    return silver.fact_series(raw_series(s), s["raw_named_events"])


@query("silver_fact_series", f"SELECT * {HIDE} FROM {{clean_series}}", **SERIES_SQL)
def fact_series(s: Shapes) -> DataFrame:
    return series_split(s).clean


@query("silver_fact_series_violations", f"SELECT * {HIDE} FROM {{with_event}} WHERE match_id IS NULL", **SERIES_SQL)
def fact_series_violations(s: Shapes) -> DataFrame:
    return series_split(s).violations


@query("series_event_lookup", "SELECT match_id, event_id, region FROM {lookup}", **SERIES_SQL)
def series_event_lookup(s: Shapes) -> DataFrame:
    return series_split(s).lookup.select("match_id", "event_id", "region")


MATCH_TYPED = {
    "fact_player_stats": (
        "raw_player_stats",
        "match_id, game_id, player_id",
        "CAST(match_id AS BIGINT) AS match_id, CAST(map_index AS INT) AS map_index, map_name, player_name, team_short, agents, "
        + tries("BIGINT", "game_id player_id team_id")
        + ", "
        + tries("INT", "acs kills deaths assists fk fd")
        + ", TRY_CAST(rating AS FLOAT) AS r_rating, "
        + tries("FLOAT", "kast adr hs_pct"),
    ),
    "fact_map_scores": (
        "raw_map_scores",
        "match_id, game_id",
        "CAST(match_id AS BIGINT) AS match_id, CAST(map_index AS INT) AS map_index, map_name, "
        "team1_name, team1_short, team2_name, team2_short, "
        + tries("BIGINT", "game_id team1_id team2_id")
        + ", "
        + tries(
            "INT",
            "team1_score team2_score team1_attacker_rounds team1_defender_rounds team2_attacker_rounds team2_defender_rounds",
        )
        + ", "
        + tries("BOOLEAN", "team1_is_winner team2_is_winner"),
    ),
    "fact_round_results": (
        "raw_round_results",
        "match_id, map_index, round_number",
        "CAST(match_id AS BIGINT) AS match_id, CAST(map_index AS INT) AS map_index, CAST(round_number AS INT) AS round_number, "
        "winner_side, method, winner_team_short, winner_team_name, TRY_CAST(winner_team_id AS BIGINT) AS winner_team_id, "
        + tries("INT", "score_team1 score_team2"),
    ),
    "fact_map_picks_bans": (
        "raw_map_picks_bans",
        "match_id, action_type, map, team",
        "CAST(match_id AS BIGINT) AS match_id, action_type, action, team, map",
    ),
}


def _register_fact(table: str, source: str, keys: str, columns: str) -> None:
    parts = {
        **SERIES_SQL,
        "typed": f"SELECT {columns}, _key AS _k, _pos AS _p FROM {{{source}}}",
        # Gate after the join, as the semantics are stated; the plan gates before it.
        "joined": "SELECT t.*, l.event_id, l.region, l._key, l._pos, l._ev FROM {typed} t LEFT JOIN {lookup} l USING (match_id)",
    }
    hide = "* EXCLUDE (_k, _p, _key, _pos, _ev)"
    broken = _null_key(keys)
    lists = ("agents",) if table == "fact_player_stats" else ()

    @query(
        f"silver_{table}",
        last("{joined}", keys, "_k, _p, _key, _pos, _ev", hide, f"NOT ({broken})"),
        lists,
        **parts,
    )
    def clean(s: Shapes) -> DataFrame:
        return silver.match_fact(s[source], table, series_split(s).lookup).clean

    @query(f"silver_{table}_violations", f"SELECT {hide} FROM {{joined}} WHERE {broken}", lists, **parts)
    def violations(s: Shapes) -> DataFrame:
        return silver.match_fact(s[source], table, series_split(s).lookup).violations


for _table, (_source, _keys, _columns) in MATCH_TYPED.items():
    _register_fact(_table, _source, _keys, _columns)


# ---- legacy -------------------------------------------------------------------

LEGACY_SQL = {
    "typed_series": SERIES_SQL["typed_series"],
    "dated_events": "SELECT *, CAST('2025-01-01' AS DATE) AS start_date FROM {raw_named_events}",
    "wide_series": """
        SELECT s.*, e.event_id, e.region, e.start_date, CONCAT(CAST(e.event_id AS STRING), '.json') AS _ev
        FROM {typed_series} s LEFT JOIN {dated_events} e ON s.event_name = e.name""",
    "typed": f"SELECT {MATCH_TYPED['fact_player_stats'][2]}, _key AS _k, _pos AS _p FROM {{raw_player_stats}}",
    "joined": """
        SELECT t.*, w.event_id, w.event_name, w.region, w.start_date, w.match_date, w.team1_name, w.team2_name, w._key, w._pos, w._ev
        FROM {typed} t LEFT JOIN {wide_series} w USING (match_id)""",
}
WIDE = ", ".join(silver.WIDE_COLUMNS)


def legacy(s: Shapes) -> silver.WideSplit:
    events = s["raw_named_events"].withColumn("start_date", F.lit("2025-01-01").cast("date"))
    return silver.legacy_enriched(
        silver.legacy_player_stats(s["raw_player_stats"]), silver.legacy_series(raw_series(s)), events
    )


@query(
    "enrich_wide",
    last("{joined}", "match_id, game_id, player_id", "_k, _p, _key, _pos, _ev", WIDE, "NOT (match_id IS NULL OR game_id IS NULL OR player_id IS NULL)"),
    ("agents",),
    **LEGACY_SQL,
)
def enrich_wide(s: Shapes) -> DataFrame:
    return legacy(s).clean


@query(
    "enrich_wide_violations",
    f"SELECT {WIDE} FROM {{joined}} WHERE match_id IS NULL OR game_id IS NULL OR player_id IS NULL",
    ("agents",),
    **LEGACY_SQL,
)
def enrich_wide_violations(s: Shapes) -> DataFrame:
    return legacy(s).violations


@query("legacy_series_with_event", "SELECT * EXCLUDE (_key, _pos, _ev) FROM {wide_series}", **LEGACY_SQL)
def legacy_series_with_event(s: Shapes) -> DataFrame:
    return legacy(s).series


@query("legacy_events", f"SELECT {TYPED['dim_events'][2]} FROM {{raw_events}}")
def legacy_events(s: Shapes) -> DataFrame:
    return silver.legacy_events(s["raw_events"]).drop("_key", "_pos")


@query("legacy_player_stats", f"SELECT {MATCH_TYPED['fact_player_stats'][2]} FROM {{raw_player_stats}}", ("agents",))
def legacy_player_stats(s: Shapes) -> DataFrame:
    return silver.legacy_player_stats(s["raw_player_stats"]).drop("_key", "_pos")


# ---- the joins on their own ---------------------------------------------------


@query(
    "resolve_event_fk",
    "SELECT s.*, e.event_id, e.region FROM {fx_series} s LEFT JOIN {fx_events} e ON s.event_name = e.name",
)
def resolve_event_fk(s: Shapes) -> DataFrame:
    return resolve_event(s["fx_series"], s["fx_events"])


@query(
    "enrich_with_event",
    """
    SELECT m.match_id, m.game_id, m.map_name, e.event_id, e.region
    FROM {fx_map_scores} m LEFT JOIN {fx_series} s ON m.match_id = s.match_id LEFT JOIN {fx_events} e ON s.event_name = e.name""",
)
def enrich_with_event(s: Shapes) -> DataFrame:
    lookup = resolve_event(s["fx_series"], s["fx_events"]).select("match_id", "event_id", "region")
    return attach(s["fx_map_scores"].select("match_id", "game_id", "map_name"), lookup)
