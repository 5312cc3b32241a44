"""The given tables projected onto the shapes the operators read.

Every shape is one SELECT that Spark and DuckDB read the same way.  They hold
draws, null scores and ids, unknown events, duplicate and incomplete keys, and
text that does not cast.  ``{name}`` is another shape or a given table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from duelake.session import PARQUET_CODEC, shared_folder

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# A total order on lineitem rows, usable as an object key.
LINE_KEY = (
    "CONCAT(LPAD(CAST(l_partkey AS STRING), 10, '0'), '_', LPAD(CAST(l_suppkey AS STRING), 8, '0'), '_', "
    "LPAD(CAST(CAST(FLOOR(l_extendedprice * 100 + 0.5) AS BIGINT) AS STRING), 12, '0'), '.json')"
)


def key_of(column: str, width: int = 12) -> str:
    return f"CONCAT(LPAD(CAST({column} AS STRING), {width}, '0'), '.json')"


SHAPES = {
    "fx_events": """
        SELECT CAST(n_nationkey AS BIGINT) AS event_id, n_name AS name, r_name AS region
        FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "fx_series": """
        SELECT o_orderkey AS match_id,
               CASE WHEN o_orderkey % 89 = 0 THEN 'unknown' ELSE n_name END AS event_name,
               CAST(o_orderdate AS DATE) AS match_date, o_orderpriority AS best_of, o_orderstatus AS patch,
               CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_custkey % 61 END AS team1_id,
               CONCAT('team_', CAST(o_custkey % 61 AS STRING)) AS team1_name,
               CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE CAST(o_orderkey % 4 AS INT) END AS team1_score,
               (o_custkey % 61 + 1 + o_orderkey % 59) % 61 AS team2_id,
               CONCAT('team_', CAST((o_custkey % 61 + 1 + o_orderkey % 59) % 61 AS STRING)) AS team2_name,
               CAST(o_custkey % 4 AS INT) AS team2_score
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey""",
    "fx_map_scores": f"""
        SELECT l_orderkey AS match_id, l_orderkey * 10 + l_linenumber AS game_id,
               CAST(l_linenumber - 1 AS INT) AS map_index, CONCAT(l_returnflag, l_linestatus) AS map_name,
               s.team1_id, s.team2_id,
               CASE WHEN l_linenumber = 5 THEN NULL ELSE l_partkey % 2 = 0 END AS team1_is_winner,
               CASE WHEN l_linenumber = 5 THEN NULL ELSE l_partkey % 2 = 1 END AS team2_is_winner,
               CASE WHEN l_suppkey % 17 = 0 THEN NULL ELSE CAST(l_suppkey % 13 AS INT) END AS team1_attacker_rounds,
               CAST(l_partkey % 13 AS INT) AS team1_defender_rounds,
               CAST(l_partkey % 11 AS INT) AS team2_attacker_rounds,
               CAST(l_suppkey % 11 AS INT) AS team2_defender_rounds,
               l_partkey, l_suppkey, l_extendedprice, l_quantity, l_linenumber,
               CAST(l_shipdate AS DATE) AS ship_day, {LINE_KEY} AS line_key
        FROM {{lineitem}} JOIN {{fx_series}} s ON l_orderkey = s.match_id""",
    "fx_player_stats": """
        SELECT m.match_id, m.game_id, m.map_index, m.map_name,
               CASE WHEN p_partkey % 211 = 0 THEN NULL ELSE p_partkey % 320 END AS player_id,
               CONCAT('player_', CAST(p_partkey % 320 AS STRING)) AS player_name,
               CASE WHEN p_partkey % 3 = 0 THEN m.team1_id WHEN p_partkey % 3 = 1 THEN m.team2_id ELSE NULL END AS team_id,
               CASE WHEN p_partkey % 3 = 0 THEN 'home' WHEN p_partkey % 3 = 1 THEN 'away' ELSE NULL END AS team_short,
               CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE SPLIT(p_name, ' ') END AS agents,
               CAST(m.l_suppkey % 200 AS FLOAT) AS r_rating, CAST(p_partkey % 400 AS INT) AS acs,
               CAST(FLOOR(m.l_quantity) AS INT) AS kills, CAST(m.l_suppkey % 25 AS INT) AS deaths,
               CAST(p_partkey % 12 AS INT) AS assists, CAST(m.l_suppkey % 6 AS INT) AS fk, CAST(p_partkey % 5 AS INT) AS fd,
               CAST(m.l_suppkey % 101 AS FLOAT) AS kast, CAST(p_partkey % 250 AS FLOAT) AS adr,
               CASE WHEN m.l_suppkey % 19 = 0 THEN NULL ELSE CAST(p_partkey % 60 AS FLOAT) END AS hs_pct,
               m.l_partkey, m.l_suppkey, m.l_extendedprice, m.line_key
        FROM {fx_map_scores} m JOIN {part} ON m.l_partkey = p_partkey""",
    # ---- raw silver inputs: text scalars, origin columns, ingestion stamp ----
    "raw_events": f"""
        SELECT CASE WHEN c_custkey % 53 = 0 THEN NULL ELSE CAST(c_custkey % 400 AS STRING) END AS event_id,
               c_name AS name, 'completed' AS status, c_mktsegment AS region,
               CONCAT(CAST(2020 + c_custkey % 6 AS STRING), '-0', CAST(1 + c_custkey % 9 AS STRING), '-15') AS start_date,
               CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE '2025-12-31' END AS end_date,
               CAST(c_nationkey AS STRING) AS prize,
               '2025-01-01T00:00:00' AS ingested_at, {key_of('c_custkey')} AS _key, 0 AS _pos
        FROM {{customer}}""",
    "raw_team_info": f"""
        SELECT CASE WHEN s_suppkey % 37 = 0 THEN NULL ELSE CAST(s_suppkey % 61 AS STRING) END AS team_id, s_name AS name, CONCAT('T', CAST(s_nationkey AS STRING)) AS tag,
               CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE CONCAT('logo/', s_name) END AS logo_url,
               CAST(s_nationkey AS STRING) AS country,
               CASE WHEN s_acctbal > 0 THEN 'true' ELSE 'false' END AS is_active,
               '2025-01-01T00:00:00' AS ingested_at, {key_of('s_suppkey')} AS _key, 0 AS _pos
        FROM {{supplier}}""",
    "raw_roster_members": f"""
        SELECT c_custkey, CAST(c_custkey % 61 AS STRING) AS team_id,
               CASE WHEN c_custkey % 9 = 0 THEN 'coach' ELSE CAST(c_custkey * 2 % 122 AS STRING) END AS player1,
               CAST((c_custkey * 2 + 1) % 122 AS STRING) AS player2, c_name AS ign, {key_of('c_custkey')} AS _key
        FROM {{customer}}""",
    "raw_player_profiles": f"""
        SELECT CASE WHEN p_partkey % 173 = 0 THEN NULL ELSE CAST(p_partkey % 1500 AS STRING) END AS player_id, p_name AS handle, p_brand AS real_name, p_type AS country,
               CASE WHEN p_size > 25 THEN NULL ELSE CONCAT('img/', p_brand) END AS avatar_url,
               SPLIT(p_name, ' ') AS aliases,
               '2025-01-01T00:00:00' AS ingested_at, {key_of('p_partkey')} AS _key, 0 AS _pos
        FROM {{part}}""",
    "raw_series": f"""
        SELECT CASE WHEN o_orderkey % 67 = 0 THEN NULL ELSE CAST(o_orderkey % 12000 AS STRING) END AS match_id,
               f.event_name, f.best_of AS event_phase, f.patch AS status_note, f.best_of,
               CAST(f.match_date AS STRING) AS match_date, f.patch,
               f.team1_name, CAST(f.team1_id AS STRING) AS team1_id, CAST(f.team1_score AS STRING) AS team1_score,
               f.team2_name, CAST(f.team2_id AS STRING) AS team2_id, CAST(f.team2_score AS STRING) AS team2_score,
               o_orderkey % 71 = 0 AS no_team2,
               '2025-01-01T00:00:00' AS ingested_at, {key_of('o_orderkey')} AS _key, 0 AS _pos
        FROM {{fx_series}} f JOIN {{orders}} ON f.match_id = o_orderkey""",
    # Events of the raw series: names 1 and 2 occur twice, so series of them fan out.
    "raw_named_events": """
        SELECT CAST(event_id AS BIGINT) AS event_id, name, region FROM {fx_events}
        UNION ALL
        SELECT CAST(event_id + 100 AS BIGINT) AS event_id, name, CONCAT(region, '_late') AS region
        FROM {fx_events} WHERE name = 'NATION_1' OR name = 'NATION_2'""",
    "raw_player_stats": """
        SELECT CAST(match_id % 12000 AS STRING) AS match_id, CAST(map_index AS STRING) AS map_index,
               CASE WHEN map_index = 6 AND match_id % 7 = 0 THEN 'TBD' ELSE CAST(game_id AS STRING) END AS game_id,
               map_name, player_name, CAST(player_id AS STRING) AS player_id, team_short,
               CAST(team_id AS STRING) AS team_id, agents, CAST(CAST(r_rating AS INT) AS STRING) AS rating,
               CAST(acs AS STRING) AS acs, CASE WHEN kills = 13 THEN 'x' ELSE CAST(kills AS STRING) END AS kills,
               CAST(deaths AS STRING) AS deaths, CAST(assists AS STRING) AS assists,
               CAST(CAST(kast AS INT) AS STRING) AS kast, CAST(CAST(adr AS INT) AS STRING) AS adr,
               CAST(CAST(hs_pct AS INT) AS STRING) AS hs_pct, CAST(fk AS STRING) AS fk, CAST(fd AS STRING) AS fd,
               '2025-01-01T00:00:00' AS ingested_at, line_key AS _key, map_index AS _pos
        FROM {fx_player_stats}""",
    "raw_map_scores": """
        SELECT CAST(match_id % 12000 AS STRING) AS match_id, CAST(map_index AS STRING) AS map_index, map_name,
               CASE WHEN map_index = 6 AND match_id % 7 = 0 THEN 'TBD' ELSE CAST(game_id AS STRING) END AS game_id,
               CAST(team1_id AS STRING) AS team1_id, 'n' || CAST(team1_id AS STRING) AS team1_name, 'a' AS team1_short,
               CAST(l_suppkey % 14 AS STRING) AS team1_score,
               CAST(team1_attacker_rounds AS STRING) AS team1_attacker_rounds,
               CAST(team1_defender_rounds AS STRING) AS team1_defender_rounds,
               CASE WHEN team1_is_winner THEN 'true' WHEN NOT team1_is_winner THEN 'false' ELSE NULL END AS team1_is_winner,
               CAST(team2_id AS STRING) AS team2_id, 'n' || CAST(team2_id AS STRING) AS team2_name, 'b' AS team2_short,
               CASE WHEN l_partkey % 50 = 0 THEN 'n/a' ELSE CAST(l_partkey % 14 AS STRING) END AS team2_score,
               CAST(team2_attacker_rounds AS STRING) AS team2_attacker_rounds,
               CAST(team2_defender_rounds AS STRING) AS team2_defender_rounds,
               CASE WHEN team2_is_winner THEN 'true' WHEN NOT team2_is_winner THEN 'false' ELSE NULL END AS team2_is_winner,
               '2025-01-01T00:00:00' AS ingested_at, line_key AS _key, map_index AS _pos
        FROM {fx_map_scores}""",
    "raw_round_results": """
        SELECT CAST(match_id % 12000 AS STRING) AS match_id, CAST(map_index AS STRING) AS map_index,
               CASE WHEN l_suppkey % 83 = 0 THEN NULL ELSE CAST(1 + l_partkey % 3 AS STRING) END AS round_number,
               CASE WHEN l_partkey % 2 = 0 THEN 'attack' ELSE 'defence' END AS winner_side, map_name AS method,
               CAST(l_partkey % 13 AS STRING) AS score_team1, CAST(l_suppkey % 13 AS STRING) AS score_team2,
               CASE WHEN l_partkey % 31 = 0 THEN '?' ELSE CAST(team1_id AS STRING) END AS winner_team_id,
               'a' AS winner_team_short, 'n' || CAST(team1_id AS STRING) AS winner_team_name,
               '2025-01-01T00:00:00' AS ingested_at, line_key AS _key, map_index AS _pos
        FROM {fx_map_scores}""",
    "raw_map_picks_bans": """
        SELECT CAST(match_id % 12000 AS STRING) AS match_id,
               CASE WHEN l_linenumber % 2 = 0 THEN 'pick' ELSE 'ban' END AS action_type,
               CASE WHEN l_linenumber % 2 = 0 THEN 'pick' ELSE 'ban' END AS action,
               CASE WHEN l_partkey % 41 = 0 THEN NULL ELSE CONCAT('n', CAST(l_suppkey % 3 AS STRING)) END AS team,
               map_name AS map,
               '2025-01-01T00:00:00' AS ingested_at, line_key AS _key, map_index AS _pos
        FROM {fx_map_scores}""",
    "raw_player_agent_stats": f"""
        SELECT CAST(l_partkey % 320 AS STRING) AS player_id,
               CASE WHEN l_suppkey % 37 = 0 THEN NULL ELSE p_brand END AS agent,
               CAST(l_linenumber AS STRING) AS usage_count, CAST(l_suppkey % 100 AS STRING) AS usage_percent,
               CAST(l_orderkey % 300 AS STRING) AS rounds_played, CAST(l_suppkey % 3 AS STRING) AS rating,
               CASE WHEN l_partkey % 9 = 0 THEN '' ELSE CAST(l_partkey % 400 AS STRING) END AS acs,
               CAST(l_suppkey % 2 AS STRING) AS kd, CAST(l_partkey % 200 AS STRING) AS adr, CAST(l_suppkey % 101 AS STRING) AS kast,
               CAST(CAST(FLOOR(l_quantity) AS INT) AS STRING) AS kills, CAST(l_suppkey % 25 AS STRING) AS deaths,
               CAST(l_partkey % 12 AS STRING) AS assists, CAST(l_suppkey % 6 AS STRING) AS first_kills,
               CAST(l_partkey % 5 AS STRING) AS first_deaths,
               '2025-01-01T00:00:00' AS ingested_at,
               CONCAT(LPAD(CAST(l_orderkey AS STRING), 12, '0'), {LINE_KEY}) AS _key, l_linenumber AS _pos
        FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey""",
    "raw_event_standings": f"""
        SELECT CAST(o_custkey % 500 AS STRING) AS event_id, o_orderpriority AS stage_path,
               CASE WHEN o_orderkey % 73 = 0 THEN NULL ELSE o_orderstatus END AS place,
               CASE WHEN o_orderkey % 3 = 0 THEN 'none' ELSE CAST(o_orderkey % 61 AS STRING) END AS team_id,
               CONCAT('team_', CAST(o_orderkey % 61 AS STRING)) AS team_name, 'XX' AS team_country,
               CAST(o_orderkey AS STRING) AS prize, CAST(NULL AS STRING) AS note,
               '2025-01-01T00:00:00' AS ingested_at, {key_of('o_orderkey')} AS _key, 0 AS _pos
        FROM {{orders}}""",
    "raw_team_placements": f"""
        SELECT CAST(o_custkey % 61 AS STRING) AS team_id,
               CASE WHEN o_orderkey % 11 = 0 THEN 'n/a' ELSE CAST(o_orderkey % 25 AS STRING) END AS event_id,
               o_orderpriority AS event_name, CAST(2020 + o_orderkey % 6 AS STRING) AS year, o_orderstatus AS series,
               '1st' AS place, CAST(o_orderkey AS STRING) AS prize_money,
               '2025-01-01T00:00:00' AS ingested_at, {key_of('o_orderkey')} AS _key, 0 AS _pos
        FROM {{orders}}""",
    "raw_team_transactions": f"""
        SELECT CAST(o_custkey % 61 AS STRING) AS team_id, CAST(o_custkey AS STRING) AS player_id,
               CONCAT('ign_', CAST(o_custkey AS STRING)) AS ign, CAST(NULL AS STRING) AS real_name, 'XX' AS country,
               o_orderstatus AS action, o_orderpriority AS position,
               CASE WHEN o_orderkey % 19 = 0 THEN 'soon' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS transaction_date,
               '2025-01-01T00:00:00' AS ingested_at, {key_of('o_orderkey')} AS _key, 0 AS _pos
        FROM {{orders}}""",
    # ---- landed payloads -----------------------------------------------------
    "landing_events": """
        SELECT CAST(1 + c_custkey % 7 AS INT) AS page, c_custkey AS id,
               CONCAT(CASE c_mktsegment WHEN 'MACHINERY' THEN 'Masters ' WHEN 'AUTOMOBILE' THEN 'emea stage '
                        WHEN 'BUILDING' THEN 'Pacific Promo ' WHEN 'FURNITURE' THEN 'China Ascension ' ELSE 'Open ' END,
                      CAST(2028 - c_custkey % 7 AS STRING)) AS name,
               CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE 'completed' END AS status, c_mktsegment AS region,
               CASE WHEN c_custkey % 7 < 4 AND c_custkey % 10 = 3 THEN NULL
                    ELSE CAST(CONCAT(CAST(2028 - c_custkey % 7 AS STRING), '-03-01') AS DATE) END AS start_date,
               CAST(NULL AS DATE) AS end_date, CAST(c_nationkey AS STRING) AS prize, c_custkey AS fetch_seq
        FROM {customer}""",
    "landing_matches": """
        SELECT o_custkey AS event_id, o_orderkey AS match_id,
               CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'completed' ELSE 'live' END AS status
        FROM {orders}""",
    "series_head": """
        SELECT f.match_id, f.event_name AS event, f.best_of AS event_phase,
               CASE WHEN f.match_id % 31 = 0 THEN NULL ELSE f.patch END AS status_note, f.best_of,
               CAST(f.match_date AS STRING) AS date, f.patch, f.match_id AS fetch_seq,
               CASE WHEN f.match_id % 41 = 0 THEN NULL ELSE f.team1_name END AS name1, CAST(f.team1_id AS STRING) AS id1,
               CAST(f.team1_score AS STRING) AS score1, f.team2_name AS name2, CAST(f.team2_id AS STRING) AS id2,
               CASE WHEN f.match_id % 43 = 0 THEN 'n/a' ELSE CAST(f.team2_score AS STRING) END AS score2,
               f.match_id % 37 = 0 AS one_team
        FROM {fx_series} f""",
    "landing_standings": """
        SELECT o_custkey AS event_id, o_orderpriority AS stage_path,
               CASE WHEN o_orderkey % 73 = 0 THEN NULL ELSE CONCAT(CAST(1 + o_orderkey % 4 AS STRING), 'st / ', o_orderstatus) END AS place,
               CASE WHEN o_orderkey % 19 = 0 THEN 'none' ELSE CAST(o_orderkey % 61 AS STRING) END AS team_id,
               CONCAT('team_', CAST(o_orderkey % 61 AS STRING)) AS team_name, 'XX' AS team_country,
               CAST(o_orderkey AS STRING) AS prize, CAST(NULL AS STRING) AS note, o_orderkey AS fetch_seq
        FROM {orders}""",
    "landing_team_info": """
        SELECT s_suppkey % 61 AS team_id, s_name AS name, 'T' AS tag, CAST(NULL AS STRING) AS logo_url,
               CAST(s_nationkey AS STRING) AS country,
               CASE WHEN s_suppkey % 13 = 0 THEN 'maybe' WHEN s_acctbal > 0 THEN 'yes' ELSE 'off' END AS is_active,
               s_suppkey AS fetch_seq
        FROM {supplier}""",
    "landing_placements": """
        SELECT o_custkey % 80 AS team_id,
               CASE WHEN o_orderkey % 11 = 0 THEN 'n/a' ELSE CAST(o_orderkey % 25 AS STRING) END AS event_id,
               o_orderpriority AS event_name, CAST(2020 + o_orderkey % 6 AS STRING) AS year, o_orderstatus AS series,
               '1st' AS place, CAST(o_orderkey AS STRING) AS prize_money, o_orderkey AS fetch_seq
        FROM {orders}""",
    "landing_transactions": """
        SELECT o_custkey % 80 AS team_id, CAST(o_custkey AS STRING) AS player_id,
               CONCAT('ign_', CAST(o_custkey AS STRING)) AS ign, CAST(NULL AS STRING) AS real_name, 'XX' AS country,
               o_orderstatus AS action, o_orderpriority AS position,
               CASE WHEN o_orderkey % 19 = 0 THEN 'soon' WHEN o_orderkey % 23 = 0 THEN NULL
                    ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS date,
               o_orderkey AS fetch_seq
        FROM {orders}""",
    "landing_profiles": """
        SELECT p_partkey % 400 AS player_id, p_name AS handle, p_brand AS real_name, p_type AS country,
               CAST(NULL AS STRING) AS avatar_url, CASE WHEN p_partkey % 29 = 0 THEN NULL ELSE SPLIT(p_name, ' ') END AS aliases,
               p_partkey AS fetch_seq
        FROM {part}""",
    "landing_agent_stats": """
        SELECT l_partkey % 400 AS player_id, CASE WHEN l_suppkey % 37 = 0 THEN NULL ELSE l_returnflag END AS agent,
               CAST(l_linenumber AS STRING) AS usage_count, CAST(l_suppkey % 100 AS STRING) AS usage_percent,
               CAST(l_orderkey % 300 AS STRING) AS rounds_played, CAST(l_suppkey % 3 AS STRING) AS rating,
               CASE WHEN l_partkey % 9 = 0 THEN 'bad' ELSE CAST(l_partkey % 400 AS STRING) END AS acs,
               CAST(l_suppkey % 2 AS STRING) AS kd, CAST(l_partkey % 200 AS STRING) AS adr, CAST(l_suppkey % 101 AS STRING) AS kast,
               CAST(CAST(FLOOR(l_quantity) AS INT) AS STRING) AS kills, CAST(l_suppkey % 25 AS STRING) AS deaths,
               CAST(l_partkey % 12 AS STRING) AS assists, CAST(l_suppkey % 6 AS STRING) AS first_kills,
               CAST(l_partkey % 5 AS STRING) AS first_deaths,
               CONCAT(LPAD(CAST(l_orderkey AS STRING), 12, '0'), CAST(l_linenumber AS STRING), '_', __LINE_KEY__) AS fetch_seq
        FROM {lineitem}""".replace("__LINE_KEY__", LINE_KEY),
}

_LANDED: dict[tuple[str, str, str], tuple] = {}
_REFERENCE = re.compile(r"\{(\w+)\}")


def references(text: str) -> list[str]:
    return list(dict.fromkeys(_REFERENCE.findall(text)))


class Shapes:
    """Shapes as lazy frames over one directory of Parquet tables."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory.rstrip("/")
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def landed(self, name: str, build) -> DataFrame:
        """A derived payload table, written to the shared folder once per application."""
        key = (self.spark.sparkContext.applicationId, self.directory, name)
        if key not in _LANDED:
            path = shared_folder(self.spark, name)
            df = build(self)
            df.write.parquet(path, compression=PARQUET_CODEC)
            _LANDED[key] = (path, df.schema)
        path, schema = _LANDED[key]
        return self.spark.read.schema(schema).parquet(path)

    def _build(self, name: str) -> DataFrame:
        if name not in SHAPES:
            return self.spark.read.parquet(f"{self.directory}/{name}.parquet")
        text = SHAPES[name]
        return self.spark.sql(text, **{r: self[r] for r in references(text)})


def with_shapes(query: str, **more: str) -> str:
    """A DuckDB statement: the shapes the query names, as common table expressions.

    ``more`` holds further named selects, usable like shapes.
    """
    known = {**SHAPES, **more}
    ordered: dict[str, str] = {}

    def visit(text: str) -> None:
        for name in references(text):
            if name in known and name not in ordered:
                visit(known[name])
                ordered[name] = known[name]

    visit(query)
    ctes = ",\n".join(f"{n} AS ({_REFERENCE.sub(r'\1', t)})" for n, t in ordered.items())
    body = _REFERENCE.sub(r"\1", query)
    return f"WITH {ctes}\n{body}" if ctes else body
