"""Sinks and jobs: write to the shared folder, read back, and return what is there."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelake.operators.contracts import ERRORS
from duelake.operators.keys import keep_last, pk_gate
from duelake.plans import bronze, gold, jobs
from duelake.record_types import raw_schema
from duelake.registry import GOLD, SILVER
from duelake.session import shared_folder
from duelake.sinks.records import last_accepted, stage_flagged, write_keyed, write_keyed_json, write_quarantine, write_violations
from duelake.sinks.tables import ensure_database, publish, rebuild, reset
from duelake.sources.catalog import build_if_available, register_silver_views, table, view_name, view_rows
from duelake.sources.landed import discover_schema, raw_path, read_documents, read_keyed
from workload import payloads
from workload.bronze_queries import SCOPE, SERIES_OK, STAT_OK, Backfill
from workload.bronze_queries import SQL as BRONZE_SQL
from workload.gold_queries import QUERY_SQL, silver_series
from workload.gold_queries import SQL as GOLD_SQL
from workload.registry import query
from workload.shapes import Shapes

FIRST, SECOND, THIRD = "20250101T000000", "20250102T000000", "20250103T000000"


def scratch_database(s: Shapes) -> str:
    """A new database whose files are in the shared folder."""
    name = f"duelake_{uuid.uuid4().hex}"
    ensure_database(s.spark, name, shared_folder(s.spark, "db"))
    return name


def frame(s: Shapes, rows: list[tuple], schema: str) -> DataFrame:
    return s.spark.createDataFrame(rows, schema)


# ---- bronze sinks ---------------------------------------------------------------


@query(
    "keyed_write",
    f"""
    SELECT CAST(k AS STRING) AS record_key, o_orderkey AS payload FROM
      (SELECT *, o_custkey % 500 AS k, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS run FROM orders)
    QUALIFY ROW_NUMBER() OVER (PARTITION BY k ORDER BY run DESC, o_orderkey DESC) = 1""",
)
def keyed_write(s: Shapes) -> DataFrame:
    # Three runs over overlapping keys, the first one repeated: the newest run wins per key.
    root = shared_folder(s.spark, "bronze")
    rows = s["orders"].select((F.col("o_custkey") % 500).cast("string").alias("record_key"), "o_orderkey", "o_orderstatus")
    for run, status in ((FIRST, "F"), (FIRST, "F"), (SECOND, "O"), (THIRD, "P")):
        newest = keep_last(rows.where(F.col("o_orderstatus") == status), ["record_key"], ["o_orderkey"])
        write_keyed(newest.select("record_key", F.col("o_orderkey").alias("payload")), root, "orders", run)
    return read_keyed(s.spark, root, "orders")


@query("keyed_write_json", "SELECT CAST(o_orderkey AS STRING) AS id, CAST(CAST(o_orderdate AS DATE) AS STRING) AS day FROM orders")
def keyed_write_json(s: Shapes) -> DataFrame:
    root = shared_folder(s.spark, "bronze")
    rows = s["orders"].select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("date").alias("day"))
    write_keyed_json(rows, root, "orders", FIRST)
    return s.spark.read.schema("id string, day string").json(f"{raw_path(root, 'orders')}/run_ts={FIRST}")


@query(
    "contract_quarantine_write",
    f"""
    SELECT CAST(match_id AS STRING) || '_{FIRST}' AS record_key, CAST(match_id AS STRING) AS payload_id,
           (CASE WHEN status_note IS NULL THEN 1 ELSE 0 END) + (CASE WHEN name1 IS NULL THEN 1 ELSE 0 END)
           + (CASE WHEN score2 = 'n/a' THEN 1 ELSE 0 END) AS problems
    FROM {{usable}} WHERE NOT ({SERIES_OK})""",
    **BRONZE_SQL,
)
def contract_quarantine_write(s: Shapes) -> DataFrame:
    root = shared_folder(s.spark, "bronze")
    flagged, _ = stage_flagged(bronze.series_attempts(Backfill(s).series), f"{root}/staged")
    write_quarantine(flagged, root, "series", FIRST)
    written = s.spark.read.schema(f"record_key string, original_payload string, {ERRORS} array<string>").json(
        f"{root}/quarantine/series/run_ts={FIRST}"
    )
    return written.select(
        "record_key",
        F.get_json_object("original_payload", "$.match_id").alias("payload_id"),
        F.size(ERRORS).alias("problems"),
    )


@query(
    "staged_attempts",
    f"""
    SELECT 'player_stats' AS record_type, COUNT(*) FILTER ({STAT_OK}) AS valid, COUNT(*) FILTER (NOT ({STAT_OK})) AS invalid,
           COUNT(*) FILTER ({STAT_OK}) AS stored FROM {{players}}""",
    **BRONZE_SQL,
)
def staged_attempts(s: Shapes) -> DataFrame:
    # The tally comes from the write; the stored rows are counted from the files.
    flagged, counts = stage_flagged(
        bronze.player_stat_attempts(Backfill(s).maps), f"{shared_folder(s.spark, 'staged')}/player_stats"
    )
    stored = last_accepted(flagged).agg(F.count(F.lit(1)).alias("stored"))
    return stored.select(
        F.lit("player_stats").alias("record_type"),
        F.lit(counts["valid"]).cast("bigint").alias("valid"),
        F.lit(counts["invalid"]).cast("bigint").alias("invalid"),
        "stored",
    )


@query("violation_quarantine_write", "SELECT match_id, game_id, player_id, line_key FROM {fx_player_stats} WHERE player_id IS NULL")
def violation_quarantine_write(s: Shapes) -> DataFrame:
    root = shared_folder(s.spark, "quarantine")
    stats = s["fx_player_stats"].select("match_id", "game_id", "player_id", "line_key")
    split = pk_gate(stats, SILVER["fact_player_stats"].key, ["line_key"])
    write_violations(s.spark, split.violations, root, "fact_player_stats", FIRST)
    return s.spark.read.schema(split.violations.schema).parquet(f"{root}/quarantine/fact_player_stats/run_ts={FIRST}")


@query(
    "json_prefix_scan",
    """
    SELECT CAST(n_nationkey AS STRING) AS event_id, n_name AS name, r_name AS region, CAST(0 AS INT) AS _pos
    FROM nation JOIN region ON n_regionkey = r_regionkey""",
)
def json_prefix_scan(s: Shapes) -> DataFrame:
    # One document per nation, as object files below a prefix.
    prefix = shared_folder(s.spark, "landed") + "/events/raw"
    document = F.to_json(F.struct("event_id", "name", "region")).alias("value")
    s["fx_events"].select(document, F.col("event_id").alias("k")).repartition("k").write.partitionBy("k").text(prefix)
    return read_documents(s.spark, prefix, raw_schema("events")).select("event_id", "name", "region", "_pos")


@query("discovered_schema", "SELECT * FROM (VALUES ('event_id', 'bigint'), ('name', 'string'), ('region', 'string')) t(field, kind)")
def discovered_schema(s: Shapes) -> DataFrame:
    prefix = shared_folder(s.spark, "landed") + "/events/raw"
    s["fx_events"].write.json(prefix)
    found = discover_schema(s.spark, prefix)
    return frame(s, [(f.name, f.dataType.simpleString()) for f in found.fields], "field string, kind string")


# ---- catalog tables -----------------------------------------------------------


@query("replace_table", "SELECT s.*, e.event_id, e.region FROM {fx_series} s LEFT JOIN {fx_events} e ON s.event_name = e.name")
def replace_table(s: Shapes) -> DataFrame:
    # Written twice, then once with nothing, which must leave it as it was.
    name = f"{scratch_database(s)}.fact_series"
    df = silver_series(s)
    for rows in (df, df, df.where("match_id < 0")):
        publish(s.spark, name, rows, SILVER["fact_series"].partitions)
    return s.spark.table(name).select(*df.columns)


@query("rebuild_table", QUERY_SQL["team_standings"], **GOLD_SQL)
def rebuild_table(s: Shapes) -> DataFrame:
    name, spec = f"{scratch_database(s)}.team_standings", GOLD["team_standings"]
    df = gold.team_standings(silver_series(s), ordered=False)
    for _ in range(2):
        rebuild(s.spark, name, df, spec.partitions, spec.order)
    return s.spark.table(name).select(*df.columns)


@query("row_metric", "SELECT 'fact_series' AS name, COUNT(*) AS written, CAST(0 AS BIGINT) AS written_when_empty FROM {fx_series}")
def row_metric(s: Shapes) -> DataFrame:
    name = f"{scratch_database(s)}.fact_series"
    written = publish(s.spark, name, s["fx_series"])
    nothing = publish(s.spark, name, s["fx_series"].where("match_id < 0"))
    return frame(s, [("fact_series", written, nothing)], "name string, written bigint, written_when_empty bigint")


@query("silver_views", "SELECT 'fact_series' AS name, COUNT(*) AS n FROM {fx_series} UNION ALL SELECT 'dim_events', COUNT(*) FROM {fx_events}")
def silver_views(s: Shapes) -> DataFrame:
    # The third table is never written: its view is left out.
    database = scratch_database(s)
    publish(s.spark, f"{database}.fact_series", s["fx_series"])
    publish(s.spark, f"{database}.dim_events", s["fx_events"])
    wanted = ["fact_series", "dim_events", "dim_players"]
    register_silver_views(s.spark, database, wanted)
    counts = view_rows(s.spark, wanted)
    for name in wanted:
        s.spark.catalog.dropTempView(view_name(name))
    return frame(s, list(counts.items()), "name string, n bigint")


@query("views_gate", QUERY_SQL["team_standings"], **GOLD_SQL)
def views_gate(s: Shapes) -> DataFrame:
    # Standings need only series and are built; the summary needs map scores and is not.
    database = scratch_database(s)
    publish(s.spark, f"{database}.fact_series", silver_series(s))
    register_silver_views(s.spark, database, ["fact_series", "fact_map_scores"])
    skipped = build_if_available(s.spark, lambda: gold.from_views(s.spark, "match_summary"), "fact_map_scores")
    built = build_if_available(s.spark, lambda: gold.from_views(s.spark, "team_standings"), "fact_series")
    s.spark.catalog.dropTempView(view_name("fact_series"))
    if skipped is not None or built is None:
        raise AssertionError("gate let the wrong table through")
    return built


@query("catalog_scan", "SELECT team1_id, COUNT(*) AS n FROM {fx_series} GROUP BY team1_id")
def catalog_scan(s: Shapes) -> DataFrame:
    database = scratch_database(s)
    publish(s.spark, f"{database}.fact_series", s["fx_series"])
    return table(s.spark, database, "fact_series").groupBy("team1_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "reset_tables",
    "SELECT * FROM (VALUES ('fact_series', FALSE), ('match_summary', FALSE), ('unrelated', TRUE)) t(name, still_there)",
)
def reset_tables(s: Shapes) -> DataFrame:
    database = scratch_database(s)
    names = ["fact_series", "match_summary", "unrelated"]
    for name in names:
        publish(s.spark, f"{database}.{name}", s["fx_series"])
    reset(s.spark, database, database)
    found = [(n, s.spark.catalog.tableExists(f"{database}.{n}")) for n in names]
    return frame(s, found, "name string, still_there boolean")


@query("ensure_db", "SELECT TRUE AS first_time, TRUE AS second_time")
def ensure_db(s: Shapes) -> DataFrame:
    name = scratch_database(s)
    first = s.spark.catalog.databaseExists(name)
    ensure_database(s.spark, name)
    return frame(s, [(first, s.spark.catalog.databaseExists(name))], "first_time boolean, second_time boolean")


# ---- jobs -------------------------------------------------------------------------


def lake(s: Shapes, bronze_format: str = "keyed") -> jobs.Lake:
    """A new lake in the shared folder with databases of its own."""
    root = shared_folder(s.spark, "lake")
    names = {}
    for layer in ("silver", "gold"):
        names[layer] = f"duelake_{layer}_{uuid.uuid4().hex}"
        ensure_database(s.spark, names[layer], f"{root}/{names[layer]}")
    return jobs.Lake(root, bronze_format=bronze_format, run_ts=FIRST, **names)


FULL_SQL = {**BRONZE_SQL, "wanted": "SELECT match_id FROM {candidates}"}


@query(
    "job_backfill",
    f"""
    SELECT 'events_in_scope' AS counter, COUNT(*) AS n FROM {{scoped}}
    UNION ALL SELECT 'events_valid', COUNT(status) FROM {{scoped}}
    UNION ALL SELECT 'series_valid', COUNT(*) FILTER ({SERIES_OK}) FROM {{usable}}
    UNION ALL SELECT 'series_invalid', COUNT(*) FILTER (NOT ({SERIES_OK})) FROM {{usable}}
    UNION ALL SELECT 'series_missing', (SELECT COUNT(*) FROM {{wanted}}) - COUNT(*) FROM {{usable}}
    UNION ALL SELECT 'series_skipped', CAST(0 AS BIGINT)
    UNION ALL SELECT 'player_stats_valid', COUNT(*) FILTER ({STAT_OK}) FROM {{players}}
    UNION ALL SELECT 'player_stats_invalid', COUNT(*) FILTER (NOT ({STAT_OK})) FROM {{players}}
    UNION ALL SELECT 'second_run', CAST(0 AS BIGINT)""",
    **FULL_SQL,
)
def job_backfill(s: Shapes) -> DataFrame:
    # A second run finds series in bronze and does nothing.
    target = lake(s)
    counts = jobs.run_backfill(s.spark, payloads.landing(s), target, SCOPE)
    again = jobs.run_backfill(s.spark, payloads.landing(s), target, SCOPE)
    shown = "events_in_scope events_valid series_valid series_invalid series_missing series_skipped player_stats_valid player_stats_invalid"
    rows = [(c, counts[c]) for c in shown.split()] + [("second_run", len(again))]
    return frame(s, rows, "counter string, n bigint")


# Player stats a full run brings to silver: valid records with a numeric game id
# and a player id.
JOB_SQL = {
    **FULL_SQL,
    "valid_stats": f"""
        SELECT m, i, j, (m + 7 * j) % 320 AS p, m * 10 + i AS game_id FROM {{players}}
        WHERE {STAT_OK} AND (m + i) % 13 <> 0 AND (m + j) % 23 <> 0""",
}


@query(
    "job_full_run",
    """
    SELECT p AS player_id, 'map_' || CAST(i AS STRING) AS map_name, COUNT(DISTINCT game_id) AS maps_played,
           CAST(SUM((m + j) % 40 - 1) AS BIGINT) AS total_kills, CAST(SUM((m * 3 + j) % 30) AS BIGINT) AS total_deaths
    FROM {valid_stats} GROUP BY p, i""",
    **JOB_SQL,
)
def job_full_run(s: Shapes) -> DataFrame:
    # Bronze, silver and gold jobs one after the other; gold is summed over teams for the check.
    target = lake(s)
    jobs.run_backfill(s.spark, payloads.landing(s), target, SCOPE)
    jobs.run_silver(s.spark, target)
    jobs.run_gold(s.spark, target)
    per_team = s.spark.table(f"{target.gold}.player_map_performance")
    return per_team.groupBy("player_id", "map_name").agg(
        F.sum("maps_played").alias("maps_played"),
        F.sum("total_kills").alias("total_kills"),
        F.sum("total_deaths").alias("total_deaths"),
    )


@query("job_legacy_silver", "SELECT match_id, team1_name, team2_name, COUNT(*) AS stats FROM {joined} GROUP BY ALL", joined=f"""
    SELECT DISTINCT m AS match_id, m * 10 + i AS game_id, (m + 7 * j) % 320 AS p,
           CASE WHEN {SERIES_OK} THEN name1 END AS team1_name, CASE WHEN {SERIES_OK} THEN name2 END AS team2_name
    FROM {{players}} WHERE {STAT_OK} AND (m + i) % 13 <> 0 AND (m + j) % 23 <> 0""", **FULL_SQL)
def job_legacy_silver(s: Shapes) -> DataFrame:
    target = lake(s)
    jobs.run_backfill(s.spark, payloads.landing(s), target, SCOPE)
    jobs.run_legacy(s.spark, target)
    stats = s.spark.table(f"{target.silver}.fact_player_stats")
    return stats.groupBy("match_id", "team1_name", "team2_name").agg(F.count(F.lit(1)).alias("stats"))


@query(
    "job_silver_single_pass",
    """
    SELECT m AS match_id, CAST(i AS INT) AS map_index, m * 10 + i AS game_id, 'map_' || CAST(i AS STRING) AS map_name,
           CAST(id1 AS BIGINT) AS team1_id, CAST((m + i) % 14 AS INT) AS team1_score, (m + 1) % 2 = 0 AS team1_is_winner,
           CAST(id2 AS BIGINT) AS team2_id, CAST((m + 2 * i) % 14 AS INT) AS team2_score, (m + 2) % 2 = 0 AS team2_is_winner
    FROM {maps} WHERE (m + i) % 11 <> 0 AND (m + i) % 8 <> 0 AND (m + i) % 13 <> 0""",
    **FULL_SQL,
)
def job_silver_single_pass(s: Shapes) -> DataFrame:
    target = lake(s)
    jobs.run_backfill(s.spark, payloads.landing(s), target, SCOPE)
    jobs.run_silver_single_pass(s.spark, target)
    shown = "match_id map_index game_id map_name team1_id team1_score team1_is_winner team2_id team2_score team2_is_winner"
    return s.spark.table(f"{target.silver}.fact_map_scores").select(*shown.split())
