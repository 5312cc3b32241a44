"""Whole jobs over the derived landing tables, their results read back from the lake and the catalog.

Several queries read the same lake; each of its layers is built once for a session and a data directory, when a query reads it.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelake.plans import jobs
from duelake.plans.bronze import Landing
from duelake.record_types import RECORD_TYPES
from duelake.registry import GOLD, LEGACY_PARTITIONS, SILVER
from duelake.session import shared_folder
from duelake.sinks.records import read_quarantine, write_objects
from duelake.sinks.tables import POSITION, publish, read_in_order
from duelake.sources.landed import read_keyed
from workload import payloads
from workload.bronze_queries import ACTIONS, ROUNDS, SCOPE, SERIES_OK, STAT_OK
from workload.bronze_queries import SQL as BRONZE_SQL
from workload.registry import query, statement
from workload.shapes import SHAPES, Shapes
from workload.sink_queries import FIRST, SECOND, frame, lake

# ---- landing tables whose events are found by name -----------------------------------

#: Parts of the SQL: nothing was ingested before, every event has a name of its own, all series name one of 25
#: events, of which some are out of scope.
JOB = {
    **BRONZE_SQL,
    "wanted": "SELECT match_id FROM {candidates}",
    "landing_events": f"SELECT * REPLACE (name || ' ' || CAST(id AS STRING) AS name) FROM ({SHAPES['landing_events']})",
    "series_head": f"""
        SELECT h.* REPLACE (e.name AS event) FROM ({SHAPES['series_head']}) h
        JOIN {{landing_matches}} m ON h.match_id = m.match_id JOIN {{landing_events}} e ON e.id = m.event_id % 25 + 1""",
}


def landing(s: Shapes) -> Landing:
    plain = payloads.landing(s)
    events = plain.events.withColumn("name", F.concat("name", F.lit(" "), F.col("id").cast("string")))
    hosts = plain.matches.select("match_id", (F.col("event_id") % 25 + 1).alias("host"))
    names = hosts.join(events.select(F.col("id").alias("host"), "name"), "host").select("match_id", "name")
    series = plain.series.join(names, "match_id").withColumn("event", F.col("name")).select(plain.series.columns)
    return replace(plain, events=events, series=series)


_LAKES: dict[tuple, object] = {}


def _once(s: Shapes, step: str, build):
    """What a step gives, run once for a session and a data directory."""
    key = (s.spark.sparkContext.applicationId, s.directory, step)
    if key not in _LAKES:
        _LAKES[key] = build()
    return _LAKES[key]


def backfilled(s: Shapes) -> tuple[jobs.Lake, dict[str, int]]:
    """A lake after the backfill, and its counters."""

    def build():
        target = lake(s)
        return target, jobs.run_backfill(s.spark, landing(s), target, SCOPE)

    return _once(s, "backfill", build)


def with_silver(s: Shapes) -> jobs.Lake:
    """The same lake with its silver tables."""
    target = backfilled(s)[0]
    _once(s, "silver", lambda: jobs.run_silver(s.spark, target))
    return target


def finished(s: Shapes) -> jobs.Lake:
    """The same lake with its silver and gold tables."""
    target = with_silver(s)
    _once(s, "gold", lambda: jobs.run_gold(s.spark, target))
    return target


def together(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def bronze_sql(record_type: str) -> str:
    """The SQL of a type's records."""
    return f"({statement(f'bronze_{record_type}', **JOB)})"


# ---- keys of all silver tables ----------------------------------------------------------


def _key(table: str) -> list[str]:
    return ["TRY_CAST(game_id AS BIGINT)" if c == "game_id" else c for c in SILVER[table].key]


def clean_keys_sql(tables=SILVER) -> str:
    def one(table: str) -> str:
        text = ", ".join(f"CAST({c} AS STRING)" for c in _key(table))
        whole = " AND ".join(f"{c} IS NOT NULL" for c in _key(table))
        return f"SELECT DISTINCT '{table}' AS name, concat_ws('|', {text}) AS key FROM {bronze_sql(SILVER[table].source)} WHERE {whole}"

    return " UNION ALL ".join(map(one, tables))


def violation_keys_sql() -> str:
    def one(table: str) -> str:
        text = ", ".join(f"COALESCE(CAST({c} AS STRING), 'null')" for c in _key(table))
        broken = " OR ".join(f"{c} IS NULL" for c in _key(table))
        return f"SELECT '{table}' AS name, concat_ws('|', {text}) AS key FROM {bronze_sql(SILVER[table].source)} WHERE {broken}"

    return " UNION ALL ".join(map(one, SILVER))


def keys_of(df: DataFrame, table: str) -> DataFrame:
    text = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in SILVER[table].key]
    return df.select(F.lit(table).alias("name"), F.concat_ws("|", *text).alias("key"))


def silver_keys(s: Shapes, database: str) -> DataFrame:
    return together([keys_of(s.spark.table(f"{database}.{t}"), t) for t in SILVER])


@query("job_silver_tables", clean_keys_sql())
def job_silver_tables(s: Shapes) -> DataFrame:
    # run_dims, run_facts_meta and run_facts_match: every row of all thirteen tables by its key.
    return silver_keys(s, with_silver(s).silver)


@query("job_silver_single_pass_tables", clean_keys_sql())
def job_silver_single_pass_tables(s: Shapes) -> DataFrame:
    single = replace(lake(s), root=backfilled(s)[0].root)
    jobs.run_silver_single_pass(s.spark, single)
    return silver_keys(s, single.silver)


@query("job_silver_violations", violation_keys_sql())
def job_silver_violations(s: Shapes) -> DataFrame:
    # The quarantine folders, read back: a table without violations has none.
    target = with_silver(s)
    schemas = {t: s.spark.table(f"{target.silver}.{t}").schema for t in SILVER}
    folder = f"{target.rejects}/quarantine/{{}}/run_ts={FIRST}"
    found = jobs.side_by_side(lambda t: s.spark.read.schema(schemas[t]).option("ignoreMissingFiles", "true").parquet(folder.format(t))
                              if has_folder(s, folder.format(t)) else s.spark.createDataFrame([], schemas[t]), SILVER)
    return together([keys_of(df, t) for t, df in found.items()])


def has_folder(s: Shapes, path: str) -> bool:
    from duelake.sources.files import file_names

    return bool(file_names(s.spark, path))


@query("job_silver_series", f"""
    SELECT b.match_id, b.event_name, b.match_date, e.event_id, e.region, b.team1_id, b.team2_name, CAST(b.team2_score AS INT) AS team2_score
    FROM {bronze_sql('series')} b LEFT JOIN {bronze_sql('events')} e ON b.event_name = e.name""")  # fmt: skip
def job_silver_series(s: Shapes) -> DataFrame:
    names = "match_id event_name match_date event_id region team1_id team2_name team2_score"
    return s.spark.table(f"{with_silver(s).silver}.fact_series").select(*names.split())


# ---- gold ---------------------------------------------------------------------------------

GOLD_JOB = {
    **JOB,
    "fx_events": f"SELECT event_id, name, region FROM {bronze_sql('events')}",
    "series": f"""
        SELECT b.match_id, b.event_name, e.event_id, e.region, b.match_date, b.best_of, b.patch, b.team1_id, b.team1_name,
               CAST(b.team1_score AS INT) AS team1_score, b.team2_id, b.team2_name, CAST(b.team2_score AS INT) AS team2_score
        FROM {bronze_sql('series')} b LEFT JOIN {{fx_events}} e ON b.event_name = e.name""",
    "maps": f"""
        SELECT * REPLACE (TRY_CAST(game_id AS BIGINT) AS game_id) FROM {bronze_sql('map_scores')}
        WHERE TRY_CAST(game_id AS BIGINT) IS NOT NULL""",
    "gated": f"""
        SELECT * EXCLUDE (rating) REPLACE (TRY_CAST(game_id AS BIGINT) AS game_id, string_split(agents, '|') AS agents), rating AS r_rating
        FROM ({{listed}}) WHERE player_id IS NOT NULL AND TRY_CAST(game_id AS BIGINT) IS NOT NULL""",
    "listed": f"SELECT * REPLACE (array_to_string(agents, '|') AS agents) FROM {bronze_sql('player_stats')}",
    "teams": f"SELECT team_id, name FROM {bronze_sql('team_info')}",
}


def _gold_query(table: str) -> None:
    @query(f"job_gold_{table}", f"SELECT * FROM ({statement(table, **GOLD_JOB)})")
    def read(s: Shapes) -> DataFrame:
        return s.spark.table(f"{finished(s).gold}.{table}")


for _table in GOLD:
    _gold_query(_table)


# ---- order and partitions of published tables ----------------------------------------------


def order_sql(table: str) -> str:
    spec = GOLD[table]
    named = {c for c, _ in spec.order}
    by = [f"{c} {'DESC NULLS LAST' if down else 'NULLS FIRST'}" for c, down in spec.order]
    by += [f"{c} NULLS FIRST" for c in spec.key if c not in named and c not in spec.partitions]
    split = f"PARTITION BY {', '.join(spec.partitions)} " if spec.partitions else ""
    text = ", ".join(f"COALESCE(CAST({c} AS STRING), 'null')" for c in spec.key)
    rank = f"ROW_NUMBER() OVER ({split}ORDER BY {', '.join(by)})"
    return f"SELECT '{table}' AS name, concat_ws('|', {text}) AS key, {rank} AS position FROM ({statement(table, **GOLD_JOB)})"


ORDERED = [t for t in GOLD if GOLD[t].order]


@query("published_order", " UNION ALL ".join(f"({order_sql(t)})" for t in ORDERED))
def published_order(s: Shapes) -> DataFrame:
    """Every row's place in its table, read from the numbers of files and rows, beside the rank SQL gives it."""
    database = finished(s).gold

    def placed(table: str) -> DataFrame:
        text = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in GOLD[table].key]
        rows = read_in_order(s.spark, f"{database}.{table}", GOLD[table].partitions)
        return rows.select(F.lit(table).alias("name"), F.concat_ws("|", *text).alias("key"), POSITION)

    return together([placed(t) for t in ORDERED])


def registry_sql() -> str:
    silver = f"SELECT name, COUNT(*) AS n FROM ({clean_keys_sql()}) GROUP BY name"
    gold = " UNION ALL ".join(f"SELECT '{t}', COUNT(*) FROM ({statement(t, **GOLD_JOB)})" for t in GOLD)
    specs = ", ".join(f"('{t}', '{' '.join(spec.partitions)}')" for t, spec in {**SILVER, **GOLD}.items())
    return f"SELECT name, split, n FROM ({silver} UNION ALL {gold}) JOIN (VALUES {specs}) p(name, split) USING (name)"


@query("partition_registry", registry_sql())
def partition_registry(s: Shapes) -> DataFrame:
    """Partition columns of all twenty tables as the catalog has them (folders or clusters), with the rows read through them."""
    target = finished(s)

    def one(table: str) -> tuple[str, str, int]:
        name = f"{target.silver if table in SILVER else target.gold}.{table}"
        split = " ".join(c.name for c in s.spark.catalog.listColumns(name) if c.isPartition or c.isCluster)
        return table, split, s.spark.table(name).count()

    return frame(s, list(jobs.side_by_side(one, [*SILVER, *GOLD]).values()), "name string, split string, n bigint")


@query("published_databases", f"""
    SELECT 'silver' AS layer, COUNT(DISTINCT name) AS tables, COUNT(*) AS n FROM ({clean_keys_sql()})
    UNION ALL SELECT 'gold', 7, (SELECT SUM(n)::BIGINT FROM ({registry_sql()}) WHERE name IN ({", ".join(f"'{t}'" for t in GOLD)}))""")  # fmt: skip
def published_databases(s: Shapes) -> DataFrame:
    # ensure_database twice over databases that hold tables: nothing in them is lost.
    from duelake.sinks.tables import ensure_database

    rows = []
    for layer in ("silver", "gold"):
        name = getattr(finished(s), layer)
        ensure_database(s.spark, name)
        ensure_database(s.spark, name)
        found = [t.name for t in s.spark.catalog.listTables(name) if not t.isTemporary]
        rows.append((layer, len(found), sum(s.spark.table(f"{name}.{t}").count() for t in found)))
    return frame(s, rows, "layer string, tables bigint, n bigint")


# ---- backfill: counters, quarantine, retries ------------------------------------------------

QUARANTINE_CHECKS = {
    "events": ("{scoped}", "status IS NOT NULL AND TRIM(name) <> ''"),
    "series": ("{usable}", SERIES_OK),
    "map_picks_bans": ("{actions}", "map IS NOT NULL AND team IS NOT NULL"),
    "player_stats": ("{players}", STAT_OK),
    "map_scores": ("(SELECT * FROM {maps} WHERE (m + i) % 11 <> 0)", "(m + i) % 8 <> 0"),
    "round_results": ("{rounds}", "good"),
}
#: Types whose invalid attempts are dropped: every attempt that reaches the sink is counted, before the last per key is taken.
ATTEMPTS = {
    "event_standings": "{landing_standings} WHERE event_id IN (SELECT id FROM {scoped}) AND team_id <> 'none'",
    "team_info": "{landing_team_info} WHERE is_active <> 'maybe' AND team_id IN (SELECT team_id FROM {team_ids})",
    "team_placements": "{landing_placements} WHERE event_id <> 'n/a' AND team_id IN (SELECT team_id FROM {team_ids})",
    "team_transactions": "{landing_transactions} WHERE (date IS NULL OR date <> 'soon') AND team_id IN (SELECT team_id FROM {team_ids})",
    "player_profiles": "{landing_profiles} WHERE aliases IS NOT NULL AND player_id IN (SELECT player_id FROM {player_ids})",
    "player_agent_stats": "{landing_agent_stats} WHERE acs <> 'bad' AND player_id IN (SELECT player_id FROM {player_ids})",
    "team_roster": """(SELECT DISTINCT s_suppkey FROM supplier, RANGE(0, 2) t(i)
        WHERE (s_suppkey + i) % 7 <> 0 AND s_suppkey % 9 <> i AND s_suppkey % 61 IN (SELECT team_id FROM {team_ids}))""",
}
COUNTERS = """
    SELECT 'events_total' AS counter, COUNT(*) AS n FROM {landing_events}
        WHERE (SELECT stop IS NULL FROM {stale}) OR page <= (SELECT stop FROM {stale})
    UNION ALL SELECT 'events_in_scope', COUNT(*) FROM {scoped}
    UNION ALL SELECT 'events_skipped', COUNT(*) - (SELECT COUNT(*) FROM {scoped}) FROM {landing_events}
        WHERE (SELECT stop IS NULL FROM {stale}) OR page <= (SELECT stop FROM {stale})
    UNION ALL SELECT 'series_skipped', CAST(0 AS BIGINT)
    UNION ALL SELECT 'series_missing', (SELECT COUNT(*) FROM {wanted}) - COUNT(*) FROM {usable}
""" + "".join(
    f" UNION ALL SELECT '{t}_valid', COUNT(*) FILTER ({good}) FROM {rows} UNION ALL SELECT '{t}_invalid', COUNT(*) FILTER (NOT ({good})) FROM {rows}"
    for t, (rows, good) in QUARANTINE_CHECKS.items()
) + "".join(f" UNION ALL SELECT '{t}_valid', COUNT(*) FROM {rows}" for t, rows in ATTEMPTS.items())


@query("backfill_counters", COUNTERS, actions=ACTIONS, rounds=ROUNDS, **JOB)
def backfill_counters(s: Shapes) -> DataFrame:
    # All counters of one run: every step is staged once and counted by its own write.
    return frame(s, list(backfilled(s)[1].items()), "counter string, n bigint")


@query("backfill_quarantine", " UNION ALL ".join(
    f"SELECT '{t}' AS name, COUNT(*) AS n FROM {rows} WHERE NOT ({good})" for t, (rows, good) in QUARANTINE_CHECKS.items()),
    actions=ACTIONS, rounds=ROUNDS, **JOB)
def backfill_quarantine(s: Shapes) -> DataFrame:
    root = backfilled(s)[0].bronze
    return together([read_quarantine(s.spark, root, t).agg(F.lit(t).alias("name"), F.count(F.lit(1)).alias("n")) for t in QUARANTINE_CHECKS])


def bronze_keys_sql() -> str:
    return " UNION ALL ".join(f"SELECT DISTINCT '{t}' AS name, record_key FROM {bronze_sql(t)}" for t in RECORD_TYPES)


def bronze_keys(s: Shapes, target: jobs.Lake) -> DataFrame:
    found = {t: read_keyed(s.spark, target.bronze, t) for t in RECORD_TYPES}
    return together([df.select(F.lit(t).alias("name"), "record_key") for t, df in found.items() if df is not None])


@query("ingest_retry", bronze_keys_sql())
def ingest_retry(s: Shapes) -> DataFrame:
    """A run, its repeat that fails half-way, and a run under another stamp: no record of any type is lost."""
    target = lake(s)
    good = landing(s)
    jobs.run_backfill(s.spark, good, target, SCOPE)
    broken = replace(good, agent_stats=good.agent_stats.withColumn("agent", F.raise_error(F.lit("the connection broke")).cast("string")))
    try:
        jobs.ingest(s.spark, broken, target, SCOPE)
    except Exception as failure:
        if "the connection broke" not in str(failure):
            raise
    else:
        raise AssertionError("the repeat should have failed")
    later = replace(target, run_ts=SECOND)
    if jobs.run_backfill(s.spark, good, later, SCOPE):
        raise AssertionError("the first run counts as done")
    jobs.ingest(s.spark, good, later, SCOPE)
    return bronze_keys(s, target)


@query("silver_increment", clean_keys_sql())
def silver_increment(s: Shapes) -> DataFrame:
    """Half of the matches, a snapshot, then the rest in a second run: silver as from one full run."""
    target = lake(s)
    whole = landing(s)
    jobs.run_backfill(s.spark, replace(whole, matches=whole.matches.where(F.col("status") == "completed")), target, SCOPE)
    jobs.compact_bronze(s.spark, target)
    later = replace(target, run_ts=SECOND)
    jobs.ingest(s.spark, whole, later, SCOPE)
    jobs.run_silver(s.spark, later)
    return silver_keys(s, target.silver)


# ---- JSON lake -------------------------------------------------------------------------------


def json_lake(s: Shapes) -> jobs.Lake:
    def build():
        target = lake(s, "json")
        jobs.run_backfill(s.spark, landing(s), target, SCOPE)
        return target

    return _once(s, "json", build)


@query("job_json_silver_tables", clean_keys_sql())
def job_json_silver_tables(s: Shapes) -> DataFrame:
    # One JSON object a record, written and read by the jobs; a second backfill finds them and does nothing.
    target = json_lake(s)
    if jobs.run_backfill(s.spark, landing(s), target, SCOPE):
        raise AssertionError("the objects of the first run count as done")
    jobs.run_silver(s.spark, target)
    return silver_keys(s, target.silver)


@query("json_lake_compacted", bronze_keys_sql())
def json_lake_compacted(s: Shapes) -> DataFrame:
    keyed = lake(s)
    jobs.keyed_from_objects(s.spark, json_lake(s), keyed)
    return bronze_keys(s, keyed)


LEGACY_SQL = f"""
    SELECT 'fact_player_stats' AS name, concat_ws('|', CAST(match_id AS STRING), CAST(game_id AS STRING), CAST(player_id AS STRING),
        CAST(event_id AS STRING), region, CAST(match_date AS STRING), team1_name) AS row_text FROM ({{legacy_stats}})
    UNION ALL SELECT 'dim_events', concat_ws('|', CAST(event_id AS STRING), name, region) FROM {bronze_sql('events')}
    UNION ALL SELECT 'fact_series', concat_ws('|', CAST(match_id AS STRING), event_name, CAST(event_id AS STRING), team1_name) FROM {{series}}
    UNION ALL SELECT 'violations', concat_ws('|', CAST(match_id AS STRING), player_name) FROM {bronze_sql('player_stats')}
        WHERE TRY_CAST(game_id AS BIGINT) IS NULL OR player_id IS NULL"""
LEGACY_STATS = "SELECT g.*, s.event_id, s.region, s.match_date, s.team1_name FROM {gated} g LEFT JOIN {series} s USING (match_id)"


def legacy_rows(s: Shapes, target: jobs.Lake) -> DataFrame:
    """The three tables of the older job and its quarantine folder."""
    jobs.run_legacy(s.spark, target)
    tables = {t: s.spark.table(f"{target.silver}.{t}") for t in LEGACY_PARTITIONS}
    folder = f"{target.bronze}/quarantine/fact_player_stats/run_ts={FIRST}"
    tables["violations"] = s.spark.read.schema(tables["fact_player_stats"].schema).parquet(folder)
    shown = {
        "fact_player_stats": "match_id game_id player_id event_id region match_date team1_name",
        "dim_events": "event_id name region",
        "fact_series": "match_id event_name event_id team1_name",
        "violations": "match_id player_name",
    }
    texts = {t: F.concat_ws("|", *[F.col(c).cast("string") for c in shown[t].split()]) for t in shown}
    return together([tables[t].select(F.lit(t).alias("name"), texts[t].alias("row_text")) for t in shown])


@query("job_legacy_tables", LEGACY_SQL, legacy_stats=LEGACY_STATS, **GOLD_JOB)
def job_legacy_tables(s: Shapes) -> DataFrame:
    return legacy_rows(s, replace(lake(s), root=backfilled(s)[0].root))


@query("job_json_legacy_tables", LEGACY_SQL, legacy_stats=LEGACY_STATS, **GOLD_JOB)
def job_json_legacy_tables(s: Shapes) -> DataFrame:
    # The same from one JSON object a record.
    return legacy_rows(s, replace(lake(s, "json"), root=json_lake(s).root))


# ---- readers ---------------------------------------------------------------------------------


@query("single_object_scan", "SELECT CAST(id AS STRING) AS event_id, name, CAST(0 AS INT) AS _pos FROM {landing_events}")
def single_object_scan(s: Shapes) -> DataFrame:
    # One object a file below a prefix, beside a prefix that does not exist; each row has an object of its own, whatever its id.
    from duelake.record_types import raw_schema
    from duelake.sources.landed import raw_path, read_single_objects

    root = shared_folder(s.spark, "landed")
    prefix = raw_path(root, "events")
    own = F.concat_ws("_", F.col("id").cast("string"), F.monotonically_increasing_id().cast("string")).alias("record_key")
    write_objects(s["landing_events"].select(own, F.col("id").alias("event_id"), "name").repartition("record_key"), root, "events")
    found = read_single_objects(s.spark, prefix, raw_schema("events"))
    absent = read_single_objects(s.spark, prefix + "/none", raw_schema("events"))
    return found.unionByName(absent).select("event_id", "name", "_pos")


@query("ingestion_stamp", f"""
    SELECT name, COUNT(*) AS n, COUNT(*) AS stamped, 'timestamp' AS kind FROM ({bronze_keys_sql()}) GROUP BY name""")  # fmt: skip
def ingestion_stamp(s: Shapes) -> DataFrame:
    target = backfilled(s)[0]
    found = {t: read_keyed(s.spark, target.bronze, t) for t in RECORD_TYPES}
    counts = [
        df.agg(F.lit(t).alias("name"), F.count(F.lit(1)).alias("n"), F.count("ingested_at").alias("stamped")).withColumn(
            "kind", F.lit(dict(df.dtypes)["ingested_at"])
        )
        for t, df in found.items()
    ]
    return together(counts)


@query("swap_keeps_readers", """
    SELECT CAST(r AS INT) AS round, COUNT(*) AS n FROM {fx_series}, RANGE(0, 3) t(r) GROUP BY r""")  # fmt: skip
def swap_keeps_readers(s: Shapes) -> DataFrame:
    # A frame that was planned on one version is read after the table was switched to the next.
    name = f"{lake(s).silver}.fact_series"
    rows = s["fx_series"].withColumn("day", F.col("match_date"))
    publish(s.spark, name, rows, ["patch"])
    counts = []
    for turn in range(3):
        planned = s.spark.table(name)
        publish(s.spark, name, rows, ["patch"])
        counts.append((turn, planned.count()))
    return frame(s, counts, "round int, n bigint")


@query("discovered_fields", """
    SELECT field, SUM(n)::BIGINT AS records, string_agg(kind || ':' || n, ',' ORDER BY kind || ':' || n) AS kinds,
           COUNT(*) FILTER (kind <> 'VOID') > 1 AS conflict,
           CASE WHEN COUNT(*) FILTER (kind <> 'VOID') > 1 THEN 'VARIANT'
                ELSE COALESCE(MAX(kind) FILTER (kind <> 'VOID'), 'VOID') END AS merged
    FROM (
        SELECT 'id' AS field, 'BIGINT' AS kind, COUNT(*) AS n FROM {landing_events}
        UNION ALL SELECT 'name', 'STRING', COUNT(*) FROM {landing_events}
        UNION ALL SELECT 'status', CASE WHEN status IS NULL THEN 'VOID' ELSE 'STRING' END, COUNT(*) FROM {landing_events} GROUP BY 2
        UNION ALL SELECT 'prize', CASE id % 3 WHEN 0 THEN 'STRING' WHEN 1 THEN 'BIGINT' ELSE 'BOOLEAN' END, COUNT(*) FROM {landing_events} GROUP BY 2
        UNION ALL SELECT 'end_date', 'VOID', COUNT(*) FROM {landing_events}
    ) GROUP BY field""")  # fmt: skip
def discovered_fields(s: Shapes) -> DataFrame:
    # One document a page, an array of its events; the attribute prize is text, a number or a truth value.
    from duelake.sources.landed import discover_fields

    prefix = shared_folder(s.spark, "landed") + "/events/raw"
    prize = F.when(F.col("id") % 3 == 0, F.concat(F.lit('"'), "prize", F.lit('"'))).when(F.col("id") % 3 == 1, F.col("prize")).otherwise("true")
    plain = F.to_json(F.struct("id", "name", "status", F.col("end_date").cast("string").alias("end_date")), {"ignoreNullFields": "false"})
    record = F.concat(F.substring(plain, F.lit(1), F.length(plain) - 1), F.lit(',"prize":'), prize, F.lit("}"))
    pages = s["landing_events"].withColumn("part", F.col("id") % 40).groupBy("page", "part")
    documents = pages.agg(F.concat(F.lit("["), F.array_join(F.collect_list(record), ","), F.lit("]")).alias("value"))
    documents.repartition("page", "part").write.partitionBy("page", "part").option("lineSep", "\n").text(prefix)
    return discover_fields(s.spark, prefix)
