"""Jobs: whole-layer runs that publish tables and return their counts.

Nothing is kept in executor memory between steps.  What more than one step
needs is written under ``Lake.staging`` and read back, so a lost executor costs
the tasks it held and not the steps before them.  A job removes what it staged
when it ends, and what its queries shuffled goes with each of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duelake.commits import commit, new_attempt
from duelake.operators.keys import VIOLATION
from duelake.plans import bronze, gold, silver
from duelake.plans.bronze import Landing, Scope
from duelake.record_types import QUARANTINED, RECORD_TYPES, raw_schema
from duelake.registry import GOLD, LEGACY_PARTITIONS, SILVER, clustered
from duelake.session import PARQUET_CODEC, require_ansi, shared_root, shuffles_dropped
from duelake.sinks.records import (
    drop_attempt,
    last_accepted,
    observed,
    stage_flagged,
    write_attempt,
    write_objects,
    write_quarantine,
    write_violations,
)
from duelake.sinks.tables import counted, ensure_database, publish_flagged, rebuild
from duelake.sources.files import delete_path
from duelake.sources.catalog import build_if_available, register_silver_views
from duelake.sources.landed import (
    ORIGIN,
    compact_runs,
    lake_objects,
    object_keys,
    raw_frames,
    raw_path,
    read_keyed,
    read_single_objects,
)


def _now() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S")


def side_by_side(work: Callable[[str], object], names: Iterable[str]) -> dict[str, object]:
    """Run independent Spark jobs from a few driver threads, so the last tasks of
    one table do not leave the cluster idle.  All run to the end; then the first
    failure, if any, is raised.
    """
    with ThreadPoolExecutor(max_workers=4) as pool:
        running = {name: pool.submit(work, name) for name in names}
    return {name: future.result() for name, future in running.items()}


def compact(record_type: str) -> str:
    """The staged name of a type's JSON documents."""
    return f"compact/{record_type}"


@dataclass(frozen=True)
class Lake:
    """Where the layers live.  ``bronze_format`` is ``json`` or ``keyed``."""

    root: str
    silver: str = "silver"
    gold: str = "gold"
    bronze_format: str = "keyed"
    table_format: str = "parquet"
    run_ts: str = field(default_factory=_now)

    @property
    def bronze(self) -> str:
        return f"{self.root.rstrip('/')}/bronze"

    def staging(self, spark: SparkSession) -> str:
        """Folder of this run's staged frames: in the session's shared root, else in the lake."""
        shared = shared_root(spark)
        base = f"{shared}/staging-{hashlib.md5(self.root.encode()).hexdigest()}" if shared else f"{self.root.rstrip('/')}/staging"
        return f"{base}/run_ts={self.run_ts}"

    @property
    def rejects(self) -> str:
        return f"{self.root.rstrip('/')}/silver"

    def keys(self, spark: SparkSession, record_type: str, without_run: str | None = None) -> DataFrame | None:
        """(``record_key``) of the records that are there; None if there are none."""
        if self.bronze_format == "json":
            return object_keys(spark, self.bronze, record_type)
        records = read_keyed(spark, self.bronze, record_type, without_run)
        return None if records is None else records.select("record_key")

    def raw(self, spark: SparkSession, *types: str) -> dict[str, DataFrame]:
        """Raw frames, JSON documents first compacted to Parquet once per run."""
        if self.bronze_format != "json":
            return raw_frames(spark, self.bronze, self.bronze_format, types)
        return side_by_side(lambda t: self.stage(compact(t), raw_frames(spark, self.bronze, self.bronze_format, [t])[t]), types)

    def stage(self, name: str, df: DataFrame) -> DataFrame:
        """Write once per run and read back: a durable stand-in for a cached frame."""
        return self.stage_counted(name, df)[0]

    def stage_counted(self, name: str, df: DataFrame) -> tuple[DataFrame, int]:
        """``stage`` with the number of rows, which the write reports."""
        path = f"{self.staging(df.sparkSession)}/{name}"
        rows, seen = counted(df)
        rows.write.mode("overwrite").parquet(path, compression=PARQUET_CODEC)
        return df.sparkSession.read.schema(df.schema).parquet(path), seen.get["rows"]

    @contextmanager
    def tidy(self, spark: SparkSession, *names: str) -> Iterator[None]:
        """A job that stages frames of these names: they are removed when it ends or fails, its shuffles with each query."""
        try:
            with shuffles_dropped(spark):
                yield
        finally:
            self.unstage(spark, *names)

    def unstage(self, spark: SparkSession, *names: str) -> None:
        for name in names:
            delete_path(spark, f"{self.staging(spark)}/{name}")


# ---- bronze -----------------------------------------------------------------


def run_backfill(spark: SparkSession, landing: Landing, lake: Lake, scope: Scope = Scope()) -> dict[str, int]:
    """Landed payloads to bronze records and quarantine.

    Does nothing when bronze already holds series of a committed run.  Returns counts by type.
    """
    series = lake.keys(spark, "series")
    if series is not None and not series.isEmpty():
        return {}
    return ingest(spark, landing, lake, scope)


def ingest(spark: SparkSession, landing: Landing, lake: Lake, scope: Scope = Scope()) -> dict[str, int]:
    """As ``run_backfill`` but for an existing bronze: keys of earlier runs are skipped.

    In the keyed form every attempt writes folders of its own, and one manifest makes all of them count when the last is
    complete: an attempt that fails changes nothing, and a run that is repeated works as if it had not been there and
    takes the place of its earlier attempt at that moment.  In the JSON form an object counts when it is
    written; what marks a team, a player or the whole backfill as seen lands after everything it stands for.  So
    a run that fails half-way can be repeated under any stamp.
    """
    require_ansi(spark)
    with lake.tidy(spark, *STAGED_BY_INGEST, "flagged"):
        return _ingest(spark, landing, lake, scope)


STAGED_BY_INGEST = ("events_seen", "candidates", "wanted", "series_payloads", "map_payloads", "team_ids", "player_ids")


def _ingest(spark: SparkSession, landing: Landing, lake: Lake, scope: Scope) -> dict[str, int]:
    attempt = new_attempt()
    written: dict[str, str] = {}
    refused: dict[str, str] = {}

    def existing(record_type: str) -> DataFrame | None:
        return lake.keys(spark, record_type, without_run=lake.run_ts)

    seen = lake.stage("events_seen", bronze.seen_events(landing.events, scope))
    events = bronze.in_scope(seen)
    candidates = lake.stage("candidates", bronze.candidate_matches(landing.matches, events))
    wanted = lake.stage("wanted", bronze.wanted_matches(candidates, existing("series")))
    series = lake.stage("series_payloads", bronze.usable_series(landing.series, wanted))
    maps = lake.stage("map_payloads", bronze.maps_of(landing.series_maps, series))
    teams = lake.stage("team_ids", bronze.unseen(bronze.team_ids(series), "team_id", existing("team_info")))
    players = lake.stage("player_ids", bronze.unseen(bronze.player_ids(maps), "player_id", existing("player_profiles")))

    attempts: dict[str, DataFrame] = {
        "events": bronze.scoped_event_attempts(events),
        "series": bronze.series_attempts(series),
        "map_picks_bans": bronze.action_attempts(series),
        "player_stats": bronze.player_stat_attempts(maps),
        "map_scores": bronze.map_score_attempts(maps),
        "round_results": bronze.round_attempts(maps),
        "event_standings": bronze.standing_attempts(landing.standings, events),
        "team_info": bronze.team_info_attempts(landing.team_info, teams),
        "team_roster": bronze.roster_attempts(landing.roster, teams),
        "team_placements": bronze.placement_attempts(landing.placements, teams),
        "team_transactions": bronze.transaction_attempts(landing.transactions, teams),
        "player_profiles": bronze.profile_attempts(landing.profiles, players),
        "player_agent_stats": bronze.agent_stat_attempts(landing.agent_stats, players),
    }
    counts = dict(bronze.count_seen(seen).first().asDict())
    for name, frame in bronze.series_counts(candidates, wanted, series).items():
        counts[name] = frame.count()

    def store(records: DataFrame, record_type: str) -> None:
        if lake.bronze_format == "json":
            write_objects(records.drop("quarantine_key"), lake.bronze, record_type)
        else:
            write_attempt(records.drop("quarantine_key"), lake.bronze, record_type, lake.run_ts, attempt)
            written[record_type] = attempt

    def land(record_type: str) -> None:
        if record_type in QUARANTINED:
            land_both(record_type)
            return
        # Only the last valid record of each key is wanted: there is nothing to stage for a second reader.
        flagged, seen = observed(attempts[record_type])
        store(last_accepted(flagged), record_type)
        counts[f"{record_type}_valid"] = seen.get["valid"]
        if not seen.get["valid"] and written.pop(record_type, None):
            drop_attempt(spark, lake.bronze, record_type, lake.run_ts, attempt)

    def land_both(record_type: str) -> None:
        staged = f"flagged/{record_type}"
        flagged, tally = stage_flagged(attempts[record_type], f"{lake.staging(spark)}/{staged}")
        counts[f"{record_type}_valid"] = tally["valid"]
        counts[f"{record_type}_invalid"] = tally["invalid"]
        if tally["invalid"]:
            write_quarantine(flagged, lake.bronze, record_type, lake.run_ts, attempt=attempt)
            refused[record_type] = attempt
        if tally["valid"]:
            store(last_accepted(flagged), record_type)
        lake.unstage(spark, staged)

    markers = ("team_info", "player_profiles")
    side_by_side(land, [t for t in attempts if t not in (*markers, "series")])
    side_by_side(land, markers)
    # Series go last: their presence is what marks a backfill as done.
    land("series")
    # The last accepted record of each key is what was written.
    commit(spark, lake.bronze, lake.run_ts, written, refused, distinct=written)
    return counts


def compact_bronze(spark: SparkSession, lake: Lake) -> dict[str, int]:
    """Snapshots of every record type, so later jobs compare only the runs since; their rows by type."""
    with shuffles_dropped(spark):
        return side_by_side(
            lambda t: spark.read.parquet(made.path).count() if (made := compact_runs(spark, lake.bronze, t)) else 0, RECORD_TYPES
        )


def keyed_from_objects(spark: SparkSession, objects: Lake, keyed: Lake) -> dict[str, int]:
    """Merge the small JSON objects of one lake into a run of a keyed lake; the records by type."""
    attempt = new_attempt()
    counts: dict[str, int] = {}

    def one(record_type: str) -> None:
        records = lake_objects(spark, objects.bronze, record_type)
        rows, seen = counted(records)
        write_attempt(rows, keyed.bronze, record_type, keyed.run_ts, attempt)
        counts[record_type] = seen.get["rows"]

    with shuffles_dropped(spark):
        side_by_side(one, RECORD_TYPES)
    commit(spark, keyed.bronze, keyed.run_ts, {t: attempt for t, n in counts.items() if n})
    return counts


# ---- silver -----------------------------------------------------------------


def _publish(spark: SparkSession, lake: Lake, flagged: Mapping[str, DataFrame]) -> dict[str, int]:
    """Replace each table and quarantine its violations, from one write of its flagged rows."""

    def one(table: str) -> tuple[int, int]:
        name = f"{lake.silver}.{table}"
        split = SILVER[table].partitions
        written, violations, rejected = publish_flagged(
            spark, name, flagged[table], split, fmt=lake.table_format, clustered=clustered(split)
        )
        if violations is not None:
            write_violations(spark, violations, lake.rejects, table, lake.run_ts)
        return written, rejected

    done = side_by_side(one, flagged)
    return {**{t: n for t, (n, _) in done.items()}, "quarantined": sum(r for _, r in done.values())}


def _publish_dimensions(spark: SparkSession, lake: Lake, tables: Iterable[str]) -> dict[str, int]:
    require_ansi(spark)
    ensure_database(spark, lake.silver)
    sources = [SILVER[t].source for t in tables]
    with lake.tidy(spark, *map(compact, sources)):
        raw = lake.raw(spark, *sources)
        return _publish(spark, lake, {t: silver.flagged_dimension(raw[SILVER[t].source], t) for t in tables})


DIMS = ("dim_events", "dim_teams", "dim_team_roster", "dim_players")
META_FACTS = ("fact_player_agent_stats", "fact_event_standings", "fact_team_placements", "fact_team_transactions")


def run_dims(spark: SparkSession, lake: Lake) -> dict[str, int]:
    return _publish_dimensions(spark, lake, DIMS)


def run_facts_meta(spark: SparkSession, lake: Lake) -> dict[str, int]:
    return _publish_dimensions(spark, lake, META_FACTS)


STAGED_FOR_MATCHES = ("named_series", "series_event_lookup")
MATCH_FACTS = ("fact_player_stats", "fact_map_scores", "fact_round_results", "fact_map_picks_bans")


def _match_tables(lake: Lake, raw: Mapping[str, DataFrame], events: DataFrame) -> dict[str, DataFrame]:
    """Series and the four match facts, flagged.

    The series joined to their events and the lookup the four facts share are staged: each is read more than once.
    """
    joined = lake.stage("named_series", silver.named_series(raw["series"], events))
    series = silver.flagged_series(joined)
    lookup = lake.stage("series_event_lookup", series.lookup)
    facts = {t: silver.flagged_match_fact(raw[SILVER[t].source], t, lookup) for t in MATCH_FACTS}
    return {"fact_series": series.rows, **facts}


def run_facts_match(spark: SparkSession, lake: Lake) -> dict[str, int]:
    """Match facts; events are read from bronze again, not from their table."""
    require_ansi(spark)
    ensure_database(spark, lake.silver)
    sources = ("events", "series", *[SILVER[t].source for t in MATCH_FACTS])
    with lake.tidy(spark, *map(compact, sources), *STAGED_FOR_MATCHES):
        raw = lake.raw(spark, *sources)
        return _publish(spark, lake, _match_tables(lake, raw, silver.dim_events(raw["events"]).clean))


def run_silver(spark: SparkSession, lake: Lake) -> dict[str, int]:
    """Dimensions, then meta facts, then match facts."""
    total: dict[str, int] = {"quarantined": 0}
    for job in (run_dims, run_facts_meta, run_facts_match):
        counts = job(spark, lake)
        total["quarantined"] += counts.pop("quarantined", 0)
        total.update(counts)
    return total


def run_silver_single_pass(spark: SparkSession, lake: Lake) -> dict[str, int]:
    """All thirteen tables from one read of bronze."""
    require_ansi(spark)
    ensure_database(spark, lake.silver)
    with lake.tidy(spark, *map(compact, RECORD_TYPES), "flagged_events", *STAGED_FOR_MATCHES):
        raw = lake.raw(spark, *RECORD_TYPES)
        tables = {t: silver.flagged_dimension(raw[SILVER[t].source], t) for t in (*DIMS, *META_FACTS)}
        # The events are flagged once, for their own table and for the series.
        tables["dim_events"] = lake.stage("flagged_events", tables["dim_events"])
        events = tables["dim_events"].where(~F.col(VIOLATION)).drop(VIOLATION)
        return _publish(spark, lake, {**tables, **_match_tables(lake, raw, events)})


def run_legacy(spark: SparkSession, lake: Lake) -> dict[str, int]:
    """The older three-table silver: wide player stats, no gate on the other two."""
    require_ansi(spark)
    ensure_database(spark, lake.silver)
    with lake.tidy(spark, "legacy"):
        return _legacy(spark, lake)


def _legacy(spark: SparkSession, lake: Lake) -> dict[str, int]:
    def found(record_type: str) -> DataFrame:
        if lake.bronze_format == "json":
            return read_single_objects(spark, raw_path(lake.bronze, record_type), raw_schema(record_type))
        return lake.raw(spark, record_type)[record_type]

    # Each is staged once, which also counts it.
    staged = side_by_side(lambda t: lake.stage_counted(f"legacy/{t}", found(t)), ("events", "series", "player_stats"))
    raw = {t: df for t, (df, _) in staged.items()}
    counts = {f"{t}_read": n for t, (_, n) in staged.items()}
    events = silver.legacy_events(raw["events"])
    series = lake.stage("legacy/named_series", silver.legacy_with_event(silver.legacy_series(raw["series"]), events))
    wide = silver.flagged_legacy(silver.legacy_player_stats(raw["player_stats"]), series)
    own = [c for c in (*ORIGIN, "_event_order") if c in series.columns]
    for table, df in {"dim_events": events.drop(*ORIGIN), "fact_series": series.drop(*own)}.items():
        name = f"{lake.silver}.{table}"
        split = LEGACY_PARTITIONS[table]
        counts[f"{table}_written"] = rebuild(spark, name, df, split, fmt=lake.table_format, clustered=clustered(split))
    name, split = f"{lake.silver}.fact_player_stats", LEGACY_PARTITIONS["fact_player_stats"]
    written, violations, bad = publish_flagged(
        spark, name, wide, split, skip_empty=False, fmt=lake.table_format, clustered=clustered(split)
    )
    if violations is not None:
        write_violations(spark, violations, lake.bronze, "fact_player_stats", lake.run_ts)
    return {**counts, "fact_player_stats_written": written, "pk_violations": bad}


# ---- gold -------------------------------------------------------------------

# job -> (views to load, [(table, view it needs or "")])
GOLD_JOBS = {
    "players": (
        ("fact_player_stats", "dim_events"),
        (("player_performance", ""), ("player_map_performance", "")),
    ),
    "agents": (
        ("fact_player_stats", "fact_map_scores"),
        (("agent_meta", "fact_map_scores"), ("agent_player_affinity", "")),
    ),
    "teams": (
        ("fact_series", "fact_map_scores", "dim_teams"),
        (("team_standings", ""), ("team_map_performance", "fact_map_scores")),
    ),
    "matches": (("fact_series", "fact_map_scores"), (("match_summary", "fact_map_scores"),)),
}


def run_gold_job(spark: SparkSession, lake: Lake, job: str) -> dict[str, int]:
    """One group of gold tables; a table whose required view is missing is skipped."""
    ensure_database(spark, lake.gold)
    views, tables = GOLD_JOBS[job]
    register_silver_views(spark, lake.silver, views)
    built = {
        table: build_if_available(spark, lambda t=table: gold.from_views(spark, t, ordered=False), requires)
        for table, requires in tables
    }

    def write(table: str) -> int:
        spec = GOLD[table]
        name = f"{lake.gold}.{table}"
        return rebuild(spark, name, built[table], spec.partitions, spec.order, fmt=lake.table_format, ties=spec.key, clustered=clustered(spec.partitions))

    with shuffles_dropped(spark):
        return side_by_side(write, [t for t, df in built.items() if df is not None])


def run_players(spark: SparkSession, lake: Lake) -> dict[str, int]:
    return run_gold_job(spark, lake, "players")


def run_agents(spark: SparkSession, lake: Lake) -> dict[str, int]:
    return run_gold_job(spark, lake, "agents")


def run_teams(spark: SparkSession, lake: Lake) -> dict[str, int]:
    return run_gold_job(spark, lake, "teams")


def run_matches(spark: SparkSession, lake: Lake) -> dict[str, int]:
    return run_gold_job(spark, lake, "matches")


def run_gold(spark: SparkSession, lake: Lake) -> dict[str, int]:
    counts: dict[str, int] = {}
    for job in GOLD_JOBS:
        counts.update(run_gold_job(spark, lake, job))
    return counts
