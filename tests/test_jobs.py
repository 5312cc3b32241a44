import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from duelake import commits
from duelake.operators.keys import VIOLATION, pk_flagged, pk_gate
from duelake.plans import bronze, jobs
from duelake.plans.bronze import Landing
from duelake.registry import GOLD, SILVER, clustered
from duelake.sinks.records import last_accepted, write_keyed
from duelake.sinks.tables import ensure_database, publish, publish_flagged, read_in_order, reset, spread_for_write
from duelake.sources.files import write_new
from duelake.sources.landed import compact_runs, read_keyed
from conftest import rows

ACTION = "array<struct<team:string,map:string>>"
PLAYER = (
    "struct<name:string,player_id:bigint,team_short:string,team_id:bigint,agents:array<string>,r:double,acs:int,k:int,d:int,a:int,"
    "kast:double,adr:double,hs_pct:double,fk:int,fd:int>"
)
TEAM = "struct<id:bigint,name:string,short:string,score:int,attacker_rounds:int,defender_rounds:int,is_winner:boolean>"
ROUND = (
    "struct<round_number:int,winner_side:string,method:string,score_team1:int,score_team2:int,winner_team_id:bigint,"
    "winner_team_short:string,winner_team_name:string>"
)
DDL = {
    "events": "page int, id bigint, name string, status string, region string, start_date date, end_date date, prize string, fetch_seq bigint",
    "matches": "event_id bigint, match_id bigint, status string",
    "series": (
        "fetch_seq bigint, match_id bigint, event string, event_phase string, status_note string, best_of string, date date, patch string, "
        f"teams array<struct<id:bigint,name:string,short:string,country:string,score:int>>, picks {ACTION}, bans {ACTION}, "
        f"remaining {ACTION}, map_actions {ACTION}"
    ),
    "series_maps": (
        f"fetch_seq bigint, match_id bigint, maps array<struct<game_id:string,map_name:string,players:array<{PLAYER}>,"
        f"teams:array<{TEAM}>,rounds:array<{ROUND}>>>"
    ),
    "standings": "fetch_seq bigint, event_id bigint, stage_path string, place string, team_id bigint, team_name string",
    "team_info": "fetch_seq bigint, team_id bigint, name string",
    "roster": "fetch_seq bigint, team_id bigint, members array<struct<player_id:bigint,ign:string,role:string>>",
    "placements": "fetch_seq bigint, team_id bigint, event_id bigint, place string",
    "transactions": "fetch_seq bigint, team_id bigint, player_id bigint, action string, date date",
    "profiles": "fetch_seq bigint, player_id bigint, handle string",
    "agent_stats": "fetch_seq bigint, player_id bigint, agent string, kills int, rating double",
}


def player(name, pid, team_id=1, kills=10, agents=("x",)):
    return (name, pid, "t", team_id, list(agents), 1.0, 200, kills, 5, 3, 0.5, 100.0, 0.2, 1, 1)


def side(team_id, won):
    return (team_id, f"t{team_id}", "t", 13 if won else 7, 6, 7, won)


def landing(spark):
    day = dt.date(2025, 3, 1)
    pair = [(1, "t1", "a", None, 2), (2, "t2", "b", None, 1)]
    data = {
        "events": [
            (1, 9, "Masters One", "completed", "EU", day, None, None, 1),
            (1, 8, "Pacific Promo", "completed", "EU", day, None, None, 2),
            (2, 7, "Open", "completed", "EU", dt.date(2024, 1, 1), None, None, 3),
            (3, 6, "Masters Late", "completed", "EU", day, None, None, 4),
        ],
        "matches": [(9, 100, "Completed"), (9, 101, "completed"), (9, 102, "live"), (8, 103, "completed"), (9, 104, "completed")],
        "series": [
            (1, 100, "Masters One", "f", "n", "3", day, "p", pair, [("t1", "M")], [("t2", "N")], [(None, "O")], None),
            # replaced by a later fetch
            (0, 100, "Masters One", "old", "n", "3", day, "p", pair, None, None, None, None),
            # no phase: quarantined, but its children count
            (2, 101, "Masters One", None, "n", "3", day, "p", pair, None, None, None, None),
            # one side only: missing
            (3, 104, "Masters One", "f", "n", "3", day, "p", pair[:1], None, None, None, None),
            (4, 103, "Pacific Promo", "f", "n", "3", day, "p", pair, None, None, None, None),
        ],
        "series_maps": [
            (
                1,
                100,
                [
                    ("11", "M", [player("p1", 5), player("p2", 6, 2), player(" ", 0)], [side(1, True), side(2, False)], [(1, "att", "e", 1, 0, 1, "a", "t1"), (None, "def", "e", 1, 1, 2, "b", "t2")]),
                    ("12", "N", [player("p1", 5, kills=-1)], [side(1, True)], None),
                ],
            ),
            (2, 101, [("TBD", "M", [player("p1", 5)], None, None)]),
            (3, 104, [("99", "M", [player("p9", 99)], None, None)]),
        ],
        "standings": [(1, 9, "main", "1st / 2nd", 1, "t1"), (2, 9, "side", "1st / 2nd", 2, "t2"), (3, 8, "main", "1st", 3, "t3"), (4, 9, "main", None, 4, "t4")],
        "team_info": [(1, 1, "one"), (2, 2, "two"), (3, 3, "three")],
        "roster": [(1, 1, [(5, "p1", "player"), (7, "px", None)]), (2, 2, [(6, "p2", None)])],
        "placements": [(1, 1, 9, "1st"), (2, 3, 9, "2nd")],
        "transactions": [(1, 1, 5, "join", day), (2, 1, 5, "leave", day), (3, 1, 6, "join", None)],
        "profiles": [(1, 5, "h5"), (2, 6, "h6"), (3, 99, "h99")],
        "agent_stats": [(1, 5, "x", 10, 1.0), (2, 5, None, 1, 1.0), (3, 99, "x", 1, 1.0)],
    }
    return Landing(**{name: spark.createDataFrame(data[name], DDL[name]) for name in DDL})


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    made = jobs.Lake(str(tmp_path_factory.mktemp("lake")), silver="t_silver", gold="t_gold", run_ts="20250401T000000")
    counts = jobs.run_backfill(spark, landing(spark), made)
    return made, counts


def test_backfill_counts(lake):
    _, counts = lake
    assert counts == {
        "events_total": 3, "events_in_scope": 1, "events_skipped": 2, "events_valid": 1, "events_invalid": 0,
        "series_valid": 2, "series_invalid": 1, "series_missing": 1, "series_skipped": 0,
        "map_picks_bans_valid": 2, "map_picks_bans_invalid": 1,
        "player_stats_valid": 3, "player_stats_invalid": 2,
        "map_scores_valid": 1, "map_scores_invalid": 0, "round_results_valid": 1, "round_results_invalid": 1,
        "event_standings_valid": 3, "team_info_valid": 2, "team_roster_valid": 1, "team_placements_valid": 1,
        "team_transactions_valid": 3, "player_profiles_valid": 2, "player_agent_stats_valid": 2,
    }


def test_backfill_records(spark, lake):
    root = lake[0].bronze
    series = read_keyed(spark, root, "series")
    assert rows(series.select("record_key", "event_phase", "team2.team_id")) == [("100", "f", 2)]
    keys = {t: {r[0] for r in read_keyed(spark, root, t).select("record_key").collect()} for t in (
        "player_stats", "round_results", "event_standings", "team_transactions", "player_agent_stats", "map_picks_bans")}
    assert keys["player_stats"] == {"100_0_p1", "100_0_p2", "101_0_p1"}
    assert keys["round_results"] == {"100_0_1"}  # a null number is rejected
    assert keys["event_standings"] == {"9_1st___2nd", "9_None"}
    assert keys["team_transactions"] == {"1_5_2025-03-01", "1_6_None"}
    assert keys["player_agent_stats"] == {"5_x", "5_None"}
    assert keys["map_picks_bans"] == {"100_pick_0", "100_ban_1"}  # a null team is rejected
    standing = read_keyed(spark, root, "event_standings").where("record_key = '9_1st___2nd'").first()
    assert standing.stage_path == "side"  # a later stage overwrites the same place
    roster = read_keyed(spark, root, "team_roster").first()
    assert (roster.record_key, [m.ign for m in roster.members], roster.members[0].is_captain) == ("1", ["p1"], False)


def test_backfill_quarantine(spark, lake):
    quarantine = spark.read.json(f"{lake[0].bronze}/quarantine/player_stats/run_ts=20250401T000000")
    got = {r.record_key: (json.loads(r.original_payload)["kills"], r.validation_errors) for r in quarantine.collect()}
    assert got == {
        "100_0_unknown_20250401T000000": (10, ["player_name: must not be blank"]),
        "100_1_unknown_20250401T000000": (-1, ["kills: must not be negative"]),
    }


def test_second_backfill_does_nothing_and_a_resume_skips_known_matches(spark, lake):
    made, _ = lake
    assert jobs.run_backfill(spark, landing(spark), made) == {}
    resumed = jobs.Lake(made.root, made.silver, made.gold, run_ts="20250402T000000")
    counts = jobs.ingest(spark, landing(spark), resumed)
    # match 100 is known; 101 was quarantined and 104 missing, so both are tried again
    assert (counts["series_skipped"], counts["series_missing"], counts["series_valid"], counts["series_invalid"]) == (1, 1, 0, 1)
    assert (counts["team_info_valid"], counts["player_profiles_valid"]) == (0, 0)
    stats = read_keyed(spark, made.bronze, "player_stats")
    assert stats.count() == 3  # one row per key over both runs


def tables(spark, database, names):
    out = {}
    for name in names:
        if spark.catalog.tableExists(f"{database}.{name}"):
            df = spark.table(f"{database}.{name}")
            out[name] = sorted(str(tuple(r)) for r in df.select(*sorted(df.columns)).collect())
    return out


def test_silver_and_gold_can_be_rerun(spark, lake):
    made, _ = lake
    first = jobs.run_silver(spark, made), jobs.run_gold(spark, made)
    before = tables(spark, made.silver, SILVER), tables(spark, made.gold, GOLD)
    second = jobs.run_silver(spark, made), jobs.run_gold(spark, made)
    assert first == second and before == (tables(spark, made.silver, SILVER), tables(spark, made.gold, GOLD))
    silver_counts, gold_counts = first
    assert silver_counts["quarantined"] == 3  # a game id, a transaction date and an agent are missing
    assert {t: n for t, n in silver_counts.items() if n == 0} == {}
    assert set(gold_counts) == set(GOLD)
    standing = spark.table(f"{made.gold}.team_standings").where("team_id = 1").first()
    assert (standing.event_id, standing.matches_won, standing.maps_won) == (9, 1, 2)
    assert dict(spark.table(f"{made.gold}.team_standings").dtypes)["event_id"] == "bigint"
    single = jobs.Lake(made.root, "t_single", "t_gold1", run_ts=made.run_ts)
    assert jobs.run_silver_single_pass(spark, single) == silver_counts
    assert tables(spark, "t_single", SILVER) == before[0]


def test_legacy_job(spark, lake):
    made = jobs.Lake(lake[0].root, "t_legacy", "t_gold2", run_ts="20250401T000000")
    counts = jobs.run_legacy(spark, made)
    assert counts["player_stats_read"] == 3 and counts["fact_player_stats_written"] == 2 and counts["pk_violations"] == 1
    row = spark.table("t_legacy.fact_player_stats").where("player_id = 5").first()
    assert (row.event_name, row.region, row.team1_name) == ("Masters One", "EU", "t1")


def test_jobs_from_json_documents(spark, tmp_path):
    root = tmp_path / "bronze"
    files = {
        "events/raw/9.json": {"event_id": 9, "name": "E", "status": "completed", "region": "EU"},
        "series/raw/1.json": {"match_id": 1, "event_name": "E", "team1": {"name": "a", "team_id": 1, "series_score": 2}, "team2": {"name": "b", "team_id": 2, "series_score": 0}},
        "player_stats/raw/1_0_A/B.json": {"match_id": 1, "map_index": 0, "game_id": "11", "player_id": 5, "player_name": "A/B", "agents": ["x"], "map_name": ""},
        "team_roster/raw/1.json": [{"team_id": 1, "player_id": 5}, {"team_id": 1, "player_id": None}],
        "team_info/raw/1.json": {"team_id": 1, "name": "one", "is_active": True},
    }
    for key, value in files.items():
        path = root / key
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps(value))
    made = jobs.Lake(str(tmp_path), "t_json", "t_json_gold", bronze_format="json", run_ts="20250401T000000")
    counts = jobs.run_silver(spark, made)
    assert (counts["dim_team_roster"], counts["quarantined"], counts["fact_player_stats"], counts["fact_map_scores"]) == (1, 1, 1, 0)
    assert not spark.catalog.tableExists("t_json.fact_map_scores")  # empty source: not written
    stat = spark.table("t_json.fact_player_stats").first()
    assert (stat.event_id, stat.map_name) == (9, None)  # empty text in a partition column reads back as null
    gold_counts = jobs.run_gold(spark, made)
    # tables that need map scores are skipped, the others are built
    assert set(gold_counts) == {"player_performance", "player_map_performance", "agent_player_affinity", "team_standings"}
    assert jobs.run_legacy(spark, jobs.Lake(str(tmp_path), "t_json_l", "x", "json", run_ts="20250401T000000"))["fact_series_written"] == 1


def test_children_of_a_series_without_two_sides_are_left_out(spark):
    made = landing(spark)
    wanted = spark.createDataFrame([(100,), (101,), (104,)], "match_id bigint")
    usable = bronze.usable_series(made.series, wanted)
    assert {r[0] for r in rows(usable.select("match_id"))} == {100, 101}
    maps = bronze.maps_of(made.series_maps, usable)
    assert {r[0] for r in rows(bronze.player_ids(maps))} == {5, 6}
    scores = last_accepted(bronze.map_score_attempts(maps))
    assert rows(scores.select("record_key", "team2_is_winner")) == [("100_0", False)]


def test_map_attempts_read_only_their_part_of_the_payload(spark, tmp_path):
    landing(spark).series_maps.write.parquet(str(tmp_path / "maps"))
    maps = spark.read.parquet(str(tmp_path / "maps"))
    schema = lambda df: df._jdf.queryExecution().executedPlan().toString().split("ReadSchema:")[1]
    assert "players" not in schema(bronze.map_score_attempts(maps)) and "rounds" not in schema(bronze.map_score_attempts(maps))
    assert "players" not in schema(bronze.round_attempts(maps)) and "teams" not in schema(bronze.round_attempts(maps))
    assert "agents" not in schema(bronze.player_ids(maps))


def test_publish_keeps_the_old_table_on_failure_and_on_empty(spark, tmp_path):
    ensure_database(spark, "t_pub")
    df = spark.createDataFrame([(1, None, "x"), (2, 7, "")], "id bigint, event_id bigint, region string")
    assert publish(spark, "t_pub.t", df, ["event_id"]) == 2
    assert publish(spark, "t_pub.t", df.where("id > 5"), ["event_id"]) == 0
    with pytest.raises(Exception):
        publish(spark, "t_pub.t", df.withColumn("id", F.col("region").cast("bigint")), ["event_id"])
    got = spark.table("t_pub.t").select("id", "event_id", "region")
    assert rows(got, "id") == [(1, None, "x"), (2, 7, "")] and dict(got.dtypes)["event_id"] == "bigint"
    # a table may be replaced from itself
    assert publish(spark, "t_pub.t", spark.table("t_pub.t").where("id = 1"), ["event_id"]) == 1
    assert spark.table("t_pub.t").count() == 1


def test_publish_takes_over_a_managed_table(spark):
    ensure_database(spark, "t_managed")
    spark.range(5).write.mode("overwrite").saveAsTable("t_managed.t")
    assert publish(spark, "t_managed.t", spark.table("t_managed.t").where("id < 2")) == 2
    assert spark.table("t_managed.t").count() == 2


def test_reset_drops_only_registered_tables(spark):
    for name in ("fact_series", "match_summary", "other"):
        ensure_database(spark, "t_reset")
        publish(spark, f"t_reset.{name}", spark.range(1))
    assert sorted(reset(spark, "t_reset", "t_reset")) == ["t_reset.fact_series", "t_reset.match_summary"]
    assert reset(spark, "t_reset", "t_reset") == [] and spark.catalog.tableExists("t_reset.other")


def test_hot_partition_value_is_split_over_files(spark, tmp_path):
    """A value that holds nearly all rows must not become one task."""
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16KB"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    df = spark.range(0, 60000, 1, 8).select(F.when(F.col("id") % 20 == 0, F.col("id") % 7).otherwise(99).alias("event_id"), "id", F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    spread_for_write(df, ["event_id"]).write.partitionBy("event_id").parquet(str(tmp_path / "t"))
    assert len(list((tmp_path / "t" / "event_id=99").glob("*.parquet"))) > 4
    for key in settings:
        spark.conf.unset(key)


def test_hot_match_is_split_in_the_context_join(spark):
    """Adaptive execution splits a match that holds most facts."""
    from duelake.operators.joins import attach

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    facts = spark.range(0, 60000, 1, 8).select(F.when(F.col("id") % 3 != 0, F.col("id") % 500).otherwise(7).alias("match_id"), "id", F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    lookup = spark.range(500).select(F.col("id").alias("match_id"), F.lit(1).alias("event_id"))
    joined = attach(facts, lookup)
    joined.write.format("noop").mode("overwrite").save()
    result = joined.select("id", "event_id")
    assert len(result.collect()) == 60000
    assert "skew=true" in result._jdf.queryExecution().executedPlan().toString()
    for key in settings:
        spark.conf.unset(key)


def test_runs_that_failed_half_way_and_runs_that_are_repeated(spark, tmp_path):
    """What a failed write leaves is no run, and a run done twice holds what it held."""
    made = jobs.Lake(str(tmp_path / "lake"), run_ts="20250401T000000")
    (tmp_path / "lake" / "bronze" / "series" / "raw" / "run_ts=20240101T000000" / "_temporary").mkdir(parents=True)
    first = jobs.run_backfill(spark, landing(spark), made)
    assert first["series_valid"] > 0
    kept = {t: sorted(r[0] for r in read_keyed(spark, made.bronze, t).select("record_key").collect()) for t in ("series", "player_stats")}
    again = jobs.ingest(spark, landing(spark), made)
    assert again["series_valid"] == first["series_valid"]
    assert kept == {t: sorted(r[0] for r in read_keyed(spark, made.bronze, t).select("record_key").collect()) for t in kept}


def run_keys(spark, root):
    types = ("events", "series", "map_picks_bans", "player_stats", "map_scores", "round_results", "event_standings", "team_info",
             "team_roster", "team_placements", "team_transactions", "player_profiles", "player_agent_stats")
    found = {t: read_keyed(spark, root, t) for t in types}
    return {t: sorted(r[0] for r in df.select("record_key").collect()) for t, df in found.items() if df is not None}


def test_a_repeat_that_fails_leaves_the_committed_run(spark, tmp_path):
    from dataclasses import replace

    made = jobs.Lake(str(tmp_path), run_ts="20250401T000000")
    good = landing(spark)
    jobs.run_backfill(spark, good, made)
    before = run_keys(spark, made.bronze)
    assert len(before) == 13 and len(before["player_stats"]) == 3
    broken = replace(good, profiles=good.profiles.withColumn("handle", F.raise_error(F.lit("lost")).cast("string")))
    with pytest.raises(Exception, match="lost"):
        jobs.ingest(spark, broken, made)
    assert run_keys(spark, made.bronze) == before
    later = replace(made, run_ts="20250402T000000")
    assert jobs.run_backfill(spark, good, later) == {}
    jobs.ingest(spark, good, later)
    assert run_keys(spark, made.bronze) == before
    # what the failed attempt left is no part of the state and can be removed
    assert commits.sweep(spark, made.bronze, list(before)) > 0
    assert run_keys(spark, made.bronze) == before and commits.sweep(spark, made.bronze, list(before)) == 0


def test_a_repeat_takes_the_place_of_its_run_at_once(spark, tmp_path):
    root = str(tmp_path)
    for kind in ("a", "b"):
        write_keyed(spark.createDataFrame([("1", 1)], "record_key string, v int"), root, kind, "r1")
    assert set(commits.attempts(spark, root, "a")) == {"r1"}
    commits.commit(spark, root, "r1", {"a": commits.new_attempt()})
    # the new manifest names the types of the repeat only
    assert commits.attempts(spark, root, "b") == {} and len(commits.committed(spark, root)) == 1
    folder = tmp_path / "commits" / "run_ts=r1"
    names = sorted(p.name for p in folder.iterdir() if p.suffix == ".json")
    with pytest.raises(FileExistsError):
        write_new(spark, f"{folder}/{names[-1]}", "{}")
    assert sorted(p.name for p in folder.iterdir() if p.suffix == ".json") == names
    assert [p for p in folder.iterdir() if ".json." in p.name and not p.name.endswith(".crc")] == []


def test_snapshots_serve_the_runs_since(spark, tmp_path):
    root = str(tmp_path)
    record = lambda *rows: spark.createDataFrame(list(rows), "record_key string, v int")
    read = lambda **more: rows(read_keyed(spark, root, "t", **more), "record_key")
    assert compact_runs(spark, root, "t") is None
    write_keyed(record(("a", 1), ("b", 1)), root, "t", "r1")
    write_keyed(record(("b", 2), ("c", 2)), root, "t", "r2")
    assert compact_runs(spark, root, "t").runs.keys() == {"r1", "r2"}
    assert read() == [("a", 1), ("b", 2), ("c", 2)]
    write_keyed(record(("a", 3), ("d", 3)), root, "t", "r3")
    plan = read_keyed(spark, root, "t")._jdf.queryExecution().optimizedPlan().toString()
    assert "snapshot" in read_keyed(spark, root, "t").inputFiles()[0] + " ".join(read_keyed(spark, root, "t").inputFiles()) and "LeftAnti" in plan
    assert read() == [("a", 3), ("b", 2), ("c", 2), ("d", 3)]
    assert read(without_run="r3") == [("a", 1), ("b", 2), ("c", 2)]
    # a run of the snapshot that is left out or was repeated, and a run older than it: all runs are compared again
    assert read(without_run="r2") == [("a", 3), ("b", 1), ("d", 3)]
    write_keyed(record(("b", 9)), root, "t", "r2")
    assert read() == [("a", 3), ("b", 9), ("d", 3)]
    compact_runs(spark, root, "t")
    write_keyed(record(("a", 0), ("z", 0)), root, "t", "r0")
    assert read() == [("a", 3), ("b", 9), ("d", 3), ("z", 0)]


def test_json_lake_holds_what_the_keyed_lake_holds(spark, lake, tmp_path):
    objects = jobs.Lake(str(tmp_path), "t_objects", "t_objects_gold", bronze_format="json", run_ts="20250401T000000")
    counts = jobs.run_backfill(spark, landing(spark), objects)
    assert counts == lake[1]
    assert json.loads((tmp_path / "bronze" / "team_roster" / "raw" / "1.json").read_text())[0]["ign"] == "p1"
    assert json.loads((tmp_path / "bronze" / "series" / "raw" / "100.json").read_text())["match_date"] == "2025-03-01"
    assert jobs.run_backfill(spark, landing(spark), objects) == {}
    keyed = jobs.Lake(str(tmp_path / "keyed"), "t_merged", "x", run_ts="20250401T000000")
    jobs.keyed_from_objects(spark, objects, keyed)
    assert run_keys(spark, keyed.bronze) == run_keys(spark, lake[0].bronze)
    from dataclasses import replace

    plain = replace(lake[0], silver="t_plain")
    want = jobs.run_silver(spark, plain)
    for other in (objects, keyed):
        assert jobs.run_silver(spark, other) == want
        assert tables(spark, other.silver, SILVER) == tables(spark, "t_plain", SILVER)


def test_each_source_is_evaluated_once_for_a_table_and_its_violations(spark, lake, monkeypatch):
    """Rows pass a counter on their way from bronze: every job reads each source once (series: staged)."""
    from dataclasses import replace

    made = replace(lake[0], silver="t_once")
    seen = {t: spark.sparkContext.accumulator(0) for t in jobs.RECORD_TYPES}
    plain = jobs.Lake.raw

    def counting(self, session, *types):
        def watched(record_type, df):
            counter = seen[record_type]

            def run(batches):
                for batch in batches:
                    counter.add(batch.num_rows)
                    yield batch

            return df.mapInArrow(run, df.schema)

        return {t: watched(t, df) for t, df in plain(self, session, *types).items()}

    monkeypatch.setattr(jobs.Lake, "raw", counting)
    sizes = {t: df.count() for t, df in plain(made, spark, *jobs.RECORD_TYPES).items()}
    jobs.run_silver_single_pass(spark, made)
    assert {t: c.value for t, c in seen.items()} == sizes
    jobs.run_dims(spark, made)
    assert all(seen[SILVER[t].source].value == 2 * sizes[SILVER[t].source] for t in jobs.DIMS)


def test_flagged_frames_equal_the_two_sides(spark):
    df = spark.createDataFrame([(1, "a", 1, "x"), (1, "a", 2, "y"), (None, "a", 1, "z"), (None, "a", 1, "z"), (2, None, 5, "")], "k int, l string, o int, v string")
    split, flagged = pk_gate(df, ["k", "l"], ["o"]), pk_flagged(df, ["k", "l"], ["o"])
    assert rows(flagged.where(~F.col(VIOLATION)).drop(VIOLATION)) == rows(split.clean)
    assert sorted(map(str, rows(flagged.where(VIOLATION).drop(VIOLATION)))) == sorted(map(str, rows(split.violations)))
    ensure_database(spark, "t_flag")
    written, violations, bad = publish_flagged(spark, "t_flag.t", flagged, ["l"])
    assert (written, bad) == (1, 3) and rows(spark.table("t_flag.t").select("k", "l", "o", "v")) == [(1, "a", 2, "y")]
    assert sorted(map(str, rows(violations))) == sorted(map(str, rows(split.violations)))
    assert publish_flagged(spark, "t_flag.t", flagged.where(VIOLATION), ["l"])[0] == 0 and spark.table("t_flag.t").count() == 1
    assert publish_flagged(spark, "t_flag.t", flagged.where(VIOLATION), ["l"], skip_empty=False)[0] == 0 and spark.table("t_flag.t").count() == 0


def test_a_reader_never_misses_a_table_that_is_replaced(spark):
    from threading import Event, Thread
    from time import sleep

    ensure_database(spark, "t_swap")
    df = spark.range(300).select("id", (F.col("id") % 3).alias("part"))
    publish(spark, "t_swap.t", df, ["part"])
    stop, found = Event(), []

    def read():
        while not stop.is_set():
            try:
                found.append(spark.table("t_swap.t").count())
            except Exception as problem:
                found.append(str(problem)[:200])

    reader = Thread(target=read)
    reader.start()
    for _ in range(5):
        # a version stays until the switch after the next, so a read may begin before one switch and end after it
        seen = len(found)
        while len(found) < seen + 2:
            sleep(0.01)
        publish(spark, "t_swap.t", df, ["part"])
    stop.set()
    reader.join()
    assert set(found) == {300} and len(found) >= 10
    # other columns: created anew
    publish(spark, "t_swap.t", df.withColumn("more", F.lit(1)), ["part"])
    assert spark.table("t_swap.t").where("part = 1 and more = 1").count() == 100


def test_published_order_can_be_read_back(spark):
    ensure_database(spark, "t_order")
    df = spark.range(0, 5000, 1, 7).select("id", (F.col("id") % 4).alias("part"), F.when(F.col("id") % 11 != 0, F.col("id") % 90).alias("score"))
    for split in ([], ["part"]):
        publish(spark, "t_order.t", df, split, [("score", True)], ties=["id"])
        out = read_in_order(spark, "t_order.t", split).collect()
        groups = {}
        for r in sorted(out, key=lambda r: r.position):
            groups.setdefault(r.part if split else 0, []).append((r.position, r.id, r.score))
        for got in groups.values():
            want = sorted(got, key=lambda r: (r[2] is None, -(r[2] or 0), r[1]))
            assert got == want and [p for p, _, _ in got] == list(range(1, len(got) + 1))


def test_catalogue_publish_runs_the_plan_once(spark, monkeypatch):
    """Of a name with a catalog part the rows are staged, counted and handed to the catalog's replace."""
    from duelake.sinks import tables as sink

    handed = []
    monkeypatch.setattr(sink, "_replace_in_catalog", lambda session, name, df, parts: handed.append((name, df.count(), tuple(parts))))
    calls = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            calls.add(batch.num_rows)
            yield batch

    df = spark.range(10).mapInArrow(run, "id long")
    assert publish(spark, "cat.db.t", df, ["id"]) == 10 and publish(spark, "cat.db.t", df.where("id > 99")) == 0
    assert handed == [("cat.db.t", 10, ("id",))] and calls.value == 20


def test_a_table_split_by_events_has_files_by_its_rows_and_not_by_its_events(spark, tmp_path):
    split = SILVER["fact_event_standings"].partitions
    spark.sql(f"CREATE DATABASE IF NOT EXISTS t_many LOCATION '{tmp_path}/db'")
    event = F.when(F.col("id") % 1000 != 7, F.col("id") % 1000).alias("event_id")
    flagged = spark.range(0, 5000, 1, 4).select(event, "id", (F.col("id") % 1000 == 8).alias(VIOLATION))
    clean, violations, bad = publish_flagged(spark, "t_many.fact", flagged, split, clustered=clustered(split))
    assert (clean, bad, violations.count()) == (4995, 5, 5)
    assert len([*(tmp_path / "db").rglob("*.parquet")]) < 50  # a folder for each event made a thousand
    expected = [tuple(r) for r in flagged.where(~F.col(VIOLATION)).select("id", "event_id").orderBy("id").collect()]
    assert rows(spark.table("t_many.fact"), "id") == expected
    named = {c.name for c in spark.catalog.listColumns("t_many.fact") if c.isCluster}
    assert named == set(split) and spark.table("t_many.fact").columns == ["id", "event_id"]
    # The other way of writing takes the table over, and back.
    for by_cluster in (False, True):
        assert publish(spark, "t_many.fact", flagged.drop(VIOLATION), split, clustered=by_cluster) == 5000
        assert spark.table("t_many.fact").count() == 5000


def test_order_of_a_clustered_table_is_counted_within_its_values(spark):
    ensure_database(spark, "t_many_order")
    value = F.when(F.col("id") % 40 != 0, F.col("id") % 40).alias("event_id")
    df = spark.range(0, 4000, 1, 4).select("id", value, F.lit("").alias("text"))
    assert publish(spark, "t_many_order.t", df, ["event_id", "text"], [("id", True)], clustered=True) == 4000
    got = read_in_order(spark, "t_many_order.t", ["event_id", "text"])
    wrong = got.where(F.col("position") != 100 - F.floor(F.col("id") / 40))
    assert got.count() == 4000 and wrong.count() == 0
    assert got.where(F.col("text").isNotNull()).count() == 0  # as a folder's name would have it


def test_a_query_builds_only_the_layers_it_reads(monkeypatch):
    from types import SimpleNamespace

    from workload import job_queries

    done = []
    monkeypatch.setattr(job_queries, "lake", lambda s: "lake")
    monkeypatch.setattr(job_queries, "landing", lambda s: None)
    monkeypatch.setattr(job_queries, "_LAKES", {})
    for step in ("run_backfill", "run_silver", "run_gold"):
        monkeypatch.setattr(job_queries.jobs, step, lambda *_, step=step: done.append(step) or {"n": 1})
    s = SimpleNamespace(spark=SimpleNamespace(sparkContext=SimpleNamespace(applicationId="app")), directory="tables")
    assert job_queries.backfilled(s) == ("lake", {"n": 1}) and done == ["run_backfill"]
    assert job_queries.with_silver(s) == "lake" and done == ["run_backfill", "run_silver"]
    assert job_queries.finished(s) == job_queries.finished(s) == "lake"
    assert done == ["run_backfill", "run_silver", "run_gold"]


def test_payloads_are_built_by_many_tasks(spark, tmp_path):
    from workload import payloads
    from workload.shapes import Shapes

    at = str(tmp_path)
    tables = {
        "region": "select 0L r_regionkey, 'R' r_name",
        "nation": "select 0L n_nationkey, 'N' n_name, 0L n_regionkey",
        "customer": "select id c_custkey, 0L c_nationkey from range(20)",
        "orders": "select id o_orderkey, id % 20 o_custkey, timestamp'2024-01-01' o_orderdate, 'high' o_orderpriority, 'F' o_orderstatus from range(500)",
    }
    for name, text in tables.items():
        spark.sql(text).coalesce(1).write.parquet(f"{at}/{name}.parquet")
    for build in (payloads.series_payloads, payloads.map_payloads):
        built = build(Shapes(spark, at))
        assert sorted(r.match_id for r in built.select("match_id").collect()) == list(range(500))
        # The table is one file, of one row group: one task built all of it.
        assert built.select(F.spark_partition_id().alias("p")).distinct().count() > 8


def test_objects_are_written_by_many_tasks(spark, tmp_path):
    from duelake.session import many_tasks
    from duelake.sinks.records import write_objects

    records = spark.range(300).selectExpr("cast(id as string) record_key", "id event_id").coalesce(1)
    sc = spark.sparkContext
    sc.setJobGroup("objects", "objects")
    try:
        assert write_objects(records, str(tmp_path), "events") == 300
        tracker = sc.statusTracker()
        stages = [tracker.getStageInfo(n) for j in tracker.getJobIdsForGroup("objects") for n in tracker.getJobInfo(j).stageIds]
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    # Adaptive execution would let one task write all of them, by their few bytes.
    assert max(s.numTasks for s in stages if s) == many_tasks(spark)
    assert len(list((tmp_path / "events" / "raw").glob("*.json"))) == 300


def test_a_single_run_with_distinct_keys_is_read_as_it_is(spark, lake, tmp_path):
    def windows(df):
        return "Window" in df._jdf.queryExecution().optimizedPlan().toString()

    made = read_keyed(spark, lake[0].bronze, "series")
    assert not windows(made) and made.count() == made.select("record_key").distinct().count()
    # A run that was added by hand may hold a key twice, a second run may hold the first one's keys: both are compared.
    records = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "record_key string, v int")
    write_keyed(records, str(tmp_path), "series", "1")
    assert sorted(r.record_key for r in read_keyed(spark, str(tmp_path), "series").collect()) == ["a", "b"]
    commits.commit(spark, str(tmp_path), "1", {"series": commits.attempts(spark, str(tmp_path), "series")["1"]}, distinct=["series"])
    write_keyed(records.where("record_key = 'b'"), str(tmp_path), "series", "2")
    assert windows(read_keyed(spark, str(tmp_path), "series"))


def test_a_job_leaves_nothing_that_it_staged(spark, tmp_path, monkeypatch):
    from dataclasses import replace
    from pathlib import Path

    from duelake.record_types import QUARANTINED

    made = jobs.Lake(str(tmp_path), "t_tidy", "t_tidy_gold", run_ts="20250401T000000")
    flagged = []
    real = jobs.stage_flagged
    monkeypatch.setattr(jobs, "stage_flagged", lambda df, path: flagged.append(path.rpartition("/")[2]) or real(df, path))
    staged = Path(made.staging(spark).removeprefix("file:"))
    jobs.run_backfill(spark, landing(spark), made)
    assert not list(staged.rglob("*.parquet"))
    # Of the others only the last record of each key is wanted.
    assert sorted(flagged) == sorted(QUARANTINED)
    jobs.run_silver(spark, made)
    assert not list(staged.rglob("*.parquet"))
    broken = landing(spark)
    with pytest.raises(Exception, match="lost"):
        jobs.ingest(spark, replace(broken, profiles=broken.profiles.withColumn("handle", F.raise_error(F.lit("lost")).cast("string"))), made)
    assert not list(staged.rglob("*.parquet"))
    rejected = tmp_path / "bronze" / "quarantine" / "player_stats"
    assert list(rejected.rglob("*.json.gz")) and not list(rejected.rglob("*.json"))


def test_a_type_without_a_valid_record_lands_nothing(spark, tmp_path):
    from dataclasses import replace

    made = jobs.Lake(str(tmp_path), run_ts="20250401T000000")
    bad = landing(spark)
    counts = jobs.ingest(spark, replace(bad, profiles=bad.profiles.withColumn("aliases", F.lit(None).cast("array<string>"))), made)
    assert counts["player_profiles_valid"] == 0 and counts["team_info_valid"] > 0
    assert read_keyed(spark, made.bronze, "player_profiles") is None
    assert not list((tmp_path / "bronze" / "player_profiles").rglob("*.parquet"))


def test_shuffle_files_go_with_the_query(spark):
    import time

    from duelake.session import shuffles_dropped

    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {str(name) for name in found.mkString(chr(10)).split(chr(10)) if "shuffle" in name}

    before = files()
    query = spark.range(1000).repartition(3).groupBy((F.col("id") % 7).alias("k"))
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(key)
    with shuffles_dropped(spark):
        assert query.count().count() == 7
    assert spark.conf.get(key) == setting
    for _ in range(50):
        if files() <= before:
            return
        time.sleep(0.1)
    raise AssertionError("shuffle files stay")
