import datetime as dt

import pytest
from pyspark.sql import functions as F

from duelake.plans import silver
from duelake.record_types import raw_schema
from duelake.sources.landed import with_origin
from conftest import rows


def raw(spark, record_type, *records):
    """Raw frame from dicts; ``k`` is the object key, ``p`` the array position."""
    schema = with_origin(raw_schema(record_type))
    data = []
    for i, r in enumerate(records):
        values = {**r, "_key": r.get("k", f"{i:03d}.json"), "_pos": r.get("p", 0), "ingested_at": "2025-01-01"}
        data.append(tuple(values.get(f.name) for f in schema.fields))
    return spark.createDataFrame(data, schema)


def team(name=None, team_id=None, score=None):
    return (name, team_id, None, None, score)


def series(match, event="E", t1=("A", "1", "2"), t2=("B", "2", "1"), **more):
    return {
        "match_id": match,
        "event_name": event,
        "match_date": "2025-03-01",
        "team1": t1 and team(*t1),
        "team2": t2 and team(*t2),
        **more,
    }


def events(spark, *pairs):
    return silver.dim_events(raw(spark, "events", *[{"event_id": i, "name": n, "region": r} for i, n, r in pairs])).clean


def stat(match="1", game="11", player="5", **more):
    return {"match_id": match, "map_index": "0", "game_id": game, "player_id": player, "player_name": "p", **more}


def test_events_types_and_columns(spark):
    df = silver.dim_events(
        raw(spark, "events", {"event_id": "7", "name": "n", "start_date": "2025-01-02"}, {"event_id": None, "name": "x"})
    )
    assert df.clean.columns == ["event_id", "name", "status", "region", "start_date", "end_date", "prize"]
    assert rows(df.clean.select("event_id", "start_date")) == [(7, dt.date(2025, 1, 2))]
    assert rows(df.violations.select("name")) == [("x",)]


def test_key_order_decides_the_last(spark):
    # "10.json" sorts before "9.json"
    df = silver.dim_teams(
        raw(spark, "team_info", {"team_id": "1", "name": "nine", "k": "9.json"}, {"team_id": "1", "name": "ten", "k": "10.json"})
    )
    assert rows(df.clean.select("name")) == [("nine",)] and df.violations.count() == 0


def test_position_in_an_array_breaks_ties(spark):
    member = {"team_id": "1", "player_id": "5", "k": "1.json"}
    df = silver.dim_team_roster(
        raw(spark, "team_roster", {**member, "ign": "late", "p": 1}, {**member, "ign": "early"}, {"team_id": "1", "player_id": "coach"})
    )
    assert rows(df.clean.select("ign")) == [("late",)]
    assert rows(df.violations.select("team_id", "player_id")) == [(1, None)]


def test_players_keep_aliases(spark):
    df = silver.dim_players(raw(spark, "player_profiles", {"player_id": "3", "aliases": ["a", "b"]}))
    assert rows(df.clean.select("player_id", "aliases")) == [(3, ["a", "b"])]


def test_series_flattening_and_unknown_event(spark):
    split = silver.fact_series(
        raw(spark, "series", series("1"), series("2", event="nobody", t1=None)), events(spark, ("9", "E", "EU"))
    )
    assert split.clean.columns == (
        "match_id event_name event_phase status_note best_of match_date patch team1_name team1_id team1_score "
        "team2_name team2_id team2_score event_id region"
    ).split()
    assert rows(split.clean.select("match_id", "team1_id", "team1_score", "team2_name", "event_id", "region"), "match_id") == [
        (1, 1, 2, "B", 9, "EU"),
        (2, None, None, "B", None, None),
    ]


def test_duplicate_event_name_fans_out_and_collapses_to_the_later_key(spark):
    # keys "10.json" < "9.json": event 9 is the last of the two
    named = events(spark, ("10", "E", "ten"), ("9", "E", "nine"))
    split = silver.fact_series(raw(spark, "series", series("1"), series(None)), named)
    assert split.lookup.count() == 4
    assert rows(split.clean.select("event_id", "region")) == [(9, "nine")]
    assert split.violations.count() == 2
    facts = silver.fact_player_stats(raw(spark, "player_stats", stat(), stat(game="TBD")), split.lookup)
    assert rows(facts.clean.select("event_id", "region")) == [(9, "nine")]
    # the incomplete key keeps the fan-out
    assert {r[0] for r in rows(facts.violations.select("event_id"))} == {9, 10}


def test_duplicate_match_uses_the_last_series(spark):
    named = events(spark, ("1", "E1", "r1"), ("2", "E2", "r2"))
    split = silver.fact_series(
        raw(spark, "series", series("1", "E2", k="a.json"), series("1", "E1", k="b.json")), named
    )
    facts = silver.fact_map_scores(
        raw(spark, "map_scores", {"match_id": "1", "map_index": "0", "game_id": "4"}), split.lookup
    )
    assert rows(facts.clean.select("event_id", "region")) == [(1, "r1")]
    assert split.clean.count() == 1


def test_gate_before_join_equals_gate_after_join(spark):
    """Brute force on a fixture with duplicates on both sides of the join."""
    named = events(spark, ("1", "E", "r1"), ("2", "E", "r2"), ("3", "F", "r3"))
    series_rows = [series("1", "E", k="a"), series("1", "F", k="b"), series("2", "F", k="c"), series("2", "E", k="d"), series("3", "zz")]
    stats = [stat(m, g, p, kills=str(i), k=f"{i:02d}") for i, (m, g, p) in enumerate(
        [("1", "1", "1"), ("1", "1", "1"), ("2", "1", "1"), ("2", "1", None), ("3", "1", "1"), ("9", "1", "1"), ("1", "x", "1")]
    )]
    lookup = silver.fact_series(raw(spark, "series", *series_rows), named).lookup
    facts = silver.fact_player_stats(raw(spark, "player_stats", *stats), lookup)

    flat = sorted(tuple(r) for r in lookup.select("match_id", "_key", "_pos", "_event_order", "event_id").collect() if r[0] is not None and r[3] is not None)
    joined = []
    for i, s in enumerate(stats):
        match = [e for m, _, _, _, e in flat if m == int(s["match_id"])] or [None]
        game = int(s["game_id"]) if s["game_id"].isdigit() else None
        player = int(s["player_id"]) if s["player_id"] else None
        joined += [((int(s["match_id"]), game, player), i, e) for e in match]
    clean = {key: (i, e) for key, i, e in joined if None not in key}
    assert {(r.match_id, r.game_id, r.player_id): (r.kills, r.event_id) for r in facts.clean.collect()} == clean
    bad = sorted((i, e) for key, i, e in joined if None in key)
    assert sorted((r.kills, r.event_id) for r in facts.violations.collect()) == bad


def test_game_id_as_number_or_text(spark):
    lookup = silver.fact_series(raw(spark, "series", series("1")), events(spark, ("9", "E", "EU"))).lookup
    facts = silver.fact_player_stats(
        raw(spark, "player_stats", stat(game="123"), stat(game="TBD"), stat(game="124", kills="x", rating="1.5")), lookup
    )
    assert rows(facts.clean.select("game_id", "kills", "r_rating"), "game_id") == [(123, None, None), (124, None, 1.5)]
    assert rows(facts.violations.select("game_id")) == [(None,)]
    assert dict(facts.clean.dtypes)["r_rating"] == "float" and "rating" not in facts.clean.columns


def test_strict_column_fails_the_job(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        silver.dim_players(raw(spark, "player_profiles", {"player_id": "x"})).clean.collect()


def test_empty_sources_give_typed_empty_tables(spark):
    lookup = silver.fact_series(raw(spark, "series"), events(spark)).lookup
    facts = silver.fact_round_results(raw(spark, "round_results"), lookup)
    assert facts.clean.count() == 0 and dict(facts.clean.dtypes)["round_number"] == "int"


def test_meta_facts(spark):
    agent = silver.fact_player_agent_stats(
        raw(spark, "player_agent_stats", {"player_id": "1", "agent": "x", "rating": "1.5", "acs": "bad"}, {"player_id": "1"})
    )
    assert rows(agent.clean.select("r_rating", "acs")) == [(1.5, None)] and agent.violations.count() == 1
    standings = silver.fact_event_standings(
        raw(
            spark,
            "event_standings",
            {"event_id": "1", "stage_path": "a", "place": "1st"},
            {"event_id": "1", "stage_path": "b", "place": "1st"},
            {"event_id": "1", "stage_path": "b", "place": "1st", "note": "again"},
        )
    )
    assert rows(standings.clean.select("stage_path", "note"), "stage_path") == [("a", None), ("b", "again")]
    placed = silver.fact_team_placements(raw(spark, "team_placements", {"team_id": "1", "event_id": "n/a"}))
    assert placed.clean.count() == 0 and placed.violations.count() == 1
    moved = silver.fact_team_transactions(
        raw(spark, "team_transactions", {"team_id": "1", "player_id": "2", "transaction_date": "soon"})
    )
    assert rows(moved.violations.select("transaction_date")) == [(None,)]


def test_legacy_wide_table(spark):
    ev = silver.legacy_events(raw(spark, "events", {"event_id": "9", "name": "E", "region": "EU", "start_date": "2025-01-01"}))
    se = silver.legacy_series(raw(spark, "series", series("1")))
    st = silver.legacy_player_stats(raw(spark, "player_stats", stat(kills="1", k="a"), stat(kills="2", k="b"), stat(player=None)))
    wide = silver.legacy_enriched(st, se, ev)
    assert wide.clean.columns == silver.WIDE_COLUMNS and len(wide.clean.columns) == 26
    row = wide.clean.first()
    assert (row.event_id, row.team2_name, row.start_date, row.kills) == (9, "B", dt.date(2025, 1, 1), 2)
    assert wide.violations.count() == 1 and wide.series.first().event_id == 9


def test_rows_that_meet_many_are_spread_over_the_tasks(spark):
    from duelake.operators.joins import attach_all

    facts = spark.range(400).selectExpr("if(id % 50 = 0, null, id % 20) as match_id", "id as n")
    context = spark.range(4000).selectExpr("if(id % 70 = 0, null, id % 25) as match_id", "id as event_id")
    found = attach_all(facts, context)
    assert found.columns == ["match_id", "n", "event_id"]
    assert found.exceptAll(facts.join(context, "match_id", "left").select(*found.columns)).count() == 0
    assert found.count() == facts.join(context, "match_id", "left").count()
    # Few bytes come in: all rows were made by one or two tasks.
    assert found.select(F.spark_partition_id().alias("p")).distinct().count() > 8
