import datetime as dt
from decimal import Decimal

from duelake.plans import gold
from conftest import rows

SERIES = (
    "match_id bigint, event_id bigint, event_name string, region string, match_date date, best_of string, patch string, "
    "team1_id bigint, team1_name string, team1_score int, team2_id bigint, team2_name string, team2_score int"
)
MAPS = (
    "match_id bigint, game_id bigint, map_name string, team1_id bigint, team1_is_winner boolean, team1_attacker_rounds int, "
    "team1_defender_rounds int, team2_id bigint, team2_is_winner boolean, team2_attacker_rounds int, team2_defender_rounds int"
)
STATS = (
    "match_id bigint, game_id bigint, event_id bigint, region string, map_name string, player_id bigint, player_name string, "
    "team_id bigint, team_short string, agents array<string>, r_rating float, acs int, kills int, deaths int, assists int, "
    "kast float, adr float, hs_pct float, fk int, fd int"
)


def series(spark, *games):
    data = [(m, e, "E", "EU", dt.date(2025, 1, m), "3", "p", t1, f"t{t1}", s1, t2, f"t{t2}", s2) for m, e, t1, s1, t2, s2 in games]
    return spark.createDataFrame(data, SERIES)


def maps(spark, *scores):
    return spark.createDataFrame(list(scores), MAPS)


def stats(spark, *people):
    base = dict(match_id=1, game_id=11, event_id=9, region="EU", map_name="M", player_id=5, player_name="p", team_id=1,
                team_short="t", agents=["x"], r_rating=1.0, acs=200, kills=5, deaths=2, assists=1, kast=0.5, adr=100.0,
                hs_pct=0.25, fk=1, fd=1)
    names = [f.split()[0] for f in STATS.split(", ")]
    return spark.createDataFrame([tuple({**base, **p}[n] for n in names) for p in people], STATS)


def test_draws_and_unknown_scores_count_as_lost_by_both(spark):
    df = gold.team_standings(series(spark, (1, 9, 1, 1, 2, 1), (2, 9, 1, None, 2, 3), (3, 9, 1, 2, 2, 0)))
    got = {r.team_id: r for r in df.collect()}
    assert (got[1].matches_played, got[1].matches_won, got[1].matches_lost, got[1].match_win_rate) == (3, 1, 2, 0.333)
    assert (got[2].matches_won, got[2].matches_lost) == (0, 3)
    assert (got[1].maps_won, got[1].maps_lost, got[1].map_win_rate) == (3, 4, 0.429)


def test_only_unknown_scores_leave_map_rate_null(spark):
    got = {r.team_id: r for r in gold.team_standings(series(spark, (1, 9, 1, None, 2, 2))).collect()}
    assert (got[1].maps_won, got[1].maps_lost, got[1].map_win_rate) == (None, 2, None)
    assert (got[2].maps_won, got[2].maps_lost, got[2].map_win_rate) == (2, None, None)


def test_missing_side_or_event_gives_no_row(spark):
    df = gold.team_standings(series(spark, (1, 9, 1, 2, None, 0), (2, None, 1, 2, 2, 0)))
    assert rows(df.select("team_id", "matches_played")) == [(1, 1)]


def test_standings_order(spark):
    df = gold.team_standings(series(spark, (1, 9, 1, 2, 2, 0), (2, 8, 3, 2, 4, 0)))
    assert [(r.event_id, r.team_id) for r in df.collect()] == [(8, 3), (8, 4), (9, 1), (9, 2)]


def test_unpivot_reads_the_table_once(spark, tmp_path):
    series(spark, (1, 9, 1, 2, 2, 0)).write.parquet(str(tmp_path / "s"))
    plan = gold.team_standings(spark.read.parquet(str(tmp_path / "s")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "IsNotNull(event_id)" in plan and "match_date" not in plan


def test_map_performance_rules(spark):
    teams = spark.createDataFrame([(1, "one")], "team_id bigint, name string")
    df = gold.team_map_performance(
        maps(
            spark,
            (1, 11, "M", 1, True, 6, None, 2, False, 4, 5),
            (1, 12, "M", 1, None, None, None, 2, None, None, None),
            (1, 13, None, 1, True, 1, 1, 2, False, 1, 1),
            (2, 21, "N", None, True, 0, 0, 3, False, 0, 0),
        ),
        teams,
    )
    got = {(r.team_id, r.map_name): r for r in df.collect()}
    assert set(got) == {(1, "M"), (2, "M"), (3, "N")}
    one = got[(1, "M")]
    assert (one.team_name, one.maps_played, one.maps_won, one.maps_lost, one.map_win_rate) == ("one", 2, 1, 0, 0.5)
    assert (one.total_att_rounds_won, one.total_def_rounds_won, one.att_round_win_rate, one.def_round_win_rate) == (6, 0, 0.6, 0.0)
    assert got[(2, "M")].team_name is None
    assert (got[(3, "N")].att_round_win_rate, got[(3, "N")].def_round_win_rate) == (None, None)


def test_summary_winner_and_map_count(spark):
    df = gold.match_summary(
        series(spark, (1, 9, 1, 2, 2, 1), (2, 9, 1, 1, 2, 1), (3, 9, 1, None, 2, 1), (4, None, 1, 0, 2, 2)),
        maps(
            spark,
            (1, 11, "M", 1, True, 1, 1, 2, False, 1, 1),
            (1, 12, "N", 1, True, 1, 1, 2, False, 1, 1),
            (7, 71, "N", 1, True, 1, 1, 2, False, 1, 1),
        ),
    )
    assert [(r.match_id, r.winner_id, r.winner_name, r.total_maps_played) for r in df.collect()] == [
        (4, 2, "t2", 0),
        (3, None, "Draw", 0),
        (2, None, "Draw", 0),
        (1, 1, "t1", 2),
    ]
    assert dict(df.dtypes)["total_maps_played"] == "bigint" and dict(df.dtypes)["winner_id"] == "bigint"


def test_player_performance(spark):
    events = spark.createDataFrame([(9, "E")], "event_id bigint, name string")
    df = gold.player_performance(
        stats(
            spark,
            {},
            {"game_id": 12, "r_rating": None, "kills": 1, "deaths": 1},
            {"match_id": 2, "game_id": 21, "team_id": 2},
            {"player_id": None},
            {"event_id": None},
            {"event_id": 8, "deaths": 0, "fk": 0, "fd": 0},
        ),
        events,
    )
    got = {(r.event_id, r.team_id): r for r in df.collect()}
    assert set(got) == {(9, 1), (9, 2), (8, 1)}  # a change of team gives a second row
    first = got[(9, 1)]
    assert (first.event_name, first.matches_played, first.maps_played, first.avg_rating, first.total_kills) == ("E", 1, 2, 1.0, 6)
    assert (first.kd_ratio, first.fk_rate) == (2.0, 0.5)
    assert (got[(8, 1)].event_name, got[(8, 1)].kd_ratio, got[(8, 1)].fk_rate) == (None, None, None)


def test_player_map_performance_skips_unnamed_maps(spark):
    df = gold.player_map_performance(stats(spark, {}, {"map_name": None}, {"event_id": None, "game_id": 12}))
    assert rows(df.select("map_name", "maps_played", "total_kills")) == [("M", 2, 10)]


def test_agent_meta_unknown_winner_counts_as_not_won(spark):
    df = gold.agent_meta(
        stats(
            spark,
            {},
            {"game_id": 99},
            {"team_id": 77},
            {"team_id": 2},
            {"agents": None},
            {"agents": []},
            {"agents": ["x", None]},
            {"map_name": None},
        ),
        maps(spark, (1, 11, "M", 1, True, 1, 1, 2, False, 1, 1)),
    )
    # won: the first row and the one with a null second agent
    assert [(r.map_name, r.agent, r.pick_count, r.win_rate) for r in df.collect()] == [("M", "x", 5, Decimal("0.400"))]
    assert dict(df.dtypes)["win_rate"] == "decimal(5,3)"


def test_agent_affinity(spark):
    df = gold.agent_player_affinity(stats(spark, {}, {"agents": ["x", "y"]}, {"player_id": None}))
    assert [(r.agent, r.maps_played, r.total_deaths) for r in df.collect()] == [("x", 2, 4), ("y", 1, 2)]


def test_no_plan_evaluates_python(spark):
    s = stats(spark, {})
    m = maps(spark, (1, 11, "M", 1, True, 1, 1, 2, False, 1, 1))
    games = series(spark, (1, 9, 1, 2, 2, 0))
    events = spark.createDataFrame([(9, "E")], "event_id bigint, name string")
    teams = spark.createDataFrame([(1, "one")], "team_id bigint, name string")
    frames = {"fact_player_stats": s, "fact_map_scores": m, "fact_series": games, "dim_events": events, "dim_teams": teams}
    for builder, inputs in gold.BUILDERS.values():
        plan = builder(*[frames[i] for i in inputs])._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Nested" not in plan and "Cartesian" not in plan


def test_repeated_dimension_and_series_rows_count_as_a_join_before_grouping(spark):
    events = spark.createDataFrame([(9, "E"), (9, "E"), (9, "F")], "event_id bigint, name string")
    found = {r.event_name: r for r in gold.player_performance(stats(spark, {}, {"game_id": 12}), events).collect()}
    assert {n: (r.total_kills, r.maps_played, r.kd_ratio) for n, r in found.items()} == {"E": (20, 2, 2.5), "F": (10, 2, 2.5)}
    teams = spark.createDataFrame([(1, "A"), (1, "A"), (2, "B")], "team_id bigint, name string")
    sides = gold.team_map_performance(maps(spark, (1, 11, "M", 1, True, 7, 6, 2, False, 5, 3)), teams)
    assert {r.team_name: (r.maps_played, r.maps_won, r.total_att_rounds_won, r.map_win_rate) for r in sides.collect()} == {
        "A": (2, 2, 14, 1.0),
        "B": (1, 0, 5, 0.0),
    }
    twice = series(spark, (1, 9, 1, 2, 2, 0), (1, 9, 1, 2, 2, 0))
    assert gold.match_summary(twice, maps(spark, (1, 11, "M", 1, True, 7, 6, 2, False, 5, 3))).count() == 1
