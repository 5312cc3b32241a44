import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from duelake.functions.casting import lenient_casts, strict_casts
from duelake.functions.measures import rounded_mean, safe_ratio, true_share
from duelake.functions.text import path_safe, record_key
from duelake.operators.contracts import ERRORS, accepted, rejected, validate
from duelake.operators.filters import before_cutoff, not_ingested, scope_condition, unless_present
from duelake.operators.keys import distinct_ids, keep_last, pk_gate
from duelake.operators.reshape import attribute, explode_actions, explode_values
from duelake.record_types import CONTRACTS
from conftest import rows


# ---- casts ------------------------------------------------------------------


def test_lenient_cast_nulls_what_does_not_fit(spark):
    df = spark.createDataFrame([("x", "99999999999", "12.7", "7")], "a string, b string, c string, d string")
    assert rows(lenient_casts(df, dict.fromkeys("abcd", "int"))) == [(None, None, None, 7)]


def test_strict_cast_fails_on_bad_text(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        strict_casts(spark.createDataFrame([("x",)], "match_id string"), {"match_id": "bigint"}).collect()


# ---- measures -----------------------------------------------------------------


def test_ratio_is_null_over_zero_or_null(spark):
    df = spark.createDataFrame([(5, 0), (5, None), (6, 10)], "a int, b int")
    got = df.groupBy("b").agg(safe_ratio(F.sum("a"), F.sum("b")).alias("r"))
    assert {r["b"]: r["r"] for r in got.collect()} == {0: None, None: None, 10: 0.6}


def test_rounding_is_half_up(spark):
    df = spark.createDataFrame([(1.0,), (1.005,)], "v double")
    assert rows(df.agg(rounded_mean(F.lit(1.005), 2), F.round(F.avg(F.lit(0.5025)), 3))) == [(1.01, 0.503)]


@pytest.mark.parametrize("hits,total", [(1, 2001), (0, 7), (7, 7), (1, 3), (2, 3), (1, 8), (5, 9), (13, 16), (201, 400)])
def test_true_share_equals_the_decimal_mean(spark, hits, total):
    df = spark.range(total).select((F.col("id") < hits).alias("w"))
    plain = F.round(F.avg(F.when(F.col("w"), Decimal("1.0")).otherwise(Decimal("0.0"))), 3)
    ours, theirs = df.agg(true_share(F.col("w")).alias("a"), plain.alias("b")).first()
    assert ours == theirs
    if (hits, total) == (1, 2001):
        assert ours == Decimal("0.001")


def test_true_share_counts_unknown_as_false(spark):
    df = spark.createDataFrame([(True,), (None,), (False,), (None,)], "w boolean")
    assert df.agg(true_share(F.col("w"))).first()[0] == Decimal("0.250")


# ---- keys -----------------------------------------------------------------------


def test_gate_keeps_the_last_and_quarantines_only_incomplete_keys(spark):
    data = [(1, 1, "a.json", 0, "old"), (1, 1, "b.json", 0, "new"), (1, None, "c.json", 0, "bad"), (2, 1, "a.json", 1, "one")]
    df = spark.createDataFrame(data, "a int, b int, k string, p int, v string")
    split = pk_gate(df, ["a", "b"], ["k", "p"])
    assert rows(split.clean.select("a", "b", "v"), "a") == [(1, 1, "new"), (2, 1, "one")]
    assert rows(split.violations.select("v")) == [("bad",)]


def test_gate_refuses_to_guess_an_order(spark):
    with pytest.raises(ValueError):
        keep_last(spark.range(2), ["id"], [])


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 2)), max_size=30))
def test_gate_accounts_for_every_row(spark, pairs):
    data = [(a, b, i) for i, (a, b) in enumerate(pairs)]
    split = pk_gate(spark.createDataFrame(data, "a int, b int, i int"), ["a", "b"], ["i"])
    expected = {}
    for a, b, i in data:
        if a is not None:
            expected[(a, b)] = i
    assert {(a, b): i for a, b, i in rows(split.clean)} == expected
    assert split.violations.count() == sum(a is None for a, _ in pairs)


def test_keep_last_cuts_each_key_to_one_row_before_the_exchange(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = keep_last(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning(k")
    assert "WindowGroupLimit [k" in plan[exchange:] and "WindowGroupLimit [k" in plan[:exchange]


def test_hot_key_sends_one_row_per_task(spark, tmp_path):
    """A key holding most rows: the exchange carries at most one row per key and task."""
    (spark.range(0, 40000, 1, 8).select(F.when(F.col("id") % 10 < 7, -1).otherwise(F.col("id") % 50).alias("k"), "id")
     .write.parquet(str(tmp_path / "t")))
    df = keep_last(spark.read.parquet(str(tmp_path / "t")), ["k"], ["id"])
    got = {r.k: r.id for r in df.collect()}
    assert got[-1] == max(i for i in range(40000) if i % 10 < 7) and len(got) == 16


def test_ids_skip_null_and_zero(spark):
    df = spark.createDataFrame([(None, 0), (7, 7)], "a bigint, b bigint")
    assert rows(distinct_ids(df, ["a", "b"], "id")) == [(7,)]


# ---- filters ----------------------------------------------------------------------


def day(text):
    return dt.date.fromisoformat(text) if text else None


@pytest.mark.parametrize(
    "name,start,kept",
    [
        ("Masters Bangkok", "2025-02-20", True),
        ("Pacific Promo", "2025-02-20", False),
        ("EMEA Kickoff 2025", None, True),
        ("EMEA Kickoff", None, False),
        ("EMEA Kickoff 2025", "2024-12-01", False),
        ("Masters WGCX", "2025-01-01", False),
        ("Lock//In", "2025-01-01", True),
        ("Something Else", "2025-01-01", False),
        (None, "2025-01-01", False),
    ],
)
def test_scope(spark, name, start, kept):
    df = spark.createDataFrame([(name, day(start))], "name string, start_date date")
    assert (df.where(scope_condition(F.col("name"), F.col("start_date"))).count() == 1) is kept


def test_page_cutoff_needs_every_event_dated_and_old(spark):
    data = [
        (1, "Masters", "2025-01-01"),
        (2, "Open", "2024-01-01"),
        (2, "Open", None),
        (3, "Open", "2024-01-01"),
        (4, "Masters", "2025-01-01"),
    ]
    df = spark.createDataFrame([(p, n, day(d)) for p, n, d in data], "page int, name string, start_date date")
    condition = scope_condition(F.col("name"), F.col("start_date"))
    assert [r[0] for r in rows(before_cutoff(df, condition).select("page"), "page")] == [1, 2, 2]
    assert before_cutoff(df, condition, keep_stop=True).count() == 4
    assert before_cutoff(df.where("page < 3"), condition).count() == 3


def test_existing_keys_are_skipped_and_a_null_key_never_exists(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    seen = spark.createDataFrame([(1,), (None,)], "k int")
    assert {r[0] for r in rows(not_ingested(df, seen, "k"))} == {2, None}


def test_run_guard(spark):
    df = spark.range(3)
    assert unless_present(df, spark.range(1)).count() == 0
    assert unless_present(df, spark.range(0)).count() == 3


# ---- shape ----------------------------------------------------------------------------


def test_keys(spark):
    df = spark.createDataFrame([(1, None, "1st / 2nd")], "a int, b string, place string")
    assert rows(df.select(record_key("a", "b"), path_safe(F.col("place")))) == [("1_None", "1st___2nd")]


def test_actions_share_one_index_and_keep_a_null_team(spark):
    kind = "array<struct<team:string,map:string>>"
    df = spark.createDataFrame(
        [(1, [("A", "x"), ("B", "y")], [(None, "z")], [("C", "w")], None)],
        f"m int, picks {kind}, bans {kind}, remaining {kind}, map_actions {kind}",
    )
    lists = {"picks": "pick", "bans": "ban", "remaining": "remaining", "map_actions": "map_action"}
    assert rows(explode_actions(df, lists, ["m"]), "action_idx") == [
        (1, 0, "pick", "A", "x"),
        (1, 1, "pick", "B", "y"),
        (1, 2, "ban", None, "z"),
        (1, 3, "remaining", "C", "w"),
    ]


def test_actions_without_the_attribute_have_the_default_team(spark):
    df = spark.createDataFrame([(1, [("x",)], None)], "m int, picks array<struct<map:string>>, bans array<struct<team:string>>")
    assert rows(explode_actions(df, {"picks": "pick", "bans": "ban"}, ["m"])) == [(1, 0, "pick", "unknown", "x")]


def test_explode_drops_null_empty_and_null_elements(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, ["a", None])], "i int, agents array<string>")
    assert rows(explode_values(df, "agents", "agent").select("i", "agent")) == [(3, "a")]


def test_default_applies_to_absent_attributes_only(spark):
    df = spark.createDataFrame([(None,)], "note string")
    assert rows(df.select(attribute(df, "note", "x"), attribute(df, "role", "y"))) == [(None, "y")]


# ---- contracts ---------------------------------------------------------------------------

STAT = {"match_id": "1", "map_index": "0", "player_name": "p", "agents": ["a"]}
STAT_DDL = (
    "match_id string, map_index string, player_name string, agents array<string>, "
    "kills string, fk string, game_id string, acs string, rating string"
)


@pytest.mark.parametrize(
    "change,errors",
    [
        ({}, []),
        ({"player_name": "  "}, ["player_name: must not be blank"]),
        ({"player_name": None}, ["player_name: required"]),
        ({"kills": "-1"}, ["kills: must not be negative"]),
        ({"fk": "-1"}, []),
        ({"kills": "x", "match_id": None}, ["match_id: required", "kills: not a valid int"]),
        ({"acs": "12.0"}, []),
        ({"acs": "12.7"}, ["acs: not a valid int"]),
        ({"game_id": "TBD"}, []),
        ({"rating": "1.25"}, []),
        ({"agents": None}, ["agents: required"]),
        ({"agents": ["a", None]}, ["agents: null element"]),
    ],
)
def test_player_stat_contract(spark, change, errors):
    record = {**STAT, **change}
    names = [f.split()[0] for f in STAT_DDL.split(", ")]
    df = spark.createDataFrame([tuple(record.get(n) for n in names)], STAT_DDL)
    flagged = validate(df, CONTRACTS["player_stats"])
    assert flagged.first()[ERRORS] == errors
    assert (accepted(flagged).count(), rejected(flagged, "player_name").count()) == ((0, 1) if errors else (1, 0))


def test_absent_list_defaults_to_empty(spark):
    df = spark.createDataFrame([("1", "0", "p")], "match_id string, map_index string, player_name string")
    row = validate(df, CONTRACTS["player_stats"]).first()
    assert row[ERRORS] == [] and row["agents"] == [] and row["match_id"] == 1


@pytest.mark.parametrize(
    "value,ok",
    [("2025-01-02", True), ("2025-1-2", False), ("2025-01-02T00:00:00", True), ("2025-01-02T10:00:00", False), ("soon", False), (None, True)],
)
def test_day_contract(spark, value, ok):
    df = spark.createDataFrame([("1", "n", "s", value)], "event_id string, name string, status string, start_date string")
    row = validate(df, CONTRACTS["events"]).first()
    assert (row[ERRORS] == []) is ok
    if ok and value:
        assert row["start_date"] == dt.date(2025, 1, 2)


@pytest.mark.parametrize("value,result", [("yes", True), ("OFF", False), ("1", True), ("maybe", None)])
def test_flag_contract(spark, value, result):
    df = spark.createDataFrame([("1", value)], "team_id string, is_active string")
    row = validate(df, CONTRACTS["team_info"]).first()
    assert row["is_active"] is result and (row[ERRORS] == []) is (result is not None)


def test_flag_default_when_absent(spark):
    row = validate(spark.createDataFrame([("1",)], "team_id string"), CONTRACTS["team_info"]).first()
    assert row["is_active"] is True and row[ERRORS] == []


def test_envelope_keeps_the_landed_payload(spark):
    df = spark.createDataFrame([("x", "n", None)], "event_id string, name string, status string")
    envelope = rejected(validate(df, CONTRACTS["events"]).withColumn("key", F.lit("k")), "key").first()
    assert envelope["original_payload"] == '{"event_id":"x","name":"n","status":null}'
    assert envelope[ERRORS] == ["event_id: not a valid int", "status: required"]


def test_nested_contract_errors_are_prefixed(spark):
    team = "struct<name:string,team_id:string>"
    df = spark.createDataFrame(
        [("1", "e", "p", "n", (None, "x"), None)],
        f"match_id string, event_name string, event_phase string, status_note string, team1 {team}, team2 {team}",
    )
    assert validate(df, CONTRACTS["series"]).first()[ERRORS] == [
        "team1.name: required",
        "team1.team_id: not a valid int",
        "team2: required",
    ]


def test_starting_partitions_stay_in_the_tens_of_thousands_at_100_tb():
    from duelake.session import shuffle_partitions_for

    assert shuffle_partitions_for(100 * 1024**4) == 51_200
    assert shuffle_partitions_for(1) == 200


def test_blank_is_white_space_of_every_kind(spark):
    from duelake.operators.contracts import BLANK

    texts = ["", " ", "\t\n", "\u00a0\u2003", "\x1c\x85", " a ", "\u200b"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.b for r in df.select(F.col("t").rlike(BLANK).alias("b")).collect()] == [t.strip() == "" for t in texts]
