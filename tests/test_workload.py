"""Payloads and chains of the workload over small rows of their own."""

import datetime as dt

import pytest

from workload import payloads
from workload.bronze_queries import Backfill, records
from workload.shapes import Shapes
from duelake.operators.joins import last_context
from duelake.plans import bronze
from __spark_entry__ import queries
from conftest import rows

HEAD = "match_id bigint, fetch_seq bigint, name1 string, id1 string, name2 string, id2 string"


class Heads:
    def __init__(self, spark, ids):
        self.spark = spark
        self.rows = spark.createDataFrame([(i, i, "a", "1", "b", "2") for i in ids], HEAD)

    def __getitem__(self, name):
        return {"series_head": self.rows}[name]


def test_map_payloads_have_no_lambda_but_for_rounds(spark):
    plan = payloads.map_payloads(Heads(spark, [1]))._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction(named_struct(round_number" in plan
    assert "lambdafunction(named_struct(game_id" not in plan and "lambdafunction(named_struct(name" not in plan


def test_map_payloads_by_position(spark):
    ids = [None, -3, 0, 1, 2, 3, 39]
    found = {r.match_id: r.maps for r in payloads.map_payloads(Heads(spark, ids)).collect()}
    assert {i: len(maps) for i, maps in found.items()} == {None: 0, -3: 0, 0: 0, 1: 1, 2: 2, 3: 3, 39: 3}
    first, second, third = found[39]
    assert [m.game_id for m in found[39]] == ["TBD", "391", "392"] and [m.map_name for m in found[39]] == ["map_0", "map_1", "map_2"]
    assert [p.name for p in second.players] == ["player_39", "player_46", "player_53", "player_60"]
    assert [(p.a, p.fd, p.team_short, p.team_id, p.kast) for p in third.players] == [
        ("0", "0", "s1", "1", "41"), ("1", "1", "s1", "1", "41"), ("2", "2", "s2", "2", "41"), ("3", "3", "s2", "2", "41")]
    assert [t.score for t in second.teams] == ["12", "13"] and [t.is_winner for t in second.teams] == ["unsure", "unsure"]
    assert len(first.rounds) == 1 and len(found[2][0].rounds) == 3


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Forty orders of four customers, one line each."""
    root = str(tmp_path_factory.mktemp("tables"))
    day = dt.datetime(1999, 3, 1)
    frames = {
        "region": spark.createDataFrame([(0, "R")], "r_regionkey int, r_name string"),
        "nation": spark.createDataFrame([(0, "N", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": spark.createDataFrame(
            [(i, f"c{i}", 0, 1.0, "MACHINERY") for i in range(1, 5)],
            "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "supplier": spark.createDataFrame(
            [(i, f"s{i}", 0, 1.0) for i in range(1, 5)], "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"),
        "part": spark.createDataFrame(
            [(i, "a b", "B", "T", 1, 1.0) for i in range(1, 81)],
            "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "orders": spark.createDataFrame(
            [(i, 1 + i % 4, "F", 1.0, day, "P") for i in range(1, 41)],
            "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": spark.createDataFrame(
            [(i, i, 1 + i % 4, 1, 1.0, 1.0, 0.0, 0.0, "A", "F", day) for i in range(1, 41)],
            "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
            "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"),
    }
    for name, df in frames.items():
        df.coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return root


def test_records_by_id_are_not_shuffled_to_meet_few_ids(spark, tables):
    shapes = Shapes(spark, tables)
    lazy = records(bronze.agent_stat_attempts(shapes["landing_agent_stats"], Backfill(shapes).players))
    expected = sorted(r.record_key for r in lazy.collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "5000")
    try:
        found = queries()["bronze_player_agent_stats"](spark, tables)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert sorted(r.record_key for r in found.collect()) == expected and expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_context_behind_its_gate_has_a_measured_size(spark):
    context = spark.createDataFrame([(i % 3, i, f"r{i}") for i in range(9)] + [(None, 9, "r9")], "match_id bigint, at int, region string")
    found = last_context(context, "match_id", ["at"])
    assert rows(found.select("match_id", "region"), "match_id") == [(0, "r6"), (1, "r7"), (2, "r8")]
    assert "REBALANCE" in found._jdf.queryExecution().executedPlan().toString()
