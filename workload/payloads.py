"""Nested landed payloads derived from the order table, one row per match."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelake.plans.bronze import Landing
from workload.shapes import Shapes


def _items(count: str, most: int, body: str) -> str:
    """An array of ``count`` structs; ``i`` is the position inside ``body``."""
    return f"transform(filter(sequence(0, {most}), i -> i < {count}), i -> {body})"


def _heads(shapes: Shapes) -> DataFrame:
    """Series heads dealt over many tasks: a payload takes far more time to build and write than its head to read."""
    return shapes["series_head"].repartition(3 * shapes.spark.sparkContext.defaultParallelism)


def series_payloads(shapes: Shapes) -> DataFrame:
    """Headers with one or two teams and up to nine map actions in four lists."""
    team = "named_struct('id', id{n}, 'name', name{n}, 'short', 's{n}', 'country', 'XX', 'score', score{n})"
    first, second = team.format(n=1), team.format(n=2)
    action = "named_struct('team', {team}, 'map', concat('map_', cast((match_id + i) % 7 as string)))"
    return _heads(shapes).selectExpr(
        "fetch_seq",
        "match_id",
        "event",
        "event_phase",
        "status_note",
        "best_of",
        "date",
        "patch",
        f"if(one_team, array({first}), array({first}, {second})) as teams",
        _items("match_id % 3", 2, action.format(team="name1")) + " as picks",
        _items("match_id % 4", 3, action.format(team="if((match_id + i) % 5 = 0, null, name2)")) + " as bans",
        _items("1", 0, "named_struct('team', cast(null as string), 'map', if(match_id % 6 = 0, null, 'decider'))") + " as remaining",
        "if(match_id % 9 = 0, array(named_struct('team', 'admin', 'map', 'swap')), null) as map_actions",
    )


def map_payloads(shapes: Shapes) -> DataFrame:
    """Zero to three maps per match, four players and up to three rounds per map.

    Maps and players are spelled out by position, as lambda functions run interpreted and copy every text they make.  The
    lambda of the rounds stays: it keeps the projection from becoming one method that is too long to be compiled.
    """

    def player(i: int, j: int) -> str:
        return (
            f"named_struct('name', if((match_id + {j}) % 19 = 0, ' ', concat('player_', cast((match_id + {7 * j}) % 320 as string))),"
            f" 'player_id', if((match_id + {j}) % 23 = 0, null, cast((match_id + {7 * j}) % 320 as bigint)),"
            f" 'team_short', '{'s1' if j < 2 else 's2'}', 'team_id', {'id1' if j < 2 else 'id2'},"
            f" 'agents', if((match_id + {j}) % 27 = 0, null, array(concat('agent_', cast((match_id + {j}) % 12 as string)))),"
            f" 'r', cast((match_id + {j}) % 3 as string), 'acs', cast((match_id + {j}) % 400 as string),"
            f" 'k', cast((match_id + {j}) % 40 - 1 as string), 'd', cast((match_id * 3 + {j}) % 30 as string),"
            f" 'a', if((match_id + {j}) % 33 = 0, '4.5', '{j}'),"
            f" 'kast', cast((match_id + {i}) % 101 as string), 'adr', cast(null as string), 'hs_pct', cast(null as string),"
            f" 'fk', cast((match_id + {j}) % 5 - 1 as string), 'fd', '{j}')"
        )

    def team(i: int, n: int) -> str:
        return (
            f"named_struct('id', id{n}, 'name', name{n}, 'short', 's{n}', 'score', cast((match_id + {n * i}) % 14 as string),"
            f" 'attacker_rounds', cast((match_id + {n}) % 13 as string), 'defender_rounds', cast((match_id + {i}) % 13 as string),"
            f" 'is_winner', if((match_id + {i}) % 8 = 0, 'unsure', if((match_id + {n}) % 2 = 0, 'true', 'false')))"
        )

    rounds = (
        "named_struct('round_number', if((match_id + j) % 14 = 0, null, cast(j + 1 as string)),"
        " 'winner_side', if(j % 2 = 0, 'attack', 'defence'), 'method', 'elim', 'score_team1', cast(j as string),"
        " 'score_team2', if((match_id + j) % 21 = 0, 'x', '0'), 'winner_team_id', id1, 'winner_team_short', 's1',"
        " 'winner_team_name', name1)"
    )

    def body(i: int) -> str:
        return (
            f"named_struct('game_id', if((match_id + {i}) % 13 = 0, 'TBD', cast(match_id * 10 + {i} as string)),"
            f" 'map_name', 'map_{i}',"
            f" 'players', array({', '.join(player(i, j) for j in range(4))}),"
            f" 'teams', if((match_id + {i}) % 11 = 0, array({team(i, 1)}), array({team(i, 1)}, {team(i, 2)})),"
            f" 'rounds', transform(filter(sequence(0, 2), j -> j <= match_id % 3), j -> {rounds}))"
        )

    count = "cast(greatest(coalesce(match_id % 4, 0), 0) as int)"
    maps = f"slice(array({', '.join(body(i) for i in range(3))}), 1, {count}) as maps"
    return _heads(shapes).selectExpr("fetch_seq", "match_id", maps)


def roster_payloads(shapes: Shapes) -> DataFrame:
    """Two members per supplier team; some lack a role."""
    member = (
        "named_struct('player_id', if(s_suppkey % 9 = i, 'coach', cast(s_suppkey * 2 + i as string)),"
        " 'ign', concat(s_name, '_', cast(i as string)), 'real_name', cast(null as string), 'country', 'XX',"
        " 'role', if((s_suppkey + i) % 7 = 0, null, 'player'), 'is_captain', if(i = 0, 'true', 'false'))"
    )
    return shapes["supplier"].selectExpr(
        "s_suppkey as fetch_seq", "s_suppkey % 61 as team_id", _items("2", 1, member) + " as members"
    )


def landing(shapes: Shapes) -> Landing:
    return Landing(
        events=shapes["landing_events"],
        matches=shapes["landing_matches"],
        series=shapes.landed("series", series_payloads),
        series_maps=shapes.landed("series_maps", map_payloads),
        standings=shapes["landing_standings"],
        team_info=shapes["landing_team_info"],
        roster=roster_payloads(shapes),
        placements=shapes["landing_placements"],
        transactions=shapes["landing_transactions"],
        profiles=shapes["landing_profiles"],
        agent_stats=shapes["landing_agent_stats"],
    )


def raw_series(shapes: Shapes) -> DataFrame:
    """``raw_series`` with its team columns packed into structs, some absent."""

    def side(n: int) -> F.Column:
        return F.struct(
            F.col(f"team{n}_name").alias("name"),
            F.col(f"team{n}_id").alias("team_id"),
            F.lit(None).cast("string").alias("short"),
            F.lit(None).cast("string").alias("country"),
            F.col(f"team{n}_score").alias("series_score"),
        )

    flat = shapes["raw_series"]
    packed = [f"team{n}_{a}" for n in (1, 2) for a in ("name", "id", "score")]
    return (
        flat.withColumn("team1", side(1))
        .withColumn("team2", F.when(~F.col("no_team2"), side(2)))
        .drop(*packed, "no_team2")
    )
