"""The landed record types: their contracts and the raw silver read schemas."""

from __future__ import annotations

from pyspark.sql import types as T

from duelake.operators.contracts import NOT_BLANK, NOT_NEGATIVE, Contract, Field


def _fields(kind: str, names: str, required: bool = False, rules=()) -> tuple[Field, ...]:
    return tuple(Field(n, kind, required, rules=tuple(rules)) for n in names.split())


# Attribute names, their kinds and which of them a record must have.
TEAM = Contract(
    "team",
    _fields("text", "name", required=True) + _fields("int", "team_id") + _fields("text", "short country") + _fields("int", "series_score"),
)

CONTRACTS = {
    c.name: c
    for c in (
        Contract(
            "events",
            _fields("int", "event_id", required=True)
            + _fields("text", "name", required=True, rules=[NOT_BLANK])
            + _fields("text", "status", required=True)
            + _fields("text", "region")
            + _fields("day", "start_date end_date")
            + _fields("text", "prize"),
        ),
        Contract(
            "series",
            _fields("int", "match_id", required=True)
            + _fields("text", "event_name event_phase status_note", required=True)
            + _fields("text", "best_of")
            + _fields("day", "match_date")
            + _fields("text", "patch"),
            nested={"team1": TEAM, "team2": TEAM},
        ),
        Contract(
            "player_stats",
            _fields("int", "match_id map_index", required=True)
            + _fields("id_or_text", "game_id")
            + _fields("text", "map_name")
            + _fields("text", "player_name", required=True, rules=[NOT_BLANK])
            + _fields("int", "player_id")
            + _fields("text", "team_short")
            + _fields("int", "team_id")
            + (Field("agents", "texts", required=True, default=()),)
            + _fields("float", "rating")
            + _fields("int", "acs kills deaths assists", rules=[NOT_NEGATIVE])
            + _fields("float", "kast adr hs_pct")
            + _fields("int", "fk fd"),
        ),
        Contract(
            "map_picks_bans",
            _fields("int", "match_id", required=True) + _fields("text", "action_type action team map", required=True),
        ),
        Contract(
            "map_scores",
            _fields("int", "match_id map_index", required=True)
            + _fields("text", "map_name")
            + _fields("id_or_text", "game_id")
            + tuple(
                f
                for side in ("team1", "team2")
                for f in (
                    *_fields("int", f"{side}_id"),
                    *_fields("text", f"{side}_name {side}_short"),
                    *_fields("int", f"{side}_score {side}_attacker_rounds {side}_defender_rounds"),
                    *_fields("flag", f"{side}_is_winner"),
                )
            ),
        ),
        Contract(
            "round_results",
            _fields("int", "match_id map_index round_number", required=True)
            + _fields("text", "winner_side method")
            + _fields("int", "score_team1 score_team2 winner_team_id")
            + _fields("text", "winner_team_short winner_team_name"),
        ),
        Contract(
            "event_standings",
            _fields("int", "event_id", required=True)
            + (Field("stage_path", "text", required=True, default=""),)
            + _fields("text", "place", required=True)
            + _fields("int", "team_id")
            + _fields("text", "team_name team_country prize note"),
        ),
        Contract(
            "team_info",
            _fields("int", "team_id", required=True)
            + _fields("text", "name tag logo_url country")
            + (Field("is_active", "flag", required=True, default=True),),
        ),
        Contract(
            "team_roster",
            _fields("int", "team_id", required=True)
            + _fields("int", "player_id")
            + _fields("text", "ign real_name country")
            + (
                Field("role", "text", required=True, default=""),
                Field("is_captain", "flag", required=True, default=False),
            ),
        ),
        Contract(
            "player_profiles",
            _fields("int", "player_id", required=True)
            + _fields("text", "handle real_name country avatar_url")
            + (Field("aliases", "texts", required=True, default=()),),
        ),
        Contract(
            "player_agent_stats",
            _fields("int", "player_id", required=True)
            + _fields("text", "agent")
            + _fields("int", "usage_count")
            + _fields("float", "usage_percent")
            + _fields("int", "rounds_played")
            + _fields("float", "rating acs kd adr kast")
            + _fields("int", "kills deaths assists first_kills first_deaths"),
        ),
        Contract(
            "team_placements",
            _fields("int", "team_id", required=True)
            + _fields("int", "event_id")
            + _fields("text", "event_name year series place prize_money"),
        ),
        Contract(
            "team_transactions",
            _fields("int", "team_id", required=True)
            + _fields("int", "player_id")
            + _fields("text", "ign real_name country action position")
            + _fields("day", "transaction_date"),
        ),
    )
}

# Types whose rejected records are kept; the others drop them.
QUARANTINED = ("events", "series", "map_picks_bans", "player_stats", "map_scores", "round_results")

RECORD_TYPES = tuple(CONTRACTS)


def raw_schema(record_type: str) -> T.StructType:
    """Read schema of a record type: every scalar is text.

    Numbers and text are both legal for some attributes, and a typed JSON read
    would null one of them; the silver casts decide instead.
    """
    return _raw(CONTRACTS[record_type]).add("ingested_at", T.StringType())


def _raw(contract: Contract) -> T.StructType:
    fields = [
        T.StructField(f.name, T.ArrayType(T.StringType()) if f.kind == "texts" else T.StringType())
        for f in contract.fields
    ]
    fields += [T.StructField(name, _raw(inner)) for name, inner in contract.nested.items()]
    return T.StructType(fields)
