"""Single operators: filters, projections, casts, keys and dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duelake.functions.casting import conform, lenient_casts, strict_casts
from duelake.functions.measures import true_share
from duelake.functions.sides import decide_winner, pick_side
from duelake.functions.text import path_safe, record_key
from duelake.operators.filters import (
    at_least,
    before_cutoff,
    completed,
    not_ingested,
    scope_condition,
    unless_present,
)
from duelake.operators.keys import distinct_ids, keep_last, pk_gate
from duelake.operators.reshape import attribute, explode_values, flatten_struct, positional
from duelake.plans.bronze import Scope
from duelake.session import shared_folder
from duelake.sinks.records import write_keyed_json
from duelake.sources.catalog import listing
from duelake.sources.landed import KEY, POS, parse_documents, raw_path, read_json_lines
from workload.registry import last, query
from workload.shapes import Shapes

IN_SCOPE_SQL = """
    (CASE WHEN start_date IS NOT NULL THEN YEAR(start_date) = 2025 ELSE name LIKE '%2025%' END)
    AND NOT (UPPER(name) LIKE '%CHALLENGERS%' OR UPPER(name) LIKE '%ASCENSION%' OR UPPER(name) LIKE '%GAME CHANGERS%'
             OR UPPER(name) LIKE '%GC%' OR UPPER(name) LIKE '%PROMO%')
    AND (UPPER(name) LIKE '%PACIFIC%' OR UPPER(name) LIKE '%EMEA%' OR UPPER(name) LIKE '%AMERICAS%' OR UPPER(name) LIKE '%CHINA%'
         OR UPPER(name) LIKE '%MASTERS%' OR UPPER(name) LIKE '%CHAMPIONS%' OR UPPER(name) LIKE '%LOCK//IN%')"""


# ---- filters ------------------------------------------------------------------


@query("scope_filter", f"SELECT * FROM {{landing_events}} WHERE {IN_SCOPE_SQL}")
def scope_filter(s: Shapes) -> DataFrame:
    return s["landing_events"].where(scope_condition(F.col("name"), F.col("start_date")))


@query(
    "page_cutoff",
    "SELECT * FROM {landing_events} WHERE (SELECT stop IS NULL FROM {stale}) OR page < (SELECT stop FROM {stale})",
    stale=f"""
        SELECT MIN(page) AS stop FROM (
            SELECT page FROM {{landing_events}} GROUP BY page
            HAVING COUNT(*) = COUNT(start_date) AND MAX(YEAR(start_date)) < 2025
               AND SUM(CASE WHEN {IN_SCOPE_SQL} THEN 1 ELSE 0 END) = 0)""",
)
def page_cutoff(s: Shapes) -> DataFrame:
    return before_cutoff(s["landing_events"], Scope().condition())


@query("completed_filter", "SELECT * FROM {landing_matches} WHERE LOWER(status) = 'completed'")
def completed_filter(s: Shapes) -> DataFrame:
    return completed(s["landing_matches"])


@query(
    "skip_existing",
    "SELECT * FROM {landing_matches} m WHERE NOT EXISTS "
    "(SELECT 1 FROM lineitem l WHERE l.l_returnflag = 'R' AND l.l_orderkey = m.match_id)",
)
def skip_existing(s: Shapes) -> DataFrame:
    ingested = s["lineitem"].where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("match_id"))
    return not_ingested(s["landing_matches"], ingested, "match_id").select(*s["landing_matches"].columns)


@query(
    "run_guard",
    """
    SELECT 'against present' AS run, match_id FROM {landing_matches} WHERE NOT EXISTS (SELECT 1 FROM lineitem)
    UNION ALL
    SELECT 'against empty' AS run, match_id FROM {landing_matches} WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_returnflag = 'none')""",
)
def run_guard(s: Shapes) -> DataFrame:
    def guarded(label: str, target: DataFrame) -> DataFrame:
        return unless_present(s["landing_matches"], target).select(F.lit(label).alias("run"), "match_id")

    lines = s["lineitem"]
    return guarded("against present", lines).union(guarded("against empty", lines.where("l_returnflag = 'none'")))


@query("min_two_elements", "SELECT p_partkey, SPLIT(p_name, ' ') AS words FROM part WHERE LEN(SPLIT(p_name, ' ')) >= 2 AND p_size > 10", ("words",))
def min_two_elements(s: Shapes) -> DataFrame:
    words = s["part"].select("p_partkey", F.when(F.col("p_size") > 10, F.split("p_name", " ")).alias("words"))
    return at_least(words, "words", 2)


@query("null_key_rows", "SELECT * FROM {fx_series} WHERE team1_id IS NULL OR team1_score IS NULL")
def null_key_rows(s: Shapes) -> DataFrame:
    return pk_gate(s["fx_series"], ["team1_id", "team1_score"], ["match_id"]).violations


# ---- keys and dedup -----------------------------------------------------------

GATE = ["match_id", "game_id", "player_id"]
GATE_ORDER = ["l_partkey", "l_suppkey", "l_extendedprice"]
LINES = ", ".join(GATE_ORDER)


@query("pk_gate_clean", last("{fx_player_stats}", "match_id, game_id, player_id", LINES, where="player_id IS NOT NULL"), ("agents",))
def pk_gate_clean(s: Shapes) -> DataFrame:
    return pk_gate(s["fx_player_stats"], GATE, GATE_ORDER).clean


@query("pk_gate_violations", "SELECT * FROM {fx_player_stats} WHERE player_id IS NULL", ("agents",))
def pk_gate_violations(s: Shapes) -> DataFrame:
    return pk_gate(s["fx_player_stats"], GATE, GATE_ORDER).violations


LINE_ORDER = "l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"


@query("last_write_wins", last("lineitem", "l_orderkey, l_linenumber", LINE_ORDER))
def last_write_wins(s: Shapes) -> DataFrame:
    return keep_last(s["lineitem"], ["l_orderkey", "l_linenumber"], LINE_ORDER.split(", "))


@query(
    "distinct_side_ids",
    """
    SELECT DISTINCT team_id FROM (SELECT team1_id AS team_id FROM {fx_series} UNION ALL SELECT team2_id FROM {fx_series})
    WHERE team_id IS NOT NULL AND team_id <> 0""",
)
def distinct_side_ids(s: Shapes) -> DataFrame:
    return distinct_ids(s["fx_series"], ["team1_id", "team2_id"], "team_id")


# ---- projections and casts ----------------------------------------------------


@query("strict_cast", "SELECT o_orderkey, CAST(day AS DATE) AS day, CAST(number AS BIGINT) AS number FROM {texts}", texts="SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS STRING) AS day, CAST(o_custkey AS STRING) AS number FROM {orders}")
def strict_cast(s: Shapes) -> DataFrame:
    texts = s["orders"].selectExpr("o_orderkey", "cast(cast(o_orderdate as date) as string) as day", "cast(o_custkey as string) as number")
    return strict_casts(texts, {"day": "date", "number": "bigint"})


@query(
    "lenient_cast",
    """
    SELECT o_orderkey, TRY_CAST(o_orderpriority AS INT) AS word, CAST(NULL AS INT) AS wide,
           CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey END AS mixed FROM orders""",
)
def lenient_cast(s: Shapes) -> DataFrame:
    texts = s["orders"].selectExpr(
        "o_orderkey",
        "o_orderpriority as word",
        "cast(99999999999 + o_orderkey as string) as wide",
        "if(o_orderkey % 3 = 0, 'TBD', cast(o_custkey as string)) as mixed",
    )
    return lenient_casts(texts, {"word": "int", "wide": "int", "mixed": "bigint"})


@query("rename_drop", "SELECT p_partkey, p_size AS r_size, p_brand FROM part")
def rename_drop(s: Shapes) -> DataFrame:
    return s["part"].drop("p_name", "p_type", "p_retailprice").withColumnRenamed("p_size", "r_size")


@query(
    "key_sanitise",
    "SELECT p_partkey, REPLACE(REPLACE(CONCAT(p_name, '/', p_type), ' ', '_'), '/', '_') AS safe FROM part",
)
def key_sanitise(s: Shapes) -> DataFrame:
    return s["part"].select("p_partkey", path_safe(F.concat("p_name", F.lit("/"), "p_type")).alias("safe"))


@query(
    "record_keys",
    """
    SELECT CONCAT(CAST(match_id AS STRING), '_', CAST(map_index AS STRING), '_', COALESCE(CAST(player_id AS STRING), 'None')) AS record_key
    FROM {fx_player_stats}""",
)
def record_keys(s: Shapes) -> DataFrame:
    return s["fx_player_stats"].select(record_key("match_id", "map_index", "player_id").alias("record_key"))


@query(
    "json_flatten_struct",
    """
    SELECT match_id, CASE WHEN match_id % 71 <> 0 THEN team1_name END AS team1_name,
           CASE WHEN match_id % 71 <> 0 THEN team1_id END AS team1_id,
           CASE WHEN match_id % 71 <> 0 THEN team1_score END AS team1_score FROM {fx_series}""",
)
def json_flatten_struct(s: Shapes) -> DataFrame:
    document = F.to_json(
        F.struct(
            "match_id",
            F.when(
                F.col("match_id") % 71 != 0,
                F.struct(F.col("team1_name").alias("name"), F.col("team1_id").alias("team_id"), F.col("team1_score").alias("series_score")),
            ).alias("team1"),
        )
    )
    schema = T.StructType.fromDDL("match_id string, team1 struct<name:string,team_id:string,series_score:string>")
    parsed = parse_documents(s["fx_series"].select(document.alias("value")), schema)
    fields = {"team1_name": ("name", None), "team1_id": ("team_id", "bigint"), "team1_score": ("series_score", "int")}
    flat = flatten_struct(parsed, "team1", fields).drop("team1", POS)
    return strict_casts(flat, {"match_id": "bigint"})


@query(
    "json_documents",
    """
    SELECT CAST(o_orderkey AS STRING) AS _key, CAST(i AS INT) AS _pos, CAST(o_custkey + i AS STRING) AS id,
           CASE WHEN i = 0 THEN o_orderstatus END AS status
    FROM orders, RANGE(0, 2) t(i) WHERE i = 0 OR o_orderkey % 2 = 1""",
)
def json_documents(s: Shapes) -> DataFrame:
    # Even orders hold one object, odd ones an array of two; ids are a number and a text.
    documents = s["orders"].selectExpr(
        f"cast(o_orderkey as string) as {KEY}",
        """if(o_orderkey % 2 = 0, to_json(named_struct('id', o_custkey, 'status', o_orderstatus)),
              concat('[', to_json(named_struct('id', o_custkey, 'status', o_orderstatus)), ',',
                          to_json(named_struct('id', cast(o_custkey + 1 as string))), ']')) as value""",
    )
    return parse_documents(documents, T.StructType.fromDDL("id string, status string"), keep=[KEY])


@query("json_props", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(0 AS INT) AS _pos FROM events")
def json_props(s: Shapes) -> DataFrame:
    parsed = parse_documents(s["events"].select("event_id", "props"), T.StructType.fromDDL("k string"), text="props", keep=["event_id"])
    return strict_casts(parsed, {"k": "bigint"})


@query(
    "json_roundtrip",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS word FROM orders",
)
def json_roundtrip(s: Shapes) -> DataFrame:
    # Written as a run of JSON lines and read back by the reader for them.
    root = shared_folder(s.spark, "bronze")
    rows = s["orders"].selectExpr("o_orderkey", "cast(o_orderdate as date) as day", "if(o_orderkey % 5 = 0, null, o_orderpriority) as word")
    write_keyed_json(rows, root, "orders", "20250101T000000")
    return read_json_lines(s.spark, raw_path(root, "orders"), rows.schema).select(rows.columns)


@query(
    "json_documents_and_arrays",
    """
    SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS pos FROM orders WHERE o_orderkey % 3 < 2
    UNION ALL SELECT -o_orderkey, 0 FROM orders WHERE o_orderkey % 3 = 0""",
)
def json_documents_and_arrays(s: Shapes) -> DataFrame:
    # One text an order: an object, an array of two records, or an array of none.
    one = F.to_json(F.struct(F.col("o_orderkey").alias("id")))
    two = F.concat(F.lit(" ["), F.to_json(F.struct((-F.col("o_orderkey")).alias("id"))), F.lit(","), one, F.lit("]\n"))
    turn = F.col("o_orderkey") % 3
    texts = s["orders"].select(F.when(turn == 0, two).when(turn < 2, one).otherwise(F.lit(" [ ]\n")).alias("value"))
    parsed = parse_documents(texts, T.StructType.fromDDL("id bigint"))
    return parsed.select("id", F.col(POS).alias("pos"))


@query(
    "attr_defaults",
    "SELECT s_suppkey, s_name, 'unknown' AS role, CASE WHEN s_acctbal < 0 THEN NULL ELSE 'rich' END AS note FROM supplier",
)
def attr_defaults(s: Shapes) -> DataFrame:
    df = s["supplier"].selectExpr("s_suppkey", "s_name", "if(s_acctbal < 0, null, 'rich') as note")
    return df.select(
        "s_suppkey", "s_name", attribute(df, "role", "unknown").alias("role"), attribute(df, "note", "poor").alias("note")
    )


@query(
    "positional_pair",
    "SELECT p_partkey, SPLIT(p_name, ' ')[1] AS first, SPLIT(p_name, ' ')[2] AS second, CAST(NULL AS STRING) AS third FROM part",
)
def positional_pair(s: Shapes) -> DataFrame:
    words = F.split("p_name", " ")
    return s["part"].select("p_partkey", *[positional(words, i).alias(n) for i, n in enumerate(("first", "second", "third"))])


@query(
    "conform_schema",
    "SELECT CAST(p_size AS BIGINT) AS p_size, p_name, CAST(NULL AS DATE) AS absent, CAST(p_partkey AS STRING) AS p_partkey FROM part",
)
def conform_schema(s: Shapes) -> DataFrame:
    return conform(s["part"], T.StructType.fromDDL("p_size bigint, p_name string, absent date, p_partkey string"))


@query(
    "explode_agents",
    "SELECT match_id, player_id, line_key, UNNEST(agents) AS agent FROM {fx_player_stats} WHERE agents IS NOT NULL",
)
def explode_agents(s: Shapes) -> DataFrame:
    return explode_values(s["fx_player_stats"].select("match_id", "player_id", "line_key", "agents"), "agents", "agent").drop("agents")


@query(
    "decide_winner",
    """
    SELECT match_id, CASE WHEN team1_score > team2_score THEN team1_id WHEN team2_score > team1_score THEN team2_id END AS winner_id,
           CASE WHEN team1_score > team2_score THEN team1_name WHEN team2_score > team1_score THEN team2_name ELSE 'Draw' END AS winner_name
    FROM {fx_series}""",
)
def winner(s: Shapes) -> DataFrame:
    scores = F.col("team1_score"), F.col("team2_score")
    return s["fx_series"].select(
        "match_id",
        decide_winner(*scores, F.col("team1_id"), F.col("team2_id"), F.lit(None)).alias("winner_id"),
        decide_winner(*scores, F.col("team1_name"), F.col("team2_name"), F.lit("Draw")).alias("winner_name"),
    )


@query(
    "resolve_side",
    """
    SELECT game_id, line_key, CASE WHEN l_partkey % 61 = team1_id THEN team1_is_winner
                                   WHEN l_partkey % 61 = team2_id THEN team2_is_winner END AS won FROM {fx_map_scores}""",
)
def resolve_side(s: Shapes) -> DataFrame:
    won = pick_side(
        F.col("l_partkey") % 61, F.col("team1_id"), F.col("team1_is_winner"), F.col("team2_id"), F.col("team2_is_winner")
    )
    return s["fx_map_scores"].select("game_id", "line_key", won.alias("won"))


@query(
    "decimal_share",
    """
    SELECT l_partkey, CAST(((((200000 * w + n) // (2 * n)) + 50) // 100) / 1000.0 AS DECIMAL(5,3)) AS share
    FROM (SELECT l_partkey, COUNT(*) AS n, COUNT(*) FILTER (l_quantity > 40) AS w FROM lineitem GROUP BY l_partkey)""",
)
def decimal_share(s: Shapes) -> DataFrame:
    return s["lineitem"].groupBy("l_partkey").agg(true_share(F.col("l_quantity") > 40).alias("share"))


# ---- report -------------------------------------------------------------------


@query("listing_report", "SELECT CAST(id AS STRING) AS id, name, CAST(start_date AS STRING) AS start_date FROM {landing_events}")
def listing_report(s: Shapes) -> DataFrame:
    return listing(s["landing_events"])


@query("listing_report_defaults", "SELECT 'Unknown ID' AS id, n_name AS name, 'Unknown Date' AS start_date FROM nation")
def listing_report_defaults(s: Shapes) -> DataFrame:
    return listing(s["nation"].withColumnRenamed("n_name", "name"))
