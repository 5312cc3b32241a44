import json

import pytest
from pyspark.sql import types as T

from duelake.record_types import CONTRACTS, raw_schema
from duelake.sources.catalog import listing, register_silver_views, view_available
from duelake.sources.landed import discover_schema, keyed_as_raw, parse_documents, read_documents, read_json_lines, read_landed, read_single_objects
from conftest import rows

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.StringType())])


def put(folder, key, value):
    path = folder / f"{key}.json"
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(value if isinstance(value, str) else json.dumps(value), encoding="utf-8")


def test_objects_and_arrays_mix(spark, tmp_path):
    put(tmp_path, "a", {"id": 1, "v": "x"})
    put(tmp_path, "b", [{"id": 2}, {"id": "3", "v": "é"}])
    df = read_documents(spark, str(tmp_path), SCHEMA)
    assert rows(df.select("id", "v", "_pos"), "id") == [("1", "x", 0), ("2", None, 0), ("3", "é", 1)]


@pytest.mark.parametrize("text", ["{bad", " ", "null", "7"])
def test_malformed_document_fails(spark, tmp_path, text):
    put(tmp_path, "a", text)
    with pytest.raises(Exception):
        read_documents(spark, str(tmp_path), SCHEMA).collect()


def test_missing_and_empty_prefix_give_no_rows(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    for name in ("nowhere", "empty"):
        df = read_documents(spark, str(tmp_path / name), SCHEMA)
        assert df.count() == 0 and df.columns == ["id", "v", "_key", "_pos"]


def test_keys_with_slash_and_space_are_read_in_key_order(spark, tmp_path):
    for key in ("1_A/B", "a b", "a!b", "a+b"):
        put(tmp_path, key, {"id": key})
    df = read_documents(spark, str(tmp_path), SCHEMA)
    assert [r[0] for r in rows(df.select("id"), df["_key"])] == ["1_A/B", "a b", "a!b", "a+b"]


def test_single_object_reader_matches_on_objects(spark, tmp_path):
    put(tmp_path, "a", {"id": 1, "v": "x"})
    put(tmp_path, "b", {"id": "2"})
    assert rows(read_single_objects(spark, str(tmp_path), SCHEMA).select("id", "v"), "id") == [("1", "x"), ("2", None)]
    assert read_single_objects(spark, str(tmp_path / "none"), SCHEMA).count() == 0


def test_many_small_objects_are_read_by_few_tasks(spark, tmp_path):
    from duelake.session import many_tasks

    for i in range(1000):
        put(tmp_path, f"{i % 10}/{i}", {"id": i})
    df = read_documents(spark, str(tmp_path), SCHEMA)
    df.write.parquet(f"{tmp_path}_compact")
    # Spark puts some thirty objects in a task, and each task wrote a file of its own.
    assert len(spark.read.parquet(f"{tmp_path}_compact").inputFiles()) <= many_tasks(spark) < 1000 / 32
    assert sorted(int(r.id) for r in df.select("id").collect()) == list(range(1000))


def test_objects_are_listed_by_a_task_as_spark_lists_them(spark, tmp_path):
    from duelake.sources.landed import decoded_key, object_keys

    root = tmp_path / "events" / "raw"
    for key in ("1_A/B", "a b", "a+b", "a%20b", "é#?", "_h", ".h", "_k=1", "_g/x", "_metadata_x/y"):
        put(root, key, {"id": key})
    (root / "empty.json").write_text("")
    (root / "half.json._COPYING_").write_text("{")
    by_spark = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(root))
    wanted = sorted(r.k for r in by_spark.select(decoded_key().alias("k")).collect())
    for prefix in (str(root), f"file://{root}", f"file:{root}/"):
        df = read_documents(spark, prefix, SCHEMA)
        assert sorted(r._key for r in df.select("_key").collect()) == wanted and len(wanted) == 7
        # Spark's own listing holds every object in the driver.
        assert "binaryFile" not in df._jdf.queryExecution().toString()
    names = object_keys(spark, str(tmp_path), "events")
    assert "binaryFile" not in names._jdf.queryExecution().toString()
    assert sorted(r[0] for r in rows(names)) == sorted(["1_A/B", "a b", "a+b", "a b", "é#?", "_k=1", "_metadata_x/y"])
    assert object_keys(spark, str(tmp_path), "series") is None


def test_a_task_hands_large_objects_on_before_it_has_read_all(spark, tmp_path, monkeypatch):
    from duelake.sources import landed

    monkeypatch.setattr(landed, "READ_BYTES", 10)
    for i in range(5):
        put(tmp_path, str(i), {"id": i, "v": "x" * 20})
    assert rows(read_documents(spark, str(tmp_path), SCHEMA).select("id"), "id") == [(str(i),) for i in range(5)]


def test_an_object_appears_whole_and_takes_the_place_of_another(tmp_path):
    from duelake.sources.files import ObjectWriter

    with ObjectWriter(str(tmp_path)) as objects:
        objects.put("a/1.json", b"old")
        objects.put("a/1.json", b"new")
        objects.put("2.json", b"two")
    with pytest.raises(TypeError), ObjectWriter(str(tmp_path)) as objects:
        objects.put("3.json", "no bytes")
    assert (tmp_path / "a" / "1.json").read_bytes() == b"new"
    # Neither half a file nor a hidden folder is left.
    assert sorted(p.name for p in tmp_path.rglob("*")) == ["1.json", "2.json", "a"]


def test_a_compressed_object_is_unpacked_by_its_name(spark, tmp_path):
    import gzip

    put(tmp_path, "b", {"id": 2})
    (tmp_path / "a.json.gz").write_bytes(gzip.compress(b'{"id": 1}'))
    found = rows(read_documents(spark, str(tmp_path), SCHEMA).select("id", "_key"), "id")
    assert [(i, key.rpartition("/")[2]) for i, key in found] == [("1", "a.json.gz"), ("2", "b.json")]


def test_schema_discovery_sees_every_record(spark, tmp_path):
    put(tmp_path, "a", {"id": 1})
    put(tmp_path, "b", [{"id": 2, "late": True}])
    assert discover_schema(spark, str(tmp_path)).fieldNames() == ["id", "late"]


def test_every_record_type_has_a_raw_schema(spark, tmp_path):
    frames = read_landed(spark, str(tmp_path))
    assert len(frames) == len(CONTRACTS) == 13
    assert all(df.count() == 0 for df in frames.values())
    series = raw_schema("series")
    assert series["team1"].dataType.fieldNames() == ["name", "team_id", "short", "country", "series_score"]
    assert isinstance(raw_schema("player_stats")["agents"].dataType, T.ArrayType)


def test_unwritten_bronze_dataset_reads_as_empty(spark, tmp_path):
    assert keyed_as_raw(spark, str(tmp_path), "events").count() == 0


def test_listing_defaults_and_text_order(spark):
    df = spark.createDataFrame([(9, "n9"), (10, "n10"), (None, "none")], "id bigint, name string")
    assert rows(listing(df)) == [
        ("10", "n10", "Unknown Date"),
        ("9", "n9", "Unknown Date"),
        (None, "none", "Unknown Date"),
    ]


def test_views_of_missing_tables_are_dropped(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS views_db")
    spark.range(3).write.mode("overwrite").saveAsTable("views_db.dim_teams")
    spark.range(1).createOrReplaceTempView("silver_dim_players")
    assert register_silver_views(spark, "views_db", ["dim_teams", "dim_players"]) == ["silver_dim_teams"]
    assert view_available(spark, "dim_teams") and not view_available(spark, "dim_players")
    spark.catalog.dropTempView("silver_dim_teams")


@pytest.mark.parametrize(
    "text",
    ['{"id": 1} trailing', '{"id": 1}\n{"id": 2}', '{"id": 1}, {"id": 2}', '{"id": 1}] [2', '{"id": 1}, "w": 2', "[1] x", '{"id": 1}}'],
)
def test_text_behind_the_first_value_fails(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception):  # noqa: B017
        read_documents(spark, str(tmp_path), SCHEMA).collect()
    with pytest.raises(Exception):  # noqa: B017
        read_single_objects(spark, str(tmp_path), SCHEMA).collect()


def test_json_lines_keep_every_record(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": "1"}\n\n{"id": "2"}\n[{"id": "3"}, {"id": "4"}]\n')
    assert rows(read_json_lines(spark, str(tmp_path), SCHEMA).select("id"), "id") == [("1",), ("2",), ("3",), ("4",)]
    assert read_json_lines(spark, str(tmp_path / "none"), SCHEMA).count() == 0


def test_every_order_becomes_a_document(spark, monkeypatch):
    from workload import operator_queries

    parsed = []
    monkeypatch.setattr(operator_queries, "parse_documents", lambda texts, schema: parsed.append(texts) or parse_documents(texts, schema))
    orders = spark.createDataFrame([(1,), (2,), (3,)], "o_orderkey long")
    out = operator_queries.json_documents_and_arrays({"orders": orders})
    assert parsed[0].count() == 3
    assert sorted((r.id, r.pos) for r in out.collect()) == [(-3, 0), (1, 0), (3, 1)]


def test_single_object_scan_writes_an_object_a_row_and_no_folder_an_object(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    from workload import job_queries

    monkeypatch.setattr(job_queries, "shared_folder", lambda session, purpose: f"{tmp_path}/{purpose}")
    ids = [1, 2, 2, None, None]
    events = spark.createDataFrame([(i, f"e{n}") for n, i in enumerate(ids)], "id bigint, name string")

    class Rows(dict):
        pass

    s = Rows(landing_events=events)
    s.spark = spark
    got = job_queries.single_object_scan(s).select(F.col("event_id").cast("long"), "name", "_pos").collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == [(i, f"e{n}", 0) for n, i in enumerate(ids)]
    assert [p.name for p in tmp_path.rglob("*") if p.is_dir()] == ["landed", "events", "raw"]
