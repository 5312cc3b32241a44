"""Landed JSON documents and keyed bronze datasets.

Every reader adds where a record came from: ``_key`` (object key below the
prefix) and ``_pos`` (position in an array document).  Together they order the
records of a type, which is what "last" means downstream.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator, Mapping, Sequence
from itertools import batched

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duelake.operators.contracts import ERRORS, valid_members, validate
from duelake.operators.keys import keep_last
from duelake.record_types import CONTRACTS, RECORD_TYPES, raw_schema
from duelake.commits import Snapshot, attempt_folder, attempts, commit_snapshot, has_distinct_keys, new_attempt, raw_path, snapshot
from duelake.session import PARQUET_CODEC, many_tasks
from duelake.sources.files import exists, local_files, local_path

KEY, POS = "_key", "_pos"
ORIGIN = (KEY, POS)
#: Endings of names that Hadoop's text reader takes for compressed files.
PACKED = ("bz2", "deflate", "gz", "lz4", "snappy", "zst")


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def with_origin(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(KEY, T.StringType()), T.StructField(POS, T.IntegerType())])


def parse_documents(documents: DataFrame, schema: T.StructType, text: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """One row per record: an object is one record, an array holds many.

    Text that is no JSON object or array, or that goes on after it, fails the job.
    """
    parsed = F.from_json(single_value(F.col(text)), T.ArrayType(schema), {"mode": "FAILFAST"})
    whole = F.coalesce(parsed, F.raise_error(F.lit("landed document is not a JSON object or array")).cast(T.ArrayType(schema)))
    return documents.select(*keep, F.posexplode(whole).alias(POS, "record")).select("record.*", *keep, POS)


def single_value(text: F.Column) -> F.Column:
    """The text, if one JSON value is all it holds; else the job fails.

    Spark's parser stops after the first value.  Put in brackets and in braces, anything behind that value is a syntax
    error or a second element: what closes the one is wrong in the other.
    """
    strict = {"mode": "FAILFAST"}
    listed = F.from_json(F.concat(F.lit("["), text, F.lit("\n]")), "array<string>", strict)
    named = F.from_json(F.concat(F.lit('{"v":'), text, F.lit("\n}")), "v string", strict)
    problem = F.raise_error(F.lit("landed document holds more than one JSON value")).cast("string")
    return F.when((F.size(listed) == 1) & named["v"].isNotNull(), text).when(text.isNotNull(), problem)


def decoded_key(path: str = "_metadata.file_path") -> F.Column:
    """The object key behind a file URI.

    URIs are percent-encoded, which sorts differently from the key itself.
    """
    return F.try_url_decode(F.replace(F.col(path), F.lit("+"), F.lit("%2B")))


def read_documents(spark: SparkSession, prefix: str, schema: T.StructType) -> DataFrame:
    """All JSON documents at or below a prefix; no such prefix gives no rows.

    An object of zero bytes is passed over, as Spark's listing leaves them out; any other text that is not JSON fails the job.

    Objects are listed and read by tasks, a few for each core, so that what is written from them is a few files too.
    Objects whose names say that they are compressed are read by Spark's text reader.
    """
    if not exists(spark, prefix):
        return empty(spark, with_origin(schema))
    folder = local_path(spark, prefix)
    if folder is None:
        texts, packed = _texts_in_store(spark, prefix), True
    else:
        found, packed = _survey(spark, folder)
        texts = _texts_below(spark, folder, min(many_tasks(spark), 1 + found // OBJECTS_A_TASK))
    if packed:
        unpacked = spark.read.options(recursiveFileLookup="true", pathGlobFilter=f"*.{{{','.join(PACKED)}}}").text(prefix, wholetext=True)
        texts = texts.unionByName(unpacked.select("value", decoded_key().alias(KEY)).coalesce(many_tasks(spark)))
    return parse_documents(texts, schema, keep=[KEY])


IS_PACKED = re.compile(rf"\.({'|'.join(PACKED)})$")


def _texts_in_store(spark: SparkSession, prefix: str) -> DataFrame:
    """(``value``, ``_key``) of the objects that are not compressed, listed by the driver.

    Spark puts some thirty small files in a task; the tasks are merged to a few for each core.  Files are read as bytes, as
    the text reader copies Hadoop's settings for each.
    """
    objects = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(prefix)
    plain = objects.where(~F.col("_metadata.file_name").rlike(IS_PACKED.pattern))
    return plain.select(F.col("content").cast("string").alias("value"), decoded_key().alias(KEY)).coalesce(many_tasks(spark))


def _paths_below(spark: SparkSession, folder: str, with_bytes: bool = False) -> DataFrame:
    """(``path``) of the objects at or below a local folder, listed by one task that holds a batch of them at a time.

    ``with_bytes`` leaves out those of zero bytes, which takes a look at each.
    """

    def listed(_: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths = local_files(folder)
        for names in batched((p for p in paths if os.path.getsize(p)) if with_bytes else paths, 10_000):
            yield pa.RecordBatch.from_pydict({"path": pa.array(names, pa.binary())})

    return spark.range(0, 1, 1, 1).mapInArrow(listed, "path binary")


#: Objects that are worth a task of their own.
OBJECTS_A_TASK = 250


def _survey(spark: SparkSession, folder: str) -> tuple[int, bool]:
    """The number of objects at or below a local folder, and whether one has the name of a compressed one."""
    endings = tuple(f".{ending}".encode() for ending in PACKED)

    def looked(_: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, packed = 0, False
        for path in local_files(folder):
            found, packed = found + 1, packed or path.endswith(endings)
        yield pa.RecordBatch.from_pydict({"found": pa.array([found], pa.int64()), "packed": pa.array([packed])})

    found, packed = spark.range(0, 1, 1, 1).mapInArrow(looked, "found long, packed boolean").first()
    return found, packed


#: Bytes of objects that a task gathers before it hands them on.
READ_BYTES = 8 * 1024**2


def _texts_below(spark: SparkSession, folder: str, tasks: int) -> DataFrame:
    """(``value``, ``_key``) of the objects below a local folder that are not compressed.

    Spark's own listing would hold every object in the driver, at some 50 microseconds and a few hundred bytes each.
    """
    endings = tuple(f".{ending}".encode() for ending in PACKED)

    def out(paths: list[bytes], contents: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"path": pa.array(paths, pa.binary()), "content": pa.array(contents, pa.binary())})

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths, contents, held = [], [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                if path.endswith(endings):
                    continue
                with open(path, "rb", buffering=0) as file:
                    content = file.readall()
                if not content:
                    continue
                paths.append(path)
                contents.append(content)
                held += len(content)
                if held > READ_BYTES:
                    yield out(paths, contents)
                    paths, contents, held = [], [], 0
        if paths:
            yield out(paths, contents)

    dealt = _paths_below(spark, folder).repartition(tasks, "path")
    objects = dealt.mapInArrow(read, "path binary, content binary")
    return objects.select(F.col("content").cast("string").alias("value"), _as_uri("path").alias(KEY))


def _as_uri(path: str) -> F.Column:
    """The path as Spark's readers name it, percent signs and spaces as they are."""
    return F.concat(F.lit("file:"), F.col(path).cast("string"))


def read_single_objects(spark: SparkSession, prefix: str, schema: T.StructType) -> DataFrame:
    """Prefixes of one object per file; any other text fails the job."""
    documents = read_documents(spark, prefix, schema)
    problem = F.raise_error(F.lit("a file of one object holds an array of several")).cast("int")
    return documents.withColumn(POS, F.when(F.col(POS) == 0, F.lit(0)).otherwise(problem))


def read_json_lines(spark: SparkSession, prefix: str, schema: T.StructType) -> DataFrame:
    """Files of one JSON value a line, as ``write_keyed_json`` leaves them; blank lines are passed over.

    ``_key`` is the file's and ``_pos`` the place in a line that holds an array.
    """
    try:
        lines = spark.read.option("recursiveFileLookup", "true").text(prefix)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty(spark, with_origin(schema))
    return parse_documents(lines.where(F.trim("value") != "").select("value", decoded_key().alias(KEY)), schema, keep=[KEY])


def discover_fields(spark: SparkSession, prefix: str) -> DataFrame:
    """Every attribute of the records below a prefix: (``field``, ``records``, ``kinds``, ``merged``, ``conflict``).

    ``kinds`` counts the records of each JSON type (VOID: a null), ``merged`` is the type that holds them all
    (VARIANT where none does), ``conflict`` tells that there is more than one type besides nulls.  Counts and merged types are
    partial aggregates, so no document is collected and the result has one row an attribute.
    """
    files = spark.read.option("recursiveFileLookup", "true").text(prefix, wholetext=True)
    documents = files.select(F.parse_json("value").alias("document"))
    is_list = F.schema_of_variant("document").startswith("ARRAY")
    items = documents.where(is_list).lateralJoin(spark.tvf.variant_explode(F.col("document").outer())).select(F.col("value").alias("record"))
    records = documents.where(~is_list).select(F.col("document").alias("record")).unionByName(items)
    fields = records.lateralJoin(spark.tvf.variant_explode(F.col("record").outer())).select(
        F.col("key").alias("field"), "value", F.schema_of_variant("value").alias("kind")
    )
    counted = fields.groupBy("field", "kind").agg(F.count(F.lit(1)).alias("n"))
    merged = fields.groupBy("field").agg(F.schema_of_variant_agg("value").alias("merged"))
    listed = F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "kind", F.col("n").cast("string")))), ",")
    kinds = counted.groupBy("field").agg(
        F.sum("n").alias("records"), listed.alias("kinds"), (F.count_if(F.col("kind") != "VOID") > 1).alias("conflict")
    )
    return kinds.join(merged, "field").select("field", "records", "kinds", "merged", "conflict")


def discover_schema(spark: SparkSession, prefix: str) -> T.StructType:
    """Schema over all records of a prefix, for looking at unknown payloads."""
    return spark.read.option("recursiveFileLookup", "true").json(prefix, multiLine=True, samplingRatio=1.0).schema


def read_landed(spark: SparkSession, root: str, types: Sequence[str] = RECORD_TYPES) -> dict[str, DataFrame]:
    """Lazy raw frames by record type from ``{root}/{type}/raw/{key}.json``."""
    return {t: read_documents(spark, raw_path(root, t), raw_schema(t)) for t in types}


def object_keys(spark: SparkSession, root: str, record_type: str) -> DataFrame | None:
    """(``record_key``) of the objects ``{type}/raw/{record_key}.json``, from their names alone; None if there are none."""
    prefix = raw_path(root, record_type)
    if not exists(spark, prefix):
        return None
    folder = local_path(spark, prefix)
    if folder is None:
        names = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(prefix).select("path")
    else:
        names = _paths_below(spark, folder, with_bytes=True).select(_as_uri("path").alias("path"))
    inside = f"/{record_type}/raw/"
    key = F.regexp_replace(F.substring_index(decoded_key("path"), inside, -1), r"\.json$", "")
    return names.select(key.alias("record_key"))


def _runs(spark: SparkSession, path: str, runs: Mapping[str, str]) -> DataFrame:
    # Stamps are digits and a T, and stay text as Spark infers them.
    folders = [attempt_folder(path, run, attempt) for run, attempt in sorted(runs.items())]
    return spark.read.option("basePath", path).parquet(*folders).drop("attempt")


def read_runs(spark: SparkSession, root: str, record_type: str, without_run: str | None = None) -> DataFrame | None:
    """The newest record of every key with its ``run_ts``; None if no run has been committed.

    Where a snapshot covers the older runs only the runs since are compared: its rows are read as they are, but for
    the keys that a newer run holds.  The records of a single run are read as they are too, if its writer left one for each key.
    """
    runs = {run: a for run, a in attempts(spark, root, record_type).items() if run != without_run}
    if not runs:
        return None
    path = raw_path(root, record_type)
    held = snapshot(spark, root, record_type)
    if held is None or not held.serves(runs):
        if len(runs) == 1 and has_distinct_keys(spark, root, *runs, record_type):
            return _runs(spark, path, runs)
        return keep_last(_runs(spark, path, runs), ["record_key"], ["run_ts"])
    older = spark.read.parquet(held.path)
    since = {run: a for run, a in runs.items() if run not in held.runs}
    if not since:
        return older
    newer = keep_last(_runs(spark, path, since), ["record_key"], ["run_ts"])
    kept = older.join(newer.select("record_key"), "record_key", "left_anti")
    return kept.unionByName(newer, allowMissingColumns=True)


def read_keyed(spark: SparkSession, root: str, record_type: str, without_run: str | None = None) -> DataFrame | None:
    """Records of a bronze dataset, the newest run winning per key; None if no run has been committed.

    Runs are appended side by side.  ``without_run`` leaves one out, as a repeated run has to do with its own.
    """
    records = read_runs(spark, root, record_type, without_run)
    return None if records is None else records.drop("run_ts")


def compact_runs(spark: SparkSession, root: str, record_type: str) -> Snapshot | None:
    """Write the newest record of every key as a snapshot of all runs committed by now; None if there is none."""
    runs = attempts(spark, root, record_type)
    if not runs:
        return None
    made = Snapshot(f"{root.rstrip('/')}/{record_type}/snapshot/{new_attempt()}", runs)
    read_runs(spark, root, record_type).write.parquet(made.path, compression=PARQUET_CODEC)
    commit_snapshot(spark, root, record_type, made)
    return made


def lake_objects(spark: SparkSession, root: str, record_type: str) -> DataFrame:
    """The JSON objects of a type as records of a bronze dataset: one row a key, a roster's members as an array."""
    documents = read_documents(spark, raw_path(root, record_type), raw_schema(record_type))
    key = F.regexp_replace(F.substring_index(KEY, f"/{record_type}/raw/", -1), r"\.json$", "").alias("record_key")
    stamp = F.col("ingested_at").cast("timestamp").alias("ingested_at")
    contract = CONTRACTS[record_type]
    if record_type != "team_roster":
        flagged = validate(documents.select(*contract.columns, key, stamp), contract, carry=("record_key", "ingested_at"))
        problem = F.raise_error(F.concat_ws("; ", F.lit(f"a {record_type} object that is no valid record"), ERRORS)).cast("string")
        checked = F.when(F.size(ERRORS) == 0, F.col("record_key")).otherwise(problem)
        return flagged.withColumn("record_key", checked).drop(ERRORS, "original_payload")
    members = F.array_agg(F.struct(POS, F.struct(*contract.columns).alias("m")))
    gathered = documents.groupBy(key).agg(F.sort_array(members).alias("all"), F.max(stamp).alias("ingested_at"))
    listed = gathered.select("record_key", "ingested_at", F.transform("all", lambda x: x["m"]).alias("members"))
    typed = valid_members(F.col("members"), listed.schema["members"].dataType, contract, {})
    return listed.withColumn("members", typed)


def keyed_as_raw(spark: SparkSession, root: str, record_type: str) -> DataFrame:
    """A bronze dataset in the shape the silver transforms read."""
    records = read_keyed(spark, root, record_type)
    if records is None:
        return empty(spark, with_origin(raw_schema(record_type)))
    key = F.concat("record_key", F.lit(".json")).alias(KEY)
    if record_type == "team_roster":
        return records.select(key, "ingested_at", F.posexplode("members").alias(POS, "m")).select("m.*", "ingested_at", KEY, POS)
    return records.select(*[c for c in records.columns if c != "record_key"], key, F.lit(0).alias(POS))


def raw_frames(spark: SparkSession, root: str, fmt: str, types: Sequence[str]) -> dict[str, DataFrame]:
    """Raw frames by type from JSON documents (``json``) or a bronze dataset (``keyed``)."""
    if fmt == "json":
        return read_landed(spark, root, types)
    if fmt == "keyed":
        return {t: keyed_as_raw(spark, root, t) for t in types}
    raise ValueError(f"unknown bronze format {fmt!r}")
