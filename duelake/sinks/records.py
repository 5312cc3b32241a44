"""Bronze datasets, quarantine folders and the flagged staging in front of them."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from duelake.operators.contracts import ERRORS, accepted, rejected
from duelake.operators.keys import keep_last
from duelake.commits import (
    QUARANTINE,
    attempt_folder,
    attempts,
    commit,
    new_attempt,
    quarantine_path,
    raw_path,
)
from duelake.session import PARQUET_CODEC, many_tasks
from duelake.sinks.tables import counted
from duelake.sources.files import ObjectWriter, delete_path


def stage_flagged(flagged: DataFrame, path: str) -> tuple[DataFrame, dict[str, int]]:
    """Write validated attempts once; return them read back, and their tally.

    Valid and invalid rows are both needed downstream.  Staging them means the
    nested payload is exploded and checked once, the counts come from the write
    itself, and later failures restart from the staged files.
    """
    seen = Observation()
    (
        flagged.observe(
            seen,
            F.count_if(F.size(ERRORS) == 0).alias("valid"),
            F.count_if(F.size(ERRORS) > 0).alias("invalid"),
        )
        .write.mode("overwrite")
        .parquet(path, compression=PARQUET_CODEC)
    )
    spark = flagged.sparkSession
    return spark.read.schema(flagged.schema).parquet(path), dict(seen.get)


def observed(flagged: DataFrame) -> tuple[DataFrame, Observation]:
    """Validated attempts with an observation of the ``valid`` ones, filled by the action that reads them."""
    seen = Observation()
    return flagged.observe(seen, F.count_if(F.size(ERRORS) == 0).alias("valid")), seen


def last_accepted(flagged: DataFrame, order: str = "_order") -> DataFrame:
    """The valid records, last write per key."""
    return keep_last(accepted(flagged), ["record_key"], [order]).drop(order)


def write_attempt(records: DataFrame, root: str, record_type: str, run_ts: str, attempt: str) -> None:
    """One attempt's records of a run; they count once a manifest names the attempt."""
    records.write.mode("overwrite").parquet(attempt_folder(raw_path(root, record_type), run_ts, attempt), compression=PARQUET_CODEC)


def drop_attempt(spark: SparkSession, root: str, record_type: str, run_ts: str, attempt: str) -> None:
    """Remove an attempt that holds no record."""
    delete_path(spark, attempt_folder(raw_path(root, record_type), run_ts, attempt))


def write_keyed(records: DataFrame, root: str, record_type: str, run_ts: str) -> None:
    """Add one run of records to a bronze dataset, or replace that run's.

    Readers let the newest run win per key.
    """
    attempt = new_attempt()
    write_attempt(records, root, record_type, run_ts, attempt)
    commit(records.sparkSession, root, run_ts, {record_type: attempt}, keep=True)


def write_keyed_json(records: DataFrame, root: str, record_type: str, run_ts: str) -> None:
    """The same run as JSON lines, dates as ISO text."""
    records.select(as_json(F.struct("*")).alias("value")).write.mode("overwrite").text(
        f"{raw_path(root, record_type)}/run_ts={run_ts}"
    )


def as_json(value: Column) -> Column:
    return F.to_json(value, {"ignoreNullFields": "false"})


def documents_of(records: DataFrame) -> DataFrame:
    """(``record_key``, ``document``): the JSON object of each record, or the array of a roster's members."""
    if "members" in records.columns:
        names = records.schema["members"].dataType.elementType.names
        body = F.transform("members", lambda m: F.struct(*(m[n].alias(n) for n in names), F.col("ingested_at")))
    else:
        body = F.struct(*[F.col(f"`{c}`") for c in records.columns if c != "record_key"])
    return records.select("record_key", as_json(body).alias("document"))


def write_objects(records: DataFrame, root: str, record_type: str) -> int:
    """One object for each record, ``{type}/raw/{record_key}.json``; an object of that key is replaced.

    Every task writes the objects of its rows, so there has to be one row a key; the rows are dealt over many tasks, as an object
    takes far more time than its bytes tell adaptive execution.  A file appears whole (``ObjectWriter``).  A repeated task writes
    the same objects again.  Returns the number of objects.
    """
    base = raw_path(root, record_type)

    def save(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        written = 0
        with ObjectWriter(base) as objects:
            for batch in batches:
                for key, document in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    objects.put(f"{key}.json", document.encode())
                    written += 1
        yield pa.RecordBatch.from_pydict({"written": pa.array([written], pa.int64())})

    dealt = documents_of(records).repartition(many_tasks(records.sparkSession), "record_key")
    return dealt.mapInArrow(save, "written long").agg(F.sum("written")).first()[0] or 0


def write_quarantine(
    flagged: DataFrame, root: str, record_type: str, run_ts: str, key: str = "quarantine_key", attempt: str | None = None
) -> None:
    """The rejected records of one run, each with its payload and errors, as compressed JSON lines.

    With an ``attempt`` they count once a manifest names it, else at once.
    """
    stamped = rejected(flagged, key).withColumn(
        "record_key", F.concat_ws("_", "record_key", F.lit(run_ts))
    )
    own = attempt or new_attempt()
    stamped.write.mode("overwrite").json(attempt_folder(quarantine_path(root, record_type), run_ts, own), compression="gzip")
    if attempt is None:
        commit(flagged.sparkSession, root, run_ts, {}, {record_type: own}, keep=True)


QUARANTINE_SCHEMA = f"record_key string, original_payload string, {ERRORS} array<string>"


def read_quarantine(spark: SparkSession, root: str, record_type: str) -> DataFrame:
    """The rejected records of all committed runs."""
    base = quarantine_path(root, record_type)
    paths = [attempt_folder(base, run, a) for run, a in sorted(attempts(spark, root, record_type, QUARANTINE).items())]
    return spark.read.schema(QUARANTINE_SCHEMA).json(paths) if paths else spark.createDataFrame([], QUARANTINE_SCHEMA)


def write_violations(spark: SparkSession, violations: DataFrame, root: str, table: str, run_ts: str) -> int:
    """Rows with an incomplete key, as Parquet; no folder when there are none."""
    path = f"{root.rstrip('/')}/quarantine/{table}/run_ts={run_ts}"
    rows, seen = counted(violations)
    rows.write.mode("overwrite").parquet(path, compression=PARQUET_CODEC)
    written = seen.get["rows"]
    if written == 0:
        delete_path(spark, path)
    return written
