"""Which attempts of which runs count: the manifests of a bronze root.

A run writes every record type below a folder of its own attempt, ``{type}/raw/run_ts={run}/attempt={id}``, and
states them all in one manifest, ``commits/run_ts={run}/{n}.json``, when the last of them is complete.  The
manifest with the greatest number is the run's state, so a repeated run switches from its old records to its new ones at
one moment, and an attempt that fails leaves the state as it was.  A manifest is written under another name and
renamed; of two attempts that finish together one fails.

A snapshot holds the newest record of every key over the runs it names (``snapshots/{type}/{n}.json``), so readers need to
compare only the runs since.  Manifests hold a few names for each run and are read on the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession

from duelake.sources.files import delete_path, file_names, read_text, write_new

RECORDS, QUARANTINE = "records", "quarantine"
#: The record types of a run whose writer left one record for each key.
DISTINCT = "distinct"


def new_attempt() -> str:
    return uuid.uuid4().hex


def raw_path(root: str, record_type: str) -> str:
    return f"{root.rstrip('/')}/{record_type}/raw"


def quarantine_path(root: str, record_type: str) -> str:
    return f"{root.rstrip('/')}/quarantine/{record_type}"


def attempt_folder(base: str, run_ts: str, attempt: str) -> str:
    return f"{base}/run_ts={run_ts}/attempt={attempt}"


def _manifests(spark: SparkSession, folder: str) -> list[str]:
    return [n for n in file_names(spark, folder) if n.endswith(".json")]


def _latest(spark: SparkSession, folder: str) -> dict | None:
    names = _manifests(spark, folder)
    return json.loads(read_text(spark, f"{folder}/{names[-1]}")) if names else None


def _append(spark: SparkSession, folder: str, content: Mapping) -> None:
    names = _manifests(spark, folder)
    number = int(names[-1].removesuffix(".json")) + 1 if names else 1
    write_new(spark, f"{folder}/{number:08d}.json", json.dumps(content, sort_keys=True))


def _runs_folder(root: str) -> str:
    return f"{root.rstrip('/')}/commits"


def commit(
    spark: SparkSession,
    root: str,
    run_ts: str,
    records: Mapping[str, str],
    quarantine: Mapping[str, str] | None = None,
    keep: bool = False,
    distinct: Iterable[str] = (),
) -> None:
    """State the attempts that make up a run, by record type; ``keep`` leaves the types that are not named as they were.

    ``distinct`` names the types whose records are known to have keys of their own.
    """
    folder = f"{_runs_folder(root)}/run_ts={run_ts}"
    before = (_latest(spark, folder) if keep else None) or {RECORDS: {}, QUARANTINE: {}}
    single = {t for t in before.get(DISTINCT, ()) if t not in records} | set(distinct)
    state = {RECORDS: {**before[RECORDS], **records}, QUARANTINE: {**before[QUARANTINE], **(quarantine or {})}}
    _append(spark, folder, {**state, DISTINCT: sorted(single)})


def committed(spark: SparkSession, root: str) -> dict[str, dict]:
    """The newest manifest of every run."""
    folder = _runs_folder(root)
    found = {n.removeprefix("run_ts="): _latest(spark, f"{folder}/{n}") for n in file_names(spark, folder)}
    return {run: manifest for run, manifest in found.items() if manifest}


def attempts(spark: SparkSession, root: str, record_type: str, kind: str = RECORDS) -> dict[str, str]:
    """run -> attempt of one record type."""
    return {run: m[kind][record_type] for run, m in committed(spark, root).items() if record_type in m[kind]}


def has_distinct_keys(spark: SparkSession, root: str, run_ts: str, record_type: str) -> bool:
    """Whether the run's writer left one record for each key of a type."""
    manifest = _latest(spark, f"{_runs_folder(root)}/run_ts={run_ts}") or {}
    return record_type in manifest.get(DISTINCT, ())


@dataclass(frozen=True)
class Snapshot:
    """``path`` holds the newest record per key over ``runs`` (run -> attempt)."""

    path: str
    runs: Mapping[str, str]

    def serves(self, runs: Mapping[str, str]) -> bool:
        """Whether it is part of these runs: none of its own was repeated or left out, all others are newer."""
        own = all(runs.get(run) == attempt for run, attempt in self.runs.items())
        return own and all(run > max(self.runs) for run in runs if run not in self.runs)


def snapshot(spark: SparkSession, root: str, record_type: str) -> Snapshot | None:
    found = _latest(spark, f"{root.rstrip('/')}/snapshots/{record_type}")
    return Snapshot(found["path"], found["runs"]) if found else None


def commit_snapshot(spark: SparkSession, root: str, record_type: str, made: Snapshot) -> None:
    _append(spark, f"{root.rstrip('/')}/snapshots/{record_type}", {"path": made.path, "runs": dict(made.runs)})


def sweep(spark: SparkSession, root: str, types: list[str] | tuple[str, ...]) -> int:
    """Remove attempts that no manifest names, and snapshots that were replaced; the number removed.

    Not while a run is writing or a job reads the root.
    """
    removed = 0
    for record_type in types:
        for kind, base in ((RECORDS, raw_path(root, record_type)), (QUARANTINE, quarantine_path(root, record_type))):
            valid = attempts(spark, root, record_type, kind)
            for run in (n for n in file_names(spark, base) if n.startswith("run_ts=")):
                for name in file_names(spark, f"{base}/{run}"):
                    if name.startswith("attempt=") and name != f"attempt={valid.get(run.removeprefix('run_ts='))}":
                        delete_path(spark, f"{base}/{run}/{name}")
                        removed += 1
        folder = f"{root.rstrip('/')}/{record_type}/snapshot"
        held = snapshot(spark, root, record_type)
        for name in file_names(spark, folder):
            if held is None or held.path != f"{folder}/{name}":
                delete_path(spark, f"{folder}/{name}")
                removed += 1
    return removed
