"""Reversible line deduplication: reference counts of lines, one cuckoo filter a shard.

The index of a corpus lives in a folder that all executors see.  Each generation of it holds two tables, and the
generation that was written last is the index:

* ``counts``: for every line key (128-bit hash, dealt to shards by the hash) the number of documents that hold it.  This is
  the exact truth; adding documents adds to it, removing them subtracts, and a key without documents leaves.
* ``filters``: for every shard a cuckoo filter of the keys that at least ``threshold`` documents hold, and the list of its
  false positives.  A key that reaches the threshold is inserted, one that falls below is deleted; a full filter is
  built again at twice the size from the counts.  Every key the filter could be asked about is in the counts, so its false
  positives are found by probing them, and filter and list together answer exactly.

Cleaning a text asks the filters alone, so lines are not shuffled a second time and the texts never are.  While the filters fit
in ``FILTER_BYTES`` every task loads them all; beyond that the lines' keys go to the tasks of their shards, and only the
answers come back to the documents.  Both ways give the same rows.

A line's key is the line without the white space ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased; keys of fewer than
``least`` code points are neither counted nor dropped.  A line counts once for each row of the table that holds it.

Edge cases: a null or empty text is one empty line; a text that loses all lines becomes empty; repeated rows and rows that share
an id are documents of their own; an empty table gives an empty index and no rows; columns other than id and text are
left out of the result, whatever their names.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duelake.llm.common import slices, staged, texts_of

SPACE = b" \t\n\x0b\x0c\r"
#: Keys a task counts before it hands them on.
KEYS_HELD = 400_000
#: Bytes of filters that every task may hold.
FILTER_BYTES = 64 << 20
SLOTS = 4
#: Tasks of one shard where lines travel to the filters.
SPREAD = 8
#: Moves before a filter counts as full.
KICKS = 400


def line_keys(text: bytes, least: int) -> list[bytes | None]:
    """The key of each line as a 16-byte hash; None for a line that is too short to count."""
    keys = [line.strip(SPACE).lower() for line in text.split(b"\n")]
    return [xxhash.xxh3_128_digest(k) if len(k) >= least and (least < 2 or len(k.decode()) >= least) else None for k in keys]


def halves(keys: Iterable[bytes]) -> np.ndarray:
    """16-byte keys as rows of two signed 64-bit integers."""
    return np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


class CuckooFilter:
    """Fingerprints of 32 bits in two candidate buckets each; every step is deterministic, so a repeated task
    builds the same filter."""

    def __init__(self, capacity: int, table: np.ndarray | None = None):
        buckets = 1
        while buckets * SLOTS * 0.85 < capacity:
            buckets *= 2
        self.table = np.zeros((buckets, SLOTS), np.uint32) if table is None else table

    @classmethod
    def holding(cls, keys: np.ndarray) -> CuckooFilter:
        """A filter of all the keys, enlarged until they fit."""
        capacity = max(len(keys), SLOTS)
        while True:
            made = cls(capacity)
            if made.insert(keys):
                return made
            capacity = made.table.size * 2

    @classmethod
    def loaded(cls, raw: bytes) -> CuckooFilter:
        return cls(0, np.frombuffer(raw, "<u4").reshape(-1, SLOTS).copy())

    def saved(self) -> bytes:
        return self.table.astype("<u4").tobytes()

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        low, high = keys[:, 0].astype(np.uint64), keys[:, 1].astype(np.uint64)
        mask = np.uint64(len(self.table) - 1)
        prints = np.maximum(high & np.uint64(0xFFFFFFFF), np.uint64(1))
        first = mixed(low) & mask
        return prints.astype(np.uint32), first, first ^ (mixed(prints) & mask)

    def has(self, keys: np.ndarray) -> np.ndarray:
        prints, first, second = self._places(keys)
        found = (self.table[first] == prints[:, None]).any(axis=1)
        return found | (self.table[second] == prints[:, None]).any(axis=1)

    def insert(self, keys: np.ndarray) -> bool:
        """Add keys that are not in the filter; False if one found no place (the filter is then of no use)."""
        prints, first, second = self._places(keys)
        table, mask = self.table, len(self.table) - 1
        for fingerprint, one, two in zip(prints.tolist(), first.tolist(), second.tolist(), strict=True):
            bucket = one
            for at in (one, two):
                free = np.flatnonzero(table[at] == 0)
                if len(free):
                    table[at, free[0]] = fingerprint
                    break
            else:
                for kick in range(KICKS):
                    slot = kick % SLOTS
                    fingerprint, table[bucket, slot] = int(table[bucket, slot]), fingerprint
                    bucket ^= int(mixed(np.array([fingerprint], np.uint64))[0]) & mask
                    free = np.flatnonzero(table[bucket] == 0)
                    if len(free):
                        table[bucket, free[0]] = fingerprint
                        break
                else:
                    return False
        return True

    def delete(self, keys: np.ndarray) -> None:
        """Take out keys that were inserted, one copy of the fingerprint each."""
        prints, first, second = self._places(keys)
        for fingerprint, one, two in zip(prints.tolist(), first.tolist(), second.tolist(), strict=True):
            for at in (one, two):
                held = np.flatnonzero(self.table[at] == fingerprint)
                if len(held):
                    self.table[at, held[0]] = 0
                    break
            else:
                raise KeyError("a key that the filter never held")


class ShardUpdate:
    """One shard's filter while the rows (low, high, refs, old) of a change pass by."""

    def __init__(self, number: int, threshold: int):
        self.number, self.threshold = number, threshold
        self.filter: CuckooFilter | None = None
        self.parts: list[np.ndarray] = []
        self.wrong: list[bytes] = []
        self.ready = False

    def common(self, table: np.ndarray) -> None:
        self.parts.append(table)

    def _apply(self) -> None:
        table = np.concatenate(self.parts) if self.parts else np.empty((0, 4), np.int64)
        keys, now, before = table[:, :2], table[:, 2] >= self.threshold, table[:, 3] >= self.threshold
        if self.filter is not None:
            self.filter.delete(keys[before & ~now])
        if self.filter is None or not self.filter.insert(keys[now & ~before]):
            self.filter = CuckooFilter.holding(keys[now])
        self.parts, self.ready = [], True
        self._probe(table[~now & (table[:, 2] > 0)])

    def _probe(self, table: np.ndarray) -> None:
        found = table[self.filter.has(table[:, :2]), :2] if len(table) else table
        if len(found):
            self.wrong.append(np.ascontiguousarray(found).astype("<i8").tobytes())

    def rare(self, table: np.ndarray) -> None:
        if not self.ready:
            self._apply()
        self._probe(table[table[:, 2] > 0])

    def finished(self) -> pa.RecordBatch:
        if not self.ready:
            self._apply()
        columns = [pa.array([self.number], pa.int32()), pa.array([self.filter.saved()]), pa.array([b"".join(self.wrong)])]
        return pa.RecordBatch.from_arrays(columns, names=["shard", "filter", "exceptions"])


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (keys[:, 1].astype(np.uint64) >> np.uint64(40)).astype(np.int64) % shards


def _counted(docs: DataFrame, text: str, sign: int, shards: int, least: int) -> DataFrame:
    """Rows of ``COUNTS``: documents a key is in, added up per key within a task first."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in slices(batches, "text"):
            for body in texts_of(batch, "text"):
                held.update({k for k in line_keys(body, least) if k is not None})
            if len(held) > KEYS_HELD:
                yield packed(held)
                held = Counter()
        if held:
            yield packed(held)

    def packed(held: Counter) -> pa.RecordBatch:
        keys = halves(held)
        refs = np.fromiter(held.values(), np.int64, len(held)) * sign
        columns = [shard_of(keys, shards).astype(np.int32), keys[:, 0].copy(), keys[:, 1].copy(), refs, np.zeros_like(refs)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["shard", "low", "high", "refs", "old"])

    return docs.select(F.col(text).alias("text")).mapInArrow(run, COUNTS)


COUNTS = "shard int, low long, high long, refs long, old long"
FILTERS = "shard int, filter binary, exceptions binary"


@dataclass(frozen=True)
class LineIndex:
    """The index at one generation; ``tables`` is the folder of that generation (None: nothing was added yet).

    ``shards`` sets the memory of a task: it holds the common keys of one shard, 16 bytes each.
    """

    spark: SparkSession
    folder: str
    threshold: int = 10
    least: int = 1
    shards: int = 32
    tables: str | None = None

    def counts(self) -> DataFrame:
        """(``shard``, ``low``, ``high``, ``refs``): the documents that hold a key."""
        held = self._read("counts", COUNTS)
        return held.where("refs > 0").drop("old")

    def filters(self) -> DataFrame:
        return self._read("filters", FILTERS)

    def _read(self, name: str, schema: str) -> DataFrame:
        if self.tables is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.tables}/{name}")

    def insert(self, docs: DataFrame, text: str = "text") -> LineIndex:
        return self._changed(docs, text, 1)

    def delete(self, docs: DataFrame, text: str = "text") -> LineIndex:
        """Take out documents that were inserted with these texts; the index is then as if they had never been in it."""
        return self._changed(docs, text, -1)

    def _changed(self, docs: DataFrame, text: str, sign: int) -> LineIndex:
        after = replace(self, tables=f"{self.folder}/{uuid.uuid4().hex}")
        both = _counted(docs, text, sign, self.shards, self.least)
        if self.tables is not None:
            # Keys keep their old count beside the new one, so a filter knows which keys cross the threshold.
            both = both.unionByName(self.counts().withColumn("old", F.col("refs")))
        sums = both.groupBy("shard", "low", "high").agg(F.sum("refs").alias("refs"), F.sum("old").alias("old"))
        sums.write.parquet(f"{after.tables}/counts")
        joint = after._read("counts", COUNTS)
        if not joint.where("refs < 0").isEmpty():
            raise ValueError("documents are taken out that the index does not hold")
        self._filtered(joint).write.parquet(f"{after.tables}/filters")
        return after

    def _filtered(self, joint: DataFrame) -> DataFrame:
        """The filters after a change: crossing keys are put in and taken out, false positives listed anew.

        A shard's rows come in order: its old filter, the keys that are or were common, then the rare ones, which are
        probed as they stream by.
        """
        threshold = self.threshold
        turn = F.when(F.greatest("refs", "old") >= threshold, 1).otherwise(2)
        rows = joint.where("refs > 0 or old > 0").select("*", turn.alias("turn"), F.lit(None).cast("binary").alias("filter"))
        old = self.filters().select("shard", F.lit(0).alias("turn"), "filter")
        stream = (
            rows.unionByName(old, allowMissingColumns=True)
            .repartition(self.shards, "shard")
            .sortWithinPartitions("shard", "turn", "low", "high")
            .select("shard", "turn", "low", "high", "refs", "old", "filter")
        )

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shard: ShardUpdate | None = None
            for batch in batches:
                of, turns = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                starts = np.flatnonzero((np.diff(of) != 0) | (np.diff(turns) != 0)) + 1
                for start, end in zip([0, *starts.tolist()], [*starts.tolist(), len(of)], strict=True):
                    if start == end:
                        continue
                    if shard is None or shard.number != of[start]:
                        if shard is not None:
                            yield shard.finished()
                        shard = ShardUpdate(int(of[start]), threshold)
                    part = batch.slice(start, end - start)
                    if turns[start] == 0:
                        shard.filter = CuckooFilter.loaded(part.column(6)[0].as_py())
                    else:
                        table = np.stack([part.column(i).to_numpy() for i in (2, 3, 4, 5)], axis=1)
                        (shard.common if turns[start] == 1 else shard.rare)(table)
            if shard is not None:
                yield shard.finished()

        return stream.mapInArrow(run, FILTERS)

    def clean(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = FILTER_BYTES) -> DataFrame:
        """(``doc_id``, ``text``, ``n_lines``, ``n_dropped``) of indexed documents, without the lines of common keys."""
        size = self.filters().agg(F.sum(F.octet_length("filter") + F.octet_length("exceptions"))).first()[0] or 0
        source = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        return self._clean_here(source) if size <= most else self._clean_by_shard(source)

    def _clean_here(self, source: DataFrame) -> DataFrame:
        held = [(r.shard, bytes(r.filter), bytes(r.exceptions)) for r in self.filters().collect()]
        known = self.spark.sparkContext.broadcast(held)
        least, shards = self.least, self.shards

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            filters = {s: _Answers(raw, wrong) for s, raw, wrong in known.value}
            for batch in slices(batches, "text"):
                bodies = texts_of(batch, "text")
                keys = [line_keys(body, least) for body in bodies]
                distinct = list({k for ks in keys for k in ks if k is not None})
                drop = set(_common(distinct, filters, shards))
                yield _cleaned(batch, bodies, [[k in drop for k in ks] for ks in keys])

        return source.mapInArrow(run, _schema(source))

    def _clean_by_shard(self, source: DataFrame) -> DataFrame:
        """Keys travel to their shard's filter and the numbers of dropped lines back to the text, by a row number that is
        written down first.  Every shard has ``SPREAD`` tasks, so the lines of a very common key do not meet in one."""
        least, shards = self.least, self.shards
        numbered = staged(source.withColumn("row", F.monotonically_increasing_id()), "line-rows")

        def keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text"):
                for row, body in zip(batch.column(0).to_pylist(), texts_of(batch, "text"), strict=True):
                    lines = [(i, k) for i, k in enumerate(line_keys(body, least)) if k is not None]
                    if lines:
                        shard = shard_of(halves(k for _, k in lines), shards).astype(np.int32)
                        columns = [pa.array([row] * len(lines), pa.int64()), pa.array([i for i, _ in lines], pa.int32())]
                        columns += [pa.array(shard), pa.array([k for _, k in lines], pa.binary())]
                        yield pa.RecordBatch.from_arrays(columns, names=["row", "line", "shard", "key"])

        def asked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            answers: dict[int, _Answers] = {}
            for batch in batches:
                has_filter = batch.column(4).is_valid().to_numpy(zero_copy_only=False)
                answers = dict([*answers.items()][-1:])  # only the last shard goes on into the next batch
                for row in batch.take(pa.array(np.flatnonzero(has_filter))).to_pylist():
                    answers[row["shard"]] = _Answers(row["filter"], row["exceptions"])
                part = batch.take(pa.array(np.flatnonzero(~has_filter)))
                keys = part.column(3).to_pylist()
                drop = set(_common(list(set(keys)), answers, shards))
                yield part.filter(pa.array([k in drop for k in keys], pa.bool_())).select(["row", "line"])

        pairs = numbered.select("row", "text").mapInArrow(keyed, "row long, line int, shard int, key binary")
        pairs = pairs.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(SPREAD)).cast("int"))
        answers = self.filters().select(F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("part"), "shard", "filter", "exceptions")
        columns = ["row", "line", "shard", "key", "filter", "exceptions"]
        dropped = (
            pairs.unionByName(answers, allowMissingColumns=True)
            .repartition(SPREAD * shards, "part", "shard")
            .sortWithinPartitions("part", "shard", F.col("row").asc_nulls_first())
            .select(columns)
            .mapInArrow(asked, "row long, line int")
            .groupBy("row")
            .agg(F.collect_list("line").alias("drop"))
        )

        def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text"):
                bodies = texts_of(batch, "text")
                gone = [set(d or ()) for d in batch.column(2).to_pylist()]
                flags = [[i in g for i in range(body.count(b"\n") + 1)] for body, g in zip(bodies, gone, strict=True)]
                yield _cleaned(batch, bodies, flags)

        return numbered.join(dropped, "row", "left").select("doc_id", "text", "drop").mapInArrow(cut, _schema(source))


class _Answers:
    """A shard's filter with its false positives."""

    def __init__(self, raw: bytes, wrong: bytes):
        self.filter = CuckooFilter.loaded(raw)
        self.wrong = {wrong[i : i + 16] for i in range(0, len(wrong), 16)}

    def common(self, keys: list[bytes]) -> list[bytes]:
        found = np.flatnonzero(self.filter.has(halves(keys))).tolist()
        return [keys[i] for i in found if keys[i] not in self.wrong]


def _common(keys: list[bytes], filters: dict[int, _Answers], shards: int) -> Iterator[bytes]:
    """Those of the distinct keys that the filters of their shards hold."""
    if not keys:
        return
    of = shard_of(halves(keys), shards)
    order = np.argsort(of, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(of[order])) + 1):
        answers = filters.get(int(of[group[0]]))
        if answers is not None:
            yield from answers.common([keys[i] for i in group.tolist()])


def _schema(source: DataFrame) -> str:
    return f"doc_id {source.schema['doc_id'].dataType.simpleString()}, text string, n_lines long, n_dropped long"


def _cleaned(batch: pa.RecordBatch, bodies: list[bytes], drop: list[list[bool]]) -> pa.RecordBatch:
    texts = [
        b"\n".join([line for line, gone in zip(body.split(b"\n"), flags, strict=True) if not gone]) if any(flags) else body
        for body, flags in zip(bodies, drop, strict=True)
    ]
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0),
            pa.array(texts, pa.binary()).cast(pa.string()),
            pa.array([len(flags) for flags in drop], pa.int64()),
            pa.array([sum(flags) for flags in drop], pa.int64()),
        ],
        names=["doc_id", "text", "n_lines", "n_dropped"],
    )
