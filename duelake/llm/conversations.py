"""Conversation structure repair by a persistent audit DP.

A repaired conversation's roles read ``(s?(ua)+)?``: an optional system turn, then user and assistant in turn, or nothing.
Each row is kept (K, cost 0), re-roled to user or assistant (R, 2) or deleted (D, 3); empty user or assistant turns can be
inserted anywhere (I, 2).  Blank rows and repeats of an earlier row have to go; a truncated row that stays costs 1 more.
Of the cheapest edits the one whose initials are least in ASCII order is the audit.

The search holds one edit string for each of four states (nothing yet, system, user or assistant last).  Edit strings are
linked nodes that share their prefixes (``EditLog``): a node knows its last edit, its ancestors at powers of two and a rolling
hash of its whole string, so two strings of equal cost are compared by a search for their longest common prefix.
Strings of equal cost at one row are never prefixes of each other, as each edit has its own cost and a longer string would
have further insertions.  Equal strings are the same node, so a hash that says "equal" for two nodes is a collision; it
is found at once and settled by comparing edit by edit.

Rows are streamed in order from a sorted partition.  Once the live strings agree on a prefix, that part is final: its rows go to
the digest and are forgotten, so memory is bounded by what is still undecided and not by the length of a
conversation.  A conversation is one stream, because its digest is a hash over all of its repaired text in order;
neither its rows nor its texts are collected.

Order: by turn, nulls first, then role, text.  Edge cases: nulls count as one space (so a null text is blank); a null id is a
conversation of its own; every id of the input has a row, also if no row is left: zeros, an empty audit, the hash
of nothing; repeated rows are duplicates; a role is judged by its first character; an empty table gives none;
other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duelake.llm.common import slices, texts_of

SPACE = b" \t\n\x0b\x0c\r"
DELETE, INSERT, KEEP, REROLE = b"DIKR"
#: Nodes and bytes of undecided rows after which the agreed part is cut off.
NODES_HELD = 40_000
BYTES_HELD = 16 << 20
# States of a repaired conversation.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: Where a kept role's initial leads; other moves are not allowed.
KEPT = {
    (NOTHING, b"s"): SYSTEM,
    (NOTHING, b"u"): USER,
    (SYSTEM, b"u"): USER,
    (ASSISTANT, b"u"): USER,
    (USER, b"a"): ASSISTANT,
}
LEGAL = {b"su", b"ua", b"au"}
LONGEST = (1 << 63) - 1


class EditLog:
    """Edit strings as nodes that share prefixes; node 0 is the empty string."""

    MODULUS = (1 << 61) - 1
    BASE = 1_000_003

    def __init__(self):
        self.edit, self.depth, self.hash, self.above = [0], [0], [0], [[]]

    def add(self, node: int, edit: int) -> int:
        above = [node]
        while len(higher := self.above[above[-1]]) >= len(above):
            above.append(higher[len(above) - 1])
        self.edit.append(edit)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * self.BASE + edit) % self.MODULUS)
        self.above.append(above)
        return len(self.edit) - 1

    def lifted(self, node: int, depth: int) -> int:
        """The ancestor of that depth: the prefix of that length."""
        while self.depth[node] > depth:
            node = self.above[node][(self.depth[node] - depth).bit_length() - 1]
        return node

    def common(self, x: int, y: int) -> tuple[int, int]:
        """The nodes at which two strings first differ; twice the same node if one is a prefix of the other."""
        depth = min(self.depth[x], self.depth[y])
        x, y = self.lifted(x, depth), self.lifted(y, depth)
        if x == y:
            return x, y
        if self.hash[x] == self.hash[y]:
            return self._walked(x, y)
        for k in range(len(self.above[x]) - 1, -1, -1):
            if k < len(self.above[x]) and self.hash[self.above[x][k]] != self.hash[self.above[y][k]]:
                x, y = self.above[x][k], self.above[y][k]
        if self.above[x][0] != self.above[y][0]:
            return self._walked(x, y)
        return x, y

    def _walked(self, x: int, y: int) -> tuple[int, int]:
        """Hashes collided: up to the shared node, one edit at a time; the last pair below it differs."""
        while self.above[x][0] != self.above[y][0]:
            x, y = self.above[x][0], self.above[y][0]
        return x, y

    def less(self, x: int, y: int) -> bool:
        one, two = self.common(x, y)
        return self.depth[x] < self.depth[y] if one == two else self.edit[one] < self.edit[two]

    def text(self, node: int, after: int = 0) -> bytes:
        """The edits of a node below the depth ``after``."""
        out = bytearray()
        while self.depth[node] > after:
            out.append(self.edit[node])
            node = self.above[node][0]
        return bytes(reversed(out))


class Repair:
    """One conversation, row by row."""

    def __init__(self, nodes_held: int = NODES_HELD, bytes_held: int = BYTES_HELD):
        self.log = EditLog()
        self.best: list[tuple[int, int] | None] = [(0, 0), None, None, None]
        self.limit = [nodes_held, bytes_held]
        self.rows: list[tuple[bytes, bytes]] = []
        self.held = 0
        self.audit = bytearray()
        self.out = NOTHING
        self.digest = hashlib.sha256()
        self.messages = 0
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.before: bytes | None = None
        self.turns = 0
        self.first = self.last = None

    def _better(self, state: int, cost: int, node: int, edit: int) -> None:
        """Take ``node`` followed by ``edit`` for a state if it is cheaper, or as cheap and earlier in order."""
        now = self.best[state]
        if now is None or cost < now[0]:
            self.best[state] = (cost, self.log.add(node, edit))
        elif cost == now[0]:
            made = self.log.add(node, edit)
            if self.log.less(made, now[1]):
                self.best[state] = (cost, made)

    def _inserted(self) -> None:
        for state in (NOTHING, SYSTEM, ASSISTANT):
            if self.best[state] is not None:
                self._better(USER, self.best[state][0] + 2, self.best[state][1], INSERT)
        if self.best[USER] is not None:
            self._better(ASSISTANT, self.best[USER][0] + 2, self.best[USER][1], INSERT)
        # What these states can still become, an answered conversation can for less: a first system turn costs it at most 3.
        done = self.best[ASSISTANT][0]
        if self.best[NOTHING] is not None and self.best[NOTHING][0] > done + 3:
            self.best[NOTHING] = None
        if self.best[SYSTEM] is not None and self.best[SYSTEM][0] > done:
            self.best[SYSTEM] = None

    def row(self, turn: int | None, role: bytes, text: bytes, duplicate: bool) -> None:
        if turn is not None:
            if turn != self.last:
                self.turns += 1
            self.first, self.last = turn if self.first is None else self.first, turn
        initial = role.decode()[:1].encode()
        if self.before is not None and self.before + initial not in LEGAL:
            self.counts["illegal"] += 1
        self.before = initial
        body = text.strip(SPACE)
        fault = "blank" if not body else "duplicate" if duplicate else "truncated" if body[-1] not in b".!?" else None
        if fault:
            self.counts[fault] += 1
        self._inserted()
        was, self.best = self.best, [None] * 4
        extra = int(fault == "truncated")
        for state, held in enumerate(was):
            if held is None:
                continue
            cost, node = held
            self._better(state, cost + 3, node, DELETE)
            if fault in ("blank", "duplicate"):
                continue
            if (to := KEPT.get((state, initial))) is not None:
                self._better(to, cost + extra, node, KEEP)
            self._better(ASSISTANT if state == USER else USER, cost + 2 + extra, node, REROLE)
        self.rows.append((role, text))
        self.held += len(text)
        if len(self.log.edit) > self.limit[0] or self.held > self.limit[1]:
            self._cut()

    def _cut(self) -> None:
        """Settle the prefix that all live strings share, and begin a new log with what they do not."""
        log = self.log
        live = [held[1] for held in self.best if held is not None]
        shared = live[0]
        for node in live[1:]:
            one, two = log.common(shared, node)
            shared = one if one == two else log.above[one][0]
        depth = log.depth[shared]
        if depth < max(log.depth[n] for n in live) // 2:
            self.limit = [2 * limit for limit in self.limit]  # too little is settled yet
        self._settle(log.text(shared))
        self.log, made = EditLog(), {b"": 0}
        for state, held in enumerate(self.best):
            if held is not None:
                rest = log.text(held[1], depth)
                for end in range(1, len(rest) + 1):
                    if rest[:end] not in made:
                        made[rest[:end]] = self.log.add(made[rest[: end - 1]], rest[end - 1])
                self.best[state] = (held[0], made[rest])

    def _settle(self, edits: bytes) -> None:
        self.audit += edits
        at = 0
        for edit in edits:
            role, text = b"", b""
            if edit != INSERT:
                role, text = self.rows[at]
                at += 1
            if edit == DELETE:
                continue
            if edit == KEEP:
                self.out = KEPT[self.out, role.decode()[:1].encode()]
            else:
                self.out = ASSISTANT if self.out == USER else USER
                role = b"assistant" if self.out == ASSISTANT else b"user"
            self.message(role, text)
        self.held -= sum(len(text) for _, text in self.rows[:at])
        del self.rows[:at]

    def message(self, role: bytes, text: bytes) -> None:
        self.digest.update((b"\n" if self.messages else b"") + role + b":" + text)
        self.messages += 1

    def finish(self) -> dict:
        self._inserted()
        cost, node = self.best[ASSISTANT]
        empty = self.best[NOTHING]
        if empty is not None and (empty[0] < cost or empty[0] == cost and self.log.less(empty[1], node)):
            cost, node = empty
        self._settle(self.log.text(node))
        gaps = 0 if self.first is None else min(self.last - self.first + 1 - self.turns, LONGEST)
        return {
            "gaps": gaps,
            **self.counts,
            "cost": cost,
            "audit": self.audit.decode(),
            "messages": self.messages,
            "repaired_sha256": self.digest.hexdigest(),
        }


class Messages(Repair):
    """Keeps the repaired messages that became final, to be handed on."""

    def __init__(self, *limits: int):
        super().__init__(*limits)
        self.ready: list[tuple[int, bytes, bytes]] = []

    def message(self, role: bytes, text: bytes) -> None:
        self.ready.append((self.messages, role, text))
        self.messages += 1


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with the faults that ``crc32(conv_id:turn) % 20`` deals out; dropped rows stay as rows without ``role``.

    0 drops, 1 empties the text, 2 removes its ``. ! ?``, 3 repeats the row, 4 makes it a user's.
    """
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = shown("text")
    dealt = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(fault == 0, F.lit(None)).when(fault == 4, "user").otherwise(shown("role")).alias("role"),
        F.when(fault.isin(0, 1), "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("copies"),
    )
    return dealt.withColumn("copy", F.explode("copies")).drop("copies", "copy")


def undamaged(conversations: DataFrame) -> DataFrame:
    """The rows as they are, nulls as one space."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    return conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), shown("role"), shown("text"))


def _ordered(rows: DataFrame) -> DataFrame:
    """Each conversation in one partition, in order, with the rows that repeat an earlier one marked."""
    earlier = Window.partitionBy("conv_id", "role", "text").orderBy("turn")
    return (
        rows.repartition("conv_id")
        .withColumn("duplicate", F.row_number().over(earlier) > 1)
        .sortWithinPartitions("conv_id", "turn", "role", "text", "duplicate")
        .select("conv_id", "turn", "role", "text", "duplicate")
    )


def _streamed(batches: Iterable[pa.RecordBatch], kind: type[Repair], limits: tuple[int, ...]) -> Iterator[tuple[int | None, Repair, bool]]:
    """(id, its repair so far, whether it is complete) after each batch and at each conversation's end."""
    current: Repair | None = None
    key: int | None = None
    for batch in slices(batches, "text", 1 << 20):
        ids, turns = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        roles = batch.column(2).cast(pa.binary()).to_pylist()
        for conv, turn, role, text, again in zip(
            ids, turns, roles, texts_of(batch, "text"), batch.column(4).to_pylist(), strict=True
        ):
            if current is None or conv != key:
                if current is not None:
                    yield key, current, True
                key, current = conv, kind(*limits)
            if role is not None:
                current.row(turn, role, text, again)
        if current is not None:
            yield key, current, False
    if current is not None:
        yield key, current, True


AUDIT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "messages long, repaired_sha256 string"
)


def audits(rows: DataFrame, nodes_held: int = NODES_HELD, bytes_held: int = BYTES_HELD) -> DataFrame:
    """One row for each conversation: faults, cost, audit and the digest of the repaired ``role:text`` lines."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size = 0
        for key, repair, complete in _streamed(batches, Repair, (nodes_held, bytes_held)):
            if complete:
                held.append({"conv_id": key, **repair.finish()})
                size += len(held[-1]["audit"]) + 200
                if size > 1 << 20:
                    yield pa.RecordBatch.from_pylist(held, schema)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)

    schema = pa.schema(
        [(n, pa.string() if n in ("audit", "repaired_sha256") else pa.int64()) for n in (p.split()[0] for p in AUDIT.split(", "))]
    )
    return _ordered(rows).mapInArrow(run, AUDIT)


def repaired(rows: DataFrame, nodes_held: int = NODES_HELD, bytes_held: int = BYTES_HELD) -> DataFrame:
    """The repaired conversations themselves: (``conv_id``, ``position``, ``role``, ``text``)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, repair, complete in _streamed(batches, Messages, (nodes_held, bytes_held)):
            if complete:
                repair.finish()
            if repair.ready:
                position, role, text = zip(*repair.ready, strict=True)
                repair.ready = []
                columns = [pa.array([key] * len(position), pa.int64()), pa.array(position, pa.int64())]
                columns += [pa.array(c, pa.binary()).cast(pa.string()) for c in (role, text)]
                yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "position", "role", "text"])

    return _ordered(rows).mapInArrow(run, "conv_id long, position long, role string, text string")
