"""Byte-level BPE: encode and decode a corpus by replaying the merges over its distinct words.

Every task takes the documents of its partition in blocks.  The distinct words of
a block (matches of the split pattern) lie end to end in one chain of symbols, and an
inverted index names, for every pair that can merge, the places where it
stands.  Merges are applied in rank order, each at all its places at once; a
merge only looks at the neighbours it touches.  Words never influence each
other, so the outcome is the same however the corpus is cut into blocks, and
no word has to be shuffled to meet its copies.

Edge cases: a null or empty text has no ids; repeated documents are encoded each for itself; a word of any
length costs time in proportion to its merges.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from duelake.llm.common import give_back, slices, texts_of

#: Pairs are kept as one integer: left * PAIR + right.
PAIR = 1 << 20
#: Words kept encoded from one block to the next in a worker; beyond it the store starts anew.
KEPT_WORDS = 150_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their rank from a rank file (base64 and number a line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class MergeReplay:
    """Applies the merges of a rank table to many words at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.width = np.zeros(max(ranks.values()) + 1, np.int64)
        pairs: dict[int, int] = {}
        early = np.zeros(len(self.width), bool)
        for token, rank in ranks.items():
            self.width[rank] = len(token)
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * PAIR + right] = rank
                    early[[side for side in (left, right) if side > rank]] = True
        self.pairs = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[p] for p in self.pairs.tolist()], np.int64)
        #: Tokens that can go into a pair of lower rank than their own.
        self.early = early

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair's merge, -1 where there is none."""
        pair = left * PAIR + right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pair, self.merged[at], -1)

    def encode(self, words: Iterable[bytes]) -> dict[bytes, bytes]:
        """Little-endian unsigned 32-bit ids of each distinct word."""
        done: dict[bytes, bytes] = {}
        chained: list[bytes] = []
        for word in words:
            whole = self.ranks.get(word)
            if whole is None:
                chained.append(word)
            else:
                done[word] = whole.to_bytes(4, "little")
        if chained:
            owner = np.repeat(np.arange(len(chained)), [len(w) for w in chained])
            symbol = self._replay(self.byte_id[np.frombuffer(b"".join(chained), np.uint8)], owner)
            left = symbol >= 0
            packed = symbol[left].astype("<u4").tobytes()
            ends = (4 * np.cumsum(np.bincount(owner[left], minlength=len(chained)))).tolist()
            done.update((w, packed[a:b]) for w, a, b in zip(chained, [0, *ends], ends, strict=False))
        return done

    def _replay(self, symbol: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Symbols after all merges; one that its left neighbour took up is -1.

        ``symbol`` and ``owner`` (the word of each place) get one place more, which belongs to no word.
        """
        size, width = len(symbol), self.width
        symbol, owner = np.append(symbol, -1), np.append(owner, -1)
        after, before = np.arange(1, size + 2), np.arange(-1, size)
        index: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def post(places: np.ndarray, ranks: np.ndarray) -> None:
            places, ranks = places[ranks >= 0], ranks[ranks >= 0]
            if not len(places):
                return
            order = np.argsort(ranks, kind="stable")
            places, ranks = places[order], ranks[order]
            starts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist()]
            for start, end, rank in zip(starts, [*starts[1:], len(places)], ranks[starts].tolist(), strict=True):
                if rank in index:
                    index[rank].append(places[start:end])
                else:
                    index[rank] = [places[start:end]]
                    heapq.heappush(queue, rank)

        pair = np.flatnonzero(owner[:-1] == owner[1:])
        post(pair, self._rank(symbol[pair], symbol[pair + 1]))
        while queue:
            rank = heapq.heappop(queue)
            found = index.pop(rank)
            at = found[0] if len(found) == 1 else np.sort(np.concatenate(found))
            # The bytes at a place never change: the pair still stands if both symbols' widths add up.
            mine = symbol[at]
            at, mine = at[mine >= 0], mine[mine >= 0]
            right = after[at]
            stands = (owner[right] == owner[at]) & (width[mine] + width[symbol[right]] == width[rank])
            at, right = at[stands], right[stands]
            if len(at) > 1:
                if self.early[rank]:
                    # A pair of lower rank may come up: one place a word, the others after what comes up.
                    first = np.append(True, owner[at[1:]] != owner[at[:-1]])
                    if not first.all():
                        index[rank] = [at[~first]]
                        heapq.heappush(queue, rank)
                        at, right = at[first], right[first]
                else:
                    # Places that overlap, as in a run of one letter: every other one, from the left.
                    joined = np.append(False, at[1:] == right[:-1])
                    if joined.any():
                        turn = np.arange(len(at))
                        keep = (turn - np.maximum.accumulate(np.where(joined, 0, turn))) % 2 == 0
                        at, right = at[keep], right[keep]
            symbol[at], symbol[right] = rank, -1
            follow = after[right]
            after[at], before[follow] = follow, at
            prior = before[at]
            ahead, behind = owner[follow] == owner[at], owner[prior] == owner[at]
            left = np.concatenate([at[ahead], prior[behind]])
            if len(left):
                post(left, self._rank(symbol[left], np.concatenate([symbol[follow[ahead]], symbol[at[behind]]])))
        return symbol[:-1]


class Encoder:
    """Texts to ids, a block at a time.

    A text is first cut before every single space that stands between other
    characters; no match of the pattern crosses such a place, so these pieces can be
    looked up.  A text with other runs of white space goes through the pattern whole.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.replay = MergeReplay(ranks)
        self.pattern = regex.compile(pattern)
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, bytes] = {}
        self.pieces: dict[bytes, bytes] = {}
        self.odd: set[bytes] = set()

    def _learn(self, words: set[bytes]) -> None:
        fresh = [w for w in words if w not in self.known]
        if fresh:
            self.known.update(self.replay.encode(fresh))

    def _cut(self, text: bytes) -> list[bytes]:
        return [w.encode() for w in self.pattern.findall(text.decode())]

    def block(self, texts: list[bytes]) -> list[bytes]:
        if len(self.known) > KEPT_WORDS or len(self.pieces) > KEPT_WORDS:
            self.forget()
        split = [text.split(b" ") for text in texts]
        heads = [parts[0] for parts in split]
        for parts in split:
            parts[0] = b"."  # looked up like the others, then replaced
        cuts: dict[bytes, list[bytes]] = {}
        for part in set().union(*split).difference(self.pieces, self.odd):
            chars = part.decode()
            if not chars or chars[0].isspace() or chars[-1].isspace():
                self.odd.add(part)
            elif chars.isalpha():  # the usual cases, as the pattern would cut them
                cuts[part] = [b" " + part]
            elif chars[-1] in ".," and chars[:-1].isalpha():
                cuts[part] = [b" " + part[:-1], part[-1:]]
            else:
                cuts[part] = self._cut(b" " + part)
        first: list[list[bytes]] = []
        for turn, (head, parts) in enumerate(zip(heads, split, strict=True)):
            last = head[-4:].decode(errors="replace")[-1:]
            whole = len(parts) > 1 and (not last or last.isspace() or not self.odd.isdisjoint(parts))
            first.append(self._cut(texts[turn] if whole else head))
            if whole:
                parts[1:] = []
        self._learn({w for cut in (*cuts.values(), *first) for w in cut})
        known, pieces = self.known, self.pieces
        pieces.update((part, b"".join(map(known.__getitem__, cut))) for part, cut in cuts.items())
        out = []
        for cut, parts in zip(first, split, strict=True):
            got = list(map(pieces.__getitem__, parts))
            got[0] = b"".join(map(known.__getitem__, cut))
            out.append(b"".join(got))
        return out


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> Encoder:
    return Encoder(read_ranks(path), pattern)


@lru_cache(maxsize=2)
def _tokens(path: str) -> dict[int, bytes]:
    return {rank: token for token, rank in read_ranks(path).items()}


def _extended(df: DataFrame, column: str) -> T.StructType:
    kept = [f for f in df.schema.fields if f.name.lower() != column.lower()]
    return T.StructType([*kept, T.StructField(column, T.BinaryType())])


def encode(
    df: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids", block_bytes: int = 2 << 20
) -> DataFrame:
    """Replace ``text`` by ``ids``: its token ids as little-endian unsigned 32-bit integers.

    Other columns pass through; one that is already called ``ids`` gives way.
    """
    source = df.drop(ids) if ids != text else df
    schema = _extended(source.drop(text), ids)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks_path, pattern)
        try:
            for batch in slices(batches, text, block_bytes):
                at = batch.schema.names.index(text)
                out = encoder.block(texts_of(batch, text))
                rest = [i for i in range(batch.num_columns) if i != at]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i) for i in rest), pa.array(out, pa.binary())],
                    names=[*(batch.schema.names[i] for i in rest), ids],
                )
        finally:
            encoder.forget()
            give_back()

    return source.mapInArrow(run, schema)


def decode(df: DataFrame, ranks_path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add ``decoded``: the bytes that the ids stand for."""
    source = df.drop(decoded)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = _tokens(ranks_path).__getitem__
        for batch in slices(batches, ids):
            packed = batch.column(batch.schema.names.index(ids)).to_pylist()
            out = [b"".join(map(token, np.frombuffer(p or b"", "<u4").tolist())) for p in packed]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, decoded])

    return source.mapInArrow(run, _extended(source, decoded))
