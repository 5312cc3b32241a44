"""Token ids as seekable binary files.

File format (extension ``.ids.zst``): independent zstandard frames, each with the ids of some whole
documents as little-endian unsigned integers (16 bits where the vocabulary allows, else 32); then the document
index, zstandard-compressed inside a skippable frame; then a seek table, also a skippable frame, that lists
every frame's compressed size, size and checksum and ends in a fixed-size footer.
Any zstandard tool can decompress the whole; a reader that wants some documents reads footer, table and
index and then only the frames that hold them.

Every task sorts and writes one range of ids.  A file's name is new for each attempt, and only
names that a finished task returned are listed in the manifest, a table that Spark commits; a lost executor
leaves at most a file that nobody lists.  Files go to any store that pyarrow can open.

Edge cases: a null or empty text has the end id alone; rows with the same document id are all
written, in the order of their texts; a null id comes first; an empty table gives an empty manifest.
"""

from __future__ import annotations

import struct
import uuid
from array import array
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duelake.llm.common import slices

# The public zstandard format's skippable frames and seek table.
SKIPPABLE = 0x184D2A5E
SEEK_TABLE = 0x8F92EAB1
INDEX = 0x184D2A5D
CHECKSUMS = 0x80

#: Uncompressed bytes of one frame, reached document by document.
FRAME_BYTES = 1 << 20
#: Texts encoded together.
BLOCK_BYTES = 4 << 20
#: Bytes of encoded words, and of chunks put together from them, that a worker keeps from task to task; beyond it a store
#: starts anew.
KEPT_WORDS, KEPT_CHUNKS = 96 << 20, 96 << 20
#: Bytes of an entry besides its text: a string and a bytes object with their headers, the place in the table.
ENTRY = 200
#: Words that go to the tokenizer as one text.
JOINED = 4_000


class TokenFileWriter:
    """Collects documents' ids into frames of one open binary file."""

    def __init__(self, out, wide: bool, frame_bytes: int = FRAME_BYTES, level: int = 3):
        self.out, self.dtype, self.frame_bytes = out, "<u4" if wide else "<u2", frame_bytes
        self.zstd = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.held: list[bytes] = []
        self.size = 0
        self.table: list[tuple[int, int, int]] = []
        self.docs: list[tuple[int | None, int, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids), len(self.table)))
        self.held.append(ids.astype(self.dtype, copy=False).tobytes())
        self.size += len(self.held[-1])
        if self.size >= self.frame_bytes:
            self._frame()

    def _frame(self) -> None:
        raw = b"".join(self.held)
        packed = self.zstd.compress(raw)
        self.out.write(packed)
        self.table.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.held, self.size = [], 0

    def close(self) -> None:
        if self.held:
            self._frame()
        ids = np.array([0 if d is None else d for d, _, _ in self.docs], "<i8")
        null = np.array([d is None for d, _, _ in self.docs], "<u1")
        counts = np.array([n for _, n, _ in self.docs], "<u4")
        frames = np.array([f for _, _, f in self.docs], "<u4")
        head = struct.pack("<BQ", int(self.dtype[-1]), len(self.docs))
        raw = head + ids.tobytes() + null.tobytes() + counts.tobytes() + frames.tobytes()
        index = self.zstd.compress(raw)
        self.out.write(struct.pack("<II", INDEX, len(index)) + index)
        self.table.append((len(index) + 8, 0, xxhash.xxh64_intdigest(index) & 0xFFFFFFFF))
        entries = b"".join(struct.pack("<III", *entry) for entry in self.table)
        footer = struct.pack("<IBI", len(self.table), CHECKSUMS, SEEK_TABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer)


class TokenFileReader:
    """Reads footer, table and index; frames only when their documents are asked for."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        frames, _, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_TABLE:
            raise ValueError("no seek table at the end of the file")
        table = self._at(size - 9 - 12 * frames, 12 * frames)
        self.table = list(struct.iter_unpack("<III", table))
        self.starts = np.concatenate([[0], np.cumsum([t[0] for t in self.table])]).tolist()
        index = self._at(self.starts[-2], self.table[-1][0])[8:]
        if xxhash.xxh64_intdigest(index) & 0xFFFFFFFF != self.table[-1][2]:
            raise ValueError("the document index does not match its checksum")
        raw = zstandard.ZstdDecompressor().decompress(index)
        width, docs = struct.unpack_from("<BQ", raw)
        self.dtype = f"<u{width}"
        at = struct.calcsize("<BQ")
        self.ids = np.frombuffer(raw, "<i8", docs, at)
        self.null = np.frombuffer(raw, "<u1", docs, at + 8 * docs).astype(bool)
        self.counts = np.frombuffer(raw, "<u4", docs, at + 9 * docs).astype(np.int64)
        self.frame = np.frombuffer(raw, "<u4", docs, at + 13 * docs)

    def _at(self, start: int, length: int) -> bytes:
        self.source.seek(start)
        return self.source.read(length)

    def _frame(self, turn: int) -> np.ndarray:
        packed, size, checksum = self.table[turn]
        raw = zstandard.ZstdDecompressor().decompress(self._at(self.starts[turn], packed), max_output_size=size)
        if len(raw) != size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {turn} does not match its checksum")
        return np.frombuffer(raw, self.dtype)

    def documents(self, wanted: Sequence[int] | None = None) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(id, tokens of this file before it, ids) in file order, of all documents or of those wanted."""
        start = np.cumsum(self.counts) - self.counts
        chosen = np.arange(len(self.ids))
        if wanted is not None:
            chosen = np.flatnonzero(np.isin(self.ids, np.asarray(wanted, np.int64)) & ~self.null)
        first = start[np.searchsorted(self.frame, np.arange(len(self.table)), side="left").clip(max=max(len(start) - 1, 0))]
        held, ids = -1, np.empty(0, self.dtype)
        for doc in chosen.tolist():
            if self.frame[doc] != held:
                held = int(self.frame[doc])
                ids = self._frame(held)
            begin = int(start[doc] - first[held])
            yield (
                None if self.null[doc] else int(self.ids[doc]),
                int(start[doc]),
                ids[begin : begin + int(self.counts[doc])],
            )


class WordEncoder:
    """Texts to ids with a tokenizer that drops white space, never looks across it and marks the ends of words.

    Chunks between spaces are put together from letters and closing marks, which the tokenizer always
    encodes apart; each of these is encoded once and remembered, up to a number of bytes.  Many go to the tokenizer as one
    text and are told apart by their end tokens.  A text that is not in composed Unicode form or that may hold one of
    the tokenizer's special tokens goes to the tokenizer whole.
    """

    #: Marks that no rule of the split pattern joins to letters.
    CLOSING = ".,;:!?%&*#$|)"

    def __init__(self, path: str):
        import os
        from os.path import commonprefix

        # Threads of the tokenizer's own would compete with the other tasks of the executor.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        head = commonprefix(special)
        self.special = [head] if head else special
        self.wide = len(vocabulary) > 1 << 16
        self.dtype = "<u4" if self.wide else "<u2"
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[number for token, number in vocabulary.items() if token.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.chunk_bytes = self.word_bytes = 0

    def _packed(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        kind = "I" if self.wide else "H"
        return [array(kind, e.ids).tobytes() for e in found]

    def _joined(self, words: list[str]) -> list[bytes]:
        """Words that should be one word to the tokenizer; if the ends do not count up, each is encoded by itself."""
        out: list[bytes] = []
        for start in range(0, len(words), JOINED):
            part = words[start : start + JOINED]
            ids = np.array(self.tokenizer.encode(" ".join(part), add_special_tokens=False).ids, np.int64)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(part) or (len(stops) and stops[-1] != len(ids)):
                out += self._packed(part)
                continue
            raw, size = ids.astype(self.dtype).tobytes(), int(self.dtype[-1])
            stops = (stops * size).tolist()
            out += [raw[a:b] for a, b in zip([0, *stops], stops, strict=False)]
        return out

    def _learn(self, chunks: set[str]) -> None:
        """Encode chunks by way of the distinct words in them."""
        plain: list[tuple[str, str, str]] = []
        odd: list[str] = []
        closing = self.CLOSING
        for chunk in chunks:
            body = chunk.rstrip(closing)
            if body.isalpha():
                plain.append((chunk, body.lower() if body.isascii() else body, chunk[len(body) :]))
            else:
                odd.append(chunk)
        words = self.words
        letters = list({body for _, body, _ in plain}.difference(words))
        words.update(zip(letters, self._joined(letters), strict=True))
        marks = list({mark for _, _, mark in plain}.difference(words))
        words.update(zip(marks, self._packed(marks), strict=True))
        self.chunks.update([(chunk, words[body] + words[mark]) for chunk, body, mark in plain])
        self.chunks.update(zip(odd, self._packed(odd), strict=True))
        self.word_bytes += ENTRY * len(letters) + sum(map(len, letters))
        self.chunk_bytes += ENTRY * len(chunks) + sum(map(len, chunks))

    def block(self, texts: list[str]) -> list[np.ndarray]:
        from unicodedata import is_normalized

        if self.word_bytes > KEPT_WORDS:
            self.words, self.word_bytes = {}, 0
        if self.chunk_bytes > KEPT_CHUNKS:
            self.chunks, self.chunk_bytes = {}, 0
        plain = [not any(s in text for s in self.special) and is_normalized("NFC", text) for text in texts]
        split = [text.replace("\n", " ").split(" ") if ok else [] for text, ok in zip(texts, plain, strict=True)]
        self._learn(set().union(*split).difference(self.chunks))
        whole = iter(self._packed([text for text, ok in zip(texts, plain, strict=True) if not ok]))
        get = self.chunks.__getitem__
        return [
            np.frombuffer(b"".join(map(get, parts)) if ok else next(whole), self.dtype)
            for parts, ok in zip(split, plain, strict=True)
        ]


@lru_cache(maxsize=1)
def _word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


MANIFEST = "file string, shard int, docs long, tokens long"


def write(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    doc_id: str = "doc_id",
    text: str = "text",
    shards: int | None = None,
) -> DataFrame:
    """Encode, append ``end_id`` to each document, write ranges of ids as files; the manifest, one row a file.

    ``shards`` is the number of ranges (the session's shuffle partitions by default).  The manifest's
    ``start`` is the number of ids in all files before.  ``folder`` has to be one that all executors see.
    """
    spark = docs.sparkSession
    count = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        .repartitionByRange(count, "id")
        .sortWithinPartitions("id", "text")
        .select("id", "text", F.spark_partition_id().alias("shard"))
    )

    def save(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _word_encoder(tokenizer)
        end = np.array([end_id], encoder.dtype)
        store = out = writer = None
        name, shard, docs_in, tokens = "", -1, 0, 0
        try:
            for batch in slices(batches, "text", BLOCK_BYTES):
                if writer is None:
                    shard = batch.column(2)[0].as_py()
                    store, base = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
                    store.create_dir(base, recursive=True)
                    name = f"{shard:06d}-{uuid.uuid4().hex}.ids.zst"
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                    writer = TokenFileWriter(out, encoder.wide)
                ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                for key, found in zip(ids, encoder.block(texts), strict=True):
                    found = np.concatenate([found, end])
                    writer.add(key, found)
                    docs_in, tokens = docs_in + 1, tokens + len(found)
            if writer is not None:
                writer.close()
        finally:
            if out is not None:
                out.close()
        if writer is not None:
            yield pa.RecordBatch.from_pydict({"file": [name], "shard": pa.array([shard], pa.int32()), "docs": [docs_in], "tokens": [tokens]})

    files = ordered.mapInArrow(save, MANIFEST)
    files.write.parquet(f"{folder}/manifest")
    return manifest(spark, folder)


def manifest(spark, folder: str) -> DataFrame:
    """The files of a folder in order, with the ids before each; a few numbers for each file."""
    files = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)).cast("long"))


READ = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("ids", T.BinaryType())]
)


def read(files: DataFrame, folder: str, wanted: Sequence[int] | None = None) -> DataFrame:
    """Documents of the files: id, ids before it in the whole corpus, ids as unsigned 32-bit integers.

    ``wanted`` is a short list of ids; frames without any of them stay compressed.
    """
    keys = list(wanted) if wanted is not None else None

    def load(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{base}/{row['file']}") as source:
                    rows, held = [], 0
                    for key, start, ids in TokenFileReader(source).documents(keys):
                        rows.append((key, row["start"] + start, ids.astype("<u4").tobytes()))
                        held += len(rows[-1][2])
                        if held >= 4 * FRAME_BYTES:
                            yield _rows(rows)
                            rows, held = [], 0
                    if rows:
                        yield _rows(rows)

    # One file a task: the manifest is tiny, so it is dealt out row by row.
    return files.repartition(max(1, files.count()), "shard").mapInArrow(load, READ)


def _rows(rows: list[tuple[int | None, int, bytes]]) -> pa.RecordBatch:
    ids, starts, packed = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(packed, pa.binary())], names=["doc_id", "start", "ids"]
    )

