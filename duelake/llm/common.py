"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duelake.session import shared_folder

#: The white space that separates words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD_BREAK = r"[\x20\x09-\x0D]+"


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame below the folder that all executors share and read it back.

    The written table cuts the lineage: a lost executor later costs a reread,
    not another run of everything before.
    """
    spark = df.sparkSession
    folder = shared_folder(spark, purpose)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def words_of(text: Column) -> Column:
    """Words of a text as an array; empty for a null or a text without words."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), lambda w: w != "")


def fold_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark: SparkSession, directory: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/documents.parquet")


def labels(spark: SparkSession, directory: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/labels.parquet")


def id_crc(column: Column) -> Column:
    """crc32 of an id as text."""
    return F.crc32(column.cast("string").cast("binary"))


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches: the text of one, reached row by row, is about ``most`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(batch.schema.names.index(column)).cast(pa.binary())
        sizes = np.diff(np.frombuffer(texts.buffers()[1], "<i4", batch.num_rows + 1, 4 * texts.offset).astype(np.int64))
        part = (np.cumsum(sizes) - sizes) // most
        starts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), batch.num_rows]
        for start, end in zip(starts, starts[1:], strict=False):
            yield batch.slice(start, end - start)


def give_back() -> None:
    """Return the memory that a task has freed to the system; workers live on and would keep it for themselves."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError):  # only where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def texts_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """A text column as UTF-8; a null is empty."""
    return [t or b"" for t in batch.column(batch.schema.names.index(column)).cast(pa.binary()).to_pylist()]
