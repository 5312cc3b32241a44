"""Session settings the plans rely on, and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Shuffled bytes of one starting partition.  The driver keeps track of every map output for every partition, so their
#: number has to stay in the tens of thousands at 100 TB; adaptive execution splits skewed ones.
TARGET_PARTITION_BYTES = 2 * 1024**3


def build_session(app: str = "duelake", input_bytes: int | None = None, **conf: str) -> SparkSession:
    """A session with ANSI casts, UTC and adaptive execution.

    ``input_bytes`` sizes the first shuffle so that one partition holds about
    ``TARGET_PARTITION_BYTES``; adaptive execution only merges partitions, so
    the starting number has to be large enough for the data.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if input_bytes is not None:
        builder = builder.config(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
            str(shuffle_partitions_for(input_bytes)),
        )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_partitions_for(input_bytes: int, floor: int = 200) -> int:
    return max(floor, -(-input_bytes // TARGET_PARTITION_BYTES))


def many_tasks(spark: SparkSession) -> int:
    """A number of partitions for steps whose work is far more than the bytes they read: the session's, or a few for each core."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism)


#: Codec of the Parquet files that jobs write: half the bytes of Spark's default, and Spark brings it along.
PARQUET_CODEC = "zstd"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query go when it ends; else they stay until the driver happens to collect the query as garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def require_ansi(spark: SparkSession) -> None:
    """Strict casts must fail on bad text, which Spark only does in ANSI mode."""
    if spark.conf.get("spark.sql.ansi.enabled").lower() != "true":
        raise RuntimeError("spark.sql.ansi.enabled must be true: strict casts would return null")


def shared_root(spark: SparkSession) -> str | None:
    """The folder all executors share, as the session names it."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return root.rstrip("/") if root else None


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared root.

    A local session that names no root (a plain test) gets a temporary one; on a
    cluster a folder of one machine would be of no use, so that is an error.
    """
    root = shared_root(spark)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="duelake-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root}/{purpose}-{uuid.uuid4().hex}"
