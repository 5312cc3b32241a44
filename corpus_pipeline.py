"""Corpus pipeline: toxicity, near duplicates, personal data, mixing, tokens.

Every stage takes (spark, docs, sf_dir) and returns a table; it is written as Parquet and read again as the next
one's ``docs``.  All but the last return the columns of ``documents``.

* toxicity: documents with a score of 0.5 or more go.
* near duplicates: of each component the document with the smallest id stays; rows without id stay, and of rows that
  share an id the one whose text (then language, source, length) is least.
* personal data: every span becomes ``<KIND>``, and ``n_chars`` is counted anew.
* mixing: sources are taken to the temperature weights, each whole at least once and at most ``REPEATS`` times; a document
  that is taken again is a further row.
* tokens: ids of the byte-level BPE (little-endian unsigned 32-bit), in place of the text.

An empty table passes through all stages, and further columns pass through all of them; the last puts ``ids`` and
``n_tokens`` in place of the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duelake.llm import byte_bpe, mixing, near_duplicates, pii, toxicity
from duelake.llm.common import documents, staged
from duelake.llm.queries import toxicity_model

#: Sources may be repeated up to this often in the pipeline's mix.
REPEATS = 1.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_ordinary(docs, toxicity_model(spark, docs, sf_dir))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = near_duplicates.deduplicate(docs.select("doc_id", "text")).where("kept and doc_id is not null").select("doc_id").distinct()
    whole = docs.select("doc_id", F.struct(*docs.columns).alias("row"))
    # Of rows that share an id the one with the least text, language, source and length stays.
    order = F.struct(*(F.col("row")[c] for c in ("text", "lang", "source", "n_chars")))
    named = whole.join(kept, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by("row", order).alias("row"))
    return named.select("row.*").unionByName(docs.where("doc_id is null"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # All columns but the text travel as one, so that none can clash with the columns of the annotation.
    rest = [c for c in docs.columns if c != "text"]
    packed = docs.select("doc_id", "text", F.struct(*rest).alias("row"))
    redacted = pii.redact(pii.annotate(packed, keep_text=True))
    counted = F.length("text").cast("long")
    return redacted.select(
        *(F.col("text") if c == "text" else (counted if c == "n_chars" else F.col("row")[c]).alias(c) for c in docs.columns)
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of a row come one after another; ``position`` of the mixing table would order them for training."""
    taken = (
        mixing.mix(docs, repeats=REPEATS)
        .groupBy(F.col("doc_id").alias("taken_id"), F.col("text_hash").alias("taken_hash"), F.col("source").alias("taken_source"))
        .agg(F.countDistinct("epoch").cast("int").alias("times"))  # a repeated row is taken once for each of its rows
    )
    packed = docs.select(F.struct(*docs.columns).alias("row"))
    same = (
        F.col("row")["doc_id"].eqNullSafe(F.col("taken_id"))
        & F.xxhash64(F.col("row")["text"]).eqNullSafe(F.col("taken_hash"))
        & (F.coalesce(F.col("row")["source"], F.lit("")) == F.col("taken_source"))
    )
    return packed.join(taken, same).select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return encoded.withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
    ("tokens", encode_tokens),
]

#: The classifier, the signatures and the merges have no counterpart in SQL; the tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
