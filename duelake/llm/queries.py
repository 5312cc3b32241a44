"""One query for each operator of this subpackage, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duelake.llm import (
    byte_bpe,
    collocations,
    conversations,
    fingerprints,
    language_model,
    licences,
    line_dedup,
    mixing,
    near_duplicates,
    pii,
    quality,
    sql,
    token_files,
    toxicity,
)
from duelake.llm.common import documents, id_crc, labels
from duelake.session import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op11_line_dedup": sql.LINE_DEDUP,
    "op12_conversations": sql.CONVERSATIONS,
    "op13_collocations": sql.COLLOCATIONS,
}


def _query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


@_query
def op1_pii(spark: SparkSession, directory: str) -> DataFrame:
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [count(kind) for kind in pii.BASE_KINDS]
    return pii.annotate(documents(spark, directory)).select(
        "doc_id", *counts, F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans")
    )


def toxicity_model(spark: SparkSession, docs: DataFrame, directory: str) -> dict:
    """Trained on the labels of documents that are not held out."""
    training = labels(spark, directory).where(F.pmod(id_crc(F.col("doc_id")), F.lit(5)) != 0)
    return toxicity.train(docs, training, "doc_id", "text", "toxic")


@_query
def op2_toxicity(spark: SparkSession, directory: str) -> DataFrame:
    docs = documents(spark, directory)
    return toxicity.score(docs, toxicity_model(spark, docs, directory)).select(
        "doc_id",
        F.coalesce(F.pmod(id_crc(F.col("doc_id")), F.lit(5)) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "windows",
    )


@_query
def op3_near_duplicates(spark: SparkSession, directory: str) -> DataFrame:
    return near_duplicates.deduplicate(documents(spark, directory))


@_query
def op4_licences(spark: SparkSession, directory: str) -> DataFrame:
    """Documents as files below ``source/lang/``."""
    path = F.concat_ws("/", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    files = documents(spark, directory).select("doc_id", path.alias("path"), "text")
    return licences.scan(files)


@_query
def op6_mixing(spark: SparkSession, directory: str) -> DataFrame:
    return mixing.mix(documents(spark, directory)).drop("text_hash")


@_query
def op5_quality(spark: SparkSession, directory: str) -> DataFrame:
    return quality.judge(documents(spark, directory), labels(spark, directory)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "score",
    )


@_query
def op7_byte_bpe(spark: SparkSession, directory: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = byte_bpe.encode(documents(spark, directory).select("doc_id", "text"), ranks, public_tokenizers.PATTERN)
    return byte_bpe.decode(encoded, ranks).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_query
def op8_language_model(spark: SparkSession, directory: str) -> DataFrame:
    held_out = F.coalesce(F.pmod(id_crc(F.col("doc_id")), F.lit(7)) == 2, F.lit(False))
    return language_model.score(documents(spark, directory), ~held_out).withColumn("held_out", held_out)


@_query
def op9_token_files(spark: SparkSession, directory: str) -> DataFrame:
    folder = shared_folder(spark, "token-files")
    files = token_files.write(documents(spark, directory), folder, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_files.read(files, folder).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


@_query
def op10_fingerprints(spark: SparkSession, directory: str) -> DataFrame:
    return fingerprints.with_edited(documents(spark, directory)).select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("sketch")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        fingerprints.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        fingerprints.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        fingerprints.distinct_shingles(F.col("sketch")).alias("distinct_shingles"),
    )


@_query
def op11_line_dedup(spark: SparkSession, directory: str) -> DataFrame:
    docs = documents(spark, directory)
    index = line_dedup.LineIndex(spark, shared_folder(spark, "line-index"), threshold=10, least=1).insert(docs)
    return index.clean(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@_query
def op12_conversations(spark: SparkSession, directory: str) -> DataFrame:
    rows = conversations.damaged(spark.read.parquet(f"{directory}/conversations.parquet"))
    return conversations.audits(rows).drop("messages")


@_query
def op13_collocations(spark: SparkSession, directory: str) -> DataFrame:
    return collocations.collocations(documents(spark, directory), least=30, share=80, top=2_000)
