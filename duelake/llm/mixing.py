"""Mixing sources to target weights by temperature.

A source's share of the tokens is raised to an exponent between 1 (as the corpus is) and 0 (all sources alike) and
normalised.  The exponent is bisected: as near to 1 as the entropy target allows, and never so low that a source would
be repeated more often than the limit.  Without a token budget the mix is as large as it has to be for every source to be
taken whole at least once; with one, sources may also be cut.

The weights are realised by block permutations.  A source's documents fall into blocks by hash; each pass over the
source orders its blocks anew.  Full passes take every block; the last one takes blocks in order up to the budget, and
the block that crosses it document by document.  ``position`` in [0, 1) tells where in the mix a row stands, so that
sorting by it gives every stretch of the mix the same weights.

What is collected is one row for the whole corpus in each round of bisection.  A source of any size is handled by
its blocks: at most ``BLOCKS`` rows meet in one window, and of documents only those of the one block that is cut.

Edge cases: a document counts its words and one end token, so none is free; a null source is the source "";
repeated rows are documents of their own, ordered by text hash; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duelake.llm.common import staged

ENTROPY = 0.95
REPEATS = 2.0
BLOCK_TOKENS = 50_000
BLOCKS = 2_048
#: Exponents tried at once in a round, and rounds.
TRIES, ROUNDS = 16, 6


def token_count(text: Column) -> Column:
    """Words and the end token."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    breaks = F.regexp_count(trimmed, F.lit(r"[\x20\x09-\x0D]+"))
    return F.when(trimmed == "", F.lit(1)).otherwise(breaks + 2).cast("long")


def exponent(sources: DataFrame, entropy: float, repeats: float, budget: int | None) -> float:
    """The exponent for (``source``, ``tokens``): the highest that reaches ``entropy`` (a share of that of equal
    weights), or the lowest that the limit on repeats allows, whichever is higher."""
    total = sources.agg(F.sum("tokens").alias("all"), F.max("tokens").alias("most"), F.min("tokens").alias("least"), F.count("*").alias("n")).first()
    if not total["all"]:
        return 1.0

    def found(fits) -> float:
        """Highest exponent that fits, for a condition that holds from 0 up to some point."""
        low, high = 0.0, 1.0
        for _ in range(ROUNDS):
            tries = [low + (high - low) * i / TRIES for i in range(TRIES + 1)]
            good = [t for t, ok in zip(tries, fits(tries), strict=True) if ok]
            if not good:
                return low
            low, high = good[-1], min(good[-1] + (high - low) / TRIES, high)
        return low

    share = F.col("tokens") / F.lit(float(total["all"]))

    def entropies(tries: list[float]) -> list[bool]:
        powers = [F.pow(share, F.lit(t)) for t in tries]
        row = sources.agg(*(F.sum(p) for p in powers), *(F.sum(p * F.lit(t) * F.log(share)) for p, t in zip(powers, tries, strict=True))).first()
        sums, logs = row[: len(tries)], row[len(tries) :]
        most = math.log(total["n"]) if total["n"] > 1 else 0.0
        return [math.log(z) - y / z >= entropy * most - 1e-12 for z, y in zip(sums, logs, strict=True)]

    def repeated(tries: list[float]) -> list[bool]:
        """Too many repeats of the smallest source, which is repeated most."""
        if budget is None:
            ratio = total["most"] / total["least"]
            return [ratio ** (1 - t) > repeats for t in tries]
        least = total["least"] / total["all"]
        row = sources.agg(*(F.sum(F.pow(share, F.lit(t))) for t in tries)).first()
        return [least**t / z * budget / total["least"] > repeats for t, z in zip(tries, row, strict=True)]

    step = 1.0 / TRIES**ROUNDS
    flat = found(repeated)
    return min(1.0, max(found(entropies), flat + step if repeated([flat])[0] else 0.0))


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    entropy: float = ENTROPY,
    repeats: float = REPEATS,
    budget: int | None = None,
    seed: int = 1,
) -> DataFrame:
    """One row for each time a document is taken: ``doc_id``, ``text_hash``, ``source``, ``tokens``, ``weight``, ``epoch``, ``position``."""
    measured = staged(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.xxhash64(F.col(text)).alias("text_hash"),
            F.coalesce(F.col(source), F.lit("")).alias("source"),
            token_count(F.col(text)).alias("tokens"),
        ),
        "mix-tokens",
    )
    sources = staged(measured.groupBy("source").agg(F.sum("tokens").alias("tokens")), "mix-sources")
    power = exponent(sources, entropy, repeats, budget)
    sums = sources.agg(F.sum(F.pow("tokens", F.lit(power))).alias("z"), F.max(F.col("tokens") / F.pow("tokens", F.lit(power))).alias("most")).first()
    norm, most = sums["z"] or 1.0, sums["most"] or 0.0
    size = float(budget) if budget is not None else most * norm
    # Rounding must not cost a source its last document.
    wanted = F.ceil(F.col("weight") * size - 1e-6).cast("long")
    plan = (
        sources.withColumn("weight", F.pow("tokens", F.lit(power)) / norm)
        .withColumn("budget", wanted)
        .withColumn("passes", F.floor(F.col("budget") / F.col("tokens")).cast("int"))
        .withColumn("blocks", F.least(F.ceil(F.col("tokens") / BLOCK_TOKENS), F.lit(BLOCKS)).cast("int"))
        .withColumnRenamed("tokens", "source_tokens")
    )
    numbered = measured.join(plan.select("source", "blocks"), "source").withColumn(
        "block", F.pmod(F.xxhash64("doc_id", "text_hash", F.lit(seed)), F.col("blocks")).cast("int")
    )
    placed = numbered.drop("blocks")
    blocks = placed.groupBy("source", "block").agg(F.sum("tokens").alias("block_tokens"))
    order = Window.partitionBy("source", "epoch").orderBy(F.xxhash64("source", "block", "epoch", F.lit(seed)), "block")
    before = F.coalesce(F.sum("block_tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    takes = (
        blocks.join(plan, "source")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("passes"))))
        .withColumn("start", before + F.col("epoch") * F.col("source_tokens"))
        .withColumn("room", F.col("budget") - F.col("start"))
        .where("room > 0")
        .select("source", "block", "epoch", "start", "room", "block_tokens", "budget", "weight")
    )
    takes = staged(takes, "mix-blocks")
    rows = placed.join(takes, ["source", "block"])
    turn = F.xxhash64("doc_id", "text_hash", "epoch", F.lit(seed))
    whole = rows.where("room >= block_tokens").withColumn(
        "at", F.col("start") + F.pmod(turn, F.lit(1 << 20)) / float(1 << 20) * F.col("block_tokens")
    )
    inside = Window.partitionBy("source", "epoch").orderBy(turn, "doc_id", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        rows.where("room < block_tokens")
        .withColumn("ahead", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
        .where("ahead < room")
        .withColumn("at", (F.col("start") + F.col("ahead")).cast("double"))
    )
    columns = ["doc_id", "text_hash", "source", "tokens", "weight", "epoch", "at", "budget"]
    return (
        whole.select(columns)
        .unionByName(cut.select(columns))
        .withColumn("position", F.least(F.col("at") / F.col("budget"), F.lit(1.0)))
        .drop("at", "budget")
    )
