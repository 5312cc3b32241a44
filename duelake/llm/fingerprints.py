"""Document fingerprints: bottom-k sketches of word shingles.

A sketch is the ``k`` smallest distinct hashes of a text's shingles of five words (the whole sequence where there are fewer),
in ascending order.  Sketches of parts merge into the sketch of the whole; two of them estimate resemblance
and containment, one the number of distinct shingles.  Everything is built from DataFrame functions.

Edge cases: a null or empty text has an empty sketch; two empty sketches resemble each other fully, an
empty one and another not at all.  A-Z count as a-z.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duelake.llm.common import fold_ascii, staged, words_of

SIZE = 128
SHINGLE = 5
LOWEST = -(2.0**63)


def _let(value: Column, use) -> Column:
    """Evaluate ``value`` once and hand it to ``use``."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _numbered(size: Column) -> Column:
    return F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))


def shingles(text: Column) -> Column:
    """Hash of every run of five words; of all words, where there are one to four."""
    paired = lambda found, apart, other: F.transform(
        _numbered(F.size(found) - apart), lambda i: F.xxhash64(F.get(found, i), F.get(other, i + apart))
    )
    hashes = F.transform(words_of(fold_ascii(text)), lambda w: F.xxhash64(w))
    return _let(
        hashes,
        lambda one: F.when(F.size(one) == 0, F.array().cast("array<bigint>"))
        .when(F.size(one) < SHINGLE, F.array(F.xxhash64(one)))
        .otherwise(
            _let(
                paired(one, 1, one),
                lambda two: _let(
                    paired(two, 2, two),
                    # Four words and the one after; the last four words have none.
                    lambda four: F.transform(
                        _numbered(F.size(one) - (SHINGLE - 1)),
                        lambda i: F.xxhash64(F.get(four, i), F.get(one, i + (SHINGLE - 1))),
                    ),
                ),
            )
        ),
    )


def lowest(hashes: Column, size: int = SIZE) -> Column:
    """The ``size`` smallest distinct values in ascending order.

    Of a long array only the values below a mark are sorted; the mark lets about four times as many
    through as are wanted, and where it lets through too few, all are sorted.
    """
    least = lambda found: F.slice(F.sort_array(found), 1, size)

    def sorted_out(found: Column) -> Column:
        mark = F.lit(LOWEST) + F.lit(2.0**64) * (4.0 * size / F.size(found))
        below = F.filter(found, lambda h: h < mark)
        return F.when(F.size(found) <= 6 * size, least(found)).otherwise(
            _let(below, lambda b: F.when(F.size(b) >= size, least(b)).otherwise(least(found)))
        )

    return _let(F.array_distinct(hashes), sorted_out)


def sketch(text: Column, size: int = SIZE) -> Column:
    return lowest(shingles(text), size)


def merge(left: Column, right: Column, size: int = SIZE) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(left, right)), 1, size)


def merge_all(sketches: DataFrame, keys: list[str], sketch: str = "sketch", size: int = SIZE) -> DataFrame:
    """One sketch a group: the smallest distinct hashes over its rows.

    Rows become (group, hash) pairs, the distinct ones are ranked; Spark cuts every task to ``size`` rows a group before
    the shuffle, so a large group does not meet in one task.
    """
    rank = Window.partitionBy(*keys).orderBy("_hash")
    values = sketches.select(*keys, F.explode(sketch).alias("_hash")).distinct()
    best = values.withColumn("_rank", F.row_number().over(rank)).where(F.col("_rank") <= size)
    return best.groupBy(*keys).agg(F.sort_array(F.collect_list("_hash")).alias(sketch))


def resemblance(left: Column, right: Column, size: int = SIZE) -> Column:
    """Estimated intersection over union."""
    together = lambda m: F.size(F.array_intersect(F.array_intersect(m, left), right)) / F.size(m)
    return F.when((F.size(left) == 0) & (F.size(right) == 0), F.lit(1.0)).otherwise(_let(merge(left, right, size), together))


def distinct_shingles(found: Column, size: int = SIZE) -> Column:
    """Estimated number of distinct shingles; exact below ``size``."""
    span = (F.element_at(found, -1).cast("double") - LOWEST) / 2.0**64
    return F.when(F.size(found) < size, F.size(found).cast("double")).otherwise((size - 1) / span)


def containment(left: Column, right: Column, size: int = SIZE) -> Column:
    """Estimated share of the left text's shingles that the right one has."""
    both = resemblance(left, right, size) * distinct_shingles(merge(left, right, size), size)
    return F.when(F.size(left) == 0, F.lit(1.0)).otherwise(F.least(both / distinct_shingles(left, size), F.lit(1.0)))


def as_text(found: Column) -> Column:
    """The sketch as hexadecimal digits, sixteen for each hash."""
    return F.array_join(F.transform(found, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def next_ids(ids: DataFrame, doc_id: str) -> DataFrame:
    """(``doc_id``, ``next_id``) for each distinct id: the next one down, for the lowest the highest.

    Ids are dealt out in ranges and ordered inside each; only the ends of the ranges, one row each, meet in one place.
    """
    dealt = ids.select(F.col(doc_id).alias("id")).where("id is not null").distinct()
    parts = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = staged(dealt.repartitionByRange(parts, "id").withColumn("part", F.spark_partition_id()), "id-ranges")
    ends = ranged.groupBy("part").agg(F.max("id").alias("top"))
    highest = ends.agg(F.max("top")).first()[0]
    ends = ends.withColumn("below", F.coalesce(F.lag("top").over(Window.orderBy("part")), F.lit(highest)))
    inside = F.lag("id").over(Window.partitionBy("part").orderBy("id"))
    return (
        ranged.withColumn("inside", inside)
        .join(F.broadcast(ends.select("part", "below")), "part")
        .select(F.col("id").alias(doc_id), F.coalesce("inside", "below").alias("next_id"))
    )


def with_edited(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """Each document with its edited text and the sketches of itself, of that, and of the next document.

    The edited text has the last third of the code points replaced by the first as many of the next document (in
    descending order of id).  Rows that share an id are separate documents with the same next one, and where
    several share the next id, its first text in order counts.  A row without id has no next document.
    """
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = staged(next_ids(rows, "id"), "id-order")
    third = lambda value: F.floor(F.length(value) / 3).cast("int")
    need = (
        rows.select("id", third(F.col("text")).alias("take"))
        .groupBy("id")
        .agg(F.max("take").alias("take"))
        .join(order, "id")
        .select(F.col("id").alias("for_id"), F.col("next_id").alias("id"), "take")
    )
    # Both sides below read the same exchange of the texts by id; a rank filter would put a step before one of them.
    named = rows.where("id is not null")
    earlier = F.lag("id").over(Window.partitionBy("id").orderBy("text"))
    heads = named.withColumn("earlier", earlier).where("earlier is null")
    given = heads.join(need, "id").select(
        F.col("for_id").alias("id"),
        F.substring("text", F.lit(1), F.col("take")).alias("prefix"),
        sketch(F.col("text"), size).alias("next_sketch"),
    )
    unnamed = rows.where("id is null").select(
        "id", "text", F.lit("").alias("prefix"), F.lit(None).cast("array<bigint>").alias("next_sketch")
    )
    cut = third(F.col("text"))
    edited = F.concat(
        F.substring("text", F.lit(1), F.length("text") - cut), F.substring("prefix", F.lit(1), cut)
    )
    return (
        named.join(given, "id")
        .unionByName(unnamed)
        .select(F.col("id").alias("doc_id"), "text", edited.alias("edited"), "next_sketch")
        .withColumn("sketch", sketch(F.col("text"), size))
        .withColumn("edited_sketch", sketch(F.col("edited"), size))
    )
