"""Near duplicates by an inverted join of MinHash signature coordinates.

1. Every text becomes its set of five-word shingles (64-bit hashes) and a signature of ``K`` coordinates.  Documents with
   the same set are one class from here on; its smallest id stands for it.
2. Each class is posted under its (coordinate, value) pairs; the postings are counted.  A pair of documents
   has to collide in at least ``MATCHES`` coordinates, so each document has to be looked up only under its
   rarest ``shared - MATCHES + 1`` values (the prefix); the long posting lists beyond are skipped, and a document that
   shares fewer than ``MATCHES`` values with anything needs no look-up at all.
3. Candidates come in two passes.  First each document is paired with the smallest one of each of its posting
   lists, which joins the members of a large group without pairing them all.  Documents of lists that still
   hold several components go on: they are posted again, under the rarest of their shingles (the same prefix rule on the
   full sets, where it is sharpest), and under each the documents of different components are paired.  Pairs inside a
   component can add nothing.
4. Of each candidate pair the collisions over all coordinates are counted, and pairs that reach ``MATCHES`` are
   confirmed on the full sets.

With 96 coordinates and 64 matches a pair at a similarity of 0.85 is missed with a probability of about 2e-6.

Edge cases: a null text or one without words has an empty set and is linked with nothing; a row without id keeps a null
component and stays; rows that share an id are one node, and of these one row stays.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duelake.llm.common import slices, staged, texts_of
from duelake.llm.components import components

K = 96
MATCHES = 64
SHINGLE = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 85

_numbers = np.random.default_rng(20_240_117)
FLIPS = _numbers.integers(0, 1 << 63, K, dtype=np.uint64)
FACTORS = _numbers.integers(0, 1 << 63, K, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLACES = _numbers.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = [text.lower().split() for text in texts]
    counts = np.array([len(w) for w in words])
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for ws in words for w in ws), np.uint64, int(counts.sum()))
    windows = hashes[:0]
    if len(hashes) >= SHINGLE:
        last = len(hashes) - SHINGLE + 1
        windows = _mixed(sum(_mixed(hashes[i : last + i] * PLACES[i]) * PLACES[i] for i in range(SHINGLE)))
    sets, start = [], 0
    for count in counts.tolist():
        if count >= SHINGLE:
            sets.append(np.unique(windows[start : start + count - SHINGLE + 1]))
        elif count:
            short = sum(_mixed(hashes[start + i : start + i + 1] * PLACES[i]) * PLACES[i] for i in range(count))
            sets.append(_mixed(short + np.uint64(count)))
        else:
            sets.append(hashes[:0])
        start += count
    return sets


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """``K`` coordinates of each set that is not empty: upper halves of the least permuted hashes."""
    joined = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    out = np.empty((len(sets), K), np.int32)
    for k in range(K):
        least = np.minimum.reduceat((joined ^ FLIPS[k]) * FACTORS[k], starts)
        out[:, k] = (least >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return out


def _lists(rows: np.ndarray | list[np.ndarray], kind: pa.DataType) -> pa.Array:
    sizes = [len(r) for r in rows]
    flat = np.concatenate(rows) if len(rows) else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), pa.array(flat, kind))


def described(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """id, size of the set, a 128-bit key of the set (null if empty), signature (null if empty)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            sets = shingle_sets(texts_of(batch, "text"))
            full = [s for s in sets if len(s)]
            found = iter(signatures(full) if full else ())
            rows = [next(found) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_pydict(
                {
                    "id": batch.column(0),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "key": pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    "signature": pa.array(rows, pa.list_(pa.int32())),
                }
            )

    source = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    return source.mapInArrow(run, "id long, n_shingles long, key binary, signature array<int>")


def full_sets(docs: DataFrame) -> DataFrame:
    """(``id``, ``text``) to (``id``, ``shingles``)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            sets = shingle_sets(texts_of(batch, "text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _lists([s.view(np.int64) for s in sets], pa.int64())], names=["id", "shingles"]
            )

    return docs.select("id", "text").mapInArrow(run, "id long, shingles array<bigint>")


def prefixes(posted: DataFrame, need: Column) -> DataFrame:
    """Of each id's tokens those under which it has to be looked up: its ``shared - need + 1`` rarest shared ones.

    Two ids with at least ``need`` tokens in common share one of these, as both are ordered alike.  ``left`` counts
    the shared tokens from this one on; the first token that a pair shares bounds its overlap by that.
    """
    others = [c for c in posted.columns if c != "token"]
    shared = posted.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    ranked = F.sort_array(F.collect_list(F.struct("n", "token")))
    return (
        posted.join(shared, "token")
        .groupBy(*others)
        .agg(ranked.alias("ranked"))
        .where(F.size("ranked") >= need)
        .withColumn("shared", F.size("ranked"))
        .select(*others, "shared", F.posexplode(F.slice("ranked", F.lit(1), (F.col("shared") - need + 1).cast("int"))).alias("turn", "r"))
        .select(F.col("r.token").alias("token"), *others, (F.col("shared") - F.col("turn")).alias("left"))
    )


def postings(classes: DataFrame) -> DataFrame:
    """(``token``, ``id``) for every coordinate; a token holds the coordinate's place and value."""
    token = F.shiftleft(F.col("place").cast("long"), 32).bitwiseOR(F.col("value").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
    return classes.select("id", F.posexplode("signature").alias("place", "value")).select("id", token.alias("token"))


def _alike(left: Column, right: Column) -> Column:
    """Sizes that allow the similarity at all."""
    return 100 * F.least(left, right) >= PERCENT * F.greatest(left, right)


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (``a``, ``b``) with enough collisions, and then enough common shingles.

    The set of ``a`` is fetched first: ``a`` may be in very many pairs, whose rows are still small then.
    """
    side = lambda n: sets.select(F.col("id").alias(n), *(F.col(c).alias(f"{n}_{c}") for c in ("signature", "shingles")))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    hits = F.size(F.filter(F.zip_with("a_signature", "b_signature", lambda x, y: x == y), lambda same: same))
    common = F.size(F.array_intersect("a_shingles", "b_shingles"))
    union = F.size("a_shingles") + F.size("b_shingles")
    linked = F.when(hits >= MATCHES, 100 * common >= PERCENT * (union - common)).otherwise(F.lit(False))
    return joined.where(linked).select("a", "b")


def _open_lists(posted: DataFrame, joined: DataFrame) -> DataFrame:
    """Postings, with their ids' components, of the tokens under which more than one component stands."""
    grouped = posted.join(joined, "id", "left").withColumn("component", F.coalesce("component", "id"))
    several = grouped.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    return grouped.join(several.select("token"), "token")


def links(docs: DataFrame, classes: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Edges between classes that join exactly those that links connect."""
    # The postings are the largest table here; they are unrolled from the signatures twice instead of being written.
    posted = staged(prefixes(postings(classes), F.lit(MATCHES)).join(classes.select("id", "size"), "id"), "prefixes")
    wanted = posted.select("id").distinct()
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).where("id is not null")
    sets = staged(
        full_sets(texts.join(wanted, "id", "left_semi")).join(classes.select("id", "signature"), "id"), "shingle-sets"
    )

    hubs = posted.groupBy("token").agg(F.min(F.struct("id", "size")).alias("hub"))
    stars = staged(
        posted.join(hubs, "token")
        .where((F.col("id") != F.col("hub.id")) & _alike(F.col("size"), F.col("hub.size")))
        .select(F.col("hub.id").alias("a"), F.col("id").alias("b"))
        .distinct(),
        "star-pairs",
    )
    edges = staged(confirmed(stars, sets), "star-links")

    joined = staged(components(edges), "star-components")
    open_ids = _open_lists(posted, joined).select("id").distinct()
    shingles = sets.join(open_ids, "id").select("id", F.size("shingles").alias("size"), F.explode("shingles").alias("token"))
    need = F.ceil(F.col("size") * PERCENT / 100)
    rest = staged(_open_lists(staged(prefixes(staged(shingles, "open-shingles"), need), "open-prefixes"), joined), "open-lists")
    side = lambda n: rest.select("token", F.col("id").alias(n), *(F.col(c).alias(f"{n}_{c}") for c in ("size", "left", "component")))
    overlap = F.least("a_left", "b_left")
    across = (
        side("a")
        .join(side("b"), "token")
        .where(
            (F.col("a_component") < F.col("b_component"))
            & _alike(F.col("a_size"), F.col("b_size"))
            & ((100 + PERCENT) * overlap >= PERCENT * (F.col("a_size") + F.col("b_size")))
        )
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
        .join(stars, ["a", "b"], "left_anti")
    )
    return edges.union(staged(confirmed(staged(across, "cross-pairs"), sets), "cross-links"))


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: ``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable), ``kept``."""
    known = staged(described(docs, doc_id, text), "signatures")
    named = known.where("id is not null and key is not null")
    heads = named.groupBy(F.col("key").alias("class_key")).agg(F.min("id").alias("head"))
    # One row a class: of rows that share an id, each set is a class, all under the same id.
    classes = staged(
        named.join(heads, (F.col("key") == F.col("class_key")) & (F.col("id") == F.col("head")))
        .select("key", "id", F.col("n_shingles").alias("size"), "signature")
        .dropDuplicates(["key"]),
        "classes",
    )
    joined = components(links(docs, classes, doc_id, text))
    found = heads.join(joined, F.col("head") == F.col("id"), "left").select(
        "class_key", F.coalesce("component", "head").alias("component_id")
    )
    turn = F.row_number().over(Window.partitionBy("id").orderBy("component_id", "key"))
    rows = (
        known.select("id", "n_shingles", "key")
        .join(found, F.col("key") == F.col("class_key"), "left")
        .withColumn("component_id", F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")))
    )
    unnamed = rows.where("id is null").withColumn("turn", F.lit(1))
    numbered = rows.where("id is not null").withColumn("turn", turn).unionByName(unnamed)
    return numbered.select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        "component_id",
        F.coalesce((F.col("id") == F.col("component_id")) & (F.col("turn") == 1), F.lit(True)).alias("kept"),
    )
