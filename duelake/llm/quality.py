"""Quality rules: surface counts, and a likelihood ratio between trusted text and the raw corpus.

Words and pairs of words are hashed into buckets.  One multinomial is counted over all documents (raw), one over
the trusted ones; a document's score is the mean, over its hashed n-grams, of the log of their ratio.  Documents whose
surface rules fail, or whose score is below the threshold, are not kept.  The threshold is the one that
best separates labelled good from labelled poor documents which the trusted counts have not seen.

Everything is built from DataFrame functions.  The corpus is read three times, once for the trusted texts alone; what is
shuffled is one row for each bucket and task, and the trusted texts, which are found by bits of their ids first.  All
other work on a document stays in its row.

All labels are used: of every labelled id either its text is counted as trusted or its score helps to set the
threshold.  The raw counts, scores and rules cover every document.

Edge cases: a null or empty text has no words, score 0 and fails the rules; without trusted labels every
score is 0, and without labels of both kinds the threshold keeps every document that passes the rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelake.llm.common import WORD_BREAK, staged

BUCKETS = 8192
WINDOW = 8
#: How much more the loss of a share of good documents counts than the catch of the same share of poor ones.
CLEAN_WEIGHT = 10
#: Width of the bins in which scores are counted to find the threshold.
BIN = 0.002
#: Bits that tell which texts may be trusted: 8 MB in all.
ID_BITS = 2**26
SPACES = " \t\n\x0b\f\r"


def with_words(df: DataFrame, text: str) -> DataFrame:
    """Add ``words`` and ``hashes``, the words' hashes."""
    trimmed = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_BREAK))
    return df.withColumn("words", words).withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))


def _numbered(size: Column) -> Column:
    """0 .. size - 1, empty for 0."""
    return F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))


def _let(value: Column, use) -> Column:
    """Evaluate ``value`` once and hand it to ``use``."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def repeated_words(hashes: Column) -> Column:
    """Words that lie in a window of ``WINDOW`` words found twice or more in the text."""
    window = WINDOW

    def covered(found: Column) -> Column:
        ordered = F.array_sort(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            twice = F.filter(
                _numbered(F.size(s)),
                lambda k: F.coalesce(F.get(s, k - 1)["h"] == F.get(s, k)["h"], F.lit(False))
                | F.coalesce(F.get(s, k + 1)["h"] == F.get(s, k)["h"], F.lit(False)),
            )
            return F.array_sort(F.transform(twice, lambda k: F.get(s, k)["i"]))

        def reach(p: Column) -> Column:
            steps = F.transform(p, lambda at, k: F.least(F.lit(window), F.coalesce(F.get(p, k + 1) - at, F.lit(window))))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda a, b: a + b)

        return _let(_let(ordered, places), reach)

    def count(found: Column) -> Column:
        return F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0).cast("long")).otherwise(covered(found))

    def paired(found: Column, apart: int) -> Column:
        """Hash of each entry with the one ``apart`` places on."""
        return F.transform(_numbered(F.size(found) - apart), lambda i: F.xxhash64(F.get(found, i), F.get(found, i + apart)))

    # Two words, then four, then eight.
    return _let(paired(hashes, 1), lambda two: _let(paired(two, 2), lambda four: _let(paired(four, 4), count)))


def surface(df: DataFrame, text: str = "text", words: str = "words") -> DataFrame:
    """Add the surface counts and ``base_failed``."""
    value = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(value, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    return (
        df.withColumn("n_words", F.size(words).cast("long"))
        .withColumn("word_chars", F.length(F.array_join(words, "")).cast("long"))
        .withColumn("n_symbols", F.regexp_count(value, F.lit(r"[#*$%&|<>]")).cast("long"))
        .withColumn("n_dup_lines", _let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")))
        .withColumn("n_repeat_words", repeated_words(F.col("hashes")))
        .withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
    )


def buckets(hashes: Column, count: int = BUCKETS) -> Column:
    """Hashed words and pairs of neighbours, from the words' hashes."""
    single = F.transform(hashes, lambda h: F.pmod(h, F.lit(count)).cast("int"))
    pair = F.transform(
        _numbered(F.size(hashes) - 1),
        lambda i: F.pmod(F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1)), F.lit(count)).cast("int"),
    )
    return F.concat(single, pair)


def known_labels(labels: DataFrame, doc_id: str, quality: str) -> DataFrame:
    """All labelled ids; half of them (by hash) to count, half to set the threshold.

    An id with several labels is good only if all of them are.
    """
    return (
        labels.where(F.col(doc_id).isNotNull() & F.col(quality).isNotNull())
        .groupBy(F.col(doc_id).alias("_labelled"))
        .agg(F.min(F.col(quality)).alias("_good"))
        .withColumn("_fit", F.pmod(F.xxhash64(F.col("_labelled") + 1), F.lit(2)) == 0)
    )


def _bucket_counts(docs: DataFrame, count: int) -> DataFrame:
    """(``b``, ``n``): how often each bucket occurs in all texts."""
    hashed = with_words(docs, "_text")
    return hashed.select(F.explode(buckets(F.col("hashes"), count)).alias("b")).groupBy("b").agg(F.count("*").alias("n"))


def maybe_in(df: DataFrame, ids: DataFrame, column: str, id_column: str, bits: int = ID_BITS) -> DataFrame:
    """The rows whose ``column`` may be among the ids: all that are, and a few others, so that a join moves little else.

    Each id sets one of ``bits`` bits.  The bits have the same size for any number of ids and are broadcast; no row of
    ``df`` is shuffled.  Ids of another type than the column's hash differently, so nothing is left out then.
    """
    if df.schema[column].dataType != ids.schema[id_column].dataType:
        return df

    def number(c: str) -> Column:
        return F.pmod(F.xxhash64(F.col(c)), F.lit(bits)) + 1

    sets = ids.groupBy(F.bitmap_bucket_number(number(id_column)).alias("_bits_of")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number(id_column))).alias("_bits")
    )
    place = F.bitmap_bit_position(number(column))
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    there = F.getbit(byte, F.pmod(place, F.lit(8)).cast("int")) == 1
    held = df.join(F.broadcast(sets), F.bitmap_bucket_number(number(column)) == F.col("_bits_of"))
    return held.where(there).select(df.columns)


def trusted_texts(source: DataFrame, trusted: DataFrame) -> DataFrame:
    """The rows of trusted ids, each of which is there once.

    A semi-join would be planned below the filter by bits, and move every text.
    """
    return maybe_in(source, trusted, "_id", "_labelled").join(trusted, F.col("_id") == F.col("_labelled")).select(source.columns)


def log_ratios(docs: DataFrame, known: DataFrame, doc_id: str, text: str, count: int) -> list[float]:
    """For each bucket log(trusted share / raw share), with one added to every count.

    The result has ``count`` numbers, whatever the corpus.
    """
    trusted = known.where((F.col("_good") == 1) & F.col("_fit")).select("_labelled")
    source = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    chosen = trusted_texts(source, trusted)
    rows = {b: (n, 0) for b, n in _bucket_counts(source, count).collect()}
    for b, n in _bucket_counts(chosen, count).collect():
        rows[b] = (rows[b][0], n)
    raw, good = (sum(pair[k] for pair in rows.values()) for k in (0, 1))
    if not good:
        return [0.0] * count
    import math

    shift = math.log((raw + count) / (good + count))
    return [
        math.log((rows.get(b, (0, 0))[1] + 1) / (rows.get(b, (0, 0))[0] + 1)) + shift for b in range(count)
    ]


def threshold(scored: DataFrame, known: DataFrame, doc_id: str, score: str = "score") -> float | None:
    """The score that best separates held-back good from poor documents that pass the surface rules."""
    held = known.where(~F.col("_fit"))
    bins = (
        scored.where(~F.col("base_failed"))
        .join(held, F.col(doc_id) == F.col("_labelled"))
        .groupBy(F.floor(F.col(score) / BIN).alias("bin"))
        .agg(F.sum((F.col("_good") == 1).cast("long")).alias("good"), F.sum((F.col("_good") != 1).cast("long")).alias("poor"))
        .orderBy("bin")
        .collect()
    )
    good, poor = sum(r["good"] for r in bins), sum(r["poor"] for r in bins)
    if not good or not poor:
        return None
    # Below a cut lie poor documents that it catches and good ones that it loses; ties take the middle of the gap.
    caught = lost = 0
    gains = [(0.0, bins[0]["bin"])]
    for r, following in zip(bins, [*bins[1:], None], strict=True):
        caught, lost = caught + r["poor"], lost + r["good"]
        gains.append((caught / poor - CLEAN_WEIGHT * lost / good, (r["bin"] + 1 + (following["bin"] if following else r["bin"] + 1)) / 2))
    return max(gains, key=lambda g: g[0])[1] * BIN


def score(df: DataFrame, ratios: list[float]) -> DataFrame:
    """Add ``score``, the mean log ratio of the row's n-grams."""
    table = F.split(F.lit(" ".join(map(repr, ratios))), " ").cast("array<double>")
    grams = buckets(F.col("hashes"), len(ratios))
    total = lambda g: F.aggregate(g, F.lit(0.0), lambda a, b: a + F.get(table, b))
    mean = lambda g: F.when(F.size(g) > 0, total(g) / F.size(g)).otherwise(F.lit(0.0))
    return df.withColumn("score", _let(grams, mean))


def judge(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    quality: str = "quality",
    count: int = BUCKETS,
) -> DataFrame:
    """One row a document: its id, the surface counts, ``base_failed``, ``score``, ``kept``."""
    known = staged(known_labels(labels, doc_id, quality), "quality-labels")
    ratios = log_ratios(docs, known, doc_id, text, count)
    wide = with_words(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text")
    scored = staged(score(surface(wide), ratios).drop("text", "words", "hashes"), "quality-scores")
    cut = threshold(scored, known, "doc_id")
    kept = ~F.col("base_failed") & (F.lit(True) if cut is None else F.col("score") >= cut)
    return scored.withColumn("kept", kept)
