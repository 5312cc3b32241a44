"""Phrase collocations from count streams in prefix and suffix order.

1. Counting.  Texts are cut into pieces and words; phrases of one to four words are counted per language, summed block by block in a
   task before they are shuffled.  A phrase of ``least`` occurrences consists of phrases that have as many, so longer
   phrases are counted only where the shorter ones can be frequent: an admission bitmap of fixed size tells, which
   Spark builds from the hashes of the frequent phrases.  It may admit too much (more so on more data), never too
   little, and the counts decide in the end.
2. Streams.  The frequent phrases are laid out twice: in prefix order (words as they stand) and in suffix order (words
   reversed), each cut into ranges and sorted.  One pass over a range keeps the open phrases on a stack, so that a
   phrase meets the counts of all its beginnings (in suffix order: of all its ends) and each beginning the count of
   its most frequent extension.  Phrases whose extensions reach over several ranges are put at the head of each of
   them, so a very common first word is spread over many tasks.
3. The two streams are merge-joined: beginnings and ends give every cut's left and right counts, the larger of
   the two extensions decides whether a phrase is only part of a longer one.  A longer candidate around a phrase occurs
   no more often than the phrase with one word added, so looking one word further to both sides is enough.

Edge cases: a null text is empty; a null language is ``und``; repeated rows count again; a table without frequent phrases gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duelake.llm.common import give_back, slices, staged, texts_of

WORDS = 4
#: Bits of an admission bitmap, whatever the size of the corpus.
BITMAP_BITS = 1 << 26
#: Bits of one row of Spark's bitmap aggregate.
ROW_BITS = 32_768
#: Bytes of text counted together.
BLOCK_BYTES = 2 << 20
#: Rows of one batch that a task hands on.
ROWS_HANDED = 50_000
#: Distinct words a task keeps between blocks.
WORDS_KEPT = 150_000
#: Marks that end a piece become a full stop, tabs a space, A-Z a-z.
TABLE = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\tABCDEFGHIJKLMNOPQRSTUVWXYZ", b".......... abcdefghijklmnopqrstuvwxyz")
STOP = b"."
#: Parts of a language that are ranked by themselves first.
PARTS = 64
COUNTS = "lang string, phrase string, f long"


def tokens(texts: list[bytes]) -> list[bytes]:
    """The words of all texts in order, with ``STOP`` (which is in no word) between pieces."""
    return b"\n".join(texts).translate(TABLE).replace(STOP, b" . ").split()


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """(language, words) of about ``BLOCK_BYTES`` of text each."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in slices(batches, "text"):
        for lang, text in zip(batch.column(0).to_pylist(), texts_of(batch, "text"), strict=True):
            held.setdefault(lang, []).append(text)
            size += len(text)
        if size >= BLOCK_BYTES:
            yield from ((lang, tokens(texts)) for lang, texts in held.items())
            held, size = {}, 0
    yield from ((lang, tokens(texts)) for lang, texts in held.items())
    give_back()


def _counts(lang: str, phrases: pa.Array, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for start in range(0, len(counts), ROWS_HANDED):
        part = pa.array(counts[start : start + ROWS_HANDED], pa.int64())
        texts = phrases.slice(start, ROWS_HANDED).cast(pa.string())
        yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang), len(part)), texts, part], names=["lang", "phrase", "f"])


def _summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


class Admission:
    """Which phrases may be frequent, as one bit for the hash of language and phrase."""

    def __init__(self, rows: list[tuple[int, bytes]], bits: int):
        self.bits = bits
        self.map = np.zeros(bits // 8, np.uint8)
        for number, part in rows:
            start = (number - 1) * ROW_BITS // 8
            self.map[start : start + len(part)] = np.frombuffer(part, np.uint8)[: len(self.map) - start]

    def __call__(self, lang: str, phrases: list[bytes]) -> np.ndarray:
        head = lang.encode() + b"\0"
        places = np.fromiter((xxhash.xxh64_intdigest(head + p, 42) for p in phrases), np.uint64, len(phrases))
        places &= np.uint64(self.bits - 1)
        return (self.map[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8)) & 1 == 1


def admission(frequent: DataFrame, bits: int = BITMAP_BITS):
    """A broadcast ``Admission`` of these phrases: at most ``bits`` bits, however many phrases there are."""
    place = F.xxhash64(F.concat("lang", F.lit("\0"), "phrase")).bitwiseAND(bits - 1) + 1
    rows = (
        frequent.select(place.alias("place"))
        .groupBy(F.bitmap_bucket_number("place").alias("number"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("part"))
        .collect()
    )
    return frequent.sparkSession.sparkContext.broadcast([(r.number, bytes(r.part)) for r in rows])


def count_words(docs: DataFrame) -> DataFrame:
    """Every word's count."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words in _blocks(batches):
            found = Counter(words)
            found.pop(STOP, None)
            if found:
                yield from _counts(lang, pa.array(list(found), pa.binary()), np.fromiter(found.values(), np.int64, len(found)))

    return _summed(docs.mapInArrow(run, COUNTS))


class Coded:
    """Words as numbers, -1 for those that cannot be part of a frequent phrase."""

    def __init__(self, admitted: Admission):
        self.admitted = admitted
        self.codes: dict[str, dict[bytes, int]] = {}
        self.words: dict[str, list[bytes]] = {}

    def __call__(self, lang: str, words: list[bytes]) -> tuple[np.ndarray, pa.Array]:
        if sum(map(len, self.codes.values())) > WORDS_KEPT:
            self.codes, self.words = {}, {}
        codes, names = self.codes.setdefault(lang, {STOP: -1}), self.words.setdefault(lang, [])
        fresh = [w for w in set(words) if w not in codes]
        for word, admitted in zip(fresh, self.admitted(lang, fresh).tolist(), strict=True):
            codes[word] = len(names) if admitted else -1
            if admitted:
                names.append(word)
        return np.fromiter(map(codes.__getitem__, words), np.int64, len(words)), pa.array(names, pa.binary())


def _phrases(names: pa.Array, *codes: np.ndarray) -> pa.Array:
    return pc.binary_join_element_wise(*(names.take(pa.array(c)) for c in codes), b" ")


def count_pairs(docs: DataFrame, admitted_words, bits: int = BITMAP_BITS) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded = Coded(Admission(admitted_words.value, bits))
        for lang, words in _blocks(batches):
            code, names = coded(lang, words)
            at = np.flatnonzero((code[:-1] >= 0) & (code[1:] >= 0))
            if len(at):
                pairs, counts = np.unique(code[at] * len(names) + code[at + 1], return_counts=True)
                yield from _counts(lang, _phrases(names, pairs // len(names), pairs % len(names)), counts)

    return _summed(docs.mapInArrow(run, COUNTS))


def count_longer(docs: DataFrame, admitted_words, admitted_pairs, bits: int = BITMAP_BITS) -> DataFrame:
    """Phrases of three and four words all of whose pairs are admitted."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded, pair_admitted = Coded(Admission(admitted_words.value, bits)), Admission(admitted_pairs.value, bits)
        for lang, words in _blocks(batches):
            code, names = coded(lang, words)
            if len(code) < 3:
                continue
            starts = np.flatnonzero((code[:-1] >= 0) & (code[1:] >= 0))
            pairs, number = np.unique(code[starts] * len(names) + code[starts + 1], return_inverse=True)
            if not len(pairs):
                continue
            admitted = pair_admitted(lang, _phrases(names, pairs // len(names), pairs % len(names)).to_pylist())
            # The number of the admitted pair that starts at each word, -1 where there is none.
            pair = np.full(len(code) + 2, -1, np.int64)
            pair[starts] = np.where(admitted[number], number, -1)
            three = np.flatnonzero((pair[:-2] >= 0) & (pair[1:-1] >= 0))
            four = three[pair[three + 2] >= 0]
            for at, key in ((three, pair[three] * len(names) + code[three + 2]), (four, pair[four] * len(pairs) + pair[four + 2])):
                if len(at):
                    _, first, counts = np.unique(key, return_index=True, return_counts=True)
                    size = 3 if at is three else 4
                    yield from _counts(lang, _phrases(names, *(code[at[first] + i] for i in range(size))), counts)

    return _summed(docs.mapInArrow(run, COUNTS))


def frequent_phrases(docs: DataFrame, least: int, lang: str = "lang", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(``lang``, ``phrase``, ``f``) of phrases of up to four words with at least ``least`` occurrences, and
    (``lang``, ``n``): the words of each language."""
    source = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    words = staged(count_words(source), "word-counts")
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    common = words.where(F.col("f") >= least)
    some = admission(common)
    pairs = staged(count_pairs(source, some).where(F.col("f") >= least), "pair-counts")
    longer = staged(count_longer(source, some, admission(pairs)).where(F.col("f") >= least), "longer-counts")
    return common.unionByName(pairs).unionByName(longer), sizes


def _bounds(keyed: DataFrame, ranges: int) -> list[tuple[str, bytes]]:
    """Where to cut the order into ranges: quantiles of some twenty keys a range.  They shape the tasks, not the result."""
    total = keyed.count()
    some = keyed.sample(min(1.0, 20 * ranges / max(total, 1)), 7).limit(40 * ranges).collect() if ranges > 1 else []
    keys = sorted((r.lang, r.key.encode()) for r in some)
    return sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if keys else []


def stream(phrases: DataFrame, key: Column, ranges: int) -> DataFrame:
    """One pass over the phrases in the order of ``key`` (its words, each followed by a space).

    Gives (``lang``, ``phrase``, ``f``, ``parts``: the counts of its beginnings of 1, 2, ... words in that order, ``longer``: the
    largest count of a phrase with one word more).
    """
    keyed = phrases.select("lang", "phrase", "f", key.alias("key"))
    bounds = _bounds(keyed.select("lang", "key"), ranges)

    def dealt(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from bisect import bisect_right

        for batch in batches:
            langs, keys = batch.column(0).to_pylist(), batch.column(3).cast(pa.binary()).to_pylist()
            rows, targets = [], []
            for row, (lang, key) in enumerate(zip(langs, keys, strict=True)):
                first = bisect_right(bounds, (lang, key))
                # All that begins with the key lies before the key with its last space raised by one.
                last = bisect_right(bounds, (lang, key[:-1] + b"!")) if first < len(bounds) else first
                rows += [row] * (last - first + 1)
                targets += range(first, last + 1)
            out = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(targets, pa.int32())], names=[*out.schema.names, "range"])

    def scanned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list[list] = []  # [range, language, key, phrase, count, largest extension], each inside the one before
        out: list[tuple] = []

        def close() -> None:
            place, lang, _, phrase, count, longer = open_.pop()
            out.append((lang, phrase, count, [o[4] for o in open_], longer))

        for batch in batches:
            keys = batch.column(3).cast(pa.binary()).to_pylist()
            for lang, phrase, count, key, place in zip(
                *(batch.column(i).to_pylist() for i in range(3)), keys, batch.column(4).to_pylist(), strict=True
            ):
                while open_ and not (open_[-1][0] == place and open_[-1][1] == lang and key.startswith(open_[-1][2])):
                    close()
                if open_:
                    open_[-1][5] = max(open_[-1][5], count)
                open_.append([place, lang, key, phrase, count, 0])
            if out:
                yield rows(out)
                out = []
        while open_:
            close()
        if out:
            yield rows(out)

    def rows(out: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    names = ["lang", "phrase", "f", "parts", "longer"]
    scan = (
        keyed.mapInArrow(dealt, "lang string, phrase string, f long, key string, range int")
        .repartition(ranges, "range")
        .sortWithinPartitions("range", "lang", "key")
        .mapInArrow(scanned, "lang string, phrase string, f long, parts array<long>, longer long")
    )
    # A phrase stands once in each range that holds extensions of it.
    return scan.groupBy("lang", "phrase").agg(F.max("f").alias("f"), F.max("parts").alias("parts"), F.max("longer").alias("longer"))


def candidates(phrases: DataFrame, share: int, ranges: int) -> DataFrame:
    """(``lang``, ``phrase``, ``a``, ``l``, ``r``, ``score``) of phrases of two words and more that are not part of a longer one.

    ``share``: a phrase goes if a longer candidate around it has at least this many per cent of its occurrences.
    """
    words = F.split("phrase", " ")
    forward = stream(phrases, F.concat("phrase", F.lit(" ")), ranges)
    backward = stream(phrases, F.concat(F.array_join(F.reverse(words), " "), F.lit(" ")), ranges).select(
        "lang", "phrase", F.col("parts").alias("ends"), F.col("longer").alias("before")
    )
    several = F.size("parts") > 0
    wide = lambda c: c.cast("decimal(20,0)")
    sides = forward.where(several).hint("merge").join(backward.where(F.size("ends") > 0), ["lang", "phrase"])
    # The first k words have parts[k-1] occurrences, the rest ends[size-k].
    cuts = (
        "transform(sequence(1, size(parts)), k -> named_struct('l', get(parts, k - 1), 'r', get(ends, size(ends) - k), 'k', k))"
    )
    scored = (
        "array_min(transform(cuts, c -> named_struct("
        "'score', cast(cast(f as decimal(20,0)) * 2000000BD div (cast(c.l as decimal(20,0)) + cast(c.r as decimal(20,0))) as bigint), "
        "'k', c.k, 'l', c.l, 'r', c.r)))"
    )
    around = F.greatest("longer", "before")
    return (
        sides.where(~(wide(around) * 100 >= wide(F.col("f")) * share))
        .withColumn("cuts", F.expr(cuts))
        .withColumn("best", F.expr(scored))
        .select("lang", "phrase", F.col("f").alias("a"), "best.l", "best.r", "best.score")
    )


def collocations(
    docs: DataFrame, least: int = 30, share: int = 80, top: int = 2_000, lang: str = "lang", text: str = "text", ranges: int | None = None
) -> DataFrame:
    """Each language's ``top`` phrases by score, then count, then the phrase itself."""
    phrases, sizes = frequent_phrases(docs, least, lang, text)
    phrases = staged(phrases, "phrases")
    count = ranges or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.desc("score"), F.desc("a"), F.col("phrase")]
    # First the best of each of some parts of a language, so that no more than PARTS * top rows of one meet in a task.
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    within = candidates(phrases, share, count).withColumn("part", part)
    within = within.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*by))).where(F.col("rank") <= top)
    ranked = within.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*by)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
