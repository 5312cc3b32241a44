"""Scores of a log-bilinear neural language model, trained with noise-contrastive estimation.

Words are counted over all training documents.  The commonest ``CLASSES`` are predicted one by one, all others
as one class, within which a word has its share of the counts and words never seen have the Good-Turing
share (words seen once over tokens).  A token is predicted from the two before it: their vectors, weighted by position,
are multiplied with the candidate's vector, a bias is added, and a softmax over the classes normalises.

Training reads every training document once.  Each task starts from the same weights (biases at the log unigram shares) and
runs minibatches in numpy; noise words are shared by a minibatch, so its work is matrix products.  The tasks' weights
are averaged, each by its tokens.  Scoring computes the normaliser once for each distinct context of a
batch and reads token probabilities from the product with the outputs.

Counts of the commonest ``LISTED`` words go to the tasks as a list of bounded size; rarer words are looked up by a
join, in which no word is common.

Edge cases: a null or empty text is the end token alone; a word outside the training documents has count 0; without
training documents every token has probability 1.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelake.llm.common import slices, staged, texts_of

CLASSES = 1_023
#: Tasks whose weights are added first.
TOGETHER = 64
LISTED = 150_000
WIDTH = 24
NOISE = 32
BATCH = 4_096
RATE = 0.02
#: Distinct words that a task gathers before it hands on its counts.
GATHERED = 400_000
#: Stands for the end of a text among the words; no word is empty.
END = b""


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """(``word``, ``c``) over all texts, the end token included."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in slices(batches, "text"):
            for value in texts_of(batch, "text"):
                counts.update(value.lower().split())
            counts[END] += batch.num_rows
            if len(counts) > GATHERED:
                yield _counted(counts)
                counts.clear()
        if counts:
            yield _counted(counts)

    found = docs.select(F.col(text).alias("text")).mapInArrow(run, "word binary, c long")
    return found.groupBy("word").agg(F.sum("c").alias("c"))


def _counted(counts: Counter[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "c"]
    )


def common_words(counts: DataFrame, most: int = LISTED) -> dict[bytes, int]:
    """The commonest words, at most ``most`` of them, commonest first.

    Words are tallied by the size of their count; the smallest count that lets no more than ``most`` words through is
    the limit, so no task sends more than its share of the list.
    """
    size = F.floor(F.log2("c") * 8)
    tally = counts.groupBy(size.alias("size")).agg(F.count("*").alias("n"), F.min("c").alias("least")).collect()
    limit, held = None, 0
    for row in sorted(tally, key=lambda r: -r["size"]):
        held += row["n"]
        if held > most:
            break
        limit = row["least"]
    if limit is None:
        return {}
    rows = counts.where(F.col("c") >= limit).collect()
    return {bytes(r["word"]): r["c"] for r in sorted(rows, key=lambda r: (-r["c"], bytes(r["word"])))}


class Weights:
    """Vectors of classes as context and as output, weights of the two positions, biases."""

    def __init__(self, shares: np.ndarray):
        numbers = np.random.default_rng(7)
        size = len(shares)
        self.context = numbers.normal(0, 0.1, (size, WIDTH)).astype(np.float32)
        self.output = numbers.normal(0, 0.1, (size, WIDTH)).astype(np.float32)
        self.place = np.array([[1.0], [0.5]], np.float32).repeat(WIDTH, 1)
        self.bias = np.log(shares).astype(np.float32)[:, None]

    def parts(self) -> list[np.ndarray]:
        return [self.context, self.output, self.place, self.bias]

    def predicted(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        return self.context[first] * self.place[0] + self.context[second] * self.place[1]

    def log_probabilities(self, first: np.ndarray, second: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Natural log of the normalised probability of each word after (second, first)."""
        size = len(self.bias)
        contexts, where = np.unique(first.astype(np.int64) * size + second, return_inverse=True)
        out = np.empty(len(word))
        order = np.argsort(where, kind="stable")
        starts = np.searchsorted(where[order], np.arange(len(contexts) + 1))
        for begin in range(0, len(contexts), 2_048):
            end = min(begin + 2_048, len(contexts))
            part = contexts[begin:end]
            scores = self.predicted(part // size, part % size) @ self.output.T + self.bias[:, 0]
            top = scores.max(1, keepdims=True)
            scores -= top + np.log(np.exp(scores - top).sum(1, keepdims=True))
            mine = order[starts[begin] : starts[end]]
            out[mine] = scores[where[mine] - begin, word[mine]]
        return out


def _spread(target: np.ndarray, squares: np.ndarray, rows: np.ndarray, step: np.ndarray) -> None:
    """Adagrad on the rows of ``target``; gradients of one row are summed first."""
    order = np.argsort(rows, kind="stable")
    ordered = rows[order]
    starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    total = np.add.reduceat(step[order], starts, axis=0)
    at = ordered[starts]
    squares[at] += total * total
    target[at] += RATE * total / np.sqrt(squares[at] + 1e-6)


class Trainer:
    """Noise-contrastive minibatches from one start."""

    def __init__(self, shares: np.ndarray, seed: int):
        self.weights = Weights(shares)
        self.squares = [np.full_like(p, 0.1) for p in self.weights.parts()]
        self.log_noise = np.log(NOISE * shares).astype(np.float32)
        self.cumulated = np.cumsum(shares)
        self.numbers = np.random.default_rng(seed)
        self.seen = 0

    def batch(self, first: np.ndarray, second: np.ndarray, word: np.ndarray) -> None:
        w, n = self.weights, len(word)
        noise = np.minimum(np.searchsorted(self.cumulated, self.numbers.random(NOISE)), len(self.cumulated) - 1)
        hidden = w.predicted(first, second)
        mine = w.output[word]
        hit = (hidden * mine).sum(1) + w.bias[word, 0] - self.log_noise[word]
        miss = hidden @ w.output[noise].T + w.bias[noise, 0] - self.log_noise[noise]
        # Gradients of the log likelihood that the word is data and each noise word is noise.
        up = (1 / (1 + np.exp(np.clip(hit, -30, 30)))) / n
        down = -(1 / (1 + np.exp(np.clip(-miss, -30, 30)))) / n
        to_hidden = up[:, None] * mine + down @ w.output[noise]
        from_word, from_noise = up[:, None] * hidden, down.T @ hidden
        step_place = np.stack([(to_hidden * w.context[c]).sum(0) for c in (first, second)])
        to_first, to_second = to_hidden * w.place[0], to_hidden * w.place[1]
        context, output, place, bias = w.parts()
        _spread(context, self.squares[0], np.concatenate([first, second]), np.concatenate([to_first, to_second]) * n)
        _spread(output, self.squares[1], np.concatenate([word, noise]), np.concatenate([from_word, from_noise]) * n)
        _spread(bias, self.squares[3], np.concatenate([word, noise]), np.concatenate([up, down.sum(0)])[:, None] * n)
        _spread(place, self.squares[2], np.arange(2), step_place * n)
        self.seen += n


def sequences(texts: list[bytes], classes: dict[bytes, int], rare: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[bytes]]]:
    """Of all texts' tokens the class, the one before, the one before that; and the words of each text."""
    words = [[*text.lower().split(), END] for text in texts]
    end, get = classes.get(END, rare), classes.get
    word = np.fromiter((get(w, rare) for ws in words for w in ws), np.int64, sum(map(len, words)))
    starts = np.cumsum([0, *map(len, words[:-1])])
    first = np.append(end, word[:-1])
    first[starts] = end
    second = np.append(end, first[:-1])
    second[starts] = end
    return word, first, second, words


def train(docs: DataFrame, text: str, classes: dict[bytes, int], shares: np.ndarray, tasks: int) -> list[np.ndarray]:
    """The averaged weights; what each task hands on has the size of the model."""
    rare = len(shares) - 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        trainer = Trainer(shares, seed=11 + task)
        for batch in slices(batches, "text", 2 << 20):
            word, first, second, _ = sequences(texts_of(batch, "text"), classes, rare)
            order = trainer.numbers.permutation(len(word))
            for begin in range(0, len(word), BATCH):
                at = order[begin : begin + BATCH]
                trainer.batch(first[at], second[at], word[at])
        if trainer.seen:
            flat = [p.astype(np.float64).ravel() * trainer.seen for p in trainer.weights.parts()]
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array(range(len(flat)), pa.int32()),
                    "group": pa.array([task // TOGETHER] * len(flat), pa.int32()),
                    "seen": pa.array([float(trainer.seen)] * len(flat), pa.float64()),
                    "values": pa.array([f.tobytes() for f in flat], pa.binary()),
                }
            )

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(len(table.column("values")[0].as_buffer()) // 8)
        for value in table.column("values"):
            total += np.frombuffer(value.as_buffer(), np.float64)
        return pa.table(
            {
                "part": table.column("part")[:1],
                "group": table.column("group")[:1],
                "seen": pa.array([sum(table.column("seen").to_pylist())], pa.float64()),
                "values": pa.array([total.tobytes()], pa.binary()),
            }
        )

    # Few tasks' weights meet at once: they are added in groups of ``TOGETHER`` tasks, then the groups.
    schema = "part int, group int, seen double, values binary"
    source = docs.select(F.col(text).alias("text")).coalesce(tasks)
    grouped = source.mapInArrow(run, schema).groupBy("part", "group").applyInArrow(add, schema)
    rows = grouped.groupBy("part").applyInArrow(add, schema).collect()
    start = Weights(shares)
    found = {r["part"]: np.frombuffer(r["values"], np.float64) / r["seen"] for r in rows}
    return [found[i].reshape(p.shape).astype(np.float32) if i in found else p for i, p in enumerate(start.parts())]


def score(
    docs: DataFrame, training: Column, doc_id: str = "doc_id", text: str = "text", tasks: int | None = None
) -> DataFrame:
    """One row a document: ``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    ``training`` says which rows to learn from.  ``base_score`` is the add-one unigram, ``score`` the model;
    both are log10 probabilities of the text over the known words and one unknown one.
    """
    spark = docs.sparkSession
    counts = staged(word_counts(docs.where(training), text), "word-counts")
    total = counts.agg(F.sum("c").alias("tokens"), F.count("*").alias("words"), F.sum((F.col("c") == 1).cast("long")).alias("once")).first()
    tokens, words, once = total["tokens"] or 0, total["words"], total["once"] or 0
    listed = common_words(counts)
    classes = {w: i for i, w in enumerate(list(listed)[:CLASSES])}
    rare = len(classes)
    common = [listed[w] for w in classes]
    rare_tokens = tokens - sum(common)
    unseen = (once - sum(c == 1 for c in common) + 1) / (rare_tokens + 2) if rare_tokens else 1.0
    shares = np.array([*common, max(rare_tokens, 1)], float)
    shares /= shares.sum()
    norm = math.log10(tokens + words + 1)
    log_unseen, log_known = math.log10(unseen), math.log10((1 - unseen) / max(1, rare_tokens)) if unseen < 1 else 0.0
    parts = train(docs.where(training), text, classes, shares, tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))) if tokens else None
    # Of a listed word: log10(c + 1), whether it is rare, log10(c).
    known = {w: (math.log10(c + 1), w not in classes, math.log10(c)) for w, c in listed.items()}
    shipped = spark.sparkContext.broadcast((classes, known, parts))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, known, parts = shipped.value
        weights = Weights(shares)
        if parts is not None:
            weights.context, weights.output, weights.place, weights.bias = parts
        for turn, batch in enumerate(slices(batches, "text", 2 << 20)):
            word, first, second, split = sequences(texts_of(batch, "text"), classes, rare)
            logs = weights.log_probabilities(first, second, word) / math.log(10) if parts is not None else np.zeros(len(word))
            starts = np.cumsum([0, *map(len, split[:-1])])
            model = np.add.reduceat(logs, starts)
            rows: dict[str, list] = {k: [] for k in ("n_tokens", "n_known", "log_counts", "rare_logs", "rare")}
            for ws in split:
                per = Counter(ws)
                sure = log_counts = rare_logs = 0.0
                pending = []
                for w, n in per.items():
                    found = known.get(w)
                    if found is None:
                        pending.append({"word": w, "n": n})
                        continue
                    sure += n
                    log_counts += n * found[0]
                    if found[1]:
                        rare_logs += n * (found[2] + log_known)
                rows["n_tokens"].append(len(ws))
                rows["n_known"].append(int(sure))
                rows["log_counts"].append(log_counts)
                rows["rare_logs"].append(rare_logs)
                rows["rare"].append(pending)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(rows["n_tokens"], pa.int64()),
                    pa.array(rows["n_known"], pa.int64()),
                    pa.array(rows["log_counts"], pa.float64()),
                    pa.array(rows["rare_logs"] + model, pa.float64()),
                    pa.array(rows["rare"], pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))),
                ],
                names=["doc_id", "row", "n_tokens", "n_known", "log_counts", "logs", "rare"],
            )

    source = docs.select(F.col(doc_id).alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"))
    kind = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, row long, n_tokens long, n_known long, log_counts double, logs double, "
    found = staged(source.mapInArrow(run, kind + "rare array<struct<word:binary,n:bigint>>"), "scored-texts")
    pending = (
        found.select("row", F.explode("rare").alias("r"))
        .select("row", F.col("r.word").alias("word"), F.col("r.n").alias("n"))
        .join(counts, "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("also_known"),
            F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("also_counts"),
            F.sum(F.col("n") * F.coalesce(F.log10("c") + log_known, F.lit(log_unseen))).alias("also_logs"),
        )
    )
    zero = lambda column: F.coalesce(column, F.lit(0))
    return found.drop("rare").join(pending, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + zero("also_known")).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("log_counts") + zero("also_counts") - F.col("n_tokens") * norm).alias("base_score"),
        (F.col("logs") + zero("also_logs")).alias("score"),
    )
