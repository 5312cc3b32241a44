"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic and one on ordinary text.  A window is one word between spaces,
closed by a fixed tail that both dictionaries hold (zstandard looks for no matches in a block's last bytes and keeps
tiny blocks raw; the tail makes the lengths comparable).  Its distance is the length under the ordinary dictionary less
the length under the toxic one: bytes that knowing toxic text saves.  A text's windows are counted at
several distance thresholds, and a logistic model, calibrated on labelled texts that the dictionaries have not seen,
turns the counts into a probability.

Toxic documents are mostly ordinary text.  The toxic dictionary is therefore trained on those of their words that hold a
run of bytes found in many toxic and relatively few ordinary documents.

Only the *fit* is bounded: at most ``TOXIC`` and ``ORDINARY`` labelled documents, those of lowest hash, go through one
task.  Every document is scored on its whole text; windows are distinct words, each compressed once and
remembered (within a bound) by the worker.

Edge cases: a null or empty text has no windows and gets the score of that; a document with several labels is toxic
if one of them says so; without labels of both kinds the score is 1 or 0 throughout, as the labels there are say,
and 0 without any.
"""

from __future__ import annotations

import json
import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Collection, Iterable, Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelake.llm.common import give_back, slices, staged, texts_of

#: Labelled documents that the fit takes at most.
TOXIC, ORDINARY = 2_500, 5_000
#: Bytes of the dictionaries.
TOXIC_BYTES, ORDINARY_BYTES = 6_144, 32_768
#: A run of bytes marks toxic words if it is in this share of toxic documents and so much rarer in ordinary ones.
SUPPORT, CONTRAST = 0.02, 12
RUNS = (4, 5, 6, 7, 8)
#: Thresholds at which windows are counted; distances beyond the ends count as the ends.
CUTS = (3, 4, 5, 6, 7)
LEAST, MOST = -3, 9
#: Longest windows of the length classes; the same distance says more of a short window.
LENGTHS = (6, 8, 10, 13)
#: Bytes of remembered windows in a task; beyond it the store starts anew.
KEPT_BYTES = 24 << 20
CLASSES = len(LENGTHS) + 1
CELLS = (MOST - LEAST + 1) * CLASSES

#: Control characters that no word holds.
TAIL = bytes(b for b in (*range(1, 9), *range(14, 32)) for _ in (0, 1))[::-1]
_FORMAT = zstandard.ZstdCompressionParameters(
    format=zstandard.FORMAT_ZSTD1_MAGICLESS,
    write_content_size=False,
    write_checksum=False,
    write_dict_id=False,
    window_log=17,
    hash_log=13,
    chain_log=13,
    search_log=4,
    min_match=4,
    target_length=64,
    strategy=zstandard.STRATEGY_BTLAZY2,
)


def windows(text: bytes) -> set[bytes]:
    return {b" " + word + b" " for word in text.lower().split()}


def _runs(window: bytes) -> set[bytes]:
    return {window[i : i + n] for n in RUNS for i in range(len(window) - n)}


def dictionary(counts: Counter[bytes], size: int) -> bytes:
    """Dictionary content: the most frequent words, the commonest last, where offsets are short; then the tail."""
    chosen, held = [], 0
    for word, _ in sorted(counts.items(), key=lambda item: (-item[1], item[0])):
        if held + len(word) > size:
            break
        chosen.append(word.rstrip())
        held += len(word)
    return b"".join(reversed(chosen)) + b" " + TAIL


def toxic_words(toxic: list[tuple[bytes, ...]], ordinary: list[tuple[bytes, ...]]) -> Counter[bytes]:
    """Documents with each telling part of a word of toxic text."""
    found: Counter[bytes] = Counter()
    for words in toxic:
        found.update(set().union(*map(_runs, words)))
    least = max(3, SUPPORT * len(toxic))
    frequent = {run: n for run, n in found.items() if n >= least}
    del found
    shared = {run: run for run in frequent}
    known: dict[bytes, tuple[bytes, ...]] = {}
    against: Counter[bytes] = Counter()
    for words in ordinary:
        runs: set[bytes] = set()
        for word in words:
            if word not in known:
                known[word] = tuple(shared[r] for r in _runs(word) if r in shared)
            runs.update(known[word])
        against.update(runs)
    telling = {
        run for run, n in frequent.items() if (against[run] + 0.5) / max(1, len(ordinary)) * CONTRAST < n / len(toxic)
    }
    return Counter(part for words in toxic for part in {_told(w, telling) for w in words} if part)


def _told(window: bytes, telling: set[bytes]) -> bytes:
    """The part of a window from its first telling run to the end of its last."""
    spans = [(i, i + n) for n in RUNS for i in range(len(window) - n) if window[i : i + n] in telling]
    return window[min(a for a, _ in spans) : max(b for _, b in spans)] if spans else b""


class Distance:
    """Distances of windows, remembered, each with the window's length class: distance * classes + class."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.toxic, self.ordinary = (
            zstandard.ZstdCompressor(
                dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
                compression_params=_FORMAT,
            )
            for content in (toxic, ordinary)
        )
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.held = 0

    def __call__(self, words: Collection[bytes]) -> np.ndarray:
        if self.held > KEPT_BYTES:
            self.forget()
        known = self.known
        for word in words:
            if word not in known:
                block = word + TAIL
                saved = len(self.ordinary.compress(block)) - len(self.toxic.compress(block))
                known[word] = (min(MOST, max(LEAST, saved)) - LEAST) * CLASSES + bisect_left(LENGTHS, len(word))
                self.held += len(word) + 120  # with the headers and the entry of the table
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


def described(cells: np.ndarray, weights: np.ndarray) -> list[float]:
    """Windows over each threshold, the strongest windows' weights, all positive weight, and its share."""
    distances = cells // CLASSES + LEAST
    found = np.sort(weights[cells])[::-1]
    strong = found[found > 1].sum()
    return [
        *(math.log1p(int((distances >= cut).sum())) for cut in CUTS),
        found[0] if len(found) else 0.0,
        float(found[:3].sum()),
        float(strong),
        math.log1p(float(strong) * 100 / max(1, len(found))),
        math.log1p(len(found)),
    ]


def fit(texts: list[bytes], toxic: list[bool], calibrate: list[bool], odds: float) -> dict:
    """Dictionaries from the texts that are not for calibration, windows' weights and logistic model from the others.

    ``odds`` are those of a toxic document among all labelled ones; the sample holds relatively more.
    """
    kinds = sorted(set(toxic))
    if len(kinds) < 2:
        return {"constant": float(bool(kinds and kinds[0]))}
    # Each word is held once, whatever the number of documents with it.
    once: dict[bytes, bytes] = {}
    sets = [tuple(once.setdefault(w, w) for w in windows(t)) for t in texts]
    part = lambda kind, later: [s for s, x, c in zip(sets, toxic, calibrate, strict=True) if x == kind and c == later]
    bad, good = part(True, False) or part(True, True), part(False, False) or part(False, True)
    marked = toxic_words(bad, good)
    usual: Counter[bytes] = Counter(w for words in good for w in words)
    model = {"toxic": dictionary(marked, TOXIC_BYTES), "ordinary": dictionary(usual, ORDINARY_BYTES)}
    distance = Distance(model["toxic"], model["ordinary"])
    rows = [i for i, c in enumerate(calibrate) if c]
    if len({toxic[i] for i in rows}) < 2:
        rows = list(range(len(texts)))
    found = [distance(sets[i]) for i in rows]
    y = np.array([toxic[i] for i in rows], float)
    counts = [sum((np.bincount(d, minlength=CELLS) for d, x in zip(found, y, strict=True) if x == k), np.zeros(CELLS)) for k in (0, 1)]
    # Twenty windows more on either side, spread as all windows are: a rare cell then says little.
    prior = (counts[0] + counts[1] + 1e-3) / (counts[0] + counts[1] + 1e-3).sum()
    shares = [(c + 20 * prior + 0.25) / (c + 20 * prior + 0.25).sum() for c in counts]
    weights = np.log(shares[1] / shares[0])
    x = np.array([described(d, weights) for d in found])
    mean, spread = x.mean(0), x.std(0) + 1e-9
    design = np.c_[np.ones(len(x)), (x - mean) / spread]
    beta = np.zeros(design.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-design @ beta))
        hessian = design.T @ (design * (p * (1 - p))[:, None]) + np.eye(len(beta))
        beta += np.linalg.solve(hessian, design.T @ (y - p) - beta)
    beta[0] += math.log(odds) - math.log(y.sum() / (len(y) - y.sum()))
    return model | {k: v.tolist() for k, v in (("weights", weights), ("mean", mean), ("spread", spread), ("beta", beta))}


def train(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str) -> dict:
    """Fit on a bounded sample in one task; the model is some tens of kilobytes."""
    known = (
        labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(doc_id).alias("_labelled"))
        .agg((F.max(label) == 1).alias("toxic"))
        .withColumn("_order", F.xxhash64("_labelled"))
    )
    part = lambda kind, most: known.where(F.col("toxic") == kind).orderBy("_order", "_labelled").limit(most)
    totals = known.agg(F.sum(F.col("toxic").cast("long")).alias("toxic"), F.count("*").alias("all")).first()
    odds = (totals["toxic"] or 0) / max(1, totals["all"] - (totals["toxic"] or 0))
    sample = staged(part(True, TOXIC).union(part(False, ORDINARY)), "toxicity-labels")
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text")).join(
        F.broadcast(sample), F.col("_id") == F.col("_labelled")
    )
    held = rows.select("text", "toxic", (F.pmod(F.xxhash64(F.col("_order")), F.lit(3)) == 0).alias("calibrate"), "_order")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, texts, toxic, calibrate = [], [], [], []
        for batch in batches:
            texts += texts_of(batch, "text")
            toxic += batch.column(1).to_pylist()
            calibrate += batch.column(2).to_pylist()
            order += batch.column(3).to_pylist()
        turn = sorted(range(len(texts)), key=lambda i: (order[i], texts[i]))
        model = fit(*([xs[i] for i in turn] for xs in (texts, toxic, calibrate)), odds)
        packed = {k: v.hex() if isinstance(v, bytes) else v for k, v in model.items()}
        order, texts, toxic, calibrate = [], [], [], []
        give_back()
        yield pa.RecordBatch.from_pydict({"model": [json.dumps(packed)]})

    found = held.repartition(1).mapInArrow(run, "model string").first()
    packed = json.loads(found["model"]) if found else {"constant": 0.0}
    return {k: bytes.fromhex(v) if isinstance(v, str) else v for k, v in packed.items()}


@lru_cache(maxsize=2)
def _distance(toxic: bytes, ordinary: bytes) -> Distance:
    return Distance(toxic, ordinary)


@contextmanager
def scorer(model: dict) -> Iterator[Callable[[Collection[bytes]], float]]:
    """A function from a text's windows to its score; what it remembers goes at the end."""
    if "constant" in model:
        yield lambda words: model["constant"]
        return
    distance = _distance(model["toxic"], model["ordinary"])
    weights, mean, spread, beta = (np.array(model[k]) for k in ("weights", "mean", "spread", "beta"))

    def probability(words: Collection[bytes]) -> float:
        x = (np.array(described(distance(words), weights)) - mean) / spread
        return 1 / (1 + math.exp(-min(500.0, max(-500.0, float(beta[0] + x @ beta[1:])))))

    try:
        yield probability
    finally:
        distance.forget()
        give_back()


def score(docs: DataFrame, model: dict, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(``doc_id``, ``score``, ``windows``) of every document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with scorer(model) as probability:
            for batch in slices(batches, "text", 1 << 20):
                sets = [windows(value) for value in texts_of(batch, "text")]
                scores = pa.array([probability(words) for words in sets], pa.float64())
                sizes = pa.array([len(words) for words in sets], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0), scores, sizes], names=["doc_id", "score", "windows"])

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(run, "doc_id long, score double, windows long")


def keep_ordinary(docs: DataFrame, model: dict, text: str = "text", limit: float = 0.5) -> DataFrame:
    """The documents, all columns, whose score is below ``limit``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with scorer(model) as probability:
            for batch in slices(batches, text, 1 << 20):
                yield batch.filter(pa.array([probability(windows(value)) < limit for value in texts_of(batch, text)]))

    return docs.mapInArrow(run, docs.schema)
