"""Graded quality by cumulative-link regression on hashed text.

P(grade <= k) = sigmoid(threshold_k - score): one weight vector over hashed features for all grades, and
ordered thresholds. From it come the expected grade and the probability of the highest grades.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.batches import map_texts

# Buckets of features; labelled documents that a model is fitted on at most; documents that a feature has to be in to get
# a weight; steps of the fit, and the precision of the weights' prior, a normal distribution around zero.
BUCKETS, SAMPLE, LEAST_DOCS, STEPS, PRIOR = 1 << 18, 12_000, 10, 40, 9.0
GRADES = 3
# Probability of the highest grade from which a document is kept.
LEAST = 0.7
# The shape of a word: capitals, small letters and digits alike, other characters as they are.
_SHAPE = bytes(
    65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in range(256)
)
_STARTS = [(b"\x01", 4), (b"\x02", 6)]
_MARKS = b".,;:!?"
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def features(text: str | None) -> np.ndarray:
    """Buckets of a whole text, each once: its lower-cased words without marks around them, how they begin, and shapes."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = {w.strip(_MARKS) for w in data.translate(_LOWER).split()}
    starts = (tag + w[:n] for w in words for tag, n in _STARTS if len(w) > n)
    shapes = (b"\x00" + s for s in set(data.translate(_SHAPE).split()))
    hashed = np.fromiter(map(zlib.crc32, chain(words, starts, shapes)), np.uint32)
    return np.unique(hashed % BUCKETS).astype(np.int32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Model:
    """Weights by bucket, and the thresholds between grades in ascending order."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    def tails(self, found: np.ndarray) -> np.ndarray:
        """P(grade > k) for each threshold k."""
        return _sigmoid(self.weights[found].sum() - self.thresholds)


def _minimise(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, steps: int, memory: int = 10) -> np.ndarray:
    """Limited-memory BFGS with backtracking; ``loss`` gives value and gradient."""
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    value, slope = loss(x)
    for _ in range(steps):
        way, parts = slope.copy(), []
        for s, y in reversed(moves):
            parts.append((s @ way) / (y @ s))
            way -= parts[-1] * y
        way *= (moves[-1][0] @ moves[-1][1]) / (moves[-1][1] @ moves[-1][1]) if moves else 1 / max(1.0, np.linalg.norm(way))
        for (s, y), part in zip(moves, reversed(parts), strict=True):
            way += s * (part - (y @ way) / (y @ s))
        length = 1.0
        while True:
            new_value, new_slope = loss(x - length * way)
            if new_value <= value - 1e-4 * length * (slope @ way) or length < 1e-6:
                break
            length /= 2
        s, y = -length * way, new_slope - slope
        if s @ y > 1e-12:
            moves = [*moves, (s, y)][-memory:]
        done = value - new_value < 1e-7
        x, value, slope = x + s, new_value, new_slope
        if done:
            break
    return x


def fit_rows(found: list[np.ndarray], grade: np.ndarray, grades: int, least_docs: int = LEAST_DOCS) -> Model:
    """The likeliest model given a normal prior on the weights; without rows, all grades are equally likely.

    Features of fewer than ``least_docs`` rows have weight 0."""
    weights, n = np.zeros(BUCKETS), len(found)
    if not n:
        return Model(weights, np.log(np.arange(1, grades) / np.arange(grades - 1, 0, -1)))
    column = np.concatenate(found).astype(np.int32)
    row = np.repeat(np.arange(n, dtype=np.int32), [len(f) for f in found])
    used = np.flatnonzero(np.bincount(column, minlength=BUCKETS) >= least_docs)
    place = np.full(BUCKETS, -1, np.int32)
    place[used] = np.arange(len(used))
    column, row = place[column], row[place[column] >= 0]
    column = column[column >= 0]
    m = len(used)
    # thresholds as the first and the logarithms of the gaps, so they keep their order; they start at the grades' shares
    share = (np.bincount(grade, minlength=grades)[:-1].cumsum() + 0.5 * np.arange(1, grades)) / (n + 0.5 * grades)
    start = np.log(share / (1 - share))

    def thresholds(x: np.ndarray) -> np.ndarray:
        return x[m] + np.r_[0, np.cumsum(np.exp(x[m + 1 :]))]

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        cuts = np.r_[-np.inf, thresholds(x), np.inf]
        score = np.bincount(row, x[column], n)
        high, low = _sigmoid(cuts[grade + 1] - score), _sigmoid(cuts[grade] - score)
        chance = np.maximum(high - low, 1e-12)
        d_high, d_low = high * (1 - high) / chance, low * (1 - low) / chance
        by_weight = np.bincount(column, ((d_high - d_low) / n)[row], m) + PRIOR / n * x[:m]
        by_cut = np.array([d_low[grade == k + 1].sum() - d_high[grade == k].sum() for k in range(grades - 1)]) / n
        behind = np.cumsum(by_cut[::-1])[::-1]  # a gap moves all thresholds behind it
        value = -np.log(chance).mean() + 0.5 * PRIOR / n * (x[:m] @ x[:m])
        return value, np.r_[by_weight, behind[0], behind[1:] * np.exp(x[m + 1 :])]

    x = _minimise(loss, np.r_[np.zeros(m), start[0], np.log(np.maximum(np.diff(start), 1e-3))], STEPS)
    weights[used] = x[:m]
    return Model(weights, thresholds(x))


def sample_ids(labels: DataFrame, sample: int = SAMPLE, seed: int = 5) -> DataFrame:
    """(doc_id, grade) of the labelled documents to learn from: the ``sample`` smallest by a hash of the id, each once,
    with its lowest grade."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("grade").isNotNull())
    once = known.groupBy("doc_id").agg(F.min("grade").alias("grade"))
    return once.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(sample)


def fit(docs: DataFrame, labels: DataFrame, grades: int = GRADES, sample: int = SAMPLE, text: str = "text") -> Model:
    """A model of (doc_id, grade), grades from 0 to ``grades`` - 1, and the texts of these documents.

    Learns from ``sample`` labelled documents at most, in one task; the driver gets the weights. Labels without a
    document, null labels and null ids teach nothing. Of rows that repeat an id the one with the smallest hash of its text
    is learned from, of labels that repeat one the lowest.
    """
    chosen = sample_ids(labels.select("doc_id", F.col("grade").cast("int").alias("grade")), sample)
    found = docs.select("doc_id", F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    # a row for each id of the sample, so rows are bounded by it
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one")
    rows = found.groupBy("doc_id", "grade").agg(one).select("doc_id", "grade", "one.text")
    hashed = map_texts(rows, lambda texts: [[features(t) for t in texts]], "found array<int>", "text", ["doc_id", "grade"])

    def learn(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        every = pd.concat([p for p in parts if len(p)] or [pd.DataFrame({"doc_id": [], "grade": [], "found": []})])
        every = every.sort_values("doc_id", kind="stable")
        model = fit_rows(list(every["found"]), every["grade"].to_numpy(np.int64), grades)
        met = np.flatnonzero(model.weights)
        yield pd.DataFrame({"weights": [model.weights[met]], "met": [met], "thresholds": [model.thresholds]})

    schema = "weights array<double>, met array<int>, thresholds array<double>"
    row = hashed.repartition(1).mapInPandas(learn, schema).first()
    weights = np.zeros(BUCKETS)
    weights[row["met"]] = row["weights"]
    return Model(weights, np.array(row["thresholds"]))


def predict(docs: DataFrame, model: Model, good: int = GRADES - 1, least: float = LEAST, text: str = "text") -> DataFrame:
    """(doc_id, expected_grade, p_good, kept) of every whole text.

    ``p_good`` is the probability of grade ``good`` or more; documents with ``least`` or more are kept. Null and empty
    texts are graded by the thresholds alone. A row for each input row, also where ids repeat or are null.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers

    def run(texts: list[str | None]) -> list:
        tails = [shared.value.tails(features(t)) for t in texts]
        return [[float(t.sum()) for t in tails], [float(t[good - 1]) for t in tails]]

    scored = map_texts(docs, run, "expected_grade double, p_good double", text, ["doc_id"])
    return scored.withColumn("kept", F.col("p_good") >= least)


def grade_of(quality: str = "quality", toxic: str = "toxic") -> Column:
    """Two ratings as one grade: a point for good quality, a point for not being toxic. Null if either is unknown."""
    return F.col(quality).cast("int") + (1 - F.col(toxic).cast("int"))
