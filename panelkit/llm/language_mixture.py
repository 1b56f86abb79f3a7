"""Languages of documents as mixtures, by expectation-maximisation over n-gram likelihoods.

A model holds, for each language, the probability of every bucket of hashed character n-grams, counted
over all labelled documents. A document is a mixture: each of its n-grams comes from one language with the
document's proportions. Languages enter one by one, the one with the steepest gain first, as long
as the re-estimated log-likelihood rises by more than a penalty (half the logarithm of the number of n-grams,
as in the Bayesian information criterion, times a factor).
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.batches import map_texts

GRAM, BUCKETS = 3, 1 << 16
UNKNOWN = "und"
# Added to each count of a bucket; weight of the penalty; EM steps at most, and the gain below which they end.
SMOOTH, PENALTY, STEPS, CLOSE = 0.5, 4.0, 60, 1e-3
_TIMES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


@cache
def _letters() -> np.ndarray:
    """For every code point: the code point of its lower case, or a space if it is no letter or mark of one."""
    table = np.full(0x110000, 32, np.uint32)
    for i in range(0x110000):
        char = chr(i)
        if char.isalpha() or unicodedata.category(char) == "Mn":
            table[i] = ord(low) if len(low := char.lower()) == 1 else i
    return table


def grams(text: str) -> np.ndarray:
    """Bucket of each n-gram of a whole text: lower-cased letters, everything else a single space."""
    codes = _letters()[np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), np.uint32)]
    blank = codes == 32
    codes = codes[~(blank & np.r_[False, blank[:-1]])]
    if len(codes) < GRAM:
        return np.empty(0, np.int64)
    n = len(codes) - GRAM + 1
    wide = codes.astype(np.uint64)
    mixed = wide[:n] * _TIMES[0]
    for k in range(1, GRAM):
        mixed = (mixed ^ (mixed >> np.uint64(29))) + wide[k : k + n] * _TIMES[k]
    return ((mixed * _TIMES[0]) >> np.uint64(48)).astype(np.int64)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def count_grams(labelled: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, bucket, n): n-grams of all documents with a known language, each text whole.

    Every task adds up what it reads, so the shuffle holds a row for each task, language and bucket it
    met at most. Null texts and null languages count nothing.
    """
    source = labelled.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text")).dropna()

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for part in parts:
            for name, one in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                if name not in sums:
                    sums[name] = np.zeros(BUCKETS, np.int64)
                found = grams(one)
                if len(found) > BUCKETS // 8:
                    sums[name] += np.bincount(found, minlength=BUCKETS)
                else:
                    np.add.at(sums[name], found, 1)
        for name, n in sums.items():
            met = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(met), pa.string()), pa.array(met, pa.int32()), pa.array(n[met])],
                names=["lang", "bucket", "n"],
            )

    counted = source.mapInArrow(count, "lang string, bucket int, n bigint")
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Model:
    """Log-probabilities are not needed: EM works on the probabilities themselves."""

    def __init__(self, langs: list[str], prob: np.ndarray):
        self.langs, self.prob = langs, prob  # (languages, BUCKETS)

    def mixture(self, text: str | None) -> tuple[list[str], list[float]]:
        """Languages and proportions of a text, largest first, ties by name; none without a letter."""
        if not self.langs or not text or not has_letter(text):
            return [], []
        found = grams(text)
        bucket, n = np.unique(found, return_counts=True)
        prob, total = self.prob[:, bucket], float(len(found))
        start = int(np.argmax(np.log(prob) @ n))
        chosen, share = [start], np.ones(1)
        likely = float(n @ np.log(prob[start]))
        while len(chosen) < len(self.langs):
            # slope of the log-likelihood, per n-gram, towards each language; 1 is level
            slope = (prob / (share @ prob[chosen])) @ n / total
            slope[chosen] = 0
            new = int(np.argmax(slope))
            most = total * (slope[new] - 1)  # the log-likelihood is concave: it rises by no more
            needed = PENALTY * 0.5 * np.log(total)
            if most <= needed:
                break
            tried = [*chosen, new]
            better, gained = self._fit(prob[tried], n, np.r_[share * 0.9, 0.1], likely + needed)
            if gained - likely <= needed:
                break
            chosen, share, likely = tried, better, gained
        order = sorted(range(len(chosen)), key=lambda i: (-share[i], self.langs[chosen[i]]))
        return [self.langs[chosen[i]] for i in order], [float(share[i]) for i in order]

    @staticmethod
    def _fit(prob: np.ndarray, n: np.ndarray, share: np.ndarray, goal: float) -> tuple[np.ndarray, float]:
        """(proportions, log-likelihood) after expectation-maximisation; ends early where the goal is out of reach."""
        total = n.sum()
        for _ in range(STEPS):
            each = share @ prob
            slope = (prob / each) @ n / total
            likely = float(n @ np.log(each))
            rest = float(total * (slope.max() - 1))
            if rest < CLOSE or likely + rest <= goal:
                break
            share = share * slope
        return share, float(n @ np.log(share @ prob))


def fit(counts: DataFrame) -> Model:
    """The model of counted n-grams. The driver gets BUCKETS numbers at most for each language, however many
    documents were counted; languages without any n-gram are not learned."""
    rows = counts.toArrow().to_pandas()
    langs = sorted(rows["lang"].unique())
    at = {name: i for i, name in enumerate(langs)}
    n = np.full((len(langs), BUCKETS), SMOOTH)
    n[rows["lang"].map(at).to_numpy(np.int64), rows["bucket"].to_numpy(np.int64)] += rows["n"].to_numpy(np.float64)
    return Model(langs, n / n.sum(axis=1, keepdims=True))


def predict(docs: DataFrame, model: Model, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """Columns ``keep`` (doc_id if not given), ``lang_pred``, ``score``, ``langs`` and ``shares`` of every whole text.

    ``lang_pred`` is the language with the largest proportion, ``score`` that proportion. Null texts, texts
    without a letter, and all texts if no language was learned: ``und``, score 0, empty lists. A row for each input
    row, also where ids repeat or are null; no other column is looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x BUCKETS numbers

    def run(texts: list[str | None]) -> list:
        found = [shared.value.mixture(t) for t in texts]
        return [
            [names[0] if names else UNKNOWN for names, _ in found],
            [shares[0] if shares else 0.0 for _, shares in found],
            [names for names, _ in found],
            [shares for _, shares in found],
        ]

    fields = "lang_pred string, score double, langs array<string>, shares array<double>"
    return map_texts(docs, run, fields, text, ["doc_id"] if keep is None else keep)


def held_out(doc_id: str = "doc_id"):
    """True for documents never learned from: checksum of the id as text, modulo 4, is 2. Null ids are learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def learn_and_predict(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, langs, shares): learned from the documents that are not held out."""
    rows = docs.withColumn("held_out", held_out())
    model = fit(count_grams(rows.filter(~F.col("held_out"))))
    return predict(rows, model, ["doc_id", "held_out"])
