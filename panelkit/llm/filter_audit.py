"""What filters of a corpus do to each other: every order of them, step by step.

Each document is measured once and becomes a set of bits, one for each filter that it fails. All orders of the
filters are then sums over the sets that occur, of which there are few: a document falls to the first of its failing
filters that an order applies.
"""

from __future__ import annotations

import json
import math
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm.word_transducer import measure

# Failure condition of each filter over the measures of a text. COPY has no condition of its own: it fails documents whose
# text is that of a document with a smaller id.
FILTERS = {
    "A": "n_words < 200",
    "B": "100 * n_distinct < 50 * n_words",
    "C": "100 * n_capitals > 2 * n_points",
    "D": "n_symbols > 0",
}
COPY = "E"
# Rows without an id match no label; they are dealt to so many parts of the join.
_SALTS = 1024


def _bits(filters: dict[str, str]) -> Column:
    bits = F.lit(0)
    for k, fails in enumerate(filters.values()):
        bits = bits + F.when(F.expr(fails), 1 << k).otherwise(0)
    return bits


def failures(docs: DataFrame, labels: DataFrame, filters: dict[str, str] = FILTERS, part: str = "source") -> DataFrame:
    """(part, failed, n, n_good, n_toxic): documents of each part by the set of filters that they fail.

    Bit k of ``failed`` is the k-th of ``filters``, the bit behind them COPY. Null is an empty text, and an empty part. A
    document is good, or toxic, if any row of ``labels`` with its id says so. Rows that repeat an id are documents of
    their own, and no copies of each other; rows without an id have no labels, are no copies and make none.

    Rows are combined before each shuffle, so copies and hot parts never gather; what is shuffled has no texts.
    """
    copy = 1 << len(filters)
    chosen = docs.select("doc_id", F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"), "text")
    measured = measure(chosen, ["doc_id", "part"]).select("doc_id", "part", "digest", _bits(filters).alias("failed"))
    salt = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("digest", "part"), F.lit(_SALTS))).otherwise(0)
    known = labels.groupBy("doc_id").agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    known = known.filter(F.col("doc_id").isNotNull()).withColumn("salt", F.lit(0).cast("bigint"))
    rows = measured.withColumn("salt", salt.cast("bigint")).join(known, ["doc_id", "salt"], "left")
    rows = rows.na.fill(False, ["good", "toxic"])
    kind = ["part", "failed", "good", "toxic"]
    by_id = rows.groupBy("doc_id", "salt", "digest", *kind).agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    nameless = F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0))
    by_text = by_id.groupBy("digest", *kind).agg(F.sum("n").alias("n"), first.alias("first"), nameless.alias("nameless"))
    # a text has few rows by now, one for each kind of document that has it
    earliest = F.min("first.doc_id").over(Window.partitionBy("digest"))
    fresh = F.col("nameless") + F.when(F.col("first.doc_id") == earliest, F.col("first.n")).otherwise(0)
    told = by_text.select(*kind, "n", fresh.alias("fresh")).select(
        "part", "good", "toxic",
        F.inline(F.array(
            F.struct(F.col("failed"), F.col("fresh").alias("n")),
            F.struct((F.col("failed") + copy).alias("failed"), (F.col("n") - F.col("fresh")).alias("n")),
        )),
    )
    count = {"n": F.col("n"), "n_good": F.when(F.col("good"), F.col("n")), "n_toxic": F.when(F.col("toxic"), F.col("n"))}
    sums = [F.coalesce(F.sum(v), F.lit(0)).alias(c) for c, v in count.items()]
    return told.filter("n > 0").groupBy("part", "failed").agg(*sums)


def _steps(letters: str) -> list[dict]:
    """Every step of every order: the filter's bit, and the bits of the filters before it."""
    bit = {c: 1 << k for k, c in enumerate(letters)}
    return [
        {"filter_order": "".join(order), "step": k + 1, "bit": bit[c], "before": sum(bit[x] for x in order[:k])}
        for order in permutations(letters)
        for k, c in enumerate(order)
    ]


def interactions(failed: DataFrame, letters: str) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of the rows of
    ``failures``, for every order of the filters and every step, zeros included.

    ``shapley`` is what a step's filter removes, summed over all orders; a document that fails m filters falls to each
    of them in one of m orders. No document, no row.
    """
    kind = "array<struct<filter_order:string,step:int,bit:int,before:int>>"
    steps = F.from_json(F.lit(json.dumps(_steps(letters))), kind)
    has = F.col("failed").bitwiseAND(F.col("bit")) != 0
    had = F.col("failed").bitwiseAND(F.col("before")) != 0
    sums = {
        "kept": ("n", ~has & ~had),
        "removed": ("n", has & ~had),
        "redundant": ("n", has & had),
        "unique_fails": ("n", F.col("failed") == F.col("bit")),
        "good_lost": ("n_good", has & ~had),
        "toxic_lost": ("n_toxic", has & ~had),
    }
    orders = F.when(has, F.lit(math.factorial(len(letters))) / F.bit_count("failed")).otherwise(0).cast("bigint")
    return (
        failed.select("*", F.inline(steps))
        .groupBy("part", "filter_order", "step")
        .agg(
            *[F.sum(F.when(where, F.col(c)).otherwise(0)).alias(name) for name, (c, where) in sums.items()],
            F.sum(F.col("n") * orders).alias("shapley"),
        )
    )


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, str] = FILTERS, part: str = "source") -> DataFrame:
    """``interactions`` of the filters and COPY over the documents. Filters are named by one letter each."""
    return interactions(failures(docs, labels, filters, part), "".join(filters) + COPY)
