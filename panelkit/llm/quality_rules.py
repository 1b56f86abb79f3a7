"""Quality rules as a ledger of failure bits.

Every rule is evaluated once for each document. The ledger keeps the measurements and one bit per
failed rule, so that policies (sets of rules, in versions) and ablations are bit operations on a
narrow table; texts are not read again.
"""

from __future__ import annotations

import operator
import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.batches import map_texts

WINDOW = 8
MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper", "n_stutters",
]
_FIELDS = ", ".join(f"{m} bigint" for m in MEASURES)

# What counts as white space between words, and as a symbol.
_BLANKS = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_HAS_WORD = re.compile(r"[^\x20\x09-\x0D]")
_UPPER = bytes(range(65, 91))
_NOT_LETTER = bytes(b for b in range(192) if not 97 <= (b | 32) <= 122 or b >= 128)
_TIMES = np.random.default_rng(8).integers(1, 2**63, WINDOW, dtype=np.uint64) | np.uint64(1)


# Bit number of each rule, and when it fails. Numbers are never reused, so stored ledgers stay readable.
RULES = {
    "few_words": (0, "n_words < 20"),
    "repeated_windows": (1, "100 * n_repeat_words > 30 * n_words"),
    "many_symbols": (2, "10 * n_symbols > 2 * n_words"),
    "repeated_lines": (3, "2 * n_dup_lines > n_lines"),
    "odd_word_length": (4, "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    "few_letters": (5, "2 * n_letters < word_chars"),
    "upper_case": (6, "2 * n_upper > n_letters"),
    "stutters": (7, "5 * n_stutters > n_words"),
}
# The policies by name and version; rules of a policy reject, all others only measure.
POLICIES = {
    "base-1": ["few_words", "repeated_windows"],
    "web-1": ["few_words", "repeated_windows", "many_symbols", "repeated_lines"],
    "web-2": [
        "few_words", "repeated_windows", "many_symbols", "repeated_lines", "odd_word_length", "few_letters",
        "upper_case", "stutters",
    ],
}
POLICY = "web-2"


def _bit(rule: str) -> int:
    return 1 << RULES[rule][0]


def mask(policy: str) -> int:
    """The bits of a policy's rules."""
    return sum(_bit(rule) for rule in POLICIES[policy])


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a run of WINDOW words found twice or more in ``words``."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.uint64)
    sums = ids[:n] * _TIMES[0]
    for k in range(1, WINDOW):
        sums += ids[k : k + n] * _TIMES[k]
    ordered = np.sort(sums)
    if not (ordered[1:] == ordered[:-1]).any():
        return 0
    _, first, group, size = np.unique(sums, return_index=True, return_inverse=True, return_counts=True)
    again = np.flatnonzero(size[group] > 1)
    runs = np.lib.stride_tricks.sliding_window_view(ids, WINDOW)
    if not (runs[again] == runs[first[group[again]]]).all():  # two runs with one sum: compare the runs themselves
        seen: dict[bytes, list[int]] = {}
        for i in again:
            seen.setdefault(runs[i].tobytes(), []).append(i)
        again = np.array(sorted(i for found in seen.values() if len(found) > 1 for i in found), np.int64)
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, again, 1)
    np.add.at(steps, again + WINDOW, -1)
    return int((np.cumsum(steps) > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    """MEASURES of one whole text; null is measured as an empty text.

    Letters are those of ASCII and all characters beyond it; upper case is told in ASCII only. A stutter is a
    word equal to the one before it.
    """
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # splits at exactly the six characters of _BLANKS
    lines = [x for x in text.split("\n") if _HAS_WORD.search(x)]
    # ASCII letters, and the code points beyond ASCII, of which only leading bytes are kept
    letters = data.translate(None, _NOT_LETTER)
    return (
        len(words),
        len(text) - sum(text.count(b) for b in _BLANKS),
        sum(text.count(s) for s in _SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(letters),
        len(data) - len(data.translate(None, _UPPER)),
        sum(map(operator.eq, words, words[1:])),
    )


def _measured(texts: list[str | None]) -> list:
    rows = [measure(t) for t in texts]
    return [list(v) for v in zip(*rows, strict=True)] if rows else [[] for _ in MEASURES]


def ledger(docs: DataFrame, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """Columns ``keep`` of the documents, MEASURES, and ``failed``: the bits of all rules that fail.

    Null and empty texts have no words and fail ``few_words``. Each row is judged for itself: copies and rows
    that repeat an id get a row each. Columns of ``keep`` with the name of a measure are replaced.
    """
    measured = map_texts(docs, _measured, _FIELDS, text, ["doc_id"] if keep is None else keep)
    bits = [F.when(F.expr(fails), 1 << bit).otherwise(0).cast("bigint") for bit, fails in RULES.values()]
    failed = bits[0]
    for b in bits[1:]:
        failed = failed.bitwiseOR(b)
    return measured.withColumn("failed", failed)


def passes(policy: str, failed: str = "failed") -> Column:
    """True where no rule of the policy fails."""
    return F.col(failed).bitwiseAND(F.lit(mask(policy))) == 0


def verdicts(rows: DataFrame, policy: str = POLICY) -> DataFrame:
    """The ledger with ``base_failed`` (a rule of policy base-1 fails) and ``kept`` (no rule of ``policy`` or of
    base-1 fails)."""
    return rows.withColumns({"base_failed": ~passes("base-1"), "kept": passes("base-1") & passes(policy)})


def ablations(rows: DataFrame, policies: list[str] | None = None) -> DataFrame:
    """(policy, rule, n, kept, failing, only_this, kept_without) for each rule of each policy.

    One grouping of the ledger by its bits, combined before the shuffle; what follows has a row for each
    pattern of bits. ``only_this``: rows which no other rule of the policy rejects; without the rule
    ``kept_without`` rows are kept. An empty ledger gives no rows.
    """
    patterns = rows.groupBy("failed").agg(F.count(F.lit(1)).alias("rows"))
    names = list(POLICIES) if policies is None else policies
    tests = F.array(
        *[
            F.struct(
                F.lit(p).alias("policy"), F.lit(r).alias("rule"),
                F.lit(mask(p)).cast("bigint").alias("mask"), F.lit(_bit(r)).cast("bigint").alias("bit"),
            )
            for p in names
            for r in POLICIES[p]
        ]
    )
    hit = F.col("failed").bitwiseAND(F.col("mask"))
    return (
        patterns.select("failed", "rows", F.inline(tests))
        .withColumn("hit", hit)
        .groupBy("policy", "rule")
        .agg(
            F.sum("rows").alias("n"),
            F.sum(F.when(F.col("hit") == 0, F.col("rows")).otherwise(0)).alias("kept"),
            F.sum(F.when(F.col("failed").bitwiseAND(F.col("bit")) != 0, F.col("rows")).otherwise(0)).alias("failing"),
            F.sum(F.when(F.col("hit") == F.col("bit"), F.col("rows")).otherwise(0)).alias("only_this"),
        )
        .withColumn("kept_without", F.col("kept") + F.col("only_this"))
    )
