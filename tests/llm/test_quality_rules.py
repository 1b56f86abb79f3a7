import random
import re

import pytest

from panelkit.llm import quality_rules as q


def brute_repeats(words):
    runs = {}
    for i in range(len(words) - q.WINDOW + 1):
        runs.setdefault(tuple(words[i : i + q.WINDOW]), []).append(i)
    return len({i + k for found in runs.values() if len(found) > 1 for i in found for k in range(q.WINDOW)})


@pytest.mark.parametrize("seed", range(40))
def test_repeated_windows_as_by_hand(seed):
    rng = random.Random(seed)
    part = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 30))]
    words = part + [b"x"] * rng.randint(0, 12) + part[: rng.randint(0, 30)] + [rng.choice([b"a", b"y"]) for _ in range(9)]
    assert q.repeated_words(words) == brute_repeats(words)


def test_measures():
    text = "Ab\x0bcd éß #x\n\nAb\x0bcd éß #x\n \n\x85 | 1\n"
    row = dict(zip(q.MEASURES, q.measure(text), strict=True))
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    assert row["n_words"] == len(words)
    assert row["word_chars"] == sum(map(len, words))
    assert (row["n_symbols"], row["n_dup_lines"], row["n_lines"]) == (3, 1, 3)
    assert row["n_upper"] == 2
    assert row["n_stutters"] == 0
    assert q.measure(None) == q.measure("") == (0,) * len(q.MEASURES)


def test_ledger_and_verdicts(spark, documents):
    clean = " ".join(f"word{i}" for i in range(50))
    rows = [
        clean, None, "", "too short", "again and " * 40, " ".join(f"w{i}***" for i in range(30)),
        "x" * 100_000, clean, (None, clean), (0, clean),
    ]
    docs = documents(rows)
    got = q.verdicts(q.ledger(docs)).collect()
    assert [r["kept"] for r in got] == [True, False, False, False, False, False, False, True, True, True]
    assert [r["base_failed"] for r in got] == [False, True, True, True, True, False, True, False, False, False]
    symbols = got[5]
    assert symbols["failed"] == 1 << 2 | 1 << 5
    wide = docs.withColumn("n_words", docs["doc_id"]).withColumn("failed", docs["text"])
    again = q.verdicts(q.ledger(wide, wide.columns)).select("doc_id", "kept", "n_words", "failed").collect()
    assert [(r["kept"], r["n_words"], r["failed"]) for r in again] == [(r["kept"], r["n_words"], r["failed"]) for r in got]
    assert q.verdicts(q.ledger(docs.limit(0))).count() == 0


def test_ablations_count_rows(spark, documents):
    texts = ["a b", "c c " * 40, " ".join(f"w{i}***" for i in range(30)), " ".join(f"w{i}" for i in range(30)), "x|" * 3]
    rows = q.ledger(documents(texts))
    judged = [r["failed"] for r in rows.collect()]
    for r in q.ablations(rows).collect():
        mask = q.mask(r["policy"])
        without = mask & ~q._bit(r["rule"])
        assert r["n"] == len(texts)
        assert r["kept"] == sum(not f & mask for f in judged)
        assert r["kept_without"] == sum(not f & without for f in judged)
        assert r["failing"] == sum(bool(f & q._bit(r["rule"])) for f in judged)
    assert q.ablations(rows.limit(0)).count() == 0
