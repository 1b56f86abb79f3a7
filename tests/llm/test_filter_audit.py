import random
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.llm import filter_audit, word_transducer

PARTS = ["a", "b", "A", "  ", " ", "\n", "\t", "é", "中", "😀", "#", "|", "the ", "x" * 20, "y" * 70, "\x0b", "\x1c", "\x85", " word", "\x00"]


def wild(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def by_hand(text):
    data = text.encode()
    words = data.split()
    return len(words), len(set(words)), sum(65 <= b <= 90 for b in data), len(text), sum(b in b"#$%&*|" for b in data)


def counted(texts):
    parts = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(parts), np.uint8)
    return [tuple(r) for r in word_transducer.count_texts(data, np.cumsum([len(p) for p in parts], dtype=np.int64)).T.tolist()]


EDGES = ["", "", " ", "a", "x" * 5000, " " * 3000, "ab " * 900 + "x" * 300 + " " + "x" * 300, "A" * 70 + " " + "A" * 69 + "B"]


@pytest.mark.parametrize("block", [1, 7, 64, 1000, 1 << 18])
def test_counts_of_texts(monkeypatch, block):
    monkeypatch.setattr(word_transducer, "BLOCK", block)
    texts = wild(300 if block > 7 else 60, block) + EDGES
    assert counted(texts) == [by_hand(t) for t in texts]


def test_words_of_one_hash_are_told_apart(monkeypatch):
    """With all powers 0 every word has the hash 0, so that only the comparison of the bytes tells words apart."""
    monkeypatch.setattr(word_transducer, "_POWER", np.zeros_like(word_transducer._POWER))
    texts = wild(150, 3) + EDGES
    assert counted(texts) == [by_hand(t) for t in texts]


def test_table_grows():
    texts = [" ".join(f"w{i}" for i in range(9000)) + " w1 w2", " ".join(f"w{i % 50}" for i in range(9000))]
    assert [r[1] for r in counted(texts)] == [9000, 50]
    assert counted([]) == []


def test_measured_rows(spark, documents, monkeypatch):
    monkeypatch.setattr(word_transducer, "LOT", 100)
    texts = [*wild(40, 5), None, "", "long " * 3000]
    docs = documents(texts).withColumn("n_words", F.lit("mine"))
    rows = word_transducer.measure(documents(texts).coalesce(1), ["doc_id"]).collect()
    want = [by_hand(t or "") for t in texts]
    assert [tuple(r[c] for c in word_transducer.COUNTS) for r in sorted(rows, key=lambda r: r["doc_id"])] == want
    assert word_transducer.measure(docs, ["doc_id", "n_words"]).columns == ["doc_id", *word_transducer.COUNTS, "digest"]


def brute(rows, labels):
    """Every order, document by document."""
    facts = []
    for doc_id, text, source in rows:
        words, distinct, capitals, points, symbols = by_hand(text or "")
        fails = {
            "A": words < 200, "B": 100 * distinct < 50 * words, "C": 100 * capitals > 2 * points, "D": symbols > 0,
            "E": doc_id is not None and any(i is not None and i < doc_id and (t or "") == (text or "") for i, t, _ in rows),
        }
        mine = [r for r in labels if doc_id is not None and r[0] == doc_id]
        facts.append((source or "", {c for c in fails if fails[c]}, any(r[1] == 1 for r in mine), any(r[2] == 1 for r in mine)))
    out = {}
    for part in {f[0] for f in facts}:
        here = [f[1:] for f in facts if f[0] == part]
        totals = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = here
            for k, c in enumerate(order):
                gone = [f for f in left if c in f[0]]
                left = [f for f in left if c not in f[0]]
                totals[c] += len(gone)
                failing = [f for f in here if c in f[0]]
                alone = sum(f[0] == {c} for f in here)
                lost = sum(f[1] for f in gone), sum(f[2] for f in gone)
                out[part, order, k + 1] = [len(left), len(gone), len(failing) - len(gone), alone, *lost]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(totals[order[step - 1]])
    return out


NAMES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_orders_as_by_brute_force(spark, documents):
    rng = random.Random(8)
    words = " ".join(f"w{i}" for i in range(250))
    bodies = [words, words + " #", "w " * 300, "UP " * 300, "few words", "", None, words.upper(), "few words %"]
    rows = [(i, rng.choice(bodies), rng.choice(["s", "t", None, ""])) for i in range(60)]
    rows += [(3, words, "s"), (3, words, "t"), (None, words, "s"), (None, words, "s"), (None, None, None), (70, "only here", "u")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 70, 2)]
    labels += [(4, 1, 0), (None, 1, 1), (999, 1, 1)]
    docs = documents([(i, t, "en", s) for i, t, s in rows]).withColumns({"part": F.lit("x"), "digest": F.lit(1), "good": F.lit(2)})
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = filter_audit.audit(docs.repartition(5), marks)
    assert got.columns == ["part", "filter_order", "step", *NAMES]
    found = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in NAMES] for r in got.collect()}
    assert found == brute(rows, labels)
    assert len(found) == 600 * 4
    assert filter_audit.audit(docs.limit(0), marks).count() == 0
    none = filter_audit.audit(docs, marks.limit(0)).agg({"good_lost": "sum", "toxic_lost": "sum"}).first()
    assert tuple(none) == (0, 0)


def test_other_filters(spark, documents):
    docs = documents(["a b", "A", "a b", "#"])
    marks = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = filter_audit.audit(docs, marks, {"S": "n_symbols > 0"}).orderBy("filter_order", "step").collect()
    assert [(r["filter_order"], r["step"], r["kept"], r["removed"], r["shapley"]) for r in got] == [
        ("ES", 1, 3, 1, 2), ("ES", 2, 2, 1, 2), ("SE", 1, 3, 1, 2), ("SE", 2, 2, 1, 2),
    ]
