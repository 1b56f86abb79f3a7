import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from panelkit.llm import mixing


TEXT = "y"


def fill(budget, caps, weights):
    """Shares of children, by raising the level step by step."""
    out = {k: 0.0 for k in caps}
    open_ = {k for k in caps if weights[k] > 0}
    while open_:
        level = (budget - sum(out[k] for k in caps if k not in open_)) / sum(weights[k] for k in open_)
        full = {k for k in open_ if caps[k] <= level * weights[k]}
        if not full:
            return out | {k: level * weights[k] for k in open_}
        out |= {k: float(caps[k]) for k in full}
        open_ -= full
    return out


def by_hand(rows, weights, epochs, share, seed):
    supply = {}
    for _, path, n in rows:
        supply[path] = supply.get(path, 0) + n
    budget = {(): float(math.floor(sum(supply.values()) * share))}
    for k in range(1, 4):
        caps = {}
        for path, n in supply.items():
            caps[path[:k]] = caps.get(path[:k], 0) + n * epochs
        for parent in {p[:-1] for p in caps}:
            own = {p: c for p, c in caps.items() if p[:-1] == parent}
            budget |= fill(budget[parent], own, {p: weights.get(p, 1.0) for p in own})
    out = []
    for path, held in supply.items():
        target = math.floor(budget[path])
        full = target // held if held else 0
        left = target - full * held

        def place(r, copy):
            text = hashlib.md5(TEXT.encode()).hexdigest()
            parts = [str(seed), str(full), *[str(r[0])] * (r[0] is not None), text, str(copy)]
            return hashlib.md5("|".join(parts).encode()).hexdigest()

        own = [r for r in rows if r[1] == path]
        places = [place(r, own[:i].count(r)) for i, r in enumerate(own)]
        for r, mine in zip(own, places, strict=True):
            upto = sum(o[2] for o, p in zip(own, places, strict=True) if p <= mine)
            out.append((*r, (full + (left > 0 and upto <= left)) if r[2] else 0))
    return sorted(out, key=repr)


@pytest.mark.parametrize("epochs, share", [(1, 0.5), (2, 0.8), (3, 1.7), (1, 1.0), (2, 0.0), (1, 3.0)])
def test_as_by_hand(spark, monkeypatch, epochs, share):
    rng = random.Random(epochs)
    rows = []
    for i in range(400):
        path = (rng.choice("aab"), rng.choice(["x", "y", None]), rng.choice("pqqqqr"))
        rows.append((i, path, rng.choice([0, 1, 5, 40])))
    rows += [(None, ("a", "x", "p"), 3), (None, ("a", "x", "p"), 4), (7, rows[7][1], rows[7][2])]
    weights = {("a",): 3.0, ("a", "x"): 0.5, ("b", None, "p"): 4.0, ("b", "y"): 0.0, ("nowhere",): 9.0}
    docs = spark.createDataFrame([(i, *p, n) for i, p, n in rows], "doc_id bigint, domain string, lang string, source string, n bigint")
    docs = docs.withColumn("path", F.lit("x")).withColumn("left", F.lit(1)).withColumn("text", F.lit(TEXT))
    want = by_hand(rows, weights, epochs, share, 11)
    for few, digits in ((50_000, 3), (0, 1)):
        monkeypatch.setattr(mixing, "BROADCAST_LEAVES", few)
        monkeypatch.setattr(mixing, "SLICE_DIGITS", digits)
        got = mixing.mix(docs, weights=weights, epochs=epochs, share=share, n_tokens=F.col("n")).collect()
        assert sorted(((r["doc_id"], tuple(r["path"]), r["n_tokens"], r["epochs"]) for r in got), key=repr) == want


def test_shortages_go_to_siblings_first(spark):
    """A short language's budget goes to the other language of its domain; the other domain gets nothing of it."""
    rows = [(i, "a", "x", "s", 1) for i in range(10)]
    rows += [(100 + i, "a", "y", "s", 1) for i in range(200)]
    rows += [(1000 + i, "b", "x", "s", 1) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, domain string, lang string, source string, n bigint").withColumn("text", F.lit(TEXT))
    got = mixing.mix(docs, share=200 / 410, n_tokens=F.col("n")).groupBy(F.col("path")[0], F.col("path")[1]).agg(F.sum("epochs")).collect()
    assert sorted(tuple(r) for r in got) == [("a", "x", 10), ("a", "y", 90), ("b", "x", 100)]


def test_edges_are_defined(spark, documents):
    docs = documents([(1, "a b c"), (2, None), (3, "\x0b \n"), (4, "long " * 50_000), (5, "a\x0bb\x85c d", None, None)])
    docs = docs.withColumn("domain", F.lit("d"))
    got = {r["doc_id"]: (r["n_tokens"], r["epochs"]) for r in mixing.mix(docs, share=1.0).collect()}
    assert got == {1: (3, 1), 2: (0, 0), 3: (0, 0), 4: (50_000, 1), 5: (3, 1)}
    assert mixing.mix(docs.limit(0)).count() == 0


def test_no_python_in_the_plan(spark, documents, capsys):
    mixing.mix(documents(["a b"]).withColumn("domain", F.lit("d"))).explain()
    assert "Python" not in capsys.readouterr().out


def test_shut_children_are_no_supply(spark):
    """What a shut node would have held goes to the ancestors' siblings, at every depth."""
    rows = [(i, "a", "x", "s", 1) for i in range(10)]
    rows += [(100 + i, "a", "x", "shut", 1) for i in range(90)]
    rows += [(300 + i, "a", "y", "s", 1) for i in range(100)]
    rows += [(1000 + i, "b", "x", "s", 1) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, domain string, lang string, source string, n bigint").withColumn("text", F.lit(TEXT))
    weights = {("a", "y"): 0.0, ("a", "x", "shut"): 0.0}
    mixed = mixing.mix(docs, weights=weights, share=0.5, n_tokens=F.col("n"))
    got = mixed.groupBy(F.col("path")[0], F.col("path")[1], F.col("path")[2]).agg(F.sum("epochs")).collect()
    assert sorted(tuple(r) for r in got) == [("a", "x", "s", 10), ("a", "x", "shut", 0), ("a", "y", "s", 0), ("b", "x", "s", 190)]


def test_repeated_ids_are_taken_by_their_share(spark, monkeypatch):
    """Rows without id, and rows that repeat one, up to the very text, fill a budget like others."""
    monkeypatch.setattr(mixing, "COPIES", 300)
    kinds = [(None, lambda i: f"a b c{i}"), (1, lambda i: f"a b c{i}"), (2, lambda i: "a b c"), (None, lambda i: "x y z")]
    for doc_id, text in kinds:
        rows = [(doc_id, text(i), "d", "en", "s") for i in range(4000)]
        docs = spark.createDataFrame(rows, "doc_id bigint, text string, domain string, lang string, source string")
        got = mixing.mix(docs, share=0.8).agg(F.sum(F.col("n_tokens") * F.col("epochs")), F.count("*"), F.max("epochs")).first()
        assert tuple(got) == (9600, 4000, 1)
