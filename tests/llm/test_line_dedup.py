import random

import pytest
from pyspark.sql import functions as F

from panelkit.llm import line_dedup


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def by_hand(rows):
    """Texts left, for rows with distinct ids."""
    lines = []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        for pos, line in enumerate((text or "").split("\n")):
            if len(line) >= line_dedup.MIN_CHARS:
                lines.append((doc_id, pos, line))
    gone = set()
    for i, (doc_id, pos, line) in enumerate(lines):
        if any(abs(len(line) - len(other)) < 2 and distance(line, other) <= 1 for _, _, other in lines[:i]):
            gone.add((doc_id, pos))
    out = {}
    for doc_id, text in rows:
        if text is not None:
            text = "\n".join(x for pos, x in enumerate(text.split("\n")) if (doc_id, pos) not in gone)
        out[doc_id] = text
    return out


def edited(line, rng, times):
    for _ in range(times):
        i = rng.randrange(len(line) + 1)
        line = rng.choice([line[:i] + rng.choice("abz é") + line[i:], line[:i] + line[i + 1 :], line[:i] + "q" + line[i + 1 :]])
    return line


@pytest.mark.parametrize("seed", range(3))
def test_as_by_hand(spark, documents, monkeypatch, seed):
    rng = random.Random(seed)
    words = ["alpha", "beta", "é", "gamma", "de", "ii"]
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(3, 30))) for _ in range(14)] + ["a" * 30, "ab" * 32, "x" * 64, "y" * 63]
    rows = []
    for i in range(60):
        lines = [edited(rng.choice(base), rng, rng.choice([0, 0, 1, 1, 2])) for _ in range(rng.randint(0, 5))]
        rows.append((i if i else None, "\n".join(lines + [""] * rng.randint(0, 2))))
    rng.shuffle(rows)
    rows.append((1000, None))
    for block in (64, 7):
        monkeypatch.setattr(line_dedup, "BLOCK", block)
        got = line_dedup.dedup_lines(documents(rows)).collect()
        assert {r["doc_id"]: r["text"] for r in got} == by_hand(rows)


def test_without_broadcasts(spark, documents, monkeypatch):
    rows = [(i, f"a line that comes again and again\nline number {i * 1000} of its own") for i in range(40)]
    want = by_hand(rows)
    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", 0)
    got = line_dedup.dedup_lines(documents(rows)).collect()
    assert {r["doc_id"]: r["text"] for r in got} == want


def test_edges_are_defined(spark, documents):
    long = "z" * 5000
    rows = [
        (1, "the very same line of text\nshort\nshort"), (1, "the very same line of text\nshort\nshort"),
        (1, "another line of text here\nthe very same line of text"), (2, None), (3, ""), (None, "the very same line of text"),
        (4, long), (5, long + "z"), (6, long[1:] + "\nand something more to keep"), (7, "\n\n"),
    ]
    docs = documents(rows).withColumn("n_lines", F.lit("x")).withColumn("pos", F.lit(1)).withColumn("row", F.lit(2))
    got = line_dedup.dedup_lines(docs)
    assert set(got.columns) == {*docs.columns, "n_dropped"}
    found = sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect()), key=repr)
    # rows that repeat id and text keep the same lines; among the texts of one id the order is that of a hash
    first = [r for r in found if r[0] == 1]
    assert first[0] == first[1] or first[1] == first[2]
    assert sum("the very same line of text" in r[1] for r in first) in (1, 2)
    rest = {r[0]: r[1:] for r in found if r[0] != 1}
    assert rest[2] == (None, 0, 0) and rest[3] == ("", 1, 0) and rest[None] == ("", 1, 1) and rest[7] == ("\n\n", 3, 0)
    assert rest[4] == (long, 1, 0) and rest[5] == ("", 1, 1) and rest[6] == ("and something more to keep", 2, 1)
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_no_python_in_the_plan(spark, documents, capsys):
    line_dedup.dedup_lines(documents(["a line that comes again and again"] * 3)).explain()
    assert "Python" not in capsys.readouterr().out


def test_short_lines_go_if_asked(spark, documents):
    rows = [(1, "Heading\n\nthe very same line of text\n \n"), (2, "Heading\n\nthe very same line of text\n \nHeadinq"), (None, "Heading")]
    got = {r["doc_id"]: (r["text"], r["n_dropped"]) for r in line_dedup.dedup_lines(documents(rows), short=True).collect()}
    # blank lines stay, and one edit counts from MIN_CHARS characters on
    assert got == {1: (rows[0][1], 0), 2: ("\n \nHeadinq", 2), None: ("", 1)}
    kept = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(documents(rows)).collect()}
    assert kept == by_hand(rows) and kept[None] == "Heading"
