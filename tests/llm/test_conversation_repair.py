import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from panelkit.llm import conversation_repair, queries, turn_edits

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
LEGAL = re.compile(r"(s?(ua)+)?")
SYMBOL = re.compile(r"[^\x20\x09-\x0D]")


def fault_of(row, earlier):
    marks = SYMBOL.findall(row[1])
    if not marks:
        return 1
    return 2 if row in earlier else 0 if marks[-1] in ".!?" else 3


def faults_of(rows):
    return [fault_of(r, rows[:i]) for i, r in enumerate(rows)]


def every_repair(rows, most):
    """All audits with at most ``most`` inserts at a place: (cost, audit, lines)."""
    faults = faults_of(rows)

    def inserts():
        return itertools.chain.from_iterable(itertools.product(("user", "assistant"), repeat=k) for k in range(most + 1))

    def own(row, fault):
        yield 3, "D", []
        if fault in (0, 3):
            late = fault == 3
            yield late, "K", [row]
            for role in ("user", "assistant"):
                yield 2 + late, "R", [(role, row[1])]

    slots = []
    for row, fault in zip(rows, faults, strict=True):
        slots += [[(2 * len(x), "I" * len(x), [(r, "") for r in x]) for x in inserts()], list(own(row, fault))]
    slots.append([(2 * len(x), "I" * len(x), [(r, "") for r in x]) for x in inserts()])
    for choice in itertools.product(*slots):
        lines = [x for c in choice for x in c[2]]
        if LEGAL.fullmatch("".join(r[:1] for r, _ in lines)):
            yield sum(c[0] for c in choice), "".join(c[1] for c in choice), lines


def by_strings(rows):
    """Cheapest and least audit by whole strings, state by state, from the front."""
    faults = faults_of(rows)
    best = {"": (0, "", [])}

    def put(found, roles, cost, audit, lines):
        key = "s" if roles == "s" else roles[-1:]
        if re.fullmatch(r"(s?(ua)*u?)", roles) and (key not in found or (cost, audit) < found[key][:2]):
            found[key] = cost, audit, lines

    def grown(found):
        for _ in range(3):
            for cost, audit, lines in list(found.values()):
                roles = "".join(r[:1] for r, _ in lines)
                for role in ("user", "assistant"):
                    put(found, roles + role[0], cost + 2, audit + "I", [*lines, (role, "")])
        return found

    for row, fault in zip(rows, faults, strict=True):
        # what is inserted before a row is part of the row's step, so candidates are compared with the row's letter
        behind: dict = {}
        start = list(best.values())
        for _ in range(3):
            for cost, audit, lines in start:
                roles = "".join(r[:1] for r, _ in lines)
                put(behind, roles, cost + 3, audit + "D", lines)
                if fault in (0, 3):
                    late = int(fault == 3)
                    put(behind, roles + (row[0][:1] or "?"), cost + late, audit + "K", [*lines, row])
                    for role in ("user", "assistant"):
                        put(behind, roles + role[0], cost + 2 + late, audit + "R", [*lines, (role, row[1])])
            more = []
            for cost, audit, lines in start:
                roles = "".join(r[:1] for r, _ in lines)
                for role in ("user", "assistant"):
                    if re.fullmatch(r"(s?(ua)*u?)", roles + role[0]):
                        more.append((cost + 2, audit + "I", [*lines, (role, "")]))
            start = more
        best = behind
    return min(r for k, r in grown(dict(best)).items() if k in ("", "a"))


def text_of(lines):
    return "\n".join(f"{r}:{t}" for r, t in lines)


def by_hand(rows, solve):
    """rows: (turn, role, text) in any order."""
    filled = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    filled.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    turns = [r[0] for r in filled if r[0] is not None]
    plain = [r[1:] for r in filled]
    faults = faults_of(plain)
    initials = [r[0][:1] for r in plain]
    cost, audit, lines = solve(plain)
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{n: faults.count(k) for k, n in ((1, "blank"), (2, "duplicate"), (3, "truncated"))},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
        "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256(text_of(lines).encode()).hexdigest(),
    }


ROLES, TEXTS = ["system", "user", "assistant", "tool", "", None], ["One.", "Two!", "cut off", " ", "", None, "Three?\n", "more \t"]


def some_rows(rng, n):
    roles = ROLES if rng.random() < 0.6 else ["user", "assistant"]
    texts = TEXTS if rng.random() < 0.7 else [f"T{i}." for i in range(40)]
    return [(rng.choice([None, *range(n)]), rng.choice(roles), rng.choice(texts)) for _ in range(n)]


def test_strings_are_the_cheapest_of_all_repairs():
    rng = random.Random(1)
    for _ in range(150):
        plain = [(r or " ", t or " ") for _, r, t in some_rows(rng, rng.randint(0, 3))]
        want = min(r[:2] for r in every_repair(plain, 2))
        assert by_strings(plain)[:2] == want


def test_halving_finds_the_least_audit():
    rng = random.Random(2)
    for n in [0, 1, 2, 3, 5, 8, 13, 40, 90] * 25:
        plain = [(r or " ", t or " ") for _, r, t in some_rows(rng, n)]
        kinds = [
            turn_edits.row_kind(r[0][:1], {0: turn_edits.SOUND, 3: turn_edits.CUT}.get(f, turn_edits.UNWANTED))
            for r, f in zip(plain, faults_of(plain), strict=True)
        ]
        want = by_strings(plain)
        total, vector = turn_edits.over(kinds, turn_edits.START)
        cost, end = turn_edits.best_end(total, vector)
        ways = turn_edits.crossings(kinds, turn_edits.START, end)
        audit = "".join(turn_edits.moves(k)[way][1] for k, way in zip(kinds, ways, strict=True)) + "I" * turn_edits.TAIL[end]
        assert (cost, audit) == want[:2]
        # the same over segments of any length
        cuts = sorted(rng.choices(range(n + 1), k=3))
        parts = [turn_edits.segment(kinds[a:b]) for a, b in itertools.pairwise([0, *cuts, n])]
        total, vector = 0, turn_edits.alone(turn_edits.START)
        for p in parts:
            more, vector = turn_edits.forward_segment(vector, p)
            total += more
        assert turn_edits.best_end(total, vector) == (cost, end)
        borders = turn_edits.crossings(parts, turn_edits.START, end, turn_edits.forward_segment, turn_edits.backward_segment)
        audit = ""
        for (a, b), (s, t) in zip(itertools.pairwise([0, *cuts, n]), borders, strict=True):
            audit += "".join(turn_edits.moves(k)[w][1] for k, w in zip(kinds[a:b], turn_edits.crossings(kinds[a:b], s, t), strict=True))
        assert audit + "I" * turn_edits.TAIL[end] == want[1]


NAMES = [*conversation_repair.COUNTS, "audit", "repaired_sha256"]


@pytest.mark.parametrize("bits", [12, 2])
def test_conversations_as_by_hand(spark, monkeypatch, bits):
    """Also in blocks of four rows, so that conversations cross many blocks and range partitions."""
    monkeypatch.setattr(conversation_repair, "BLOCK_BITS", bits)
    monkeypatch.setattr(conversation_repair, "PIECE", 30)
    rng = random.Random(3)
    conversations = {i: some_rows(rng, rng.randint(1, 12)) for i in range(60)} | {None: some_rows(rng, 9), 77: some_rows(rng, 150)}
    rows = [(i, *r) for i, part in conversations.items() for r in part]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"pos": F.lit("x"), "block": F.lit(1), "sha": F.lit(2), "cost": F.lit("y")})
    repair = conversation_repair.Repair(df.repartition(6))
    got = {r["conv_id"]: {c: r[c] for c in NAMES} for r in repair.report.collect()}
    assert got == {i: by_hand(part, by_strings) for i, part in conversations.items()}
    texts = {}
    for r in repair.lines.orderBy("pos").collect():
        texts.setdefault(r["conv_id"], []).append(r["data"])
    assert all(hashlib.sha256("\n".join(texts.get(i, [])).encode()).hexdigest() == got[i]["repaired_sha256"] for i in got)


def test_rows_of_any_kind(spark):
    assert conversation_repair.Repair(spark.createDataFrame([], SCHEMA)).report.count() == 0
    long = "word " * 60_000 + "end."
    rows = [(1, 0, "user", long), (1, 0, "user", long), (1, 1, "assistant", long), (2, None, None, None), (None, 5, "system", "Be nice.")]
    rows += [(3, k // 3, "user", "same.") for k in range(3000)]
    got = {r["conv_id"]: r for r in conversation_repair.Repair(spark.createDataFrame(rows, SCHEMA)).report.collect()}
    assert (got[1]["audit"], got[1]["duplicate"], got[1]["cost"]) == ("KDK", 1, 3)
    assert got[1]["repaired_sha256"] == hashlib.sha256(f"user:{long}\nassistant:{long}".encode()).hexdigest()
    assert (got[2]["audit"], got[2]["blank"], got[2]["gaps"]) == ("D", 1, 0)
    assert (got[None]["audit"], got[None]["cost"]) == ("D", 3)
    # one row of 3,000 equal ones is the first; where it lies among those of its turn does not matter to the rest
    assert (got[3]["duplicate"], got[3]["cost"]) == (2999, 2999 * 3 + 2)


def crc_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(conv, turn, "user" if k == 4 else role, text)] * {0: 0, 3: 2}.get(k, 1)
    return out


def test_query_as_by_hand(spark, tmp_path):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    extra = [(None, k, "user", "A line.") for k in range(4)] + [(900_000 + k, None if k % 2 else 0, "user", "Hi.") for k in range(80)]
    table.unionByName(spark.createDataFrame(extra, SCHEMA)).write.parquet(f"{tmp_path}/conversations.parquet")
    rows = [tuple(r) for r in spark.read.parquet(f"{tmp_path}/conversations.parquet").collect()]
    left = crc_damage(rows)
    want = {}
    for conv in {r[0] for r in rows}:
        want[conv] = by_hand([r[1:] for r in left if r[0] == conv], by_strings)
    found = queries.op13_conversation_repair(spark, str(tmp_path))
    assert found.columns == ["conv_id", *NAMES]
    assert {r["conv_id"]: {c: r[c] for c in NAMES} for r in found.collect()} == want
    assert found.count() == len(want) and any(w["audit"] == "" for w in want.values())
