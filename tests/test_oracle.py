"""Every registered query against its SQL counterpart."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from queryset.oracle import ORACLE as SQL
from queryset.registry import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = "region nation customer supplier part orders lineitem".split()
NO_SQL: set[str] = set()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return 0.0 if v == 0 else float(f"{v:.9g}") if math.isfinite(v) else v
    return v


def _canonical(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    lines = [tuple(_value(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(lines, key=repr)


def test_every_query_has_its_check():
    assert set(SQL) | NO_SQL == set(QUERIES)
    assert not set(SQL) & NO_SQL
    assert set(QUERIES) <= set(contract.queries())
    assert set(SQL) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    got = _canonical(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(SQL[name])
    want = _canonical([d[0] for d in cur.description], cur.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
    types = [type(next((r[i] for r in got[1] if r[i] is not None), None)) for i in range(len(got[0]))]
    assert types == [type(next((r[i] for r in want[1] if r[i] is not None), None)) for i in range(len(want[0]))]
