"""Periods other than months, and distinct counts that can be united."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from panelkit.functions import coarser, period_key
from panelkit.operators import rollups
from panelkit.plans import features

LINES = "total_points string, storename string, productname string, distinct_id bigint, yyyymmdd string"


def test_keys_of_all_grains(spark):
    rng = random.Random(1)
    days = [datetime.date(1999, 12, 25) + datetime.timedelta(k) for k in range(20)] + [datetime.date(1, 1, 1), datetime.date(9999, 12, 31)]
    days += [datetime.date(rng.randrange(1900, 2100), rng.randrange(1, 13), rng.randrange(1, 29)) for _ in range(60)]
    rows = [(f"{d.year:04}{d.month:02}{d.day:02}", d) for d in days if d.year > 1]
    df = spark.createDataFrame([(t, f"{t[:4]}-{t[4:6]}-{t[6:]}", f"{t[6:]} {t[4:6]} {t[:4]} 10") for t, _ in rows], "a string, b string, c string")
    for col, fmt in (("a", "yyyyMMdd"), ("b", "yyyy-MM-dd"), ("c", "dd MM yyyy HH")):
        got = df.select("a", *[period_key(col, fmt, g).alias(g) for g in ("week", "month", "quarter", "year")]).collect()
        for r, (t, d) in zip(got, rows, strict=True):
            iso = d.isocalendar()
            assert (r["week"], r["month"], r["quarter"], r["year"]) == (f"{iso[0]:04}W{iso[1]:02}", t[:6], f"{t[:4]}Q{(d.month + 2) // 3}", t[:4])
    bad = spark.createDataFrame([("20230230",), ("2023",), (None,), ("x",)], "a string")
    assert all(set(r) == {None} for r in bad.select(*[period_key("a", grain=g) for g in ("week", "quarter", "year")]).collect())
    months = spark.createDataFrame([("202301",), ("202312",), (None,)], "m string")
    found = months.select(coarser("m", "quarter"), coarser("m", "year"), coarser("m", "month")).collect()
    assert [tuple(r) for r in found] == [("2023Q1", "2023", "202301"), ("2023Q4", "2023", "202312"), (None, None, None)]
    with pytest.raises(ValueError, match="no week"):
        coarser("m", "week")
    with pytest.raises(ValueError, match="unknown grain"):
        period_key("a", grain="day")


@pytest.fixture(scope="module")
def lines(spark):
    rng = random.Random(2)
    rows = [
        (str(rng.randrange(9)), rng.choice([None, f"s{rng.randrange(5000)}"]), f"p{rng.randrange(9000)}", rng.randrange(3), f"2023{rng.randrange(1, 13):02}{rng.randrange(1, 29):02}")
        for _ in range(20_000)
    ]
    rows += [("1", None, None, 9, "20230101"), ("5", "s", "p", None, "20230101"), ("5", "s", "p", 1, "2023")]
    return rows, spark.createDataFrame(rows, LINES)


def test_sketches_are_near_the_exact_counts(lines):
    rows, df = lines
    exact = {(r["distinct_id"], r["yyyymm"]): r for r in rollups.rollup_points(df).collect()}
    got = {(r["distinct_id"], r["yyyymm"]): r for r in rollups.rollup_points(df, approx=True).collect()}
    assert got.keys() == exact.keys()
    for k, r in exact.items():
        assert (r["sum_total_points"], r["count_consumption"]) == (got[k]["sum_total_points"], got[k]["count_consumption"])
        for c in (rollups.N_STORES, rollups.N_PRODUCTS):
            assert abs(r[c] - got[k][c]) <= r[c] * rollups.sketch_error()
    assert got[9, "202301"][rollups.N_STORES] == 0


def test_months_are_united_without_the_lines(lines):
    rows, df = lines
    united = rollups.roll_up(rollups.rollup_points(df, approx=True).repartition(5)).collect()
    known = [r for r in rows if r[3] is not None and len(r[4]) == 8]
    want = {}
    for points, store, product, person, day in known:
        quarter = f"{day[:4]}Q{(int(day[4:6]) + 2) // 3}"
        for key in ((person, "quarter", quarter), (person, "year", day[:4]), (None, "quarter", quarter), (None, "year", day[:4])):
            part = want.setdefault(key, [0, 0, set(), set()])
            part[0] += int(points)
            part[1] += store is not None
            part[2] |= {store} - {None}
            part[3] |= {product} - {None}
    got = {(r["distinct_id"], r["grain"], r["period"]): r for r in united}
    assert got.keys() == want.keys() and len(united) == len(got)
    for k, (points, n, stores, products) in want.items():
        assert (got[k]["sum_total_points"], got[k]["count_consumption"]) == (points, n)
        assert abs(got[k][rollups.N_STORES] - len(stores)) <= len(stores) * rollups.sketch_error()
        assert abs(got[k][rollups.N_PRODUCTS] - len(products)) <= len(products) * rollups.sketch_error()


def test_plain_distinct_counts_are_refused(lines):
    _, df = lines
    with pytest.raises(ValueError, match="do not add up"):
        rollups.roll_up(rollups.rollup_points(df))
    with pytest.raises(ValueError, match="do not add up"):
        rollups.roll_up(rollups.rollup_points(df, approx=True), sums=(rollups.N_STORES,))
    plain = rollups.roll_up(rollups.rollup_points(df), sketches={}, everyone=False)
    assert rollups.N_STORES not in plain.columns and plain.filter("distinct_id IS NULL").count() == 0
    assert rollups.roll_up(rollups.rollup_points(df.limit(0), approx=True)).count() == 0


def test_a_panel_by_years(spark):
    people = [(1, 30 + (m > "202306"), "F", m) for m in ("202301", "202307", "202403", "202501")] + [(2, 50, None, "202312")]
    spine = spark.createDataFrame(people, "distinct_id bigint, age int, gender string, yyyymm string")
    lines = spark.createDataFrame([("5", "a", "p", 1, "20230115"), ("7", "a", "q", 1, "20230702"), ("9", "b", "q", 1, "20240301")], LINES)
    events = spark.createDataFrame([(1, "2023-07-05", "notification")], "distinct_id bigint, yyyymmdd string, main_event string")
    visits = spark.createDataFrame([(1, "20240305", "ASIA")], "distinct_id bigint, yyyymmdd string, region string")
    months = features.monthly_panel(spine, lines, events, visits, approx=True)
    got = features.coarser_panel(months, "year").orderBy("period").collect()
    names = ["distinct_id", "period", "age", "sum_total_points", "count_consumption", "count_store_distinct", "count_product_distinct", "count_notify", "count_distinct_region", "lag_sum_total"]
    assert [tuple(r[c] for c in names) for r in got] == [(1, "2023", 31, 12, 2, 1, 2, 1, 0, 9), (1, "2024", 31, 9, 1, 1, 1, 0, 1, 0)]
    assert F.col and {r["gender"] for r in got} == {"F"}


def test_rollups_by_week(lines):
    rows, df = lines
    weekly = rollups.rollup_points(df, grain="week")
    assert weekly.agg(F.sum("sum_total_points")).first()[0] == rollups.rollup_points(df).agg(F.sum("sum_total_points")).first()[0]
    assert weekly.filter(~F.col("yyyymm").rlike(r"^\d{4}W\d\d$")).count() == 0
