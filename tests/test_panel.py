"""Rollups, keys, panel assembly, future value."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from panelkit.operators.keys import dedup_first, key_violations, require_keys
from panelkit.operators.panel import add_future_value, assemble_panel, fill_features, preview
from panelkit.operators.rollups import rollup_notifications, rollup_points, rollup_visits
from panelkit.plans.features import feature_panel, monthly_panel

POINTS = "total_points string, storename string, productname string, distinct_id bigint, yyyymmdd string"
EVENTS = "distinct_id bigint, yyyymmdd string, main_event string"
VISITS = "distinct_id bigint, yyyymmdd string, region string"
PEOPLE = "distinct_id bigint, age int, gender string, yyyymm string"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_points_rollup(spark):
    df = spark.createDataFrame(
        [
            ("10", "a", "p", 1, "20230101"),
            ("5.9", "a", "q", 1, "20230131"),
            (None, None, "q", 1, "20230131"),
            ("bad", "b", None, 1, "20230115"),
            ("7", "a", "p", 1, "20230201"),
            ("7", "a", "p", None, "20230201"),
            ("7", "a", "p", 2, "2023-02-01"),
            (None, None, None, 3, "20230301"),
        ],
        POINTS,
    )
    out = rollup_points(df)
    assert out.columns[2:] == [
        "sum_total_points", "count_consumption", "count_store_distinct", "count_product_distinct",
    ]
    assert _rows(out) == [(1, "202301", 15, 3, 2, 2), (1, "202302", 7, 1, 1, 1), (3, "202303", None, 0, 0, 0)]


def _brute_points(lines):
    groups = defaultdict(list)
    for points, store, product, person, day in lines:
        groups[(person, day[:6])].append((points, store, product))
    return sorted(
        (
            *key,
            sum(int(p) for p, _, _ in g),
            sum(s is not None for _, s, _ in g),
            len({s for _, s, _ in g if s is not None}),
            len({p for _, _, p in g if p is not None}),
        )
        for key, g in groups.items()
    )


def test_points_rollup_with_a_hot_person_month(spark):
    """A third of all lines in one person-month, at any partitioning."""
    rng = random.Random(3)
    lines = []
    for i in range(3000):
        hot = i % 3 == 0
        lines.append(
            (
                str(rng.randint(0, 9)),
                rng.choice([None, "a", "b", f"s{rng.randint(0, 400)}"]),
                rng.choice([None, "", f"p{rng.randint(0, 900)}"]),
                1 if hot else rng.randint(2, 60),
                "20230105" if hot else f"2023{rng.randint(1, 12):02}07",
            )
        )
    df = spark.createDataFrame(lines, POINTS)
    want = _brute_points(lines)
    for n in (1, 3, 11):
        assert sorted(tuple(r) for r in rollup_points(df.repartition(n)).collect()) == want


def test_points_are_combined_before_the_shuffle(spark):
    df = spark.createDataFrame([("1", "a", "p", 1, "20230101")], POINTS)
    plan = rollup_points(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert "partial_sum(points" in plan and "partial_sum(CASE" in plan


def test_notifications(spark):
    df = spark.createDataFrame(
        [
            (1, "2023-01-01", "notification"),
            (1, "2023-01-09", "notification"),
            (1, "2023-01-09", "login"),
            (1, "2023-01-09", None),
            (1, "20230109", "notification"),
            (None, "2023-01-09", "notification"),
            (2, "2023-02-30", "notification"),
        ],
        EVENTS,
    )
    assert _rows(rollup_notifications(df)) == [(1, "202301", 2)]
    assert _rows(rollup_notifications(df, "login")) == [(1, "202301", 1)]


def test_visits_are_counted_not_distinct(spark):
    df = spark.createDataFrame(
        [(1, "20230101", "ASIA"), (1, "20230102", "ASIA"), (1, "20230103", None), (2, "20230103", None)], VISITS
    )
    assert _rows(rollup_visits(df)) == [(1, "202301", 2), (2, "202301", 0)]


def test_empty_inputs(spark):
    panel = feature_panel(*[spark.createDataFrame([], s) for s in (PEOPLE, POINTS, EVENTS, VISITS)])
    assert panel.collect() == []
    assert "lag_sum_total" in panel.columns


@pytest.fixture
def tables(spark):
    return (
        spark.createDataFrame(
            [
                (1, 30, "F", "202301"),
                (1, 30, "F", "202302"),
                (1, 30, "F", "202305"),
                (2, None, None, "202301"),
                (2, None, None, "202302"),
            ],
            PEOPLE,
        ),
        spark.createDataFrame([("4", "a", "p", 1, "20230201"), ("9", "a", "p", 1, "20230501")], POINTS),
        spark.createDataFrame([(1, "2023-01-01", "notification"), (1, "2023-02-01", "notification")], EVENTS),
        spark.createDataFrame([(1, "20230101", "ASIA"), (1, "20230201", "ASIA")], VISITS),
    )


def test_months_without_points_lose_their_extras(tables):
    nested = {(r.distinct_id, r.yyyymm): r for r in monthly_panel(*tables).collect()}
    flat = {(r.distinct_id, r.yyyymm): r for r in monthly_panel(*tables, nest=False).collect()}
    assert nested[1, "202301"].count_notify is None
    assert nested[1, "202301"].count_distinct_region is None
    assert (flat[1, "202301"].count_notify, flat[1, "202301"].count_distinct_region) == (1, 1)
    assert nested[1, "202302"].count_notify == flat[1, "202302"].count_notify == 1


def test_future_value_is_the_next_existing_row(tables):
    got = {(r.distinct_id, r.yyyymm): r for r in feature_panel(*tables).collect()}
    assert set(got) == {(1, "202301"), (1, "202302"), (2, "202301")}
    assert got[1, "202301"].lag_sum_total == 4
    assert got[1, "202302"].lag_sum_total == 9  # three months later, but the next row
    assert got[2, "202301"].lag_sum_total == 0
    assert got[2, "202301"].age == 0
    assert got[2, "202301"].gender is None


def test_future_value_some_rows_ahead(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("a", 3, 30), ("b", 1, 5)], "p string, o int, v int")
    assert _rows(add_future_value(df, "v", "p", "o", steps=2, out="ahead")) == [("a", 1, 10, 30)]


def test_panel_key_is_unique_with_copies_in_the_spine(spark, tables):
    people, *rest = tables
    copies = people.unionByName(people).unionByName(people.withColumn("age", F.lit(99)))
    panel = feature_panel(copies, *rest)
    assert key_violations(panel).count() == 0
    assert panel.count() == 3
    assert {r.age for r in panel.filter("distinct_id = 1").collect()} == {30}


def test_panel_shuffles_each_table_once(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = feature_panel(*tables)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # spine, points (by store and product, then by key), events, visits, future value
    assert plan.count("Exchange") == 6
    # the dates of points, notifications and visits, each parsed at one place
    assert plan.count("concat_ws(-") == 3
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_dedup_is_deterministic_and_cut_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, "m", None), (1, "m", 3), (1, "m", 2), (2, "m", None)], "k int, t string, v int")
    for n in (1, 2, 5):
        assert _rows(dedup_first(df.repartition(n), ["k", "t"])) == [(1, "m", 2), (2, "m", None)]
    assert _rows(dedup_first(df, ["k", "t"], [F.desc_nulls_last("v")])) == [(1, "m", 3), (2, "m", None)]
    plan = dedup_first(df, ["k", "t"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning") < plan.index(", Partial")


def test_dedup_of_keys_alone(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,)], "k int")
    assert _rows(dedup_first(df, ["k"])) == [(1,), (None,)]


def test_key_violations(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None), (None, "b"), (3, "c")], "k int, t string")
    assert _rows(key_violations(df, ["k", "t"])) == [
        (1, "a", 2, "duplicate key"),
        (2, None, 2, "null key"),
        (None, "b", 1, "null key"),
    ]
    assert _rows(require_keys(df, ["k", "t"])) == [(1, "a"), (1, "a"), (3, "c")]


def test_fill_leaves_keys_and_text_alone(spark):
    df = spark.createDataFrame([(None, None, None, "x")], "distinct_id bigint, age int, n bigint, gender string")
    assert fill_features(df, ["age", "n"]).collect() == [(None, 0, 0, "x")]


def test_unknown_people_do_not_become_person_zero(spark, tables):
    people = spark.createDataFrame(
        [(0, 1, "F", "202301"), (0, 1, "F", "202302"), (None, 5, "M", "202301"), (None, 5, "M", "202302")], PEOPLE
    )
    got = feature_panel(people, *tables[1:]).collect()
    assert sorted((r.distinct_id is None, r.age) for r in got) == [(False, 1), (True, 5)]


def test_assemble_needs_no_extras(spark):
    spine = spark.createDataFrame([(1, "m"), (2, "m")], "distinct_id int, yyyymm string")
    base = spark.createDataFrame([(1, "m", 5)], "distinct_id int, yyyymm string, x int")
    assert _rows(assemble_panel(spine, base, [])) == [(1, "m", 5), (2, "m", None)]


def test_preview_is_ordered(spark):
    df = spark.createDataFrame([(i % 4, f"{9 - i}") for i in range(8)], "distinct_id int, yyyymm string")
    assert [tuple(r) for r in preview(df, n=3).collect()] == [(0, "5"), (0, "9"), (1, "4")]
