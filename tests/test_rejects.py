"""Records set aside, and categories indexed by a table."""

import pytest
from pyspark.sql import functions as F

from panelkit.operators import encode
from panelkit.plans.features import build_feature_table
from panelkit.sources import feature_table as ft
from panelkit.sources import raw, rejects


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def paths(spark, tmp_path):
    found = {n: str(tmp_path / n) for n in ("people", "points", "events", "visits", "table")}
    spark.createDataFrame(
        [("1", 30, "F", "202301"), ("1", 30, "F", "202302"), (None, 1, "M", "202301"), ("x", 1, "M", "202301"), ("2", 1, "M", None), ("2", 1, "M", "2023")],
        "distinct_id string, age int, gender string, yyyymm string",
    ).write.parquet(found["people"])
    spark.createDataFrame(
        [("5", "a", "p", "1", "20230105"), ("x", "a", "p", "1", "20230106"), ("7", "a", "p", "1.5", "20230107"), ("7", "a", "p", "1", "20230230"), ("7", "a", "p", None, None)],
        "total_points string, storename string, productname string, distinct_id string, yyyymmdd string",
    ).write.parquet(found["points"])
    (tmp_path / "events").mkdir()
    (tmp_path / "events" / "one.csv").write_text(
        "main_event,distinct_id,yyyymmdd\nnotification,1,2023-01-03\nnotification,1\nnotification,1,2023-01-04,more\nlogin,,2023-01-05\nlogin,1,05.01.2023\nnotification,1,2023-01-09\n"
    )
    spark.createDataFrame([("1", "20230101", "ASIA"), ("1", "", None)], "distinct_id string, yyyymmdd string, region string").write.parquet(found["visits"])
    return found


def test_every_scan_sets_bad_records_aside(spark, paths, tmp_path):
    out = str(tmp_path / "rejects")
    build_feature_table(spark, **paths, id_type="bigint", rejects=out)
    found = rejects.read_rejects(spark, out)
    assert found.schema.simpleString() == "struct<source:string,file:string,reason:string,record:string>"
    assert _rows(found.select("source", "reason")) == sorted([
        ("people", "no id"), ("people", "bad id"), ("people", "no date"), ("people", "bad date"),
        ("points", "bad id"), ("points", "bad date"), ("points", "no id"),
        ("events", "broken record"), ("events", "broken record"), ("events", "no id"), ("events", "bad date"), ("visits", "bad date"),
    ])
    lines = {r["record"] for r in found.filter("reason = 'broken record'").collect()}
    assert lines == {"notification,1", "notification,1,2023-01-04,more"}
    assert found.filter("source = 'events' AND file NOT LIKE '%/events/one.csv'").count() == 0
    assert '"yyyymmdd":"20230230"' in found.filter("source = 'points' AND reason = 'bad date'").first()["record"]
    # 'x' is no number of points, but the line counts: only its points are unknown
    assert _rows(ft.read_feature_table(spark, paths["table"])) == [(1, "202301", 30, "F", 5, 2, 1, 1, 2, 1, 0)]


def test_good_rows_are_those_of_the_readers(spark, paths):
    for name, read in (("points", raw.read_points), ("visits", raw.read_visits), ("people", raw.read_people)):
        good, bad = rejects.scan(spark, name, paths[name])
        every = read(spark, paths[name])
        assert good.schema == every.schema and good.count() + bad.count() == every.count()
    good, bad = rejects.scan(spark, "points", paths["points"], "bigint")
    assert dict(good.dtypes)["distinct_id"] == "bigint" and good.count() == 2 and bad.count() == 3


def test_ids_that_do_not_convert_stop_a_build_without_rejects(spark, paths):
    with pytest.raises(Exception, match="is no bigint"):
        build_feature_table(spark, **paths, id_type="bigint")


GENDERS = ["F", "M", "M", "F", "F", None, "x", "M", "F", "y"]


@pytest.mark.parametrize("hot", [0, 1, 1000])
def test_indices_are_those_of_the_indexer(spark, hot):
    train = spark.createDataFrame([(i, g) for i, g in enumerate(GENDERS)], "i int, gender string")
    df = spark.createDataFrame([(i, g) for i, g in enumerate([*GENDERS, "new", None])], "i int, gender string")
    for invalid in ("skip", "keep"):
        want = encode.index_categories(train, ["gender"], invalid).transform(df)
        got = encode.index_by_table(train, df, ["gender"], invalid, hot)
        assert _rows(got.select("i", "gender", "genderIndex")) == _rows(want.select("i", "gender", "genderIndex"))
    with pytest.raises(Exception, match="unseen value of gender: "):
        encode.index_by_table(train, df, ["gender"], "error", hot).collect()
    with pytest.raises(ValueError, match="unknown way"):
        encode.index_by_table(train, df, ["gender"], "drop")
    assert encode.index_by_table(train.limit(0), df, ["gender"], hot=hot).count() == 0
    assert {r["genderIndex"] for r in encode.index_by_table(train.limit(0), df, ["gender"], "keep", hot).collect()} == {0.0}


def test_many_values_with_a_hot_one(spark):
    rows = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id") % 9001)).alias("v"))
    got = encode.index_by_table(rows, rows, ["v"], hot=10)
    assert got.count() == 60_000 and got.select("v", "vIndex").distinct().count() == 9002
    assert got.filter("v = 'hot' AND vIndex = 0").count() == 20_000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_an_indexer_with_too_many_values_is_refused(spark, monkeypatch):
    monkeypatch.setattr(encode, "MAX_CATEGORIES", 2)
    train = spark.createDataFrame([("a",), ("b",), ("c",)], "v string")
    with pytest.raises(ValueError, match="index_by_table"):
        encode.index_categories(train, ["v"])
