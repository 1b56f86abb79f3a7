"""Codes, label, categories, scaling, split."""

import hashlib
import statistics

import pytest
from pyspark.sql import functions as F

from panelkit.operators.encode import (
    GENDER_CODES,
    binarize,
    category_map,
    encode_map,
    feature_pipeline,
    fit_scaler,
    index_categories,
    numeric_features,
    standardize,
    valid_feature_rows,
)
from panelkit.operators.split import hash_split, split_parts


def test_gender_codes(spark):
    df = spark.createDataFrame([("F",), ("M",), ("x",), ("",), (None,), ("f",)], "gender string")
    got = encode_map(df, "gender", GENDER_CODES)
    assert [r[0] for r in got.collect()] == [2, 1, 0, 0, 0, 0]
    assert got.columns == ["gender"]


def test_label(spark):
    df = spark.createDataFrame([(0,), (1,), (250,), (-3,), (None,)], "v bigint")
    assert [r.label for r in binarize(df, "v").collect()] == [0, 1, 1, 1, 1]
    assert [r.v for r in binarize(df, "v", out="v").collect()] == [0, 1, 1, 1, 1]


def test_numeric_features(spark):
    df = spark.createDataFrame(
        [], "distinct_id bigint, yyyymm string, age int, x bigint, d double, label int, flag boolean"
    )
    assert numeric_features(df, exclude=["distinct_id", "yyyymm", "label"]) == ["age", "x"]


def test_category_map_is_what_the_indexer_learns(spark):
    rows = [("b", 1)] * 3 + [("a", 0)] * 3 + [("c", 1)] * 5 + [("10", 2), ("9", 2), (None, None)]
    df = spark.createDataFrame(rows, "g string, y int")
    model = index_categories(df, ["g", "y"])
    want = {(c, v): float(i) for c, labels in zip(("g", "y"), model.labelsArray) for i, v in enumerate(labels)}
    got = {(r.col, r.value): r["index"] for r in category_map(df, ["g", "y"]).collect()}
    assert got == want
    assert got["g", "c"] == 0.0 and got["g", "a"] == 1.0 and got["g", "b"] == 2.0


def test_rows_the_model_cannot_use_are_skipped(spark):
    schema = "g string, x int, z bigint"
    train = spark.createDataFrame([("a", 1, 1), ("b", 2, 2)], schema)
    df = spark.createDataFrame([("a", 1, 1), ("b", None, 1), ("c", 1, 1), (None, 1, 1), ("b", 3, None)], schema)
    assert valid_feature_rows(train, df, ["g"], ["x"]).collect() == [("a", 1, 1), ("b", 3, None)]


def test_standardize_learns_on_train_only(spark):
    xs = [1.0, 4.0, 10.0]
    train = spark.createDataFrame([(x, 7) for x in xs], "x double, c int")
    df = spark.createDataFrame([(4.0, 7), (100.0, 9), (None, None)], "x double, c int")
    got = [tuple(r) for r in standardize(train, df, ["x", "c"]).collect()]
    mean, std = statistics.mean(xs), statistics.stdev(xs)
    assert got[0] == (pytest.approx((4 - mean) / std), 0.0)
    assert got[1] == (pytest.approx((100 - mean) / std), 0.0)  # a constant column has no scale
    assert got[2] == (None, None)


def test_scaler_of_one_row_and_of_none(spark):
    one = spark.createDataFrame([(5,)], "x int")
    assert standardize(one, one, ["x"]).collect() == [(0.0,)]
    assert fit_scaler(one.limit(0), ["x"]) == {"x": (None, None)}
    assert standardize(one.limit(0), one, ["x"]).collect() == [(None,)]


def test_pipeline_scales_like_the_column_form(spark):
    schema = "gender int, age int, x bigint, label int"
    rows = [(i % 3, 20 + i % 7, i * i % 11, int(i % 4 == 0)) for i in range(40)]
    df = spark.createDataFrame(rows, schema)
    fitted = feature_pipeline(["gender"], ["age", "x"], "label").fit(df)
    scaled = standardize(df, df, ["age", "x"]).collect()
    for row, want in zip(fitted.transform(df).collect(), scaled):
        assert row.features.toArray()[1:] == pytest.approx([want.age, want.x], abs=1e-12)
        assert row.features[0] == row.genderIndex
        assert row.labelIndex == row.label  # 0 is the more frequent label here


def test_split_is_the_hash_of_the_key(spark):
    df = spark.createDataFrame([(i, f"2023{m:02}") for i in range(50) for m in (1, 2, 3)], "distinct_id bigint, yyyymm string")

    def side(*key):
        return "train" if int(hashlib.md5("|".join(key).encode()).hexdigest()[:8], 16) % 100 < 70 else "test"

    want = {(i, f"2023{m:02}"): side(str(i), f"2023{m:02}", "42") for i in range(50) for m in (1, 2, 3)}
    for n in (1, 4, 9):
        got = hash_split(df.repartition(n))
        assert {(r.distinct_id, r.yyyymm): r.split for r in got.collect()} == want
    whole = {r.distinct_id: r.split for r in hash_split(df, by="distinct_id").collect()}
    assert whole == {i: side(str(i), "42") for i in range(50)}


def test_split_parts(spark):
    df = spark.range(1000).withColumn("yyyymm", F.lit("202301")).withColumnRenamed("id", "distinct_id")
    train, test = split_parts(hash_split(df, train_pct=70))
    assert train.columns == df.columns
    assert train.count() + test.count() == 1000
    assert 650 < train.count() < 750
    assert train.join(test, ["distinct_id"]).count() == 0
    assert hash_split(df, train_pct=100).filter("split = 'test'").count() == 0
