"""Work is spread over tasks whose size follows the rows, not the bytes of the files."""

import time

from pyspark.sql import functions as F

from panelkit.operators.keys import dedup_first
from panelkit.plans import model
from panelkit.sources import rejects
from panelkit.sources.raw import read_people
from panelkit.sources.staging import new_folder, stage, tidy
from queryset import adapters, registry


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_of_a_stored_spine_are_sorted_behind_the_shuffle_only(spark, tmp_path):
    path = str(tmp_path / "people")
    person, month = (F.col("id") % 7).alias("distinct_id"), F.lit("202401").alias("yyyymm")
    spark.range(100).select(person, F.col("id").cast("int").alias("age"), F.lit("F").alias("gender"), month).write.parquet(path)
    kept = dedup_first(read_people(spark, path))
    above, below = plan_of(kept).split("Exchange hashpartitioning", 1)
    assert "Sort" in above and "Sort" not in below and "Exchange" not in below
    assert sorted(r["age"] for r in kept.collect()) == list(range(7))


def test_customers_are_dealt_out_before_their_months(spark, tmp_path):
    customers = [(i, "BUILDING") for i in range(1, 41)]
    spark.createDataFrame(customers, "c_custkey long, c_mktsegment string").coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    orders = [("1997-01-05",), ("1997-12-05",)]
    spark.createDataFrame(orders, "o_orderdate string").coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    sizes = adapters.people(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 4 and sum(r["count"] for r in sizes) == 480


def test_rows_of_a_spine_read_with_rejects_are_sorted_behind_the_shuffle_only(spark, tmp_path):
    path = str(tmp_path / "people")
    person, month = (F.col("id") % 7).cast("string").alias("distinct_id"), F.lit("202401").alias("yyyymm")
    spark.range(100).select(person, F.col("id").cast("int").alias("age"), F.lit("F").alias("gender"), month).write.parquet(path)
    kept = dedup_first(rejects.scan(spark, "people", path, "bigint")[0])
    above, below = plan_of(kept).split("Exchange hashpartitioning", 1)
    assert "Sort" in above and "Sort" not in below and "Exchange" not in below
    assert sorted(r["age"] for r in kept.collect()) == list(range(7))


def test_lines_are_dealt_out_by_their_number_before_they_meet_their_orders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(adapters, "LINES_OF_TASK", 50, raising=False)
    tables = {
        "orders": ([(o, o % 5, "1997-01-05") for o in range(200)], "o_orderkey long, o_custkey long, o_orderdate string"),
        "lineitem": ([(o, 1, 1, 2.0, "R") for o in range(200) for _ in range(2)], "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_returnflag string"),
        "supplier": ([(1, "s")], "s_suppkey long, s_name string"),
        "part": ([(1, "p")], "p_partkey long, p_name string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    sizes = [r["count"] for r in adapters.points(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 400 and max(sizes) < 150


def test_parts_are_told_once_and_stored(spark):
    rows = [(i, "202401", 20 + i % 7, "FM"[i % 2], i % 5, i % 3) for i in range(60)]
    panel = spark.createDataFrame(rows, "distinct_id long, yyyymm string, age int, gender string, sum_total_points long, lag_sum_total long")
    train, test, _ = model.prepare(panel)
    assert "md5" not in plan_of(train) + plan_of(test) and "split" not in train.columns
    assert {r[0] for r in train.select("distinct_id").collect()}.isdisjoint(r[0] for r in test.select("distinct_id").collect())
    assert train.count() + test.count() == 60


def test_rows_are_dealt_out_by_their_number_before_a_forest(spark):
    rows = spark.range(1000).select(F.lit(1.0).alias("same"), "id").coalesce(1)
    dealt = model.dealt_out(rows, 100)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 1000 and max(sizes) < 250
    assert dealt.columns == ["same", "id"] and dealt.select("id").distinct().count() == 1000
    assert model.dealt_out(rows, 1000).rdd.getNumPartitions() == 1


def shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for f in blocks.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f and f.endswith(".data")}


def test_written_results_leave_no_shuffle_files(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = shuffle_files(spark), spark.conf.get(key)
    groups = spark.range(1000).groupBy((F.col("id") % 9).alias("k")).count()
    kept = stage(groups, "groups")
    with tidy(spark):
        groups.write.parquet(new_folder(spark, "groups"))
    for _ in range(50):
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.1)  # they are removed beside the query
    assert shuffle_files(spark) <= before and spark.conf.get(key) == setting
    assert sorted(r["count"] for r in kept.collect()) == [111] * 8 + [112]
    assert sorted(r["count"] for r in groups.collect()) == [111] * 8 + [112]


def test_reranked_runs_build_the_panel_once(spark, monkeypatch):
    rows = [(p, int(p % 3 > 0)) for p in (0, 1, 19, 20, 49, 50, 99, 100, 150)]
    made = []

    def training(*_):
        made.append(1)
        return spark.createDataFrame(rows, "sum_total_points long, label int")

    monkeypatch.setattr(registry, "training_set", training)
    found = {r["threshold"]: r for r in registry.runs_reranked(spark, "").collect()}
    assert len(made) == 1 and len(found) == 4
    for t in registry.RULE_THRESHOLDS:
        right = sum((p >= t) == (y == 1) for p, y in rows) / len(rows)
        assert found[str(t)]["accuracy"] == round(right, 9)
    assert sum(r["best"] for r in found.values()) == 1
