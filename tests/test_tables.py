"""Raw readers, feature tables, runs, staging."""

import pytest
from pyspark.sql import functions as F

from panelkit.plans import features
from panelkit.plans.features import build_feature_table
from panelkit.sources import feature_table as ft
from panelkit.sources import raw, runs, staging

PANEL = "distinct_id bigint, yyyymm string, x bigint"


def _panel(spark, rows):
    return spark.createDataFrame(rows, PANEL)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("part", [None, "yyyymm"])
def test_create_and_read(spark, tmp_path, part):
    path = str(tmp_path / "t")
    rows = [(1, "202301", 5), (1, "202302", None), (2, "202301", 7)]
    ft.create_feature_table(_panel(spark, rows), path, description="d", partition_by=part)
    got = ft.read_feature_table(spark, path)
    assert got.schema.simpleString() == _panel(spark, []).schema.simpleString()
    assert _rows(got) == sorted(rows, key=repr)
    with pytest.raises(ValueError, match="exists"):
        ft.create_feature_table(_panel(spark, rows), path)


@pytest.mark.parametrize("part", [None, "yyyymm"])
def test_merge_replaces_and_adds(spark, tmp_path, part):
    path = str(tmp_path / "t")
    ft.create_feature_table(
        _panel(spark, [(1, "202301", 1), (2, "202301", 2), (1, "202302", 3)]), path, partition_by=part
    )
    new = _panel(spark, [(2, "202301", 20), (9, "202301", 90), (1, "202303", 30)])
    want = sorted([(1, "202301", 1), (2, "202301", 20), (9, "202301", 90), (1, "202302", 3), (1, "202303", 30)])
    ft.upsert_feature_table(spark, path, new)
    assert _rows(ft.read_feature_table(spark, path)) == want
    ft.upsert_feature_table(spark, path, new)
    assert _rows(ft.read_feature_table(spark, path)) == want  # twice is as good as once
    assert len(_rows(ft.read_feature_table(spark, path, version=1))) == 3


def test_merge_rewrites_only_the_months_it_touches(spark, tmp_path):
    path = str(tmp_path / "t")
    ft.create_feature_table(_panel(spark, [(1, "202301", 1), (1, "202302", 2)]), path, partition_by="yyyymm")
    ft.upsert_feature_table(spark, path, _panel(spark, [(1, "202302", 5)]))
    before, after = (dict(_rows(ft.feature_table_parts(spark, path, v))) for v in (1, 2))
    assert before["202301"] == after["202301"] and before["202302"] != after["202302"]
    assert _rows(ft.read_feature_table(spark, path)) == [(1, "202301", 1), (1, "202302", 5)]


def test_merge_takes_columns_by_name(spark, tmp_path):
    path = str(tmp_path / "t")
    ft.create_feature_table(_panel(spark, [(1, "202301", 1)]), path)
    ft.upsert_feature_table(spark, path, _panel(spark, [(2, "202301", 2)]).select("x", "yyyymm", "distinct_id"))
    assert _rows(ft.read_feature_table(spark, path)) == [(1, "202301", 1), (2, "202301", 2)]


@pytest.mark.parametrize("part", [None, "yyyymm"])
def test_overwrite(spark, tmp_path, part):
    path = str(tmp_path / "t")
    ft.create_feature_table(_panel(spark, [(1, "202301", 1), (1, "202302", 1)]), path, partition_by=part)
    ft.upsert_feature_table(spark, path, _panel(spark, [(4, "202305", 4)]), mode="overwrite")
    assert _rows(ft.read_feature_table(spark, path)) == [(4, "202305", 4)]
    bumped = ft.read_feature_table(spark, path).withColumn("x", F.col("x") + 1)
    ft.upsert_feature_table(spark, path, bumped, mode="overwrite")  # reads what it replaces
    assert _rows(ft.read_feature_table(spark, path)) == [(4, "202305", 5)]
    with pytest.raises(ValueError, match="mode"):
        ft.upsert_feature_table(spark, path, bumped, mode="append")


@pytest.mark.parametrize("part", [None, "yyyymm"])
@pytest.mark.parametrize("bad", [[(1, "202301", 1), (1, "202301", 2)], [(None, "202301", 1)], [(1, None, 1)]])
def test_broken_keys_are_not_published(spark, tmp_path, part, bad):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError, match="primary key"):
        ft.create_feature_table(_panel(spark, bad), path, partition_by=part)
    with pytest.raises(ValueError, match="no such"):
        ft.read_feature_table(spark, path)
    ft.create_feature_table(_panel(spark, [(1, "202301", 1)]), path, partition_by=part)
    with pytest.raises(ValueError, match="primary key"):
        ft.upsert_feature_table(spark, path, _panel(spark, bad))
    assert _rows(ft.read_feature_table(spark, path)) == [(1, "202301", 1)]


def test_left_over_data_of_a_dead_job_is_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    ft.create_feature_table(_panel(spark, [(1, "202301", 1)]), path, partition_by="yyyymm")
    _panel(spark, [(1, "202301", 666)]).write.partitionBy("yyyymm").parquet(f"{path}/data/write=dead")
    (tmp_path / "t" / "versions" / "version=2").mkdir()
    assert _rows(ft.read_feature_table(spark, path)) == [(1, "202301", 1)]


@pytest.mark.parametrize("part", [None, "yyyymm"])
def test_two_writers_of_one_version(spark, tmp_path, monkeypatch, part):
    path = str(tmp_path / "t")
    ft.create_feature_table(_panel(spark, [(1, "202301", 1)]), path, partition_by=part)
    publish = ft._publish

    def slow(*args):
        monkeypatch.setattr(ft, "_publish", publish)
        ft.upsert_feature_table(spark, path, _panel(spark, [(2, "202301", 2)]))  # another writer comes first
        publish(*args)

    monkeypatch.setattr(ft, "_publish", slow)
    with pytest.raises(Exception, match="already exists"):
        ft.upsert_feature_table(spark, path, _panel(spark, [(3, "202301", 3)]))
    assert _rows(ft.read_feature_table(spark, path)) == [(1, "202301", 1), (2, "202301", 2)]
    assert _rows(ft.read_feature_table(spark, path, version=1)) == [(1, "202301", 1)]


@pytest.mark.parametrize("part", [None, "yyyymm"])
def test_clean_up(spark, tmp_path, part):
    path = str(tmp_path / "t")
    ft.create_feature_table(_panel(spark, [(1, "202301", 1), (1, "202302", 1)]), path, partition_by=part)
    for i in range(3):
        ft.upsert_feature_table(spark, path, _panel(spark, [(9, "202302", i)]))
    _panel(spark, [(1, "202301", 666)]).write.parquet(f"{path}/data/write=dead")
    want = _rows(ft.read_feature_table(spark, path))
    ft.clean_feature_table(spark, path, keep=2)
    assert _rows(ft.read_feature_table(spark, path)) == want
    assert _rows(ft.read_feature_table(spark, path, version=3))[-1] == (9, "202302", 1)
    with pytest.raises(ValueError, match="no such"):
        ft.read_feature_table(spark, path, version=2)
    used = {r[1] for v in (3, 4) for r in _rows(ft.feature_table_parts(spark, path, v))}
    assert {p.name for p in (tmp_path / "t" / "data").iterdir()} == {f"write={w}" for w in used}
    ft.upsert_feature_table(spark, path, _panel(spark, [(9, "202302", 7)]))
    assert (9, "202302", 7) in _rows(ft.read_feature_table(spark, path))


def test_further_and_missing_columns_are_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    ft.create_feature_table(_panel(spark, [(1, "202301", 1)]), path)
    with pytest.raises(ValueError, match="further .'extra'."):
        ft.upsert_feature_table(spark, path, _panel(spark, [(1, "202301", 2)]).withColumn("extra", F.lit(1)))
    with pytest.raises(ValueError, match="missing .'x'."):
        ft.upsert_feature_table(spark, path, _panel(spark, [(1, "202301", 2)]).drop("x"))
    assert _rows(ft.read_feature_table(spark, path)) == [(1, "202301", 1)]


def test_partition_column_has_to_be_a_key(spark, tmp_path):
    with pytest.raises(ValueError, match="not a key"):
        ft.create_feature_table(_panel(spark, [(1, "202301", 1)]), str(tmp_path / "a"), partition_by="x")


def test_any_number_of_partitions(spark, tmp_path):
    """More partitions than any list for the driver should hold; each row has its own."""
    path, n = str(tmp_path / "t"), 10_050
    rows = spark.range(n).selectExpr("id % 7 AS distinct_id", "lpad(cast(id AS string), 6, '0') AS yyyymm", "id AS x")
    ft.create_feature_table(rows, path, partition_by="yyyymm")
    assert ft.read_feature_table(spark, path).agg(F.count("*"), F.sum("x")).first() == (n, n * (n - 1) // 2)
    ft.upsert_feature_table(spark, path, rows.filter("x < 3").withColumn("x", F.lit(-1).cast("bigint")))
    assert ft.read_feature_table(spark, path).agg(F.count("*"), F.sum("x")).first() == (n, n * (n - 1) // 2 - 6)


def test_partitions_are_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    ft.create_feature_table(_panel(spark, [(1, "202301", 1), (1, "202302", 2)]), path, partition_by="yyyymm")
    df = ft.read_feature_table(spark, path).filter("yyyymm = '202302'")
    assert len(df.inputFiles()) >= 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "yyyymm" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "DataFilters: []" in plan


def test_describe(spark, tmp_path):
    path = str(tmp_path / "t")
    ft.create_feature_table(_panel(spark, [(1, "202301", 1)]), path, description="months")
    assert _rows(ft.describe_feature_table(spark, path)) == [
        ("distinct_id", "bigint", True, 0, "months"),
        ("x", "bigint", False, 2, "months"),
        ("yyyymm", "string", True, 1, "months"),
    ]


def test_empty_table(spark, tmp_path):
    for part in (None, "yyyymm"):
        path = str(tmp_path / f"t{part}")
        ft.create_feature_table(_panel(spark, []), path, partition_by=part)
        assert ft.read_feature_table(spark, path).collect() == []
        ft.upsert_feature_table(spark, path, _panel(spark, [(1, "202301", 1)]))
        assert _rows(ft.read_feature_table(spark, path)) == [(1, "202301", 1)]


def test_readers_take_columns_by_name_and_keep_ids(spark, tmp_path):
    spark.createDataFrame(
        [(202301, "z", "F", 30, "007"), (202302, "z", None, 40, "7"), (202302, "z", None, None, "x")],
        "yyyymm int, other string, gender string, age bigint, distinct_id string",
    ).write.parquet(str(tmp_path / "people"))
    people = raw.read_people(spark, str(tmp_path / "people"))
    assert people.schema.simpleString() == "struct<distinct_id:string,age:int,gender:string,yyyymm:string>"
    assert _rows(people) == [("007", 30, "F", "202301"), ("7", 40, None, "202302"), ("x", None, None, "202302")]
    with pytest.raises(Exception, match="is no bigint: x"):
        raw.read_people(spark, str(tmp_path / "people"), id_type="bigint").collect()


def test_points_may_be_text_or_numbers(spark, tmp_path):
    for name, kind, value in (("text", "string", "12"), ("number", "bigint", 12)):
        schema = f"total_points {kind}, storename string, productname string, distinct_id bigint, yyyymmdd string"
        spark.createDataFrame([(value, "s", "p", 1, "20230101")], schema).write.parquet(str(tmp_path / name))
        assert dict(raw.read_points(spark, str(tmp_path / name)).dtypes)["total_points"] == kind


def test_csv_columns_in_any_order(spark, tmp_path):
    folder = tmp_path / "main"
    folder.mkdir()
    (folder / "a.csv").write_text("main_event,x,yyyymmdd,distinct_id\nnotification,1,2023-01-05,007\nlogin,2,,abc\n")
    got = raw.read_app_events(spark, str(folder))
    assert _rows(got) == [("007", "2023-01-05", "notification"), ("abc", None, "login")]
    # a file with another order does not slip in; read on its own it is right
    (folder / "b.csv").write_text("distinct_id,yyyymmdd,main_event,x\n8,2023-01-06,notification,3\n")
    with pytest.raises(Exception, match="CSV header"):
        raw.read_app_events(spark, str(folder)).collect()
    other = raw.read_app_events(spark, str(folder / "b.csv"))
    assert _rows(other) == [("8", "2023-01-06", "notification")]


def test_only_needed_columns_are_scanned(spark, tmp_path):
    spark.createDataFrame(
        [(1, "20230101", "ASIA", "big")], "distinct_id bigint, yyyymmdd string, region string, payload string"
    ).write.parquet(str(tmp_path / "mr"))
    plan = raw.read_visits(spark, str(tmp_path / "mr"))._jdf.queryExecution().executedPlan().toString()
    assert "payload" not in plan


def _write_raw(spark, tmp_path, months):
    """Two people with a purchase, a notification and a visit in each month, and rows that are to be set aside."""
    paths = {n: str(tmp_path / n) for n in ("people", "points", "events", "visits", "table")}
    who = [(i, m) for i in (1, 2) for m in months]
    spark.createDataFrame(
        [(i, 30, "F", m) for i, m in who] + [(1, 30, "F", months[0]), (None, 9, "F", months[0]), (3, 9, "F", None)],
        "distinct_id bigint, age int, gender string, yyyymm string",
    ).write.parquet(paths["people"])
    spark.createDataFrame(
        [(str(int(m) % 100 + i), "a", "p", i, f"{m}01") for i, m in who] + [("5", "a", "p", 1, f"{months[0]}99")],
        "total_points string, storename string, productname string, distinct_id bigint, yyyymmdd string",
    ).write.parquet(paths["points"])
    spark.createDataFrame(
        [(i, f"{m[:4]}-{m[4:]}-28", "notification") for i, m in who], "distinct_id bigint, yyyymmdd string, main_event string"
    ).write.option("header", True).csv(paths["events"])
    spark.createDataFrame(
        [(i, f"{m}15", "ASIA") for i, m in who], "distinct_id bigint, yyyymmdd string, region string"
    ).write.parquet(paths["visits"])
    return paths


def test_build_feature_table_from_files(spark, tmp_path):
    paths = _write_raw(spark, tmp_path, ["202301", "202302"])
    for update in (False, True):
        assert build_feature_table(spark, **paths, id_type="bigint", update=update) == 2
        assert _rows(ft.read_feature_table(spark, paths["table"])) == [
            (i, "202301", 30, "F", 1 + i, 1, 1, 1, 1, 1, 2 + i) for i in (1, 2)
        ]
    rejects = spark.read.parquet(f"{paths['table']}/rejects/*")
    assert rejects.count() == 4  # two of each build


def test_build_by_months(spark, tmp_path):
    months = ["202211", "202212", "202301", "202302"]
    paths = _write_raw(spark, tmp_path, months)
    build_feature_table(spark, **paths, id_type="bigint")
    whole = _rows(ft.read_feature_table(spark, paths["table"]))
    parts = paths | {"table": str(tmp_path / "parts")}
    build_feature_table(spark, **parts, id_type="bigint", months=("202211", "202212"))
    for m in ("202301", "202302"):
        before = dict(_rows(ft.feature_table_parts(spark, parts["table"])))
        build_feature_table(spark, **parts, id_type="bigint", update=True, months=(m, m))
        after = dict(_rows(ft.feature_table_parts(spark, parts["table"])))
        assert {v for v in before if after[v] == before[v]} == {v for v in before if v < features.months_before(m, 1)}
    assert _rows(ft.read_feature_table(spark, parts["table"])) == whole
    assert [features.months_before("202302", n) for n in (0, 1, 2, 14)] == ["202302", "202301", "202212", "202112"]


def test_build_by_months_with_gaps(spark, tmp_path):
    """A person's row is stored once the next one comes, however many months lie between."""
    months = ["202209", "202210", "202211", "202212", "202301"]
    paths = _write_raw(spark, tmp_path, months)
    people = spark.read.parquet(paths["people"])
    gone = {1: ["202210", "202211", "202212"], 2: ["202211"]}
    for i, absent in gone.items():
        people = people.filter(~(F.col("distinct_id").eqNullSafe(i) & F.coalesce(F.col("yyyymm").isin(absent), F.lit(False))))
    paths = paths | {"people": str(tmp_path / "gaps"), "table": str(tmp_path / "whole")}
    people.write.parquet(paths["people"])
    build_feature_table(spark, **paths, id_type="bigint")
    whole = _rows(ft.read_feature_table(spark, paths["table"]))
    assert [r[:2] for r in whole] == [(1, "202209"), (2, "202209"), (2, "202210"), (2, "202212")]
    parts = paths | {"table": str(tmp_path / "parts")}
    build_feature_table(spark, **parts, id_type="bigint", months=("202209", "202209"))
    for m in months[1:]:
        build_feature_table(spark, **parts, id_type="bigint", update=True, months=(m, m))
    assert _rows(ft.read_feature_table(spark, parts["table"])) == whole


def test_an_update_reads_new_months_only(spark, tmp_path):
    """Plans: the raw scans carry the new months. Files: the raw data of older months are not even there any more."""
    months = ["202209", "202210", "202211", "202212"]
    whole = _write_raw(spark, tmp_path, months)
    build_feature_table(spark, **whole, id_type="bigint")
    paths = {n: p for n, p in whole.items() if n != "table"}
    new, _ = features.monthly_rows(spark, **paths, id_type="bigint", months=("202212", "202212"))
    plan = new._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(filters) == 4
    assert sum("GreaterThanOrEqual(yyyymmdd,20221201)" in f for f in filters) == 2
    assert sum("GreaterThanOrEqual(yyyymmdd,2022-12-01)" in f for f in filters) == 1
    assert sum("GreaterThanOrEqual(yyyymm,202212)" in f for f in filters) == 1

    table = str(tmp_path / "parts")
    for k, m in enumerate(months):
        folder = tmp_path / f"only-{m}"
        folder.mkdir()
        only = _write_raw(spark, folder, [m])
        build_feature_table(spark, **(only | {"table": table}), id_type="bigint", update=k > 0, months=(m, m))
    assert _rows(ft.read_feature_table(spark, table)) == _rows(ft.read_feature_table(spark, whole["table"]))
    waiting = ft.read_state(spark, table)
    assert _rows(waiting.select("distinct_id", "yyyymm")) == [(1, "202212"), (2, "202212")]
    assert _rows(waiting) == _rows(ft.read_state(spark, whole["table"]))
    # the state belongs to a version
    assert _rows(ft.read_state(spark, table, version=2).select("yyyymm").distinct()) == [("202210",)]
    ft.clean_feature_table(spark, table)
    assert len(list((tmp_path / "parts" / "state").iterdir())) == 1
    assert _rows(ft.read_state(spark, table)) == _rows(waiting)


def test_an_update_may_go_back(spark, tmp_path):
    """A month that comes again corrects the stored rows and the value to predict of the rows before them."""
    paths = _write_raw(spark, tmp_path, ["202210", "202211", "202212"])
    build_feature_table(spark, **paths, id_type="bigint")
    more = spark.createDataFrame(
        [("50", "b", "q", 1, "20221103"), ("60", "b", "q", 2, "20221209")],
        "total_points string, storename string, productname string, distinct_id bigint, yyyymmdd string",
    )
    more.write.mode("append").parquet(paths["points"])
    fresh = paths | {"table": str(tmp_path / "fresh")}
    build_feature_table(spark, **fresh, id_type="bigint")
    for months in (("202211", "202211"), ("202212", "202212")):
        build_feature_table(spark, **paths, id_type="bigint", update=True, months=months)
    for read in (ft.read_feature_table, ft.read_state):
        assert _rows(read(spark, paths["table"])) == _rows(read(spark, fresh["table"]))


def test_a_table_without_state_needs_one_whole_update(spark, tmp_path):
    paths = _write_raw(spark, tmp_path, ["202210", "202211"])
    build_feature_table(spark, **(paths | {"table": str(tmp_path / "other")}), id_type="bigint")
    plain = ft.read_feature_table(spark, str(tmp_path / "other"))
    ft.create_feature_table(plain, paths["table"], partition_by="yyyymm")
    assert ft.read_state(spark, paths["table"]) is None
    with pytest.raises(ValueError, match="without months"):
        build_feature_table(spark, **paths, id_type="bigint", update=True, months=("202211", "202211"))
    build_feature_table(spark, **paths, id_type="bigint", update=True)
    assert _rows(ft.read_feature_table(spark, paths["table"])) == _rows(plain)
    assert len(_rows(ft.read_state(spark, paths["table"]))) == 2


def test_months_reach_the_scan(spark, tmp_path):
    paths = _write_raw(spark, tmp_path, ["202301", "202302"])
    rows = raw.read_points(spark, paths["points"]).filter(features._within("yyyymmdd", ("202302", "202302")))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(yyyymmdd,20230201)" in plan.split("PushedFilters")[1]
    assert rows.count() == 2


def test_runs(spark, tmp_path):
    path = str(tmp_path / "runs")
    runs.append_runs(spark, path, [{"run_id": "p", "run_name": "search"}])
    runs.append_runs(
        spark,
        path,
        [
            {"run_id": "a", "parent_run_id": "p", "params": {"d": "2"}, "metrics": {"auc": 0.6}},
            {"run_id": "b", "parent_run_id": "p", "params": {"d": "3"}, "metrics": {"auc": 0.7}},
            {"run_id": "c", "parent_run_id": "p", "params": {"d": "4"}, "metrics": {"auc": 0.7}},
            {"run_id": "d", "parent_run_id": "p", "metrics": {}},
            {"run_id": "e", "parent_run_id": "q", "metrics": {"auc": 0.9}},
        ],
    )
    table = runs.read_runs(spark, path)
    assert [r.run_id for r in runs.search_runs(table, "run_name = 'search'").collect()] == ["p"]
    children = runs.search_runs(table, "parent_run_id = 'p'", [F.col("metrics")["auc"].desc(), F.col("run_id")])
    assert [r.run_id for r in children.collect()] == ["b", "c", "a", "d"]
    best = runs.best_run(runs.search_runs(table, "parent_run_id = 'p'"), "auc").collect()
    assert [(r.run_id, r.params) for r in best] == [("b", {"d": "3"})]
    assert runs.search_runs(table).count() == 6
    # metrics logged later belong to the run; the last value of a name counts
    runs.append_runs(spark, path, [{"run_id": "a", "metrics": {"late": 1.0, "auc": 0.65}, "tags": {"t": "x"}}])
    runs.append_runs(spark, path, [{"run_id": "a", "metrics": {"late": 2.0}}])
    a = runs.read_runs(spark, path).filter("run_id = 'a'").collect()
    assert [(r.parent_run_id, r.params, r.metrics, r.tags) for r in a] == [
        ("p", {"d": "2"}, {"auc": 0.65, "late": 2.0}, {"t": "x"})
    ]
    assert runs.best_run(runs.read_runs(spark, path), "late").first().run_id == "a"


def test_staging_uses_the_shared_folder(spark, tmp_path):
    assert staging.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    df = staging.stage(spark.range(10).withColumn("x", F.rand()), "t")
    assert df.collect() == df.collect()
    assert all(staging.shared_folder(spark) in f for f in df.inputFiles())


def test_without_a_checkpoint_folder_the_warehouse_is_used():
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Session:
        conf = Conf({"spark.master": "yarn", "spark.sql.warehouse.dir": "hdfs://x/warehouse"})

    assert staging.shared_folder(Session()) == "hdfs://x/warehouse/_staging"


def test_staged_tables_can_be_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "shared_folder", lambda _: str(tmp_path))
    staging.stage(spark.range(3), "t")
    (tmp_path / "mine").mkdir()
    staging.drop_staged(spark)
    assert [p.name for p in tmp_path.iterdir()] == ["mine"]


@pytest.mark.parametrize("part", [None, "yyyymm"])
def test_merge_of_nothing(spark, tmp_path, part):
    path = str(tmp_path / "t")
    rows = [(1, "202301", 1), (1, "202302", 2)]
    ft.create_feature_table(_panel(spark, rows), path, partition_by=part)
    ft.upsert_feature_table(spark, path, _panel(spark, []))
    assert _rows(ft.read_feature_table(spark, path)) == rows
    ft.upsert_feature_table(spark, path, _panel(spark, [(2, "202302", 3)]))
    assert _rows(ft.read_feature_table(spark, path)) == [*rows, (2, "202302", 3)]


def test_merge_with_most_rows_in_one_month(spark, tmp_path):
    path = str(tmp_path / "t")
    months = F.when(F.col("id") % 3 > 0, "202301").otherwise(F.concat(F.lit("2023"), F.lpad((F.col("id") % 12 + 1).cast("string"), 2, "0")))
    rows = spark.range(3000).select(F.col("id").alias("distinct_id"), months.alias("yyyymm"), F.col("id").alias("x"))
    ft.create_feature_table(rows, path, partition_by="yyyymm")
    ft.upsert_feature_table(spark, path, rows.filter("distinct_id % 2 = 0").withColumn("x", -F.col("x")))
    got = ft.read_feature_table(spark, path)
    assert got.count() == 3000
    assert got.filter("x <> if(distinct_id % 2 = 0, -distinct_id, distinct_id)").count() == 0
