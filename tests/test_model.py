"""Forest, scores, stored models, search."""

import pytest
from pyspark.sql import functions as F

from panelkit.operators.encode import index_name
from panelkit.plans import model, search
from panelkit.sources.feature_table import create_feature_table
from panelkit.sources.models import load_model, publish_model, published_model, save_model
from panelkit.sources.runs import append_runs, read_runs
from panelkit.sources.staging import stage

PANEL = (
    "distinct_id bigint, yyyymm string, age int, gender string, sum_total_points bigint, "
    "count_notify bigint, lag_sum_total bigint"
)


@pytest.fixture(scope="module")
def panel(spark):
    rows = [
        (i, f"2023{m:02}", 20 + i % 40, ["F", "M", None][i % 3], (i * 7 + m) % 30, i % 4, 0 if (i * 7 + m) % 30 < 18 else 5)
        for i in range(60)
        for m in range(1, 6)
    ]
    return stage(spark.createDataFrame(rows, PANEL).coalesce(2), "panel")


@pytest.fixture(scope="module")
def parts(panel):
    train, test, _ = model.prepare(panel)
    return stage(train, "train"), stage(test, "test")


def _scores(df):
    return sorted(tuple(r) for r in df.collect())


def test_prepare(panel, parts):
    train, test = parts
    assert train.count() + test.count() == panel.count()
    row = train.first()
    assert len(row.features) == 4  # gender, age, points, notifications
    assert "lag_sum_total" not in train.columns


def test_forest_learns_and_is_reproducible(parts):
    train, test = parts
    first = _scores(model.score(model.train_forest(train), test))
    assert first == _scores(model.score(model.train_forest(train), test))
    hits = sum(label == pred for _, _, label, pred, _ in first)
    assert hits / len(first) > 0.9
    assert all(0 <= p <= 1 and pred == float(p > 0.5) for *_, pred, p in first if p != 0.5)


def test_stored_model_scores_the_same(parts, tmp_path):
    train, test = parts
    fitted = model.train_forest(train, max_depth=3, num_trees=5)
    save_model(fitted, str(tmp_path / "m"))
    assert _scores(model.score(load_model(str(tmp_path / "m")), test)) == _scores(model.score(fitted, test))


def test_whole_numbers_may_come_as_floats(parts):
    fitted = model.train_forest(parts[0], max_depth=2.0, num_trees=3.0)
    assert fitted.getNumTrees == 3
    assert fitted.getMaxDepth() == 2


def test_draws_stay_in_the_space():
    drawn = search.draw(search.SPACE, 500, 1)
    assert drawn == search.draw(search.SPACE, 500, 1)
    assert {d["max_depth"] for d in drawn} == {2, 3, 4, 5}
    assert min(d["num_trees"] for d in drawn) >= 10
    assert max(d["num_trees"] for d in drawn) <= 100
    ends = sum(d["max_depth"] in (2, 5) for d in drawn)
    assert 110 < ends < 230  # a third, as both ends have half weight


def test_search_and_best_model(spark, panel, tmp_path):
    table, path, target = (str(tmp_path / n) for n in ("table", "search", "best"))
    create_feature_table(panel, table)
    parent = search.select_model(spark, table, path, target, space={"max_depth": (2, 5, 1), "num_trees": (2, 6, 1)}, n=3)
    runs = read_runs(spark, f"{path}/runs")
    assert runs.filter(f"run_id = '{parent}' and run_name = 'tunning'").count() == 1
    board = search.leaderboard(spark, path, parent).collect()
    assert len(board) == 3
    assert [r.auc for r in board] == sorted((r.auc for r in board), reverse=True)
    assert all(r.negative_auc == -r.auc for r in board)

    features, made_by = published_model(spark, f"{target}/features")
    forest, best = published_model(spark, f"{target}/forest")
    assert made_by == parent and best == board[0].run_id
    rows = features.transform(model.training_rows(panel))
    assert model.score(forest, rows).count() == panel.count()
    _, test, _ = model.prepare(panel)
    report = {r.metric: r.value for r in search.report_run(spark, path, board[0].run_id, test).collect()}
    assert report["auc"] == pytest.approx(board[0].auc, abs=1e-12)
    assert report["auc_score"] == pytest.approx(board[0].auc_score, abs=1e-12)

    # reports are logged with the runs, with what the label's indices stand for, and any of them may choose
    kept = {r.run_id: r for r in runs.collect()}
    trials = [kept[f"{parent}-{i}"] for i in range(3)]
    assert all({r.tags["label_0"], r.tags["label_1"]} == {"0", "1"} for r in trials)
    assert all(r.metrics["test_auc"] == pytest.approx(r.metrics["auc"], abs=1e-12) for r in trials)
    assert all(0 <= r.metrics["train_auc"] <= 1 for r in trials)
    append_runs(spark, f"{path}/runs", [{"run_id": trials[2].run_id, "metrics": {"test_accuracy": -1.0}}])
    chosen = search.keep_best(spark, path, parent, f"{target}/forest", "test_accuracy", largest=False)
    assert chosen == trials[2].run_id == published_model(spark, f"{target}/forest")[1]
    assert published_model(spark, f"{target}/forest", version=1)[1] == best


def test_published_models_keep_their_versions(spark, parts, tmp_path):
    path = str(tmp_path / "m")
    with pytest.raises(ValueError, match="no such model"):
        published_model(spark, path)
    fitted = model.train_forest(parts[0], max_depth=2, num_trees=2)
    assert [publish_model(spark, fitted, path, r) for r in ("a", "b")] == [1, 2]
    (tmp_path / "m" / "versions" / "version=3").mkdir()  # a writer that died
    assert [published_model(spark, path, v)[1] for v in (1, 2, None)] == ["a", "b", "b"]


def test_label_index_name():
    assert model.LABEL == index_name("label") == "labelIndex"


def test_trials_are_judged_on_each_different_row_once(spark, parts):
    train, test = parts
    rows = test.unionByName(test)
    once = search.alike(rows)
    assert once.groupBy().sum("n").first()[0] == rows.count() and once.count() <= test.count()
    fitted, metrics = search.evaluate_params(train, rows, {"max_depth": 2, "num_trees": 3})
    for prefix, part in (("", rows), ("train_", train)):
        report = search.classification_report(model.score(fitted, part, keys=[]), score="probability_1")
        lines = {r.metric: r.value for r in report.collect()}
        assert {m: metrics[prefix + m] for m in ("auc", "auc_score")} == pytest.approx({m: lines[m] for m in ("auc", "auc_score")})


def test_many_equal_rows_are_drawn_in_lots_that_add_up(spark):
    sizes = {0: 1, 1: 256, 2: 300, 3: 10_000, 4: 1_000_003}
    groups = spark.createDataFrame([(k, 1.0, n) for k, n in sizes.items()], "features int, labelIndex double, n long").coalesce(1)
    told = model.lots(groups, 1_000)
    found = {r.features: r for r in told.groupBy("features").agg(F.sum("_weight").alias("n"), F.count("*").alias("lots"), F.max("_weight").alias("most")).collect()}
    assert {k: r.n for k, r in found.items()} == sizes
    assert {k: r.lots for k, r in found.items()} == {0: 1, 1: 256, 2: 256, 3: 625, 4: 62_501}
    assert all(r.most <= 16 for r in found.values()) and {found[0].most, found[1].most} == {1.0}
    hot = told.filter("features = 4").groupBy(F.spark_partition_id()).count().count()
    assert hot > 1 and told.columns == ["features", "labelIndex", "_weight"]


def test_a_forest_of_grouped_rows_is_that_of_all_rows(parts, monkeypatch):
    train, test = parts
    many = train
    for _ in range(3):
        many = many.unionByName(many)
    whole = {"max_depth": 3, "num_trees": 1, "bootstrap": False, "featureSubsetStrategy": "all"}
    plain, drawn = model.train_forest(many, **whole), model.train_forest(many)
    weighted = model.train_forest(many.withColumn("w", F.lit(2.0)), weightCol="w", **whole)
    monkeypatch.setattr(model, "FIT_ROWS", 50)
    monkeypatch.setattr(model, "ALONE", 4)
    grouped = model.train_forest(many, **whole)
    assert grouped.getOrDefault("weightCol") == "_weight"
    assert grouped.toDebugString.split("\n", 1)[1] == plain.toDebugString.split("\n", 1)[1]
    assert _scores(model.score(grouped, test)) == _scores(model.score(plain, test))
    again = model.train_forest(many.withColumn("w", F.lit(2.0)), weightCol="w", **whole)
    assert _scores(model.score(again, test)) == _scores(model.score(weighted, test))
    sure = [[r.prediction for r in model.score(m, test).orderBy("distinct_id", "yyyymm").collect()] for m in (drawn, model.train_forest(many))]
    assert sum(a == b for a, b in zip(*sure, strict=True)) / len(sure[0]) > 0.9


def test_a_search_over_many_rows_keeps_their_different_ones_only(spark, parts, tmp_path, monkeypatch):
    train, test = parts
    for place in (model, search):
        monkeypatch.setattr(place, "FIT_ROWS", 50)
    staged = []
    monkeypatch.setattr(search, "stage", lambda df, name: staged.append(name) or stage(df, name))
    path = str(tmp_path / "search")
    parent = search.random_search(train, test, path, space={"max_depth": (2, 3, 1), "num_trees": (2, 4, 1)}, n=2)
    assert staged == ["alike", "alike"]
    assert all(r.auc > 0.8 and r.negative_auc == -r.auc for r in search.leaderboard(spark, path, parent).collect())
