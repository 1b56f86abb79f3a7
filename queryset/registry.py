"""One query per operator or small group of operators, over whole tables."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.functions import coarser, month_key, reformat_date
from panelkit.functions import period_key as key_of
from panelkit.operators import encode, evaluate, forest, keys, panel, rollups, split
from panelkit.plans import features, model, search
from panelkit.sources import feature_table, models, raw, runs
from panelkit.sources.rejects import read_rejects
from panelkit.sources.staging import new_folder, stage
from queryset import adapters

KEYS = keys.KEYS
NUMBERS = features.FEATURES
# Months stored first, and months written again, by feature_table_upsert.
CREATED_TO, UPSERTED_FROM = "199712", "199711"
# Thresholds of the rule runs, "predict 1 from this many points on".
RULE_THRESHOLDS = (1, 20, 50, 100)
RULE_SEARCH = "rule search"
# Folder of a panel written before, by the folder of its raw tables; the bench uses it to time operators without the panel.
STORED_PANELS: dict[str, str] = {}


def _raw(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    sources = (adapters.people, adapters.points, adapters.app_events, adapters.visits)
    return tuple(read(spark, sf_dir) for read in sources)


def _rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


def people_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "people")
    adapters.people(spark, sf_dir).write.parquet(path)
    return keys.dedup_first(raw.read_people(spark, path))


def period_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both date formats, with text that is no date: a 13th month, or more text behind."""
    day = F.col("o_orderdate").cast("date")
    spoilt = F.when(F.col("o_orderpriority") == "5-LOW", "13").otherwise(F.date_format(day, "MM"))
    tail = F.when(F.col("o_orderstatus") == "P", "x").otherwise("")
    texts = adapters.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(F.date_format(day, "yyyy"), spoilt, F.date_format(day, "dd"), tail).alias("compact"),
        F.concat_ws("-", F.date_format(day, "yyyy"), spoilt, F.concat(F.date_format(day, "dd"), tail)).alias("dashed"),
    )
    return texts.select(
        "o_orderkey",
        month_key("compact").alias("yyyymm"),
        month_key("dashed", "yyyy-MM-dd").alias("yyyymm_dashed"),
        *[key_of("compact", grain=g).alias(g) for g in ("week", "quarter", "year")],
        coarser(month_key("compact"), "quarter").alias("quarter_of_month"),
        reformat_date("dashed", "yyyy-MM-dd", "yyyyMMdd").alias("yyyymmdd"),
    )


def points_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.rollup_points(adapters.points(spark, sf_dir))


def _stored_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of people with sketches of their stores and products, kept as a feature table."""
    path = new_folder(spark, "sketches")
    months = rollups.rollup_points(adapters.points(spark, sf_dir), approx=True)
    feature_table.create_feature_table(months, path, KEYS, partition_by="yyyymm")
    return feature_table.read_feature_table(spark, path)


def points_by_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarters and years of each person and of all people, out of the stored months; beside the sums the exact
    distinct counts of the lines, and whether the sketches' estimates are as near to them as they have to be."""
    united = rollups.roll_up(_stored_sketches(spark, sf_dir))
    lines = adapters.points(spark, sf_dir)
    everyone = lines.withColumn("distinct_id", F.lit(0))
    exact = None
    for grain in ("quarter", "year"):
        for rows, person in ((lines, F.col("distinct_id")), (everyone, F.lit(None).cast("bigint"))):
            part = rollups.rollup_points(rows, grain=grain).select(
                person.alias("_person"),
                F.lit(grain).alias("_grain"),
                F.col("yyyymm").alias("_period"),
                F.col(rollups.N_STORES).alias("stores"),
                F.col(rollups.N_PRODUCTS).alias("products"),
            )
            exact = part if exact is None else exact.unionByName(part)
    same = F.col("distinct_id").eqNullSafe(F.col("_person")) & (F.col("grain") == F.col("_grain")) & (F.col("period") == F.col("_period"))

    def close(estimate: str, count: str) -> Column:
        return F.abs(F.col(estimate) - F.col(count)) <= F.col(count) * rollups.sketch_error()

    return united.join(exact, same, "full").select(
        "distinct_id", "grain", "period", "sum_total_points", "count_consumption",
        F.col("stores").alias("count_store_distinct"), F.col("products").alias("count_product_distinct"),
        close(rollups.N_STORES, "stores").alias("stores_close"), close(rollups.N_PRODUCTS, "products").alias("products_close"),
    )


def quarterly_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel by quarters, out of stored months with their sketches, with the next quarter's points to predict."""
    months = features.monthly_panel(
        adapters.people(spark, sf_dir), adapters.points(spark, sf_dir), adapters.app_events(spark, sf_dir),
        adapters.visits(spark, sf_dir), approx=True,
    )
    path = new_folder(spark, "months")
    feature_table.create_feature_table(months, path, KEYS, partition_by="yyyymm")
    return features.coarser_panel(feature_table.read_feature_table(spark, path), "quarter")


def notify_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.rollup_notifications(adapters.app_events(spark, sf_dir))


def visits_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.rollup_visits(adapters.visits(spark, sf_dir))


def app_events_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "events")
    adapters.app_events(spark, sf_dir).write.option("header", True).csv(path)
    return rollups.rollup_notifications(raw.read_app_events(spark, path, id_type="bigint"))


def rejected_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that the scans set aside, by table and reason, out of raw tables with faults planted by order and person."""
    folder = new_folder(spark, "faulty")
    paths = adapters.write_faulty(spark, sf_dir, folder) | {"table": f"{folder}/table"}
    features.build_feature_table(spark, **paths, id_type="bigint", rejects=f"{folder}/rejects")
    found = read_rejects(spark, f"{folder}/rejects")
    files = F.count_if(F.col("file").contains(F.concat(F.lit("/"), F.col("source"), F.lit("/"))))
    return found.groupBy("source", "reason").agg(F.count("record").alias("n"), files.alias("with_file"))


def raw_parquet_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points and visits written as raw tables and read back by their readers."""
    points_path, visits_path = new_folder(spark, "points"), new_folder(spark, "visits")
    adapters.points(spark, sf_dir).write.parquet(points_path)
    adapters.visits(spark, sf_dir).write.parquet(visits_path)
    return rollups.rollup_points(raw.read_points(spark, points_path)).join(
        rollups.rollup_visits(raw.read_visits(spark, visits_path)), KEYS, "left"
    )


def points_with_extras(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.join_extras(
        points_monthly(spark, sf_dir),
        [notify_monthly(spark, sf_dir), visits_monthly(spark, sf_dir)],
    )


def feature_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.feature_panel(*_raw(spark, sf_dir))


def _panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel that the queries below start from: built from the raw tables, or read where it was stored before."""
    stored = STORED_PANELS.get(sf_dir)
    return feature_panel(spark, sf_dir) if stored is None else spark.read.parquet(stored)


def feature_panel_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.feature_panel(*_raw(spark, sf_dir), nest=False)


def panel_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.preview(_panel(spark, sf_dir))


def key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.key_violations(adapters.people(spark, sf_dir))


def training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.training_rows(_panel(spark, sf_dir))


def split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = split.hash_split(_panel(spark, sf_dir))
    return rows.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def split_by_person(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = split.hash_split(_panel(spark, sf_dir), by="distinct_id")
    return rows.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("distinct_id").alias("people")
    )


def category_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.category_map(training_set(spark, sf_dir), ["gender", "label"])


def product_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts, by name and number, indexed by their frequency among the training orders' lines, for the lines of all others."""
    named = adapters.table(spark, sf_dir, "lineitem").join(adapters.table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    lines = named.select("l_orderkey", F.concat_ws(" ", "p_name", F.col("l_partkey").cast("string")).alias("part"))
    train, test = split.split_parts(stage(split.hash_split(lines, by="l_orderkey"), "lines"))
    rows = encode.index_by_table(train, test, ["part"], hot=100)
    return rows.groupBy("part", F.col("partIndex").alias("index")).agg(F.count(F.lit(1)).alias("n"))


def standardized(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(training_set(spark, sf_dir), "training")  # written once: read for the learning and the scaling
    train, _ = split.split_parts(split.hash_split(rows))
    return _rounded(encode.standardize(train, rows, NUMBERS).select(*KEYS, *NUMBERS), *NUMBERS)


def valid_feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trained on people of known gender: rows of the others, and rows without points, drop out."""
    months = features.monthly_panel(*_raw(spark, sf_dir))
    rows = encode.encode_map(months, "gender", encode.GENDER_CODES)
    known = rows.filter(F.col("gender") != 0)
    needed = ["age", "sum_total_points"]
    return encode.valid_feature_rows(known, rows, ["gender"], needed).select(*KEYS, "gender", *needed)


def _rule_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panel rows judged by a rule: a month with points predicts another one."""
    rows = training_set(spark, sf_dir)
    return rows.withColumn("prediction", (F.col("sum_total_points") != 0).cast("double"))


def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.confusion_matrix(_rule_scores(spark, sf_dir))


def confusion_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.confusion_cells(_rule_scores(spark, sf_dir))


def roc_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = evaluate.roc_points(_rule_scores(spark, sf_dir), "sum_total_points")
    return _rounded(points, "fpr", "tpr", digits=9)


def roc_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each point of the curve of fixed size is as near to the exact curve at its threshold as it has to be."""
    rows = stage(_rule_scores(spark, sf_dir).select("label", "sum_total_points"), "scores")
    exact = evaluate.roc_points(rows, "sum_total_points").select("threshold", F.col("fpr").alias("x"), F.col("tpr").alias("y"))
    points = stage(evaluate.roc_sketch(rows, "sum_total_points", n=50), "curve")
    both = points.join(exact, "threshold", "left")
    near = [(F.abs(F.col(a) - F.col(b)) <= evaluate.rank_error()).alias(f"{a}_close") for a, b in (("fpr", "x"), ("tpr", "y"))]
    return both.select("point", *near)


def auc_hard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluate.auc_of_classes(_rule_scores(spark, sf_dir)), "auc", digits=9)


def auc_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluate.auc(_rule_scores(spark, sf_dir), "sum_total_points"), "auc", digits=9)


def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The probability handed in is points / (points + 50)."""
    points = F.col("sum_total_points")
    rows = _rule_scores(spark, sf_dir).withColumn("p", points / (points + F.lit(50.0)))
    return _rounded(evaluate.classification_report(rows, score="p"), "value", digits=9)


def feature_table_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(_panel(spark, sf_dir), "panel")
    path = new_folder(spark, "feature-table")
    feature_table.create_feature_table(
        rows.filter(F.col("yyyymm") <= CREATED_TO), path, KEYS, "person months", partition_by="yyyymm"
    )
    later = rows.filter(F.col("yyyymm") >= UPSERTED_FROM)
    bumped = later.withColumns({c: F.col(c) + 1 for c in features.ACTIVITY})
    feature_table.upsert_feature_table(spark, path, bumped)
    return feature_table.read_feature_table(spark, path)


def feature_table_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "feature-table")
    feature_table.create_feature_table(_panel(spark, sf_dir), path, KEYS, "person months")
    return feature_table.describe_feature_table(spark, path)


def _rule_runs(spark: SparkSession, training: DataFrame, path: str | None = None) -> DataFrame:
    """Runs table holding one run per rule threshold, judged on the training rows in one pass."""
    hits = {t: F.col("sum_total_points") >= t for t in RULE_THRESHOLDS}
    y = F.col("label") == 1
    rates = [
        ((F.count_if(hit & y) / F.count_if(y) + F.count_if(~hit & ~y) / F.count_if(~y)) / 2).alias(f"auc_{t}")
        for t, hit in hits.items()
    ]
    one = training.agg(*rates)
    rows = F.array(
        *[
            F.struct(
                F.lit(f"rule-{t}").alias("run_id"),
                F.lit(f"from {t} points").alias("run_name"),
                F.lit("rules").alias("parent_run_id"),
                F.create_map(F.lit("threshold"), F.lit(str(t))).alias("params"),
                F.create_map(F.lit("auc"), f"auc_{t}", F.lit("negative_auc"), -F.col(f"auc_{t}")).alias("metrics"),
                F.lit(None).cast("map<string,string>").alias("tags"),
            )
            for t in RULE_THRESHOLDS
        ]
    )
    path = path or new_folder(spark, "runs")
    runs.append_runs(spark, path, [{"run_id": "rules", "run_name": RULE_SEARCH}])
    runs.append_runs(spark, path, one.select(F.inline(rows)))
    return runs.read_runs(spark, path)


def _run_columns(found: DataFrame) -> DataFrame:
    return found.select(
        "run_id",
        "run_name",
        F.col("params")["threshold"].alias("threshold"),
        F.round(F.col("metrics")["negative_auc"], 9).alias("negative_auc"),
    )


def runs_by_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _rule_runs(spark, training_set(spark, sf_dir))
    parent = runs.search_runs(table, F.col("run_name") == RULE_SEARCH).first()["run_id"]
    order = [F.col("metrics")["auc"].desc(), F.col("run_id")]
    return _run_columns(runs.search_runs(table, F.col("parent_run_id") == parent, order))


def best_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_columns(runs.best_run(_rule_runs(spark, training_set(spark, sf_dir)), "auc"))


def runs_reranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule runs with a metric logged after they ended, best first by that metric; the panel is built once for both."""
    rows = stage(_rule_scores(spark, sf_dir).select("sum_total_points", "label"), "scores")
    path = new_folder(spark, "runs")
    _rule_runs(spark, rows, path)
    shares = [
        F.avg(((F.col("sum_total_points") >= t) == (F.col("label") == 1)).cast("double")).alias(f"accuracy_{t}")
        for t in RULE_THRESHOLDS
    ]
    found = rows.agg(*shares).first()
    for t in RULE_THRESHOLDS:
        runs.append_runs(spark, path, [{"run_id": f"rule-{t}", "metrics": {"accuracy": found[f"accuracy_{t}"]}}])
    order = [F.col("metrics")["accuracy"].desc(), F.col("run_id")]
    ranked = runs.search_runs(runs.read_runs(spark, path), F.col("parent_run_id") == "rules", order)
    best = runs.best_run(runs.read_runs(spark, path), "accuracy").select("run_id", F.lit(True).alias("best"))
    named = _run_columns(ranked).join(ranked.select("run_id", F.round(F.col("metrics")["accuracy"], 9).alias("accuracy")), "run_id")
    return named.join(best, "run_id", "left").withColumn("best", F.coalesce("best", F.lit(False)))


def run_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A study of three searches, one for each gender code, of four rules each, and two runs that name each other."""
    rows = training_set(spark, sf_dir)
    y = F.col("label") == 1
    rates = []
    for t in RULE_THRESHOLDS:
        hit = F.col("sum_total_points") >= t
        rates.append(((F.count_if(hit & y) / F.count_if(y) + F.count_if(~hit & ~y) / F.count_if(~y)) / 2).alias(f"auc_{t}"))
    by_gender = rows.groupBy("gender").agg(*rates)
    none = F.lit(None).cast("map<string,string>")
    trials = F.array(
        *[
            F.struct(
                F.concat_ws("-", F.lit("rule"), "gender", F.lit(str(t))).alias("run_id"), F.lit("trial").alias("run_name"),
                F.concat(F.lit("gender-"), "gender").alias("parent_run_id"), none.alias("params"),
                F.create_map(F.lit("auc"), f"auc_{t}").alias("metrics"), none.alias("tags"),
            )
            for t in RULE_THRESHOLDS
        ]
    )
    path = new_folder(spark, "runs")
    runs.append_runs(spark, path, by_gender.select(F.inline(trials)))
    named = [{"run_id": "study"}, *[{"run_id": f"gender-{g}", "parent_run_id": "study"} for g in range(3)]]
    named += [{"run_id": "here", "parent_run_id": "there"}, {"run_id": "there", "parent_run_id": "here"}]
    runs.append_runs(spark, path, [*named, {"run_id": "lost", "parent_run_id": "here", "metrics": {"auc": 0.25}}])
    return _rounded(runs.run_tree(runs.read_runs(spark, path), "auc"), "best_value", digits=9)


def text_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that are no numbers, '000007' and 'C-8', through all four readers to the panel."""
    number = F.col("distinct_id").cast("string")
    name = F.when(F.col("distinct_id") % 2 == 0, F.lpad(number, 6, "0")).otherwise(F.concat(F.lit("C-"), number))
    paths = adapters.write_raw(spark, sf_dir, new_folder(spark, "raw"), name)
    return features.feature_panel(
        raw.read_people(spark, paths["people"]),
        raw.read_points(spark, paths["points"]),
        raw.read_app_events(spark, paths["events"]),
        raw.read_visits(spark, paths["visits"]),
    )


def feature_panel_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table built from all months but the last two, which come in one by one."""
    folder = new_folder(spark, "raw")
    paths = adapters.write_raw(spark, sf_dir, folder) | {"table": f"{folder}/table"}
    first, last = adapters.month_span(spark, sf_dir)
    next_to_last = features.months_before(last, 1)
    spans = [(first, features.months_before(last, 2)), (next_to_last, next_to_last), (last, last)]
    for k, months in enumerate(spans):
        features.build_feature_table(spark, **paths, id_type="bigint", update=k > 0, months=months)
    return feature_table.read_feature_table(spark, paths["table"])


def feature_panel_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table built from a spine with gaps, all months but the last twelve, which come in one by one; beside its
    rows those that wait for their value to predict."""
    folder = new_folder(spark, "raw")
    paths = adapters.write_raw(spark, sf_dir, folder, spine=adapters.people_with_gaps) | {"table": f"{folder}/table"}
    first, last = adapters.month_span(spark, sf_dir)
    ends = [features.months_before(last, k) for k in range(12, -1, -1)]
    for k, month in enumerate(ends):
        months = (first if k == 0 else month, month)
        features.build_feature_table(spark, **paths, id_type="bigint", update=k > 0, months=months)
    waiting = feature_table.read_state(spark, paths["table"])
    return feature_table.read_feature_table(spark, paths["table"]).unionByName(waiting, allowMissingColumns=True)


def classification_report_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As classification_report, with no probability for people of unknown gender."""
    points = F.col("sum_total_points")
    p = F.when(F.col("gender") != 0, points / (points + F.lit(50.0)))
    rows = _rule_scores(spark, sf_dir).withColumn("p", p)
    return _rounded(evaluate.classification_report(rows, score="p"), "value", digits=9)


def _prepared(spark: SparkSession, sf_dir: str):
    return model.prepare(_panel(spark, sf_dir))


def feature_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vectors of the test part: gender index, then the scaled numbers."""
    _, test, steps = _prepared(spark, sf_dir)
    values = vector_to_array("features")
    names = ["gender_index", *NUMBERS]
    return test.select(*KEYS, *[F.round(values[i], 6).alias(n) for i, n in enumerate(names)])


def forest_stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tree with one split on gender or on points yes / no; stored and loaded before it scores.

    It learns whether gender is 2, told wrong for every tenth age: a split whose sides agree would be pruned.
    """
    told = (F.col("gender") == 2) != (F.col("age") % 10 == 0)
    rows = training_set(spark, sf_dir).withColumns(
        {"bought": (F.col("sum_total_points") > 0).cast("int"), "label": told.cast("double")}
    )
    vectors = VectorAssembler(inputCols=["gender", "bought"], outputCol="features").transform(rows)
    train, test = split.split_parts(split.hash_split(stage(vectors, "stump")))
    fitted = model.train_forest(
        train, max_depth=1, num_trees=1, label="label", bootstrap=False, featureSubsetStrategy="all"
    )
    path = new_folder(spark, "model")
    models.save_model(fitted, path)
    return _rounded(model.score(models.load_model(path), test, label="label"), "probability_1", digits=9)


# Features of the forests that are tables.
FOREST = ["gender", *NUMBERS]


def _forest_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test, _ = _prepared(spark, sf_dir)
    path = new_folder(spark, "model")
    models.save_model(model.train_forest(train), path)
    return model.score(models.load_model(path), test)


def forest_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the test part by a forest that is a table of nodes: five levels, twenty trees."""
    train, test, _ = _prepared(spark, sf_dir)
    nodes = forest.grow_forest(train, FOREST, model.LABEL)
    return _rounded(forest.forest_score(nodes, test, FOREST, model.LABEL, 5, 20), "probability_1", digits=9)


def forest_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of that forest."""
    train, _, _ = _prepared(spark, sf_dir)
    return forest.grow_forest(train, FOREST, model.LABEL)


def forest_score_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and labels of the test part scored by a Spark ML forest that was stored and loaded again, and whether its
    predictions follow from its probabilities."""
    sane = F.col("probability_1").between(0, 1) & ((F.col("prediction") == 1) == (F.col("probability_1") > 0.5))
    return _forest_scores(spark, sf_dir).select(*KEYS, "label", sane.alias("sane"))


def _forest_search(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    train, test, steps = _prepared(spark, sf_dir)
    path = new_folder(spark, "search")
    return path, search.forest_search(train, test, FOREST, path, labels=model.label_names(steps))


def search_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trials of a search over forests that are tables, best first."""
    best = search.leaderboard(spark, *_forest_search(spark, sf_dir)).drop("run_id")
    return _rounded(best, "negative_auc", "auc", "auc_score", digits=9)


# The grid of the cross-validated search.
GRID = {"max_depth": [2, 4], "num_trees": [5, 15]}


def _grid_search(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    train, _, steps = _prepared(spark, sf_dir)
    path = new_folder(spark, "grid")
    return path, search.grid_search(train, FOREST, path, GRID, labels=model.label_names(steps))


def grid_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of a cross-validated grid: the area on each fold, mean and spread, and the area of all scores together."""
    path, parent = _grid_search(spark, sf_dir)
    points = runs.search_runs(runs.read_runs(spark, f"{path}/runs"), F.col("parent_run_id") == parent)
    names = [*[f"fold_{f}_auc_score" for f in range(3)], "mean_auc_score", "spread_auc_score", "auc_score", "mean_log_loss"]
    return points.select(
        *[F.col("params")[c].cast("int").alias(c) for c in GRID], *[F.round(F.col("metrics")[m], 9).alias(m) for m in names]
    )


def grid_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folds of that search: rows, people, scores, rows not scored just once at each point, and people who were also in
    the rows that the fold's forest learned from."""
    path, parent = _grid_search(spark, sf_dir)
    scores = spark.read.parquet(f"{path}/scores/{parent}")
    points = len(GRID["max_depth"]) * len(GRID["num_trees"])
    # the points of a row as bits: they are put together before the shuffle, as the scores of a row lie together
    met = F.bit_or(F.expr("shiftleft(1L, point)"))
    by_row = scores.groupBy(*KEYS, "fold").agg(F.count("score").alias("n"), F.bit_count(met).alias("points"))
    odd = F.count_if((F.col("n") != points) | (F.col("points") != points))
    rows = by_row.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("scores"), odd.alias("odd"))
    folds = scores.groupBy("distinct_id").agg(F.collect_set("fold").alias("folds"))
    seen = folds.select("distinct_id", (F.size("folds") > 1).alias("again"), F.explode("folds").alias("fold"))
    people = seen.groupBy("fold").agg(F.count("distinct_id").alias("people"), F.count_if("again").alias("leaked"))
    return rows.join(people, "fold", "left").select("fold", "n", "people", "scores", "odd", "leaked")


def parzen_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A search of eight trials, the last four proposed after the others: names, kinds, rows judged, and whether the
    parameters lie in the space."""
    train, test, steps = _prepared(spark, sf_dir)
    path = new_folder(spark, "parzen")
    parent = search.parzen_search(train, test, FOREST, path, n=8, labels=model.label_names(steps))
    found = runs.search_runs(runs.read_runs(spark, f"{path}/runs"), F.col("parent_run_id") == parent)
    inside = F.lit(True)
    for name, (low, high, _) in search.SPACE.items():
        inside = inside & F.col("params")[name].cast("int").between(low, high)
    return found.select("run_name", F.col("params")["kind"].alias("kind"), F.col("metrics")["n"].alias("n"), inside.alias("inside"))


def _reported_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of a search, every trial reported on the test part."""
    train, test, steps = _prepared(spark, sf_dir)
    path = new_folder(spark, "search")
    parent = search.random_search(train, test, path, labels=model.label_names(steps))
    search.report_trials(spark, path, parent, test)
    table = runs.read_runs(spark, f"{path}/runs")
    return runs.search_runs(table, F.col("parent_run_id") == parent)


def run_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything logged with the trials of that search: their reports on the test part, their areas on both."""
    path, parent = _forest_search(spark, sf_dir)
    found = runs.search_runs(runs.read_runs(spark, f"{path}/runs"), F.col("parent_run_id") == parent)
    return _rounded(found.select("run_name", F.explode("metrics").alias("metric", "value")), "value", digits=9)


def search_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is known of a search's trials before any forest is grown: names, parameters, what the label's
    indices stand for, the number of rows reported; and that the loss is the negative area."""
    metrics = F.col("metrics")
    return _reported_trials(spark, sf_dir).select(
        "run_name",
        *[F.col("params")[c].cast("int").alias(c) for c in ("max_depth", "num_trees")],
        *[F.col("tags")[c].alias(c) for c in ("label_0", "label_1")],
        metrics["test_n"].alias("n"),
        metrics["test_n_left_out"].alias("n_left_out"),
        (metrics["negative_auc"] == -metrics["auc"]).alias("mirrored"),
        (F.abs(metrics["test_auc_score"] - metrics["auc_score"]) < 1e-9).alias("same_again"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        people_spine,
        period_key,
        points_monthly,
        points_by_grain,
        quarterly_panel,
        notify_monthly,
        visits_monthly,
        app_events_csv,
        raw_parquet_rollups,
        rejected_records,
        points_with_extras,
        feature_panel,
        feature_panel_flat,
        panel_preview,
        key_violations,
        training_set,
        split_sizes,
        split_by_person,
        category_map,
        product_index,
        standardized,
        valid_feature_rows,
        confusion_matrix,
        confusion_cells,
        roc_points,
        roc_sketch,
        auc_hard,
        auc_score,
        classification_report,
        feature_table_upsert,
        feature_table_schema,
        runs_by_parent,
        best_run,
        runs_reranked,
        run_tree,
        text_ids,
        feature_panel_incremental,
        feature_panel_updates,
        classification_report_gaps,
        feature_vectors,
        forest_stump,
        forest_scores,
        forest_nodes,
        forest_score_keys,
        search_leaderboard,
        run_reports,
        grid_leaderboard,
        grid_folds,
        parzen_trials,
        search_trials,
    )
}
