"""Feature table -> prepared train/test parts -> forest -> scores."""

from __future__ import annotations

import math

from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.operators.encode import (
    GENDER_CODES,
    binarize,
    encode_map,
    feature_pipeline,
    index_name,
    numeric_features,
)
from panelkit.operators.keys import KEYS
from panelkit.operators.panel import FUTURE
from panelkit.operators.split import hash_split, split_parts
from panelkit.sources.staging import stage

LABEL = index_name("label")
# Rows of a task while Spark ML grows a forest.
FIT_ROWS = 250_000
# Equal rows that a forest draws one by one; rows of a lot, where there are more; lots that are dealt out together.
ALONE, LOT, PIECE = 256, 16, 4_096


def training_rows(panel: DataFrame) -> DataFrame:
    """Panel with coded gender, and the future value turned into a 0/1 ``label``."""
    return binarize(encode_map(panel, "gender", GENDER_CODES), FUTURE).drop(FUTURE)


def prepare(
    panel: DataFrame, train_pct: int = 70, seed: int = 42, by: str | None = None
) -> tuple[DataFrame, DataFrame, PipelineModel]:
    """(train, test, fitted preprocessing): features learnt on the training part only.

    The rows are written once, with their part, when this is called, as the fitting reads them several times.
    """
    train, test = split_parts(stage(hash_split(training_rows(panel), KEYS, train_pct, seed, by), "training"))
    numeric = numeric_features(train, exclude=[*KEYS, "gender", "label"])
    steps = feature_pipeline(["gender"], numeric, "label").fit(train)
    return steps.transform(train), steps.transform(test), steps


def label_names(steps: PipelineModel, label: str = "label") -> list[str]:
    """What each index of the label stands for: the indexer numbers the values by their frequency."""
    indexer = steps.stages[0]
    return list(indexer.labelsArray[indexer.getInputCols().index(label)])


def dealt_out(rows: DataFrame, most: int = FIT_ROWS, n: int | None = None) -> DataFrame:
    """``rows``, where there are more than ``most``, in tasks of about that many; ``n``: how many they count as.

    A task reads any number of rows, as Parquet keeps equal values in next to no bytes. They are dealt out by their
    number, not by their values: most rows of a panel are alike.
    """
    n = rows.count() if n is None else n
    if n <= most:
        return rows
    tasks = max(math.ceil(n / most), rows.sparkSession.sparkContext.defaultParallelism)
    return rows.withColumn("_row", F.monotonically_increasing_id()).repartition(tasks, "_row").drop("_row")


def alike(rows: DataFrame, *cols: str) -> DataFrame:
    """(features, label, n), or ``cols`` and n: rows that are the same in all that a forest sees are one."""
    return rows.groupBy(*(cols or ("features", LABEL))).agg(F.count(F.lit(1)).alias("n"))


def lots(groups: DataFrame, most: int = FIT_ROWS, weight: str | None = None) -> DataFrame:
    """Rows of ``alike`` as rows that a forest draws one by one, with ``_weight``, in tasks of about ``most``.

    Up to ALONE equal rows come one by one, more of them in ALONE lots, or more, of LOT rows at most: a tree draws equal
    rows as often as one by one on average, give or take a share of 1 / sqrt(ALONE) at most (deviation). The weights of a group add
    up to its rows, times its ``weight``. Groups are cut into pieces and dealt out before they are told out, so that a hot
    one lies in many tasks.
    """
    size = F.when(F.col("n") <= ALONE, F.col("n")).otherwise(F.greatest(F.lit(ALONE), F.ceil(F.col("n") / LOT)))
    counted = groups.withColumn("_lots", size.cast("bigint"))
    every = counted.agg(F.coalesce(F.sum("_lots"), F.lit(0))).first()[0]
    first = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_lots") - 1, F.lit(PIECE).cast("bigint")))
    dealt = dealt_out(counted.withColumn("_first", first), most, every)
    last = F.least(F.col("_first") + PIECE, F.col("_lots")) - 1
    told = dealt.withColumn("_lot", F.explode(F.sequence("_first", last)))
    rows = F.floor(F.col("n") / F.col("_lots")) + (F.col("_lot") < F.col("n") % F.col("_lots")).cast("int")
    told = told.withColumn("_weight", rows.cast("double") * (F.lit(1.0) if weight is None else F.col(weight)))
    return told.drop("n", "_lots", "_first", "_lot")


def train_forest(
    train: DataFrame,
    max_depth: int = 5,
    num_trees: int = 20,
    seed: int = 42,
    label: str = LABEL,
    times: str | None = None,
    **params,
) -> RandomForestClassificationModel:
    """Random forest on ``features``; further parameters go to the Spark ML estimator.

    Spark ML keeps every row with a number for each tree, in memory or on disk. More than FIT_ROWS rows are therefore grouped
    first: equal rows that are many are drawn in ``lots``, all rows with their weight. ``times``: the column that tells how
    many rows each row stands for, where they are grouped already.
    """
    weight = params.get("weightCol")
    used = ["features", label, *([weight] if weight else [])]
    if times is None and (rows := train.select(*used)).count() > FIT_ROWS:
        train, times = stage(alike(rows, *used), "alike"), "n"
    if times is not None:
        rows = lots(train.select(*used, F.col(times).alias("n")), weight=weight)
        params = params | {"weightCol": "_weight"}
    return RandomForestClassifier(
        featuresCol="features",
        labelCol=label,
        maxDepth=int(max_depth),
        numTrees=int(num_trees),
        seed=seed,
        **params,
    ).fit(rows)


def score(model: Model, df: DataFrame, keys: list[str] = KEYS, label: str = LABEL) -> DataFrame:
    """(keys..., label, prediction, probability_1)."""
    return model.transform(df).select(
        *keys,
        F.col(label).alias("label"),
        "prediction",
        vector_to_array("probability")[1].alias("probability_1"),
    )
