"""Codes, labels, category indices, scaling and the feature vector."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import (
    StandardScaler,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.operators.ranking import running_totals
from panelkit.sources.staging import stage

# Gender codes.
GENDER_CODES = {"F": 2, "M": 1}
# Values of a column whose rows are never shuffled to be indexed; values that an indexer may hold on the driver.
HOT, MAX_CATEGORIES = 1_000, 100_000


def encode_map(
    df: DataFrame, col: str, mapping: dict, default: int = 0, out: str | None = None
) -> DataFrame:
    """Replace the values of ``col`` by their codes; all others, and null, by ``default``."""
    code = F.lit(default)
    for value, number in mapping.items():
        code = F.when(F.col(col) == value, number).otherwise(code)
    return df.withColumn(out or col, code)


def binarize(df: DataFrame, col: str, out: str = "label") -> DataFrame:
    """0 where ``col`` is 0, else 1."""
    return df.withColumn(out, F.when(F.col(col) == 0, 0).otherwise(1))


def numeric_features(df: DataFrame, exclude: list[str] = ()) -> list[str]:
    """Whole-number columns that may serve as features.

    Keys and label have to be excluded by name: a numeric key is no feature.
    """
    return [c for c, t in df.dtypes if t in ("int", "bigint") and c not in exclude]


def category_map(df: DataFrame, cols: list[str]) -> DataFrame:
    """(col, value, index) as the indexer assigns it: most frequent first, ties by text.

    Runs jobs when called: see ``running_totals``.
    """
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("value")) for c in cols])
    )
    counts = (
        df.select(pairs.alias("p"))
        .select("p.col", "p.value")
        .filter(F.col("value").isNotNull())
        .groupBy("col", "value")
        .agg(F.count(F.lit(1)).alias("n"), F.lit(1).alias("one"))
    )
    ranked = running_totals(counts, [F.col("col"), F.desc("n"), F.col("value")], ["one"])
    # one row per column of ``cols``
    starts = ranked.groupBy("col").agg(F.min("before_one").alias("start"))
    index = (F.col("before_one") - F.col("start")).cast("double")
    return ranked.join(F.broadcast(starts), "col").select("col", "value", index.alias("index"))


def index_name(col: str) -> str:
    return f"{col}Index"


def _indexer(cols: list[str], invalid: str) -> StringIndexer:
    return StringIndexer(
        inputCols=list(cols), outputCols=[index_name(c) for c in cols], handleInvalid=invalid
    )


def index_categories(train: DataFrame, cols: list[str], invalid: str = "skip") -> StringIndexerModel:
    """Indexer learnt on ``train``; with 'skip' it drops rows with unseen or null values.

    Its values come to the driver: more than MAX_CATEGORIES of a column are an error, use ``index_by_table`` for them.
    """
    some = [train.select(F.col(f"`{c}`").alias("v")).distinct().limit(MAX_CATEGORIES + 1).count() for c in cols]
    if max(some, default=0) > MAX_CATEGORIES:
        raise ValueError(f"more than {MAX_CATEGORIES} values in one of {cols}: use index_by_table")
    return _indexer(cols, invalid).fit(train)


def index_by_table(
    train: DataFrame, df: DataFrame, cols: list[str], invalid: str = "skip", hot: int = HOT
) -> DataFrame:
    """``df`` with the index of each column's value, as ``index_categories`` gives it, for any number of values.

    The index is the table of ``category_map`` on ``train``, written, and joined; no list of values comes to the driver.
    The ``hot`` most frequent values of a column are broadcast, so their rows, however many, are not shuffled; the rows
    of all others, of which each has a ``hot``-th of the rows at most, are dealt out by value. Values unseen in
    ``train`` and nulls: with 'skip' their rows are left out, with 'keep' they get the number of values as their index, with
    'error' they stop the query. The order of the rows is not kept.
    """
    if invalid not in ("skip", "keep", "error"):
        raise ValueError(f"unknown way to treat invalid values: {invalid}")
    every = stage(category_map(train, cols), "categories")
    for c in cols:
        known = every.filter(F.col("col") == c).select(F.col("value").alias("_value"), F.col("index").alias(index_name(c)))
        text = F.col(f"`{c}`").cast("string")
        near = F.broadcast(known.filter(F.col(index_name(c)) < hot))
        met = df.join(near, text == F.col("_value"), "left")
        rest = met.filter(F.col("_value").isNull()).drop("_value", index_name(c))
        far = known.filter(F.col(index_name(c)) >= hot)
        if invalid == "skip":
            found = rest.join(far, text == F.col("_value"))
        else:
            found = rest.join(far, text == F.col("_value"), "left")
            n = known.agg(F.count(F.lit(1)).cast("double")).scalar()
            unseen = F.raise_error(F.concat(F.lit(f"unseen value of {c}: "), F.coalesce(text, F.lit("null")))).cast("double")
            found = found.withColumn(index_name(c), F.coalesce(index_name(c), n if invalid == "keep" else unseen))
        df = met.filter(F.col("_value").isNotNull()).unionByName(found).drop("_value")
    return df


def valid_feature_rows(
    train: DataFrame, df: DataFrame, categorical: list[str], numeric: list[str]
) -> DataFrame:
    """Rows of ``df`` that the model can use.

    Rows with a category unseen in ``train``, a null category or a null number drop out.
    """
    known = index_categories(train, categorical).transform(df)
    vector = VectorAssembler(inputCols=numeric, outputCol="_numbers", handleInvalid="skip")
    return vector.transform(known).select(*df.columns)


def fit_scaler(train: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """{column: (mean, sample deviation)} on ``train``; one row comes to the driver."""
    stats = [s for c in cols for s in (F.avg(c).alias(f"m_{c}"), F.stddev_samp(c).alias(f"s_{c}"))]
    row = train.agg(*stats).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in cols}


def standardize(train: DataFrame, df: DataFrame, cols: list[str]) -> DataFrame:
    """(x - mean) / deviation, both learnt on ``train``; a constant column becomes 0."""
    scaled = {}
    for c, (mean, std) in fit_scaler(train, cols).items():
        if mean is None:
            scaled[c] = F.lit(None).cast("double")
        elif not std:
            scaled[c] = F.when(F.col(c).isNotNull(), F.lit(0.0))
        else:
            scaled[c] = (F.col(c).cast("double") - F.lit(mean)) / F.lit(std)
    return df.withColumns(scaled)


def feature_pipeline(categorical: list[str], numeric: list[str], label: str) -> Pipeline:
    """Index categories and label, scale the numbers, put all into ``features``.

    Fit on the training part only. Label and category indices follow the frequency of the
    values, so read them with ``category_map``.
    """
    return Pipeline(
        stages=[
            _indexer([*categorical, label], "skip"),
            VectorAssembler(inputCols=numeric, outputCol="numbers", handleInvalid="skip"),
            StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True, withStd=True),
            VectorAssembler(
                inputCols=[*map(index_name, categorical), "scaled"], outputCol="features"
            ),
        ]
    )
