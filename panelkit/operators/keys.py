"""Primary keys: requiring, checking and enforcing them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The key of every monthly table, in the order used for grouping and joining.
KEYS = ["distinct_id", "yyyymm"]


def require_keys(df: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Rows whose keys are all known."""
    # unlike dropna, plain null checks reach the Parquet scan
    return df.filter(reduce(Column.__and__, [F.col(k).isNotNull() for k in keys]))


def key_violations(df: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Keys that break the contract: (keys..., n, reason).

    A key value with a null in it is reported as 'null key', one that occurs more
    than once as 'duplicate key'. One grouping answers both, and its counts are
    combined before the shuffle, so a key with very many copies costs no more
    than any other.
    """
    has_null = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(has_null | (F.col("n") > 1))
        .withColumn("reason", F.when(has_null, "null key").otherwise("duplicate key"))
    )


def dedup_first(df: DataFrame, keys: list[str] = KEYS, order: list | None = None) -> DataFrame:
    """One row per key: the first by ``order``, by default by all other columns.

    The order has to tell the copies apart for the survivor to be the same on every
    run; rows equal in every ordering column are interchangeable only if they are
    equal altogether, which the default guarantees. Spark keeps one row per key in
    every map task already (``WindowGroupLimit``), so copies do not pile up in the
    task that owns the key.
    """
    order = order or [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    if not order:
        return df.dropDuplicates(keys)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")
