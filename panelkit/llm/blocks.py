"""Pairs within buckets of any size, compared block by block."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.sources.staging import stage

# Rows of a block, and rows that a task's group holds about.
BLOCK, GROUP = 512, 4096

# Gets the columns of a group, and the places of the rows of one block and of another, or None where a block meets
# itself; gives columns of the result.
Compare = Callable[[dict[str, np.ndarray], np.ndarray, np.ndarray | None], tuple[np.ndarray, ...]]


def block_pairs(rows: DataFrame, spread: str) -> DataFrame:
    """``rows`` (with ``bucket``, a bigint) handed to pairs of blocks: ``lo``, ``hi``, ``side`` and ``group`` are added.

    Rows of a bucket are dealt out to blocks of about BLOCK rows by a hash of ``spread``, and each row is handed to
    all pairs of blocks that hold its own; ``side`` is 0 in the first block of a pair, 1 in the second, 2 if they
    are the same. A bucket of one row has no pair and drops out. ``group`` gathers whole pairs,
    about GROUP rows, so no task holds a whole bucket, however large. ``rows`` has to be a written table, as
    it is read twice; the sizes of the buckets are written, so that the join with them can be split where a
    bucket is large.
    """
    counted = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("in_bucket"))
    sizes = stage(counted.filter("in_bucket > 1").withColumn("blocks", F.ceil(F.col("in_bucket") / BLOCK)), "sizes")
    # a row of a bucket goes to as many pairs as the bucket has blocks
    total = sizes.agg(F.sum(F.col("in_bucket") * F.col("blocks"))).first()[0] or 0
    lo, hi = F.least("own", "other"), F.greatest("own", "other")
    return (
        rows.join(sizes, "bucket")
        .withColumn("own", F.pmod(F.xxhash64(spread), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
        .withColumn("side", F.when(lo == hi, 2).when(F.col("own") == lo, 0).otherwise(1).cast("tinyint"))
        .withColumns({"lo": lo, "hi": hi})
        .withColumn("group", F.pmod(F.xxhash64("bucket", "lo", "hi"), F.lit(total // GROUP + 1)))
        .drop("in_bucket", "blocks", "own", "other")
    )


def compare(pairs: DataFrame, load: Callable[[pd.DataFrame], dict[str, np.ndarray]], each: Compare, schema: str) -> DataFrame:
    """What ``each`` gives for all pairs of blocks, with the columns of ``schema``; ``load`` turns a group's rows into
    arrays once."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(group: pd.DataFrame) -> pd.DataFrame:
        data = load(group)
        keys = group[["bucket", "lo", "hi"]].to_numpy()
        side = group["side"].to_numpy()
        order = np.lexsort((side, keys[:, 2], keys[:, 1], keys[:, 0]))
        keys = keys[order]
        starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
        found = []
        for start, stop in zip(starts, np.r_[starts[1:], len(keys)], strict=True):
            rows = order[start:stop]
            if side[rows[0]] == 2:
                found.append(each(data, rows, None))
            else:
                cut = int((side[rows] == 0).sum())
                found.append(each(data, rows[:cut], rows[cut:]))
        return pd.DataFrame({n: np.concatenate([f[i] for f in found]) for i, n in enumerate(names)})

    return pairs.groupBy("group").applyInPandas(run, schema)


def forest(linked: np.ndarray, ids: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``ids`` and each of ``others`` the smallest id that it reaches by ``linked``, a matrix of ids by
    others: links enough to connect what the matrix connects."""
    top = np.iinfo(np.int64).max
    row, col = ids.copy(), others.copy()
    while True:
        new_row = np.minimum(row, np.where(linked, col[None, :], top).min(axis=1, initial=top))
        new_col = np.minimum(col, np.where(linked, new_row[:, None], top).min(axis=0, initial=top))
        if (new_row == row).all() and (new_col == col).all():
            return row, col
        row, col = new_row, new_col
