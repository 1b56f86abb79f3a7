"""Reproducible train/test split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.operators.keys import KEYS


def hash_split(
    df: DataFrame,
    keys: list[str] = KEYS,
    train_pct: int = 70,
    seed: int = 42,
    by: str | list[str] | None = None,
    out: str = "split",
) -> DataFrame:
    """Add ``out`` = 'train' or 'test', decided by a hash of the keys and the seed.

    Unlike ``randomSplit`` the side of a row does not depend on partitioning or on which
    task is re-run after a failure, and both sides can be read separately. ``by`` hashes
    other columns, e.g. the person alone to keep all of a person's months on one side.
    """
    cols = keys if by is None else [by] if isinstance(by, str) else by
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in cols], F.lit(str(seed))))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100
    return df.withColumn(out, F.when(bucket < train_pct, "train").otherwise("test"))


def hash_folds(
    df: DataFrame, k: int = 3, seed: int = 42, by: str | list[str] = KEYS[0], out: str = "fold"
) -> DataFrame:
    """Add ``out``, a fold from 0 to ``k`` - 1 by a hash of ``by`` and the seed: by default all rows of a person share one."""
    cols = [by] if isinstance(by, str) else by
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in cols], F.lit(str(seed)), F.lit("fold")))
    return df.withColumn(out, (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % k).cast("int"))


def split_parts(df: DataFrame, split: str = "split") -> tuple[DataFrame, DataFrame]:
    """(train, test) of a frame that went through ``hash_split``."""
    return tuple(df.filter(F.col(split) == side).drop(split) for side in ("train", "test"))
