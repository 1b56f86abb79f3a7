"""Lenient numbers: text that is not a number gives null instead of an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_int(df: DataFrame, col: str) -> Column:
    """Column ``col`` of ``df`` as int, cut towards zero; null when it does not fit.

    '12' -> 12, '12.7' -> 12, '-12.7' -> -12, 'x' -> null, '99999999999' -> null.
    """
    c = F.col(col)
    if dict(df.dtypes)[col] != "string":
        return c.try_cast("int")
    fraction = F.when(c.rlike(r"^\s*[+-]?\d*\.\d*\s*$"), c.try_cast("double").try_cast("int"))
    return F.coalesce(c.try_cast("int"), fraction)
