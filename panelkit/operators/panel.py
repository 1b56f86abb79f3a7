"""The person-by-month panel: rollups joined onto a spine, plus the value to predict."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.operators.keys import KEYS
from panelkit.operators.rollups import SUM_POINTS

FUTURE = "lag_sum_total"


def join_extras(base: DataFrame, extras: list[DataFrame], keys: list[str] = KEYS) -> DataFrame:
    """``base`` with each extra table left-joined on the keys."""
    return reduce(lambda left, right: left.join(right, keys, "left"), extras, base)


def assemble_panel(
    spine: DataFrame,
    base: DataFrame,
    extras: list[DataFrame],
    keys: list[str] = KEYS,
    nest: bool = True,
) -> DataFrame:
    """Spine left-joined with the monthly tables.

    With ``nest`` the extras hang on ``base`` and only the result hangs on the spine:
    months without a ``base`` row lose their extras. ``nest=False`` hangs every table on
    the spine itself.

    Every input has to be unique on the keys (rollups are; pass the spine through
    ``dedup_first``). All joins then use one key order, so each table is shuffled
    once, no key is hot, and nothing is broadcast except by Spark's own size check.
    """
    if nest:
        return spine.join(join_extras(base, extras, keys), keys, "left")
    return join_extras(spine, [base, *extras], keys)


def fill_features(df: DataFrame, cols: list[str], value: int = 0) -> DataFrame:
    """Unknown values of the named numeric columns set to ``value``.

    Keys are left alone on purpose: a filled key would merge unknown people with the
    person of that number, and rewriting a key column costs one more shuffle.
    """
    return df.na.fill(value, subset=cols)


def add_future_value(
    df: DataFrame,
    value: str = SUM_POINTS,
    part: str = KEYS[0],
    order: str = KEYS[1],
    steps: int = 1,
    out: str = FUTURE,
) -> DataFrame:
    """Add the value ``steps`` rows later and keep the rows where it is known.

    "Later" is the person's next existing row, not the next calendar month. The last
    rows of a person drop out. On a table unique on (part, order) a window holds at most
    one row per period, so no person makes a large group.
    """
    w = Window.partitionBy(part).orderBy(order)
    return df.withColumn(out, F.lead(value, steps).over(w)).filter(F.col(out).isNotNull())


def preview(df: DataFrame, keys: list[str] = KEYS, n: int = 5) -> DataFrame:
    """First ``n`` rows in key order."""
    return df.orderBy(*keys).limit(n)
