"""Activity tables rolled up to one row per person and month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.functions import coarser, to_int, with_period
from panelkit.operators.keys import KEYS, require_keys

# Column names of the monthly tables and the event that counts as a notification.
SUM_POINTS = "sum_total_points"
N_PURCHASES = "count_consumption"
N_STORES = "count_store_distinct"
N_PRODUCTS = "count_product_distinct"
N_NOTIFY = "count_notify"
N_VISITS = "count_distinct_region"
NOTIFICATION = "notification"
# Columns of the sketches behind estimated distinct counts, and the logarithm of their registers.
SKETCHES = {N_STORES: "stores_sketch", N_PRODUCTS: "products_sketch"}
LG_K = 12


def _dated(rows: DataFrame, fmt: str, keys: list[str], grain: str) -> DataFrame:
    """``rows`` of known person with their period, each date parsed once.

    The month comes out of a one-element array: a condition on it, such as a later join on the key brings
    along, stays above that step. Otherwise it would be moved down and parse every date of every row again.
    """
    dated = with_period(rows, fmt=fmt, out="_month", grain=grain).withColumn(keys[-1], F.explode(F.array("_month")))
    return require_keys(dated, keys[:-1]).drop("_month")


def _per_month(rows: DataFrame, keys: list[str], *aggs: Column) -> DataFrame:
    """``rows`` aggregated per key, without the keys whose month is unknown.

    The month is tested through a count. A test on the key itself would be moved below the
    grouping, where every date of every row would be parsed once more for it.
    """
    month = keys[-1]
    grouped = rows.groupBy(*keys).agg(*aggs, F.count(month).alias("_dated"))
    return grouped.filter("_dated > 0").drop("_dated")


def rollup_points(
    points: DataFrame, keys: list[str] = KEYS, grain: str = "month", approx: bool = False, lg_k: int = LG_K
) -> DataFrame:
    """Purchases per person and month, or another period.

    Sum of points, lines with a store, distinct stores, distinct products; exact. ``keys`` are
    the person and, last, the period. Lines of unknown person or date are left out.

    With ``approx`` the distinct counts are estimates of sketches, which stand beside them (SKETCHES) and can be united
    to longer periods and more people without the lines (``roll_up``). Each line then goes through one grouping, and
    a person-month with very many lines is a sketch of ``2 ** lg_k`` registers at most in every task.

    Lines are grouped twice in one pass, by (key, store) and by (key, product); the
    second step adds the groups up per key. Against two ``count_distinct`` in one
    ``agg`` this moves two copies of each line through the shuffle, not three, and
    like it spreads a person-month with very many lines over its stores and products
    instead of sending all lines to one task.
    """
    lines = require_keys(with_period(points, out=keys[-1], grain=grain), keys[:-1]).select(
        *keys, to_int(points, "total_points").alias("points"), "storename", "productname"
    )
    if approx:
        sketched = _per_month(
            lines,
            keys,
            F.sum("points").alias(SUM_POINTS),
            F.count("storename").alias(N_PURCHASES),
            *[F.hll_sketch_agg(c, lg_k).alias(SKETCHES[n]) for n, c in ((N_STORES, "storename"), (N_PRODUCTS, "productname"))],
        )
        return sketched.withColumns({n: F.hll_sketch_estimate(s) for n, s in SKETCHES.items()})
    groups = lines.groupingSets(
        [[*keys, "storename"], [*keys, "productname"]], *keys, "storename", "productname"
    ).agg(
        F.grouping("productname").alias("by_store"),
        F.sum("points").alias("points"),
        F.count("storename").alias("lines"),
    )
    by_store = F.col("by_store") == 1
    return _per_month(
        groups,
        keys,
        F.sum(F.when(by_store, F.col("points"))).alias(SUM_POINTS),
        F.sum(F.when(by_store, F.col("lines"))).alias(N_PURCHASES),
        F.count(F.when(by_store, F.col("storename"))).alias(N_STORES),
        F.count(F.when(~by_store, F.col("productname"))).alias(N_PRODUCTS),
    )


def event_filter(df: DataFrame, col: str, value: str) -> DataFrame:
    """Rows of one kind of event; rows with an unknown event drop out."""
    return df.filter(F.col(col) == value)


def rollup_notifications(
    events: DataFrame, event: str = NOTIFICATION, keys: list[str] = KEYS, grain: str = "month"
) -> DataFrame:
    """Events of one kind per person and month, or another period, from ``yyyy-MM-dd`` dates."""
    chosen = event_filter(events, "main_event", event)
    rows = _dated(chosen, "yyyy-MM-dd", keys, grain)
    return _per_month(rows, keys, F.count("main_event").alias(N_NOTIFY))


def rollup_visits(visits: DataFrame, keys: list[str] = KEYS, grain: str = "month") -> DataFrame:
    """Visits with a known region per person and month, or another period.

    A plain count, although the established column name speaks of distinct regions.
    """
    rows = _dated(visits, "yyyyMMdd", keys, grain)
    return _per_month(rows, keys, F.count("region").alias(N_VISITS))


def sketch_error(lg_k: int = LG_K, deviations: float = 4.0) -> float:
    """Relative error that an estimate of united sketches stays within, at so many standard deviations."""
    return deviations * 1.04 / 2 ** (lg_k / 2)


def roll_up(
    monthly: DataFrame,
    grains: tuple[str, ...] = ("quarter", "year"),
    sums: tuple[str, ...] = (SUM_POINTS, N_PURCHASES),
    sketches: dict[str, str] = SKETCHES,
    keys: list[str] = KEYS,
    people: bool = True,
    everyone: bool = True,
) -> DataFrame:
    """(person, grain, period, sums..., distinct counts...) of stored months, for coarser periods.

    A row for each person and period (``people``), and for each period over all people (``everyone``, person null), by
    one grouping of the months, whose sums and sketches are combined before the shuffle; raw lines are not read. ``sums``
    add up; distinct counts do not, so they come from ``sketches``, {count: sketch}. A distinct count without its sketch
    is refused. Unknown sums count as nothing.
    """
    lost = [c for c in (N_STORES, N_PRODUCTS) if c in sums or c in sketches and sketches[c] not in monthly.columns]
    if lost:
        raise ValueError(f"distinct counts of months do not add up, keep their sketches: {lost}")
    person, month = keys
    coarse = monthly.withColumns({f"_{g}": coarser(month, g) for g in grains})
    sets = [[person, f"_{g}"] for g in grains if people] + [[f"_{g}"] for g in grains if everyone]
    grouped = coarse.groupingSets(sets, person, *[f"_{g}" for g in grains]).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums],
        *[F.hll_union_agg(s).alias(s) for s in sketches.values()],
        *[F.grouping(f"_{g}").alias(f"_no_{g}") for g in grains],
    )
    grain, period = F.lit(None).cast("string"), F.lit(None).cast("string")
    for g in grains:
        here = F.col(f"_no_{g}") == 0
        grain, period = F.when(here, g).otherwise(grain), F.when(here, F.col(f"_{g}")).otherwise(period)
    counts = [F.hll_sketch_estimate(s).alias(n) for n, s in sketches.items()]
    return grouped.select(person, grain.alias("grain"), period.alias("period"), *sums, *counts, *sketches.values())
