"""Raw tables -> panel -> feature table."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelkit.functions import coarser
from panelkit.operators.keys import KEYS, dedup_first, require_keys
from panelkit.operators.panel import FUTURE, add_future_value, assemble_panel, fill_features
from panelkit.operators.rollups import (
    N_NOTIFY,
    N_PRODUCTS,
    N_PURCHASES,
    N_STORES,
    N_VISITS,
    SKETCHES,
    SUM_POINTS,
    roll_up,
    rollup_notifications,
    rollup_points,
    rollup_visits,
)
from panelkit.sources.feature_table import create_feature_table, read_feature_table, read_state, upsert_feature_table
from panelkit.sources.folders import drop_folder
from panelkit.sources.raw import read_app_events, read_people, read_points, read_visits
from panelkit.sources.rejects import add_rejects, scan
from panelkit.sources.staging import new_folder

ACTIVITY = [SUM_POINTS, N_PURCHASES, N_STORES, N_PRODUCTS, N_NOTIFY, N_VISITS]
FEATURES = ["age", *ACTIVITY]


def monthly_panel(
    people: DataFrame, points: DataFrame, events: DataFrame, visits: DataFrame, nest: bool = True, approx: bool = False
) -> DataFrame:
    """One row per person and month with its activity; unknown activity stays null. With ``approx`` the distinct counts
    are estimates, with their sketches beside them.

    Copies of a spine row are removed before the joins, while rows are narrow; the
    joined tables are unique on the keys, so the result is the same as after.
    """
    return assemble_panel(
        dedup_first(people),
        rollup_points(points, approx=approx),
        [rollup_notifications(events), rollup_visits(visits)],
        nest=nest,
    )


def feature_panel(
    people: DataFrame, points: DataFrame, events: DataFrame, visits: DataFrame, nest: bool = True
) -> DataFrame:
    """The monthly panel, filled, with the next row's points as the value to predict."""
    panel = monthly_panel(people, points, events, visits, nest)
    return add_future_value(fill_features(panel, FEATURES))


def coarser_panel(monthly: DataFrame, grain: str) -> DataFrame:
    """The panel of stored months by quarters or years, filled, with the next row's points as the value to predict.

    ``monthly`` are rows of ``monthly_panel`` with sketches. A person has a row for each period with any month in the spine;
    age and gender are those of its last month.
    """
    person, month = KEYS
    sums = (SUM_POINTS, N_PURCHASES, N_NOTIFY, N_VISITS)
    united = roll_up(monthly, (grain,), sums, everyone=False).drop("grain", *SKETCHES.values())
    last = F.max_by(F.struct("age", "gender"), month).alias("last")
    own = monthly.groupBy(person, coarser(month, grain).alias("period")).agg(last).select(person, "period", "last.*")
    rows = own.join(united, [person, "period"])
    return add_future_value(fill_features(rows, FEATURES), order="period")


def months_before(month: str, n: int) -> str:
    """The month key ``n`` months before another."""
    at = int(month[:4]) * 12 + int(month[4:]) - 1 - n
    return f"{at // 12:04d}{at % 12 + 1:02d}"


def _within(col: str, months: tuple[str, str], dash: str = "") -> Column:
    """Date texts of these months, by a comparison of texts, which reaches the Parquet scan."""
    low, high = (f"{m[:4]}{dash}{m[4:]}" for m in months)
    return F.col(col).between(f"{low}{dash}01", f"{high}{dash}31")


def monthly_rows(
    spark: SparkSession,
    people: str,
    points: str,
    events: str,
    visits: str,
    id_type: str | None = None,
    months: tuple[str, str] | None = None,
    rejects: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(filled monthly rows, rows of ``people`` without id or month) from the raw tables at the given paths.

    ``months``, the first and last as ``yyyyMM``, restricts every scan to these months; of people without a month none are
    left out. ``rejects``: the rejects table to which the records go that the scans cannot use, whatever their months.
    """
    if rejects is None:
        spine = read_people(spark, people, id_type)
        lines, log = read_points(spark, points, id_type), read_app_events(spark, events, id_type)
        calls = read_visits(spark, visits, id_type)
    else:
        paths = {"people": people, "points": points, "events": events, "visits": visits}
        scans = {name: scan(spark, name, path, id_type) for name, path in paths.items()}
        add_rejects(rejects, reduce(DataFrame.unionByName, [bad for _, bad in scans.values()]))
        spine, lines, log, calls = (good for good, _ in scans.values())
    if months is not None:
        month = F.col(KEYS[1])
        spine = spine.filter(month.between(*months) | month.isNull())
        lines, calls = (t.filter(_within("yyyymmdd", months)) for t in (lines, calls))
        log = log.filter(_within("yyyymmdd", months, "-"))
    bad = spine.filter(F.col(KEYS[0]).isNull() | F.col(KEYS[1]).isNull())
    return fill_features(monthly_panel(require_keys(spine), lines, log, calls), FEATURES), bad


def with_successors(known: DataFrame | None, new: DataFrame) -> DataFrame:
    """``known`` and ``new`` rows, no key twice, each with the value to predict, null in a person's last row, and
    ``_changed``: whether that may differ from what was known, because the row or the one behind it is new."""
    person, month = KEYS
    rows = new.withColumn("_new", F.lit(True))
    if known is not None:
        rows = known.withColumn("_new", F.lit(False)).unionByName(rows)
    later = Window.partitionBy(person).orderBy(month)
    return rows.withColumns(
        {
            FUTURE: F.lead(SUM_POINTS, 1).over(later),
            "_changed": F.col("_new") | F.coalesce(F.lead("_new", 1).over(later), F.lit(False)),
        }
    ).drop("_new")


def _known_rows(spark: SparkSession, table: str, new: DataFrame, months: tuple[str, str] | None) -> DataFrame:
    """The rows that an update by ``new`` has to know.

    Of months that come after all others these are the rows that wait, one for each person. An update that goes back, or
    that names no months, needs the stored rows beside them, less those that it replaces.
    """
    waiting = read_state(spark, table)
    if waiting is None and months is not None:
        raise ValueError(f"no rows wait in {table}: update it once without months")
    if waiting is not None and months is not None:
        latest = waiting.agg(F.max(KEYS[1])).first()[0]
        if latest is None or latest < months[0]:
            return waiting
    stored = read_feature_table(spark, table).drop(FUTURE)
    rows = stored if waiting is None else stored.unionByName(waiting)
    return rows.join(new.select(*KEYS), KEYS, "left_anti")


def build_feature_table(
    spark: SparkSession,
    people: str,
    points: str,
    events: str,
    visits: str,
    table: str,
    description: str = "",
    id_type: str | None = None,
    partition_by: str | None = KEYS[1],
    update: bool = False,
    months: tuple[str, str] | None = None,
    rejects: str | None = None,
) -> int:
    """Read the raw tables at the given paths and store their panel as a feature table.

    A person's last row has no value to predict yet. Such rows, one for each person, wait in the table's state
    and are published with each version. ``update`` merges into the table at ``table``, otherwise it is created.
    ``months``, the first and last as ``yyyyMM``, restricts every scan of raw data to these months: a row that waits gets its
    value when the person's next row comes, however many months lie between, and no older raw data are read for it.
    Updates with older months than those that wait correct stored rows, and read the table for it; a row that the raw
    data no longer have stays. Dates that are no dates are left out with and without ``months``.

    Rows of ``people`` without id or month are set aside in ``<table>/rejects``; gives their number. With ``rejects``,
    a path, the records of all four tables that cannot be used go there instead, with the reason (``sources.rejects``): lines
    that cannot be read, unknown ids, ids that do not convert, unknown dates. This reads the raw tables whole.
    """
    new, bad = monthly_rows(spark, people, points, events, visits, id_type, months, rejects)
    held = new_folder(spark, "panel")
    if update:
        known = _known_rows(spark, table, new, months)
        with_successors(known, new).write.parquet(held)
    else:
        with_successors(None, new).write.parquet(held)
    rows = spark.read.parquet(held)
    rejected = bad.count()
    if rejected:
        bad.write.parquet(f"{table}/rejects/{uuid.uuid4().hex}")
    ready = rows.filter(F.col(FUTURE).isNotNull() & F.col("_changed")).drop("_changed")
    waiting = rows.filter(F.col(FUTURE).isNull()).drop(FUTURE, "_changed")
    if update:
        upsert_feature_table(spark, table, ready, state=waiting)
    else:
        create_feature_table(ready, table, KEYS, description, partition_by, waiting)
    drop_folder(spark, held)
    return rejected
