"""Scans of the four raw tables.

Each reader picks its columns by name, so only they are read from Parquet. The person id keeps the type
it is stored with (text in CSV files): '007' and '7' are two people. Give ``id_type`` only where the tables
store one id in different types; an id that does not convert then stops the read, it never becomes null.
Other columns are brought to the types the rollups expect; values that do not convert become null there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.operators.keys import KEYS

ID = "distinct_id"
# Columns of each raw table and the types that they are brought to (None: as stored), and the form of its dates; the
# spine has months.
SCANS: dict[str, tuple[dict[str, str | None], str | None]] = {
    "people": ({ID: None, "age": "int", "gender": "string", "yyyymm": "string"}, None),
    "points": (
        {"total_points": None, "storename": "string", "productname": "string", ID: None, "yyyymmdd": "string"},
        "yyyyMMdd",
    ),
    "visits": ({ID: None, "yyyymmdd": "string", "region": "string"}, "yyyyMMdd"),
    "events": ({ID: None, "yyyymmdd": "string", "main_event": "string"}, "yyyy-MM-dd"),
}


def _typed(df: DataFrame, types: dict[str, str | None], id_type: str | None) -> DataFrame:
    """Columns of ``types`` in that order; None keeps the stored type."""
    stored = dict(df.dtypes)

    def column(name: str, wanted: str | None):
        if name == ID and id_type not in (None, stored[name]):
            value = F.col(name).try_cast(id_type)
            message = F.concat(F.lit(f"{ID} is no {id_type}: "), F.col(name).cast("string"))
            lost = F.col(name).isNotNull() & value.isNull()
            return F.when(lost, F.raise_error(message).cast(id_type)).otherwise(value).alias(name)
        return F.col(name) if wanted in (None, stored[name]) else F.col(name).try_cast(wanted).alias(name)

    return df.select(*[column(c, t) for c, t in types.items()])


def read_people(spark: SparkSession, path: str, id_type: str | None = None) -> DataFrame:
    """Spine: one row per person and month, Parquet.

    Rows are dealt out by their keys, which the removal of copies and the joins go by as well, before anything sorts
    them: a task may read any number of rows, as Parquet keeps equal values in next to no bytes.
    """
    return _typed(spark.read.parquet(path), SCANS["people"][0], id_type).repartition(*KEYS)


def read_points(spark: SparkSession, path: str, id_type: str | None = None) -> DataFrame:
    """Purchase lines with ``yyyyMMdd`` dates, Parquet; points may be stored as text."""
    return _typed(spark.read.parquet(path), SCANS["points"][0], id_type)


def read_visits(spark: SparkSession, path: str, id_type: str | None = None) -> DataFrame:
    """Visits with ``yyyyMMdd`` dates, Parquet."""
    return _typed(spark.read.parquet(path), SCANS["visits"][0], id_type)


def read_app_events(
    spark: SparkSession, path: str | list[str], id_type: str | None = None, header: list[str] | None = None
) -> DataFrame:
    """App events with ``yyyy-MM-dd`` dates, CSV files with a header; all columns are text.

    ``header`` names the columns of the files in their order, by default as the first file has them. A file with
    another header stops the read with an error; read files of another order on their own, with theirs.
    """
    reader = spark.read.option("header", True)
    names = reader.csv(path).columns if header is None else header
    schema = ", ".join(f"`{c}` string" for c in names)
    return _typed(reader.schema(schema).option("enforceSchema", False).csv(path), SCANS["events"][0], id_type)
