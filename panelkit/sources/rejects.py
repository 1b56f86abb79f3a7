"""Records that a scan cannot use, set aside with their reason.

A rejects table has (source, file, reason, record): which raw table, the file that the record stands in, why it is left
out, and the record as JSON, or the line as it is where it could not be read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.functions import period_key
from panelkit.operators.keys import KEYS
from panelkit.sources.raw import ID, SCANS

REJECTS = "source string, file string, reason string, record string"
# The reasons, the first that holds counts.
BROKEN, NO_ID, BAD_ID, NO_DATE, BAD_DATE = "broken record", "no id", "bad id", "no date", "bad date"
_LINE, _FILE = "_broken_record", "_file_of_record"


def _csv(spark: SparkSession, path: str | list[str], header: list[str] | None) -> DataFrame:
    """Lines of CSV files as text columns; a line with fewer or more fields than the header is kept as it is in _LINE."""
    reader = spark.read.option("header", True)
    names = reader.csv(path).columns if header is None else header
    schema = ", ".join(f"`{c}` string" for c in [*names, _LINE])
    whole = reader.schema(schema).option("enforceSchema", False).option("columnNameOfCorruptRecord", _LINE)
    return whole.csv(path)


def scan(
    spark: SparkSession, source: str, path: str | list[str], id_type: str | None = None, header: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a raw table, 'people', 'points', 'events' or 'visits'.

    ``rows`` are those of its reader that have an id, of ``id_type`` if given, and a date (a month in 'people'), and whose
    record could be read. An id that does not convert sets its record aside; it does not stop the read.
    """
    types, fmt = SCANS[source]
    stored = _csv(spark, path, header) if source == "events" else spark.read.parquet(path)
    rows = stored.withColumn(_FILE, F.col("_metadata.file_path"))
    kinds = dict(stored.dtypes)
    wanted = {c: (id_type if c == ID else t) or kinds[c] for c, t in types.items()}
    typed = {c: F.col(c) if t == kinds[c] else F.col(c).try_cast(t) for c, t in wanted.items()}
    when = "yyyymm" if fmt is None else "yyyymmdd"
    is_date = typed[when].rlike("^[0-9]{6}$") if fmt is None else period_key(typed[when], fmt).isNotNull()
    broken = F.col(_LINE).isNotNull() if source == "events" else F.lit(False)
    reason = (
        F.when(broken, BROKEN)
        .when(F.col(ID).isNull(), NO_ID)
        .when(typed[ID].isNull(), BAD_ID)
        .when(typed[when].isNull(), NO_DATE)
        .when(~is_date, BAD_DATE)
    )
    told = rows.withColumn("_reason", reason)
    good = told.filter(F.col("_reason").isNull()).select(*[v.alias(c) for c, v in typed.items()])
    if source == "people":  # dealt out as ``read_people`` does it, before anything sorts them
        good = good.repartition(*KEYS)
    record = F.to_json(F.struct(*[c for c in stored.columns if c != _LINE]), {"ignoreNullFields": "false"})
    record = F.coalesce(F.col(_LINE), record) if source == "events" else record
    bad = told.filter(F.col("_reason").isNotNull())
    return good, bad.select(
        F.lit(source).alias("source"), F.col(_FILE).alias("file"), F.col("_reason").alias("reason"), record.alias("record")
    )


def add_rejects(path: str, rejects: DataFrame) -> None:
    """Add records to a rejects table; every call writes a folder of its own."""
    rejects.write.parquet(f"{path}/{uuid.uuid4().hex}")


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REJECTS).parquet(f"{path}/*")

