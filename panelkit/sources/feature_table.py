"""Keyed feature tables as plain Parquet, in versions.

    <path>/data/write=W/...         rows of one write; W is new with every attempt
    <path>/parts/P/...              (value, write): which writes hold the rows of each partition
    <path>/state/S/...              rows kept beside the table for its next update, if any
    <path>/versions/version=N/...   one JSON record: schema, keys, the folders under parts and state

A version exists once its record does, and the record is written last, after the keys of
the data have been checked: readers see whole, checked versions only, and a job
that dies leaves the version before it in place. Two writers of one version never touch each other's rows;
the one whose record comes second fails, and what it wrote is no part of any version.

A table partitioned by one of its keys is upserted by partition: only the partitions
that receive rows get new ones. The list of partitions is a table itself, joined with the rows; it never comes
to the driver, so there may be any number. The driver sees the names of the writes in use, one or two for
each version.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from panelkit.operators.keys import KEYS, key_violations
from panelkit.sources.folders import drop_folder, list_folder

_RECORD = "description string, primary_keys array<string>, partition_by string, schema string, parts string, state string"
_PARTS = "value string, write string"


def create_feature_table(
    df: DataFrame,
    path: str,
    primary_keys: list[str] = KEYS,
    description: str = "",
    partition_by: str | None = None,
    state: DataFrame | None = None,
) -> None:
    """Write ``df`` as version 1 of a new table. Fails if the table is there already or if the
    keys are not unique and known. ``partition_by``: one of the keys. ``state``: rows of any kind that belong to this
    version without being rows of the table; ``read_state`` gives them."""
    if _versions(df.sparkSession, path):
        raise ValueError(f"feature table exists: {path}")
    if partition_by is not None and partition_by not in primary_keys:
        raise ValueError(f"partition column {partition_by} is not a key")
    record = {
        "description": description,
        "primary_keys": list(primary_keys),
        "partition_by": partition_by,
        "schema": df.schema.json(),
        "state": _write_state(state, path),
    }
    _write_whole(df, path, 1, record)


def upsert_feature_table(
    spark: SparkSession, path: str, df: DataFrame, mode: str = "merge", state: DataFrame | None = None
) -> None:
    """Write ``df`` into the table as its next version, ``state`` as its state; without one the state stays as it was.

    'merge': rows whose key is there replace the stored ones, others are added.
    'overwrite': the rows of ``df`` become the whole table. The columns have to be those of the table, in any order;
    missing and further ones are an error.
    """
    version, old = _record(spark, path)
    columns = StructType.fromJson(json.loads(old["schema"]))
    if sorted(df.columns) != sorted(columns.names):
        extra, missing = sorted({*df.columns} - {*columns.names}), sorted({*columns.names} - {*df.columns})
        raise ValueError(f"columns differ from the table's: further {extra}, missing {missing}")
    df = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in columns])
    if state is not None:
        old = old | {"state": _write_state(state, path)}
    if mode == "overwrite":
        _write_whole(df, path, version + 1, old)
    elif mode == "merge":
        _merge(spark, df, path, version + 1, old)
    else:
        raise ValueError(f"unknown mode: {mode}")


def read_feature_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Rows of a version, by default of the newest."""
    return _rows(spark, path, _record(spark, path, version)[1])


def read_state(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """The state of a version, by default of the newest; None if it has none."""
    state = _record(spark, path, version)[1]["state"]
    if state is None:
        return None
    kept = json.loads(state)
    return spark.read.schema(StructType.fromJson(kept["schema"])).parquet(f"{path}/state/{kept['folder']}")


def describe_feature_table(spark: SparkSession, path: str) -> DataFrame:
    """(column, type, is_key, position, description) of the newest version."""
    record = _record(spark, path)[1]
    fields = StructType.fromJson(json.loads(record["schema"])).fields
    return spark.createDataFrame(
        [
            (f.name, f.dataType.simpleString(), f.name in record["primary_keys"], i, record["description"])
            for i, f in enumerate(fields)
        ],
        "column string, type string, is_key boolean, position int, description string",
    )


def feature_table_parts(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(value, write): the writes that hold each partition of a version; value is null in a table without partitions."""
    return _parts(spark, path, _record(spark, path, version)[1])


def clean_feature_table(spark: SparkSession, path: str, keep: int = 1) -> None:
    """Remove all versions but the newest ``keep``, and the rows that none of these has, also those of writers that
    died. Call it while nobody writes."""
    versions = _versions(spark, path)
    for v in versions[:-keep]:
        drop_folder(spark, f"{path}/versions/version={v}")
    records = [_record(spark, path, v)[1] for v in versions[-keep:]]
    writes = {w for r in records for w in _writes(_parts(spark, path, r))}
    for name in list_folder(spark, f"{path}/data"):
        if name.startswith("write=") and name.removeprefix("write=") not in writes:
            drop_folder(spark, f"{path}/data/{name}")
    for name in set(list_folder(spark, f"{path}/parts")) - {r["parts"] for r in records}:
        drop_folder(spark, f"{path}/parts/{name}")
    states = {json.loads(r["state"])["folder"] for r in records if r["state"] is not None}
    for name in set(list_folder(spark, f"{path}/state")) - states:
        drop_folder(spark, f"{path}/state/{name}")


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Published versions in ascending order. A folder without its success mark is a record being written."""
    names = [n for n in list_folder(spark, f"{path}/versions") if n.startswith("version=")]
    done = [n for n in names if "_SUCCESS" in list_folder(spark, f"{path}/versions/{n}")]
    return sorted(int(n.removeprefix("version=")) for n in done)


def _record(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, dict]:
    versions = _versions(spark, path)
    if not versions or version is not None and version not in versions:
        raise ValueError(f"no such feature table or version: {path} {version or ''}")
    version = versions[-1] if version is None else version
    row = spark.read.schema(_RECORD).json(f"{path}/versions/version={version}").first()
    return version, row.asDict()


def _write_state(state: DataFrame | None, path: str) -> str | None:
    """The record of a state, written to a folder of its own: it counts once a version names it."""
    if state is None:
        return None
    name = uuid.uuid4().hex
    state.write.parquet(f"{path}/state/{name}")
    return json.dumps({"folder": name, "schema": state.schema.jsonValue()})


def _parts(spark: SparkSession, path: str, record: dict) -> DataFrame:
    return spark.read.schema(_PARTS).parquet(f"{path}/parts/{record['parts']}")


def _writes(parts: DataFrame) -> list[str]:
    return sorted(r[0] for r in parts.select("write").distinct().collect())


def _publish(spark: SparkSession, path: str, version: int, record: dict, parts: DataFrame) -> None:
    name = uuid.uuid4().hex
    parts.write.parquet(f"{path}/parts/{name}")
    fields = ("description", "primary_keys", "partition_by", "schema")
    frame = spark.createDataFrame([(*[record[k] for k in fields], name, record["state"])], _RECORD)
    # fails if another writer has published this version meanwhile
    frame.coalesce(1).write.json(f"{path}/versions/version={version}")


def _scan(spark: SparkSession, path: str, record: dict, writes: list[str]) -> DataFrame:
    """Rows of some writes, with ``write``."""
    schema = StructType.fromJson(json.loads(record["schema"]))
    if not writes:
        return spark.createDataFrame([], schema).withColumn("write", F.lit(""))
    names = [f"{path}/data/write={w}" for w in writes]
    schema = StructType([*schema.fields, StructField("write", StringType())])
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*names)


def _rows(spark: SparkSession, path: str, record: dict, parts: DataFrame | None = None) -> DataFrame:
    """Rows of a version, optionally of some of its partitions."""
    names = StructType.fromJson(json.loads(record["schema"])).names
    parts = _parts(spark, path, record) if parts is None else parts
    rows = _scan(spark, path, record, _writes(parts))
    if record["partition_by"] is not None:
        held = F.col(f"`{record['partition_by']}`").cast("string")
        live = parts.select(F.col("value").alias("_value"), F.col("write").alias("_write"))
        rows = rows.join(live, (F.col("write") == F.col("_write")) & held.eqNullSafe(F.col("_value")), "left_semi")
    return rows.select(*[f"`{n}`" for n in names])


def _write(df: DataFrame, path: str, record: dict) -> tuple[DataFrame, DataFrame]:
    """(rows as written, their parts). A rebalance before a partitioned write lets Spark cut large
    partitions and join small ones, instead of a file per task and partition."""
    spark, part_col, name = df.sparkSession, record["partition_by"], uuid.uuid4().hex
    target = f"{path}/data/write={name}"
    if part_col is None:
        df.write.parquet(target)
        return spark.read.schema(df.schema).parquet(target), spark.createDataFrame([(None, name)], _PARTS)
    df.hint("rebalance", part_col).write.partitionBy(part_col).parquet(target)
    written = spark.read.schema(df.schema).parquet(target)
    # read from the names of the folders
    parts = written.select(F.col(f"`{part_col}`").cast("string").alias("value")).distinct()
    return written, parts.withColumn("write", F.lit(name))


def _check_keys(df: DataFrame, keys: list[str]) -> None:
    bad = key_violations(df, keys).limit(5).collect()
    if bad:
        raise ValueError(f"primary key violated, for example: {[tuple(r) for r in bad]}")


def _write_whole(df: DataFrame, path: str, version: int, record: dict) -> None:
    """One computation of ``df``: what the checks need is read back from the files."""
    written, parts = _write(df, path, record)
    _check_keys(written, record["primary_keys"])
    _publish(df.sparkSession, path, version, record, parts)


def _merge(spark: SparkSession, df: DataFrame, path: str, version: int, old: dict) -> None:
    """The new rows are written once, where they stay, and checked there; beside them the stored rows of the same
    partitions that they do not replace."""
    keys, part_col = old["primary_keys"], old["partition_by"]
    new, parts = _write(df, path, old)
    # stored keys are unique, so the result is as soon as the new ones are
    _check_keys(new, keys)
    before = _parts(spark, path, old)
    if part_col is None:
        touched, untouched = before, before.limit(0)
    else:
        mine = parts.select("value")
        touched, untouched = before.join(mine, "value", "left_semi"), before.join(mine, "value", "left_anti")
    stored = _rows(spark, path, old, touched)
    if part_col is not None:
        low, high = new.agg(F.min(part_col), F.max(part_col)).first()
        stored = stored.filter(F.col(part_col).between(low, high)) if low is not None else stored.limit(0)
    _, rest = _write(stored.join(new.select(*keys), keys, "left_anti"), path, old)
    _publish(spark, path, version, old, reduce(DataFrame.unionByName, [untouched, parts, rest]))
