"""Written intermediate results, in the folder that all executors share."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from panelkit.sources.folders import drop_folder, list_folder

_STAGED = re.compile(r"[\w-]+-[0-9a-f]{32}")
# Setting of the session: shuffle files of a query are removed when it ends.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where it is unset, a folder in the warehouse.

    Both are shared by all machines of a cluster; a machine's own temporary folder is never used.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder.rstrip("/") if folder else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staging"


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a folder, not made yet, that no other call gets."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """What is written in here leaves no shuffle files: otherwise they stay on disk until the driver's Java drops the plan.

    The setting is the session's: what other threads of it run meanwhile leaves none either.
    """
    before = spark.conf.get(_TIDY, None)
    spark.conf.set(_TIDY, "true")
    try:
        yield
    finally:
        spark.conf.unset(_TIDY) if before is None else spark.conf.set(_TIDY, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once, written as Parquet and read back.

    For results that are read several times, or that must not change between two
    readings. Lost executors cost a re-read, never a re-computation. The table stays until
    ``drop_staged`` or the owner of the folder removes it; the shuffle files behind it go at once.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    with tidy(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)



def drop_staged(spark: SparkSession) -> None:
    """Remove everything staged under the shared folder, by this session and by others: call it when no job runs."""
    for name in list_folder(spark, shared_folder(spark)):
        if _STAGED.fullmatch(name):
            drop_folder(spark, f"{shared_folder(spark)}/{name}")
