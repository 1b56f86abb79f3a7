"""Folders on whatever file system the tables are, through the session's Hadoop client."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _client(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    fs, hadoop = _client(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop)) if fs.exists(hadoop) else []


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder and all in it."""
    fs, hadoop = _client(spark, path)
    fs.delete(hadoop, True)
