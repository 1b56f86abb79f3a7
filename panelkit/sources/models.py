"""Fitted models kept in a folder, and published models in versions.

    <path>/models/M/...             a fitted model; M is new with every attempt
    <path>/versions/version=N/...   one JSON record, written last: the folder under models, the run it comes from
"""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel, Transformer
from pyspark.sql import SparkSession

from panelkit.sources.folders import list_folder

_RECORD = "model string, run_id string"


def save_model(model: Transformer, path: str) -> None:
    """Write a fitted model to a new folder."""
    as_pipeline = model if isinstance(model, PipelineModel) else PipelineModel(stages=[model])
    as_pipeline.write().save(path)


def load_model(path: str) -> PipelineModel:
    """Read a model written by ``save_model``, ready to score."""
    return PipelineModel.load(path)


def _versions(spark: SparkSession, path: str) -> list[int]:
    names = [n for n in list_folder(spark, f"{path}/versions") if n.startswith("version=")]
    done = [n for n in names if "_SUCCESS" in list_folder(spark, f"{path}/versions/{n}")]
    return sorted(int(n.removeprefix("version=")) for n in done)


def publish_model(spark: SparkSession, model: Transformer, path: str, run_id: str) -> int:
    """Store a model as the next version under ``path``; gives its number. The versions before it stay."""
    name = uuid.uuid4().hex
    save_model(model, f"{path}/models/{name}")
    version = max(_versions(spark, path), default=0) + 1
    record = spark.createDataFrame([(name, run_id)], _RECORD)
    record.coalesce(1).write.json(f"{path}/versions/version={version}")
    return version


def published_model(spark: SparkSession, path: str, version: int | None = None) -> tuple[PipelineModel, str]:
    """(model, run id) of a published version, by default the newest."""
    versions = _versions(spark, path)
    if not versions or version is not None and version not in versions:
        raise ValueError(f"no such model or version: {path} {version or ''}")
    row = spark.read.schema(_RECORD).json(f"{path}/versions/version={version or versions[-1]}").first()
    return load_model(f"{path}/models/{row['model']}"), row["run_id"]
