"""Sinks for tables and fitted models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header. ``single_file`` runs the last stage in one task: small tables only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)


def write_lines(df: DataFrame, column: str, path: str) -> None:
    df.select(F.col(column).alias("value")).write.mode("overwrite").text(path)


def write_libsvm(df: DataFrame, path: str, label: str = "label", features: str = "features") -> None:
    out = df.select(F.col(label).cast("double").alias("label"), F.col(features).alias("features"))
    out.write.mode("overwrite").format("libsvm").save(path)


def save_model(model: MLWritable, path: str) -> None:
    """Save a fitted model, replacing an earlier one at the same path."""
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)
