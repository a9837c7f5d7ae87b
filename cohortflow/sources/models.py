"""Fitted models on shared storage."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_classifier(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_calibrator(points: DataFrame, path: str) -> None:
    """The break points of an isotonic fit as a table."""
    points.write.mode("overwrite").parquet(path)


def load_calibrator(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("score double, calibrated double").parquet(path)
