"""Saved models: written once, reloaded for each request."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from tallyworks.operators import inverted


def save_text_model(weights: DataFrame, key: str, idf: DataFrame, path: str) -> None:
    """Text weights with their keys, and the vocabulary, as an inverted index."""
    inverted.build(weights, key, idf, path)


def load_text_model(spark: SparkSession, path: str) -> inverted.Index:
    return inverted.Index(spark, path)


def save_fitted(model: PipelineModel, features: Sequence[str], path: str, spark: SparkSession) -> None:
    """A fitted pipeline with the names of its features in order."""
    model.write().overwrite().save(f"{path}/model")
    names = spark.createDataFrame(list(enumerate(features)), "position int, name string")
    names.coalesce(1).write.mode("overwrite").parquet(f"{path}/features")


def load_fitted(spark: SparkSession, path: str) -> tuple[PipelineModel, list[str]]:
    names = spark.read.parquet(f"{path}/features").orderBy("position").collect()
    return PipelineModel.load(f"{path}/model"), [row["name"] for row in names]
