"""Train a model on prepared rows, store both, and score new rows from what is stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import models
from .training_prep import Preparation, prepare


def train_and_save(df: DataFrame, key: str, target: str, folder: str, family: str = "logistic", seed: int = 42) -> dict[str, DataFrame]:
    """Split and prepare ``df``, fit ``family`` on its training part and write plans and model; returns the prepared parts."""
    parts, fitted = prepare(df, key, target, seed=seed)
    features = [c for c in parts["train"].columns if c not in (key, target)]
    fitted.save(f"{folder}/preparation")
    models.train(parts["train"], features, target, family).write().overwrite().save(f"{folder}/model")
    spark = df.sparkSession
    spark.createDataFrame([(features,)], "features array<string>").write.mode("overwrite").parquet(f"{folder}/features")
    return parts


def score_new(spark: SparkSession, new: DataFrame, folder: str, key: str, donors: DataFrame | None = None) -> DataFrame:
    """``new`` raw rows through the stored preparation and model; ``donors`` only for drawing fills."""
    features = list(spark.read.parquet(f"{folder}/features").first()["features"])
    ready = Preparation.load(spark, f"{folder}/preparation", key, donors).apply(new)
    return models.batch_predict(ready, f"{folder}/model", features)
