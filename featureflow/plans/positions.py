"""Clustering of taxi positions."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from featureflow.operators.cluster import kmeans_pipeline
from featureflow.operators.split import hash_part
from featureflow.session import training_table

POSITION_SCHEMA = "tid string, lat double, lon double, time string"


def cluster_positions(
    rows: DataFrame, columns: tuple[str, ...] = ("lat", "lon"), key: str = "tid", k: int = 2, max_iter: int = 20
) -> tuple[PipelineModel, DataFrame]:
    """Fit k-means on 70% of the keys and assign the others; returns the model and those rows."""
    parted = rows.withColumn("__part", hash_part(key, {"train": 70, "test": 30}))
    # Written once: the passes of the fit read two columns instead of splitting the rows again.
    train = training_table(parted.where("__part = 'train'").select(key, *columns), "positions", key, *columns)
    model = kmeans_pipeline(columns, k, max_iter).fit(train)
    return model, model.transform(parted.where("__part = 'test'").drop("__part"))
