"""k-means: Lloyd's iteration as DataFrame aggregations, and Spark ML's."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featureflow.operators.encode import assembler

Centres = Sequence[Sequence[float]]


def nearest(columns: Sequence[str], centres: Centres) -> Column:
    """Struct (distance2, cluster) of the nearest centre; ties go to the lower number."""
    options = []
    for number, centre in enumerate(centres):
        terms = [(F.col(c) - F.lit(float(x))) * (F.col(c) - F.lit(float(x))) for c, x in zip(columns, centre, strict=True)]
        options.append(F.struct(sum(terms[1:], terms[0]).alias("distance2"), F.lit(number).alias("cluster")))
    return F.array_min(F.array(*options))


def extreme_centres(df: DataFrame, columns: Sequence[str]) -> list[list[float]]:
    """Two fixed starting centres: the smallest and the largest value of each column."""
    row = df.agg(
        *[F.min(c).alias(f"min_{c}") for c in columns], *[F.max(c).alias(f"max_{c}") for c in columns]
    ).first()
    return [[row[f"{side}_{c}"] for c in columns] for side in ("min", "max")]


def assign(df: DataFrame, columns: Sequence[str], centres: Centres) -> DataFrame:
    """Add ``cluster`` and ``distance2``; a null coordinate is an error, as in the assembler."""
    whole = df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.raise_error(F.lit(f"null in {c}")).cast("double")) for c in columns}
    )
    best = whole.withColumn("__best", nearest(columns, centres))
    return best.withColumns({"cluster": F.col("__best.cluster"), "distance2": F.col("__best.distance2")}).drop("__best")


def centre_sums(df: DataFrame, columns: Sequence[str], centres: Centres) -> DataFrame:
    """One Lloyd step: (cluster, mean per column, members, inertia). Shuffles k rows per task."""
    return (
        assign(df, columns, centres)
        .groupBy("cluster")
        .agg(
            *[F.avg(c).alias(c) for c in columns],
            F.count(F.lit(1)).alias("members"),
            F.sum("distance2").alias("inertia"),
        )
    )


def lloyd(df: DataFrame, columns: Sequence[str], start: Centres, iterations: int) -> list[list[float]]:
    """Centres after ``iterations`` steps from ``start``; an empty cluster keeps its centre.

    Each step is one aggregation; the driver holds the k centres, nothing else.
    """
    centres = [list(map(float, c)) for c in start]
    rows = df.select(*columns)
    for _ in range(iterations):
        moved = centre_sums(rows, columns, centres).collect()
        for row in moved:
            centres[row["cluster"]] = [row[c] for c in columns]
    return centres


def kmeans_pipeline(columns: Sequence[str], k: int = 2, max_iter: int = 20, seed: int = 1) -> Pipeline:
    """Assembler and Spark ML k-means (parallel k-means++ start)."""
    return Pipeline(
        stages=[
            assembler(columns),
            KMeans(k=k, maxIter=max_iter, seed=seed, featuresCol="features", predictionCol="prediction"),
        ]
    )
