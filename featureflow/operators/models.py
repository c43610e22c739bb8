"""Classifiers, linear scoring and the pipeline around them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featureflow.operators.encode import assembler, indexer, one_hot
from featureflow.operators.indexing import TableIndexer

CLASSIFIERS = {
    "tree": (DecisionTreeClassifier, {}),
    "forest": (RandomForestClassifier, {"impurity": "gini", "seed": 3}),
    "boosted": (GBTClassifier, {"seed": 3}),
    "logistic": (LogisticRegression, {}),
    "svm": (LinearSVC, {}),
}


def classifier(kind: str, label: str, **params) -> Estimator:
    """A Spark ML classifier by short name, reading ``features`` and writing ``prediction``."""
    estimator, preset = CLASSIFIERS[kind]
    return estimator(labelCol=label, featuresCol="features", predictionCol="prediction", **{**preset, **params})


def categorical_pipeline(
    model: Estimator,
    label: str,
    strings: Sequence[str] = (),
    codes: Sequence[str] = (),
    numbers: Sequence[str] = (),
    keep: bool = True,
    drop_last: bool = True,
    wide: Sequence[str] = (),
) -> Pipeline:
    """Index strings, one-hot encode them and integer codes, assemble with numbers, fit.

    ``keep`` gives unseen categories a slot of their own instead of failing. ``wide`` names those of the strings whose
    labels may be many: they are numbered by a table instead of on the driver, to the same vectors.
    """
    encoded = [*(f"{c}Index" for c in strings), *codes]
    few = [c for c in strings if c not in wide]
    stages: list = [indexer(few, keep=keep)] if few else []
    many = [c for c in strings if c in wide]
    if many:
        stages.append(TableIndexer(inputCols=many, outputCols=[f"{c}Index" for c in many], handleInvalid="keep" if keep else "error"))
    if encoded:
        stages.append(one_hot(encoded, keep=keep, drop_last=drop_last))
    stages.append(assembler([*(f"{c}Encoded" for c in encoded), *numbers], label=label))
    return Pipeline(stages=[*stages, model])


def linear_score(weights: Mapping[str, float], intercept: float = 0.0) -> Column:
    """Struct (margin, probability, prediction) of a linear model with given weights."""
    margin = F.lit(float(intercept))
    for column, weight in weights.items():
        margin = margin + F.col(column) * F.lit(float(weight))
    return F.struct(
        margin.alias("margin"),
        (1 / (1 + F.exp(-margin))).alias("probability"),
        F.when(margin > 0, 1.0).otherwise(0.0).alias("prediction"),
    )


def score(model, df: DataFrame, *columns: str) -> DataFrame:
    """Apply a fitted model and keep the named columns."""
    return model.transform(df).select(*columns)
