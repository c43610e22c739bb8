"""Areas under the ROC and precision-recall curves as aggregations.

Labels are 1 (positive) and 0. On predicted classes the curve has one threshold and the area
follows from four counts. On scores every distinct score is a threshold: rows are tallied per score
first (ties share a point), then running totals over the scores, highest first, give each point.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featureflow.operators.order import running_totals


def _count(test: Column) -> Column:
    return F.count(F.when(test, 1))


def _present(column: str) -> Column:
    """The column; a null in it stops the job, since a row without a score has no place in a curve."""
    missing = F.raise_error(F.lit(f"null in {column}")).cast("double")
    return F.when(F.col(column).isNull(), missing).otherwise(F.col(column).cast("double"))


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: tp, fp, fn, tn. A null prediction raises."""
    given = _present(prediction)
    positive, predicted = F.col(label) == 1, given == 1
    negative, rejected = F.col(label) == 0, given == 0
    return df.agg(
        _count(positive & predicted).alias("tp"),
        _count(negative & predicted).alias("fp"),
        _count(positive & rejected).alias("fn"),
        _count(negative & rejected).alias("tn"),
    )


def roc_area_of_classes(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row ``area``: ROC area of hard 0/1 predictions; null without both classes of label."""
    c = confusion(df, label, prediction)
    tpr = F.try_divide(F.col("tp"), F.col("tp") + F.col("fn"))
    fpr = F.try_divide(F.col("fp"), F.col("fp") + F.col("tn"))
    return c.select(((tpr - fpr + 1) / 2).alias("area"))


def pr_area_of_classes(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row ``area``: precision-recall area of hard predictions, starting at (0, first precision)."""
    c = confusion(df, label, prediction)
    positives = F.col("tp") + F.col("fn")
    everything = positives + F.col("fp") + F.col("tn")
    base = F.try_divide(positives, everything)
    recall = F.try_divide(F.col("tp"), positives)
    # Without a positive prediction the only point is the last one.
    precision = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), base)
    return c.select((recall * precision + (1 - recall) * (precision + base) / 2).alias("area"))


def _points(df: DataFrame, label: str, score: str) -> DataFrame:
    """Per distinct score: pos, neg, and tp, fp reached when scores down to it count as positive."""
    tallies = df.groupBy(_present(score).alias("score")).agg(
        _count(F.col(label) == 1).alias("pos"), _count(F.col(label) == 0).alias("neg")
    )
    return running_totals(
        tallies, [F.col("score").desc()], {"tp": F.col("pos"), "fp": F.col("neg")}
    )


def roc_area_of_scores(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row ``area``: exact ROC area, every distinct score a threshold."""
    slices = F.sum(F.col("neg").cast("double") * (2 * F.col("tp") - F.col("pos")))
    rectangle = F.sum("pos").cast("double") * F.sum("neg") * 2
    return _points(df, label, score).agg(F.try_divide(slices, rectangle).alias("area"))


def pr_area_of_scores(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row ``area``: exact precision-recall area, starting at (0, first precision)."""
    reached = F.col("tp") / (F.col("tp") + F.col("fp"))
    tp_before, fp_before = F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg")
    before = F.coalesce(F.try_divide(tp_before, tp_before + fp_before), reached)
    slices = F.sum(F.col("pos") * (before + reached) / 2)
    return _points(df, label, score).agg(F.try_divide(slices, F.sum("pos")).alias("area"))
