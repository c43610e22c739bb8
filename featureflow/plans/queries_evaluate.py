"""Queries: linear scoring, confusion counts, areas under curves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.operators.evaluate import (
    confusion,
    pr_area_of_classes,
    pr_area_of_scores,
    roc_area_of_classes,
    roc_area_of_scores,
)
from featureflow.plans.queries_sources import MARGIN_SQL, scored_base
from featureflow.plans.registry import query
from featureflow.plans.standin import BASE_SQL

SCORED_SQL = f"""{BASE_SQL}, scored AS (SELECT PassengerId, Survived, {MARGIN_SQL} AS margin FROM base)"""
COUNTS_SQL = f"""{SCORED_SQL}, c AS (SELECT
  count(*) FILTER (Survived = 1 AND margin > 0)::DOUBLE AS tp, count(*) FILTER (Survived = 0 AND margin > 0)::DOUBLE AS fp,
  count(*) FILTER (Survived = 1 AND margin <= 0)::DOUBLE AS fn, count(*) FILTER (Survived = 0 AND margin <= 0)::DOUBLE AS tn
  FROM scored)"""
POINTS_SQL = f"""{SCORED_SQL}, tallies AS (SELECT margin AS score, sum(Survived)::DOUBLE AS pos,
    sum(1 - Survived)::DOUBLE AS neg FROM scored GROUP BY margin),
  points AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM tallies
    WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
  steps AS (SELECT *, lag(tp, 1, 0.0) OVER o AS tp0, lag(fp, 1, 0.0) OVER o AS fp0,
    lag(tp / (tp + fp)) OVER o AS prec0 FROM points WINDOW o AS (ORDER BY score DESC))"""


@query(
    f"""WITH {SCORED_SQL} SELECT PassengerId, margin, round(1 / (1 + exp(-margin)), 9) AS probability,
      CASE WHEN margin > 0 THEN 1.0::DOUBLE ELSE 0.0 END AS prediction FROM scored"""
)
def linear_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Margin, probability and class from given weights."""
    return scored_base(spark, sf_dir).select(
        "PassengerId", "margin", F.round("probability", 9).alias("probability"), "prediction"
    )


@query(f"WITH {COUNTS_SQL} SELECT tp::BIGINT AS tp, fp::BIGINT AS fp, fn::BIGINT AS fn, tn::BIGINT AS tn FROM c")
def confusion_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """True and false positives and negatives."""
    return confusion(scored_base(spark, sf_dir), "Survived", "prediction")


@query(f"WITH {COUNTS_SQL} SELECT round((tp / (tp + fn) - fp / (fp + tn) + 1) / 2, 9) AS area FROM c")
def auc_roc_hard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ROC area of the predicted classes."""
    area = roc_area_of_classes(scored_base(spark, sf_dir), "Survived", "prediction")
    return area.select(F.round("area", 9).alias("area"))


@query(
    f"""WITH {COUNTS_SQL} SELECT round(tp / (tp + fn) * tp / (tp + fp)
      + fn / (tp + fn) * (tp / (tp + fp) + (tp + fn) / (tp + fp + fn + tn)) / 2, 9) AS area FROM c"""
)
def auc_pr_hard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision-recall area of the predicted classes."""
    area = pr_area_of_classes(scored_base(spark, sf_dir), "Survived", "prediction")
    return area.select(F.round("area", 9).alias("area"))


@query(
    f"""WITH {POINTS_SQL} SELECT round(sum((fp - fp0) * (tp + tp0) / 2) / (max(tp) * max(fp)), 6) AS area
    FROM steps"""
)
def auc_roc_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ROC area over every distinct score."""
    area = roc_area_of_scores(scored_base(spark, sf_dir), "Survived", "margin")
    return area.select(F.round("area", 6).alias("area"))


@query(
    f"""WITH {POINTS_SQL}
    SELECT round(sum((tp - tp0) * (coalesce(prec0, tp / (tp + fp)) + tp / (tp + fp)) / 2) / max(tp), 6) AS area
    FROM steps"""
)
def auc_pr_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision-recall area over every distinct score."""
    area = pr_area_of_scores(scored_base(spark, sf_dir), "Survived", "margin")
    return area.select(F.round("area", 6).alias("area"))
