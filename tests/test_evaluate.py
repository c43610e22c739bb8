import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from featureflow.operators.evaluate import (
    confusion,
    pr_area_of_classes,
    pr_area_of_scores,
    roc_area_of_classes,
    roc_area_of_scores,
)
from tests.conftest import SPARK_ERRORS, rows

HARD = [(1, 1), (1, 1), (1, 0), (0, 0), (0, 0), (0, 1), (0, 0)]


def evaluator(metric):
    return BinaryClassificationEvaluator(
        labelCol="label", rawPredictionCol="score", metricName=metric, numBins=0
    )


def frame(spark, items):
    return spark.createDataFrame([(float(a), float(b)) for a, b in items], "label double, score double")


def test_confusion(spark):
    assert rows(confusion(frame(spark, HARD), "label", "score")) == [(2, 1, 1, 3)]


@pytest.mark.parametrize(
    "items",
    [HARD, [(1, 1), (0, 1)], [(1, 0), (0, 0), (0, 0)], [(1, 0), (0, 1)], [(1, 1), (0, 0)]],
)
def test_classes_equal_evaluator(spark, items):
    df = frame(spark, items)
    assert roc_area_of_classes(df, "label", "score").first()[0] == pytest.approx(evaluator("areaUnderROC").evaluate(df))
    assert pr_area_of_classes(df, "label", "score").first()[0] == pytest.approx(evaluator("areaUnderPR").evaluate(df))


def test_hand_values(spark):
    df = frame(spark, HARD)
    assert roc_area_of_classes(df, "label", "score").first()[0] == pytest.approx((2 / 3 - 1 / 4 + 1) / 2)


@pytest.mark.parametrize("distinct", [3, 40, 100_000])
def test_scores_equal_evaluator(spark, distinct):
    """Ties across classes and a score per row."""
    df = spark.range(3_000).select(
        (F.col("id") * 31 % 7 > 4).cast("double").alias("label"),
        (F.col("id") * 7919 % distinct + F.col("id") * 31 % 7).cast("double").alias("score"),
    ).repartition(5)
    assert roc_area_of_scores(df, "label", "score").first()[0] == pytest.approx(
        evaluator("areaUnderROC").evaluate(df), abs=1e-12
    )
    assert pr_area_of_scores(df, "label", "score").first()[0] == pytest.approx(
        evaluator("areaUnderPR").evaluate(df), abs=1e-12
    )


def test_perfect_order_one_score_one_class(spark):
    assert roc_area_of_scores(frame(spark, [(0, 1), (0, 2), (1, 3)]), "label", "score").first()[0] == 1.0
    assert roc_area_of_scores(frame(spark, [(0, 1), (1, 1)]), "label", "score").first()[0] == 0.5
    assert roc_area_of_scores(frame(spark, [(1, 1), (1, 2)]), "label", "score").first()[0] is None
    assert pr_area_of_scores(frame(spark, [(0, 1), (0, 2)]), "label", "score").first()[0] is None


def test_null_scores_raise(spark):
    df = spark.createDataFrame([(1.0, 0.5, 1.0), (0.0, None, None)], "label double, score double, prediction double")
    for area, column in ((roc_area_of_scores, "score"), (pr_area_of_scores, "score"), (roc_area_of_classes, "prediction")):
        with pytest.raises(SPARK_ERRORS):
            area(df, "label", column).collect()
