"""Queries: fitted models and grid searches, each scoring every row from the id cutoff on."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.operators.compiled import compile_pipeline
from featureflow.operators.evaluate import (
    pr_area_of_classes,
    pr_area_of_scores,
    roc_area_of_classes,
    roc_area_of_scores,
)
from featureflow.operators.impute import fit_means
from featureflow.operators.models import categorical_pipeline, classifier
from featureflow.operators.search import run_search
from featureflow.operators.split import below, from_cutoff, hash_part
from featureflow.plans.passengers import FLOWS, ID, LABEL, TREE_GRID, fit_flow, fit_points, fit_statistics, labelled_points, records, run_flow, search_flow
from featureflow.plans.registry import query
from featureflow.plans.standin import BASE_SQL, base, id_cutoff, split_base
from featureflow.session import training_table, written_table


# Searches of trees, plain forests and linear models read at most this many labelled rows; the model found is fitted on all.
SEARCH_ROWS = 5_000


def _scored(spark: SparkSession, sf_dir: str, flow: str, search: str = "none", **params) -> DataFrame:
    train, score = split_base(spark, sf_dir)
    return run_flow(flow, train, score, search, **params).select(ID, "prediction")


@query()
def model_dt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decision tree on sex, family counts and fare."""
    return _scored(spark, sf_dir, "tree")


@query()
def model_rf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random forest on the cleaned record."""
    return _scored(spark, sf_dir, "forest")


@query()
def model_rf_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random forest on the banded record, means from training and scoring rows."""
    return _scored(spark, sf_dir, "forest_union", fit_on="all")


@query()
def model_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gradient-boosted trees on the banded record."""
    return _scored(spark, sf_dir, "boosted")


@query()
def model_lr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logistic regression on the cleaned record."""
    return _scored(spark, sf_dir, "logistic")


@query()
def model_one_hot_lr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logistic regression on numbers and the fully one-hot encoded sex."""
    return _scored(spark, sf_dir, "one_hot_logistic")


@query()
def model_svc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linear support vector machine on the banded record."""
    return _scored(spark, sf_dir, "svm")


@query()
def batch_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction, class probability and margin of every scored row."""
    train, score = split_base(spark, sf_dir)
    scored = run_flow("logistic", train, score)
    return scored.select(
        ID,
        "prediction",
        vector_to_array("probability")[1].alias("probability"),
        vector_to_array("rawPrediction")[1].alias("margin"),
    )


@query(
    f"""WITH {BASE_SQL} SELECT PassengerId AS passenger_id, true AS probability_fits, true AS class_fits
    FROM base, cut WHERE PassengerId >= cutoff"""
)
def batch_score_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every scored row's probability is the logistic function of its margin, its class the margin's sign."""
    logistic = 1 / (1 + F.exp(-F.col("margin")))
    return batch_score(spark, sf_dir).select(
        ID,
        (F.abs(F.col("probability") - logistic) < 1e-9).alias("probability_fits"),
        (F.col("prediction") == (F.col("margin") > 0).cast("double")).alias("class_fits"),
    )


def _fitted_on_one(spark: SparkSession, sf_dir: str, column: str, pipeline) -> DataFrame:
    """Scoring rows under a pipeline fitted on one column of the training rows."""
    train, score = split_base(spark, sf_dir, "PassengerId", "Survived", column)
    rows = train.select(F.col("PassengerId").alias(ID), F.col("Survived").alias(LABEL), column)
    return pipeline.fit(training_table(rows, "train", ID)).transform(score.withColumnRenamed("PassengerId", ID))


GROUP_SHARE_SQL = """shares AS (SELECT {column}, avg(Survived) AS share FROM base, cut WHERE PassengerId < cutoff
  GROUP BY {column})"""


@query(
    f"""WITH {BASE_SQL}, {GROUP_SHARE_SQL.format(column="Sex")}
    SELECT PassengerId AS passenger_id, round(share, 4) AS probability
    FROM base JOIN cut ON PassengerId >= cutoff JOIN shares USING (Sex)"""
)
def model_lr_group_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logistic regression on one category: its probabilities are the shares of positives per group."""
    model = classifier("logistic", LABEL, tol=1e-10)
    scored = _fitted_on_one(spark, sf_dir, "Sex", categorical_pipeline(model, LABEL, strings=("Sex",), keep=False))
    return scored.select(ID, F.round(vector_to_array("probability")[1], 4).alias("probability"))


@query(
    f"""WITH {BASE_SQL}, {GROUP_SHARE_SQL.format(column="Pclass")}
    SELECT PassengerId AS passenger_id, CASE WHEN share > 0.5 THEN 1.0::DOUBLE ELSE 0.0 END AS prediction
    FROM base JOIN cut ON PassengerId >= cutoff JOIN shares USING (Pclass)"""
)
def model_dt_group_majority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decision tree on one category: it predicts the majority of each group."""
    pipeline = categorical_pipeline(classifier("tree", LABEL), LABEL, codes=("Pclass",))
    return _fitted_on_one(spark, sf_dir, "Pclass", pipeline).select(ID, "prediction")


def _points_scored(spark: SparkSession, sf_dir: str, kind: str, more: Callable | None = None) -> DataFrame:
    """Held-out points with class; ``more`` gives further columns from the fitted model."""
    rows = base(spark, sf_dir, "PassengerId", "Survived", "Pclass", "Sex", "Age", "SibSp", "Parch", "Fare")
    rows = rows.withColumn("Fare", F.coalesce("Fare", F.lit(0.0)))
    points = labelled_points(rows, fit_means(rows, "Age"))
    parted = points.withColumn("part", hash_part(ID, {"train": 80, "test": 20}))
    train = training_table(parted.where("part = 'train'").select(ID, "label", "features"), "points", ID)
    model = fit_points(kind, train)
    return model.transform(parted.where("part = 'test'")).select(ID, "label", "prediction", *more(model) if more else [])


@query()
def model_points_svc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Support vector machine on labelled points: fitted on 80% of the keys, the others scored."""
    return _points_scored(spark, sf_dir, "svm")


@query()
def model_points_lr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logistic regression on labelled points: fitted on 80% of the keys, the others scored."""
    return _points_scored(spark, sf_dir, "logistic")


POINT_PARTS_SQL = f"""WITH {BASE_SQL} SELECT PassengerId AS passenger_id, Survived::DOUBLE AS label, true AS class_fits FROM base
    WHERE CAST('0x' || substr(md5(CAST(PassengerId AS VARCHAR)), 1, 7) AS BIGINT) % 100 >= 80"""


def _point_parts(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Whether the class of each held-out point is the side of the fitted plane on which its six numbers lie."""

    def side(model) -> list:
        x = vector_to_array("features")
        terms = [F.get(x, F.lit(i)) * F.lit(float(w)) for i, w in enumerate(model.coefficients)]
        margin = reduce(lambda a, b: a + b, terms, F.lit(float(model.intercept)))
        # Where the sum is as good as 0 its sign hangs on the order of adding up.
        right = F.col("prediction") == (margin > 0).cast("double")
        return [(right | (F.abs(margin) < 1e-9)).alias("class_fits")]

    return _points_scored(spark, sf_dir, kind, side).select(ID, "label", "class_fits")


@query(POINT_PARTS_SQL)
def model_points_svc_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Support vector machine on points: its classes against its plane."""
    return _point_parts(spark, sf_dir, "svm")


@query(POINT_PARTS_SQL)
def model_points_lr_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logistic regression on points: its classes against its plane."""
    return _point_parts(spark, sf_dir, "logistic")


@query()
def model_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas of a fitted model on labelled rows it has not seen, on classes and on scores."""
    rows, cutoff = base(spark, sf_dir), id_cutoff(spark, sf_dir)
    train, held_out = below(rows, "PassengerId", cutoff), from_cutoff(rows, "PassengerId", cutoff)
    scored = run_flow("logistic", train, held_out).select(
        LABEL, "prediction", vector_to_array("probability")[1].alias("probability")
    )
    # Four evaluations of one scoring pass.
    scored = written_table(scored, "scored")
    areas = {
        "roc_of_classes": roc_area_of_classes(scored, LABEL, "prediction"),
        "pr_of_classes": pr_area_of_classes(scored, LABEL, "prediction"),
        "roc_of_scores": roc_area_of_scores(scored, LABEL, "probability"),
        "pr_of_scores": pr_area_of_scores(scored, LABEL, "probability"),
    }
    return reduce(
        DataFrame.unionByName, [df.select(F.lit(name).alias("measure"), "area") for name, df in areas.items()]
    )


COMPILED_SQL = f"""WITH {BASE_SQL} SELECT PassengerId AS passenger_id, true AS same_class, true AS same_probability
    FROM base, cut WHERE PassengerId >= cutoff"""


def _compiled(spark: SparkSession, sf_dir: str, flow: str) -> DataFrame:
    """Whether the compiled model gives each scored row the class and the probability of the model itself."""
    train, score = split_base(spark, sf_dir)
    fitted = fit_statistics(FLOWS[flow], train)
    model = fit_flow(flow, train, fitted=fitted)
    # Both score one written table, so that they see the same rows.
    rows = written_table(records(FLOWS[flow], score, fitted), "records")
    own = model.transform(rows).select(ID, F.col("prediction").alias("class"), vector_to_array("probability").alias("p"))
    both = compile_pipeline(spark, model).score(rows).select(ID, "prediction", "probability").join(own, ID)
    near = F.forall(F.zip_with("p", "probability", lambda a, b: F.abs(a - b) < 1e-12), lambda x: x)
    return both.select(ID, (F.col("prediction") == F.col("class")).alias("same_class"), near.alias("same_probability"))


@query(COMPILED_SQL)
def compiled_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fitted tree as one expression scores like the model."""
    return _compiled(spark, sf_dir, "tree")


@query(COMPILED_SQL)
def compiled_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fitted forest as expressions scores like the model."""
    return _compiled(spark, sf_dir, "forest")


@query(COMPILED_SQL)
def compiled_boosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted boosted trees as expressions score like the model."""
    return _compiled(spark, sf_dir, "boosted")


@query()
def cv_dt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decision tree, best of its grid."""
    return _scored(spark, sf_dir, "tree", "full", search_rows=SEARCH_ROWS)


@query()
def cv_rf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random forest, best of its grid."""
    return _scored(spark, sf_dir, "forest", "full", search_rows=SEARCH_ROWS)


@query()
def cv_rf_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random forest on the banded record, best of its grid, which is searched on all rows; means from all rows."""
    return _scored(spark, sf_dir, "forest_union", "full", fit_on="all")


@query()
def cv_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gradient-boosted trees, best of their grid, which is searched on all rows."""
    return _scored(spark, sf_dir, "boosted", "full")


@query()
def cv_lr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logistic regression, best of its grid."""
    return _scored(spark, sf_dir, "logistic", "full", search_rows=SEARCH_ROWS)


@query()
def cv_svc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linear support vector machine, best of its grid."""
    return _scored(spark, sf_dir, "svm", "full", search_rows=SEARCH_ROWS)


def _areas(spark: SparkSession, sf_dir: str, name: str, search_rows: int | None = None) -> DataFrame:
    """(map, params, folds, mean_area, best) of a flow's whole search, on all rows or ``search_rows`` of them; the first of
    the best maps is ``best``.
    """
    train, _ = split_base(spark, sf_dir)
    found = search_flow(name, train, search_rows=search_rows)
    means = found.cells(spark).groupBy("map", "params").agg(F.count("area").alias("folds"), F.avg("area").alias("mean_area"))
    params = [F.col("params")[p].alias(p) for p in FLOWS[name].grid]
    return means.select("map", *params, "folds", "mean_area", (F.col("map") == found.best).alias("best"))


@query()
def cv_dt_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean area of every map of the decision tree's search."""
    return _areas(spark, sf_dir, "tree", SEARCH_ROWS)


@query()
def cv_rf_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean area of every map of the random forest's search."""
    return _areas(spark, sf_dir, "forest", SEARCH_ROWS)


@query()
def cv_gbt_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean area of every map of the boosted trees' search, on all rows."""
    return _areas(spark, sf_dir, "boosted")


@query()
def cv_lr_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean area of every map of the logistic regression's search."""
    return _areas(spark, sf_dir, "logistic", SEARCH_ROWS)


@query()
def cv_svc_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean area of every map of the support vector machine's search."""
    return _areas(spark, sf_dir, "svm", SEARCH_ROWS)


@query(
    f"""WITH {BASE_SQL}, folds AS (
      SELECT Sex, coalesce(Age >= 40, false) AS old, CAST('0x' || substr(md5('fold:' || CAST(PassengerId AS VARCHAR)), 1, 7) AS BIGINT) % 3 AS fold
      FROM base, cut WHERE PassengerId < cutoff
    ), majorities AS (
      SELECT f AS fold, Sex, avg(old::INTEGER) > 0.5 AS says FROM folds, (SELECT unnest([0, 1, 2]) AS f) WHERE fold <> f GROUP BY ALL
    ), rates AS (
      SELECT fold, avg(says::INTEGER) FILTER (old) AS hit, avg(says::INTEGER) FILTER (NOT old) AS false_alarm
      FROM folds JOIN majorities USING (fold, Sex) GROUP BY fold
    )
    SELECT map, depth::VARCHAR AS "maxDepth", fold::INTEGER AS fold, round((1 + hit - false_alarm) / 2, 6) AS area
    FROM rates, (SELECT unnest([0, 1, 2]) AS map, unnest([6, 8, 10]) AS depth)"""
)
def cv_dt_group_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of the tree's grid on one category, where each fold's area follows from the groups' majorities."""
    train, _ = split_base(spark, sf_dir, "PassengerId", "Sex", "Age")
    old = F.coalesce((F.col("Age") >= 40).cast("int"), F.lit(0))
    rows = train.select(F.col("PassengerId").alias(ID), old.alias(LABEL), "Sex")
    pipeline = categorical_pipeline(classifier("tree", LABEL), LABEL, strings=("Sex",), keep=False)
    found = run_search(pipeline, TREE_GRID, rows, LABEL, ID, folds=3, metric="areaUnderROC", refit=False)
    cells = found.cells(spark)
    return cells.select("map", F.col("params")["maxDepth"].alias("maxDepth"), "fold", F.round("area", 6).alias("area"))
