"""The search as a table of cells: shared fits, finished cells, areas as rows."""

import json
from pathlib import Path

import duckdb
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from featureflow.operators import search
from featureflow.operators.models import categorical_pipeline, classifier
from featureflow.operators.search import Facts, fit_key, param_maps, run_search, search_cells
from featureflow.operators.split import fold_of
from featureflow.plans import queries_models
from featureflow.plans.passengers import FLOWS, flow_pipeline
from featureflow.plans.registry import QUERIES
from tests.conftest import SPARK_ERRORS

FOREST = {"maxDepth": (2, 3), "maxBins": (8, 16, 32), "featureSubsetStrategy": ("auto", "sqrt", "log2")}


@pytest.fixture(scope="module")
def rows(spark):
    """240 rows in which the label follows from two categories, with some noise."""
    i = F.col("id")
    noise = F.pmod(F.xxhash64("id"), F.lit(7)) == 0
    label = ((i % 3 == 0) | (i % 5 == 1)) != noise
    df = spark.range(240).select(
        i, F.concat(F.lit("c"), (i % 3).cast("string")).alias("a"), F.concat(F.lit("d"), (i % 5).cast("string")).alias("b"), label.cast("int").alias("label")
    )
    return df.withColumn("__fold", fold_of("id", 2)).repartition(2, "id").sortWithinPartitions("id")


def pipeline(kind, **params):
    return categorical_pipeline(classifier(kind, "label", **params), "label", strings=("a", "b"))


@pytest.mark.parametrize(
    ("kind", "grid", "params", "fits"),
    [
        ("forest", FOREST, {"numTrees": 4}, 4),
        ("boosted", {**FOREST, "maxDepth": (2,)}, {"maxIter": 2}, 4),
        ("logistic", {"aggregationDepth": (2, 3, 6), "regParam": (0.0, 0.1)}, {}, 4),
        ("svm", {"aggregationDepth": (2, 4), "fitIntercept": (True, False)}, {"maxIter": 5}, 4),
    ],
)
def test_shared_fits_have_the_areas_of_fits_of_their_own(rows, kind, grid, params, fits):
    shared = search_cells(pipeline(kind, **params), grid, rows, "label", 2, "areaUnderROC", pieces=2)
    alone = search_cells(pipeline(kind, **params), grid, rows, "label", 2, "areaUnderROC", pieces=2, share=False)
    assert shared.areas == alone.areas
    assert (shared.fits, alone.fits) == (fits, 2 * len(alone.maps))


def test_what_makes_two_fits_differ():
    forest, boosted = classifier("forest", "label"), classifier("boosted", "label")
    few, many = Facts(1000, 20, 12, 1), Facts(1_000_000, 20, 1_000_000, 64)
    bins = lambda facts: [fit_key(forest, {"maxBins": b}, facts) for b in (8, 16, 32)]
    assert len(set(bins(few))) == 2 and len(set(bins(many))) == 3
    depth = lambda facts: {fit_key(boosted, {"aggregationDepth": d}, facts) for d in (2, 4)}
    assert len(depth(few)) == 1 and len(depth(many)) == 2
    strategies = lambda model, n: [search.drawn_features(model, s, n) for s in ("auto", "all", "sqrt", "log2", "0.5")]
    assert strategies(forest, 20) == [5, 20, 5, 5, "0.5"]
    assert strategies(boosted, 50) == [50, 50, 8, 6, "0.5"]
    assert strategies(classifier("forest", "label", numTrees=1), 9) == [9, 9, 3, 4, "0.5"]


def test_fits_that_run_together_are_of_different_folds(spark):
    model = classifier("tree", "label")
    depth, least = model.getParam("maxDepth"), model.getParam("minInstancesPerNode")
    maps = [{depth: d, least: n} for d in (1, 3) for n in (1, 2)]
    cells = {(str(m), fold): m for fold in range(3) for m in range(4)}
    order = search.fit_order(cells, maps)
    assert sorted(order) == sorted(cells)
    assert [cells[c] for c in order] == [2, 2, 2, 3, 3, 3, 0, 0, 0, 1, 1, 1]
    assert [fold for _, fold in order] == [0, 1, 2] * 4


def test_a_cell_is_the_evaluation_of_one_fit(rows):
    found = search_cells(pipeline("tree"), {"maxDepth": (1, 3)}, rows, "label", 2, "areaUnderPR", pieces=2)
    fit_rows, check_rows = rows.where("__fold <> 1"), rows.where("__fold = 1")
    model = pipeline("tree", maxDepth=3).fit(fit_rows)
    evaluator = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="prediction", metricName="areaUnderPR")
    assert found.areas[1][1] == evaluator.evaluate(model.transform(check_rows))


def test_an_interrupted_search_goes_on(rows, tmp_path, monkeypatch):
    grid, path = {"maxDepth": (1, 2, 3)}, str(tmp_path / "cells")
    run = lambda g=grid, **rest: search_cells(pipeline("tree"), g, rows, "label", 2, "areaUnderROC", pieces=2, parallelism=1, finished=path, **rest)
    whole = search_cells(pipeline("tree"), grid, rows, "label", 2, "areaUnderROC", pieces=2)
    evaluate, calls = BinaryClassificationEvaluator.evaluate, []

    def stopping(self, df):
        calls.append(1)
        if len(calls) > 4:
            raise RuntimeError("stopped")
        return evaluate(self, df)

    monkeypatch.setattr(BinaryClassificationEvaluator, "evaluate", stopping)
    with pytest.raises(RuntimeError):
        run()
    monkeypatch.setattr(BinaryClassificationEvaluator, "evaluate", evaluate)
    found = run()
    assert (found.fits, found.areas) == (2, whole.areas)
    assert run().fits == 0
    assert sorted(json.loads(f.read_text())["fold"] for f in Path(path).glob("cell-*.json")) == [0, 0, 0, 1, 1, 1]
    with pytest.raises(ValueError):
        run({"maxDepth": (1, 2)})


def test_cells_as_rows_and_the_first_of_the_best(spark, rows):
    found = run_search(pipeline("tree"), {"maxDepth": (3, 2, 3)}, rows.drop("__fold"), "label", "id", 2, "areaUnderROC", search_rows=200)
    cells = found.cells(spark)
    assert cells.count() == 6
    means = [r[0] for r in cells.groupBy("map").agg(F.avg("area")).orderBy("map").select("avg(area)").collect()]
    assert means == pytest.approx(found.means) and means == pytest.approx(found.model.avgMetrics)
    assert found.best == means.index(max(means)) != 2
    assert found.model.bestModel.stages[-1].getOrDefault("maxDepth") == found.maps[found.best]["maxDepth"]


@pytest.mark.parametrize("name", ["forest", "boosted", "svm", "tree", "logistic"])
def test_maps_are_the_cross_product(name):
    flow = FLOWS[name]
    maps = [tuple(str(v) for _, v in sorted((p.name, v) for p, v in m.items())) for m in param_maps(flow_pipeline(flow).getStages()[-1], flow.grid)]
    lists = ", ".join(f"(SELECT unnest({list(map(str, v))}) AS {k})" for k, v in flow.grid.items())
    want = duckdb.connect().execute(f"SELECT {', '.join(sorted(flow.grid))} FROM {lists}").fetchall()
    assert sorted(maps) == sorted(want)
    assert len(maps) == {"forest": 81, "boosted": 81, "svm": 12, "tree": 3, "logistic": 4}[name]


def test_encoders_are_fitted_on_fitting_rows_only(rows):
    """A category that only held-out rows have is unseen there."""
    odd = rows.withColumn("a", F.when((F.col("__fold") == 1) & (F.col("id") % 4 == 0), F.lit("rare")).otherwise(F.col("a")))
    strict = categorical_pipeline(classifier("tree", "label"), "label", strings=("a",), keep=False)
    with pytest.raises(SPARK_ERRORS, match="(?i)unseen"):
        search_cells(strict, {"maxDepth": (2,)}, odd, "label", 2, "areaUnderROC", pieces=2)


def repeated(rows):
    """The rows, some of them two or three times."""
    return rows.withColumn("id", F.explode(F.sequence("id", F.col("id") + F.col("id") % 3)))


def test_boosted_trees_learn_the_same_from_equal_rows_as_weights(rows, monkeypatch):
    """Also where a node needs several rows, which fewer rows with weights may stand for."""
    grid, twice = {"maxDepth": (5,), "minInstancesPerNode": (1, 3, 10, 60)}, repeated(rows).repartition(1).cache()
    run = lambda: search_cells(pipeline("boosted", maxIter=3), grid, twice, "label", 2, "areaUnderPR", pieces=1)
    seen, fit = [], GBTClassifier.fit

    def counting(self, df, params):
        seen.append((df.count(), df.agg(F.sum(search.WEIGHT)).first()[0] if search.WEIGHT in df.columns else None))
        return fit(self, df, params)

    monkeypatch.setattr(GBTClassifier, "fit", counting)
    weighed = run()
    assert {w for _, w in seen} == {float(twice.where(f"__fold <> {fold}").count()) for fold in range(2)}
    assert min(n for n, _ in seen) <= 30 < max(n for n, _ in seen) < twice.count()
    monkeypatch.setattr(search, "learns_from_weights", lambda *_: False)
    plain = run()
    assert {w for _, w in seen[len(weighed.maps) * 2 :]} == {None}
    assert [x for m in weighed.areas for x in m] == pytest.approx([x for m in plain.areas for x in m], abs=1e-9)
    assert len({tuple(m) for m in plain.areas}) > 1


@pytest.mark.parametrize("least", [1, 3, 10])
def test_copies_reach_a_number_of_rows_when_those_they_stand_for_do(spark, least):
    counts = spark.createDataFrame([(k, float(n)) for k, n in enumerate([1, 2, 3, 9, 10, 11, 5000])], f"k int, {search.WEIGHT} double")
    found = search.copies(counts, least).groupBy("k").agg(F.count("*"), F.sum(search.WEIGHT), F.min(search.WEIGHT)).collect()
    assert {k: (n, w) for k, n, w, _ in found} == {k: (min(n, least), n) for k, n in counts.collect()}
    assert all(m >= 1 for *_, m in found)


def test_bins_matter_only_where_features_are_numbers(rows):
    on_off = pipeline("boosted")
    with_number = categorical_pipeline(classifier("boosted", "label"), "label", strings=("a",), numbers=("id",))
    kept = [Pipeline(stages=p.getStages()[:-1]).fit(rows).transform(rows) for p in (on_off, with_number)]
    assert [search.has_numbers(df) for df in kept] == [False, True]
    assert [search.learns_from_weights(classifier("boosted", "label"), df) for df in kept] == [True, False]
    assert not search.learns_from_weights(classifier("boosted", "label", subsamplingRate=0.5), kept[0])
    assert not search.learns_from_weights(classifier("forest", "label"), kept[0])
    many = [Facts(1_000_000, 20, 1_000_000, 1, numbers) for numbers in (False, True)]
    assert [len({fit_key(classifier("forest", "label"), {"maxBins": b}, f) for b in (8, 16, 32)}) for f in many] == [1, 3]
    found = search_cells(on_off, {"maxBins": (2, 8), "maxDepth": (2,)}, rows, "label", 2, "areaUnderROC", pieces=2)
    alone = search_cells(on_off, {"maxBins": (2, 8), "maxDepth": (2,)}, rows, "label", 2, "areaUnderROC", pieces=2, share=False)
    assert found.areas == alone.areas and (found.fits, alone.fits) == (2, 4)


@pytest.mark.parametrize("name", ["cv_gbt", "cv_gbt_areas", "cv_rf_union"])
def test_whole_searches_read_all_rows(spark, monkeypatch, name):
    """More than 5,000 labelled rows: each is in one fold of the search."""
    monkeypatch.setattr(queries_models, "split_base", lambda *_: (many_rows(spark, 7_001), many_rows(spark, 10).drop("Survived")))
    seen = {}

    def cells(pipeline, grid, searched, label, folds, *rest, **options):
        seen.update(rows=searched.count(), keys=searched.select("passenger_id").distinct().count(), folds=folds)
        raise StopIteration

    monkeypatch.setattr(search, "search_cells", cells)
    with pytest.raises(StopIteration):
        QUERIES[name](spark, "")
    assert seen == {"rows": 7_001, "keys": 7_001, "folds": 5}


def many_rows(spark, n):
    cells = {
        "PassengerId": "id", "Survived": "cast(id % 3 = 0 as int)", "Pclass": "cast(id % 3 + 1 as int)", "Name": "concat('X, Mr. ', id)",
        "Sex": "if(id % 2 = 0, 'male', 'female')", "Age": "cast(id % 70 as double)", "SibSp": "cast(id % 4 as int)", "Parch": "0",
        "Ticket": "'T'", "Fare": "cast(id % 50 as double)", "Cabin": "'C1'", "Embarked": "'S'",
    }
    return spark.range(n).selectExpr(*(f"{v} AS {k}" for k, v in cells.items()))
