"""Records, models, searches and files, on invented passengers with a planted signal."""

import csv

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from featureflow.operators.impute import fit_means
from featureflow.operators.search import param_maps
from featureflow.operators.models import classifier
from featureflow.plans.passengers import (
    FLOWS,
    PASSENGER_SCHEMA,
    SCORING_SCHEMA,
    Cleaning,
    banded_record,
    fit_flow,
    fit_statistics,
    labelled_points,
    plain_record,
    records,
    run_flow,
    title_medians,
)
from featureflow.sources.files import read_csv, write_csv, write_predictions
from featureflow.sources.profile import table_profile
from tests.conftest import SPARK_ERRORS, rows

TITLES = ["Mr.", "Mrs.", "Master.", "Dr.", "Miss."]


def passenger(i):
    male = i % 3 != 0
    return [
        i, int(not male) if i % 17 else int(male), i % 3 + 1, f'Ashby, {TITLES[i % 5]} A "{i}"',
        "male" if male else "female", None if i % 6 == 0 else (i * 13 % 80) + 0.5, i % 4, i % 3, f"T{i}",
        None if i % 50 == 0 else (i * 7 % 60) / 1.5, None if i % 4 else "BCD"[i % 3] + str(i),
        None if i % 40 == 0 else "SCQ"[i % 3],
    ]


@pytest.fixture(scope="module")
def passengers(spark):
    return spark.createDataFrame([tuple(passenger(i)) for i in range(1, 601)], PASSENGER_SCHEMA)


@pytest.fixture(scope="module")
def halves(passengers):
    return passengers.where("PassengerId <= 400"), passengers.where("PassengerId > 400").drop("Survived")


def test_plain_record(spark, passengers):
    means = fit_means(passengers, "Age", "Fare")
    record = plain_record(passengers, means)
    assert record.columns == [
        "passenger_id", "survived", "title", "pclass", "sex", "age", "family_band", "fare", "cabin", "embarked",
    ]
    found = record.where("passenger_id = 600").first()
    mean = passengers.agg(F.avg("Age")).first()[0]
    assert found["age"] == pytest.approx(mean) and found["fare"] == 0.0
    assert found["embarked"] == "S"
    assert record.where("passenger_id = 1").first()["cabin"] == "Unknown"
    assert plain_record(passengers.drop("Survived"), means).first()["survived"] == 0


def test_banded_record(passengers):
    means = fit_means(passengers, "Age", "Fare")
    record = banded_record(passengers, means)
    # Without an age: "Dr." -> Officer -> 36 -> band 3.
    assert record.where("passenger_id = 18").first()["age_band"] == 3
    assert {r[0] for r in record.select("cabin").distinct().collect()} <= {"B", "C", "D", "U"}
    assert banded_record(passengers.drop("Survived"), means).first()["survived"] == -1


def test_zero_is_null(passengers):
    means = fit_means(passengers, "Fare")
    zeroed = passengers.na.fill({"Age": 0.0})
    assert banded_record(zeroed, means).where("passenger_id = 18").first()["age_band"] == 7
    assert banded_record(zeroed, means, zero_is_null=True).where("passenger_id = 18").first()["age_band"] == 3


def test_ages_from_medians(passengers):
    ages = sorted(r["Age"] for r in passengers.where("Name LIKE '%Dr.%' AND Age IS NOT NULL").collect())
    middle = (ages[(len(ages) - 1) // 2] + ages[len(ages) // 2]) / 2
    found = title_medians(passengers)
    assert found["Officer"] == middle
    record = banded_record(passengers, {"Fare": 1.0}, ages={**found, "Officer": 15.0})
    assert record.where("passenger_id = 18").first()["age_band"] == 1
    # A title group without any age has no median; its ages stay unknown.
    assert title_medians(passengers.where("Age IS NULL")) == {}
    assert banded_record(passengers, {"Fare": 1.0}, ages={}).where("passenger_id = 18").first()["age_band"] == 7


def test_switches_reach_the_flow(passengers, halves):
    zeroed = passengers.na.fill({"Age": 0.0})
    flow, cleaning = FLOWS["logistic"], Cleaning(zero_is_null=True)
    assert fit_statistics(flow, zeroed, cleaning) == fit_statistics(flow, passengers)
    fitted = fit_statistics(flow, passengers)
    assert rows(records(flow, zeroed, fitted, cleaning)) == rows(records(flow, passengers, fitted))
    words = passengers.withColumn("Name", F.lit("Colvin, Mr. A"))
    for match, title in (("substring", "Officer"), ("word", "Mr")):
        assert records(flow, words, fitted, Cleaning(match)).first()["title"] == title
    train, score = halves
    assert run_flow("forest_union", train, score, fit_on="all", cleaning=Cleaning(age_from="median")).count() == 200
    with pytest.raises(ValueError, match="banded"):
        run_flow("logistic", train, score, cleaning=Cleaning(age_from="median"))
    with pytest.raises(ValueError, match="age_from"):
        Cleaning(age_from="mode")


def test_means_are_held_still(spark, tmp_path):
    """A mean fitted once stays, also when its table has other rows later."""
    path = str(tmp_path / "ages")
    spark.createDataFrame([(1.0,), (3.0,)], "Age double").write.parquet(path)
    means = fit_means(spark.read.parquet(path), "Age")
    spark.createDataFrame([(100.0,)], "Age double").write.mode("append").parquet(path)
    assert means == {"Age": 2.0}
    assert fit_means(spark.createDataFrame([], "Age double"), "Age") == {"Age": None}


def test_labelled_points(passengers):
    first = labelled_points(passengers, fit_means(passengers, "Age")).where("passenger_id = 1")
    assert first.select("label", vector_to_array("features")).first() == (0.0, [2.0, 1.0, 13.5, 1.0, 1.0, 7 / 1.5])


@pytest.mark.parametrize("name", sorted(FLOWS))
def test_flow_beats_the_majority(passengers, halves, name):
    params = {"maxIter": {"boosted": 5, "svm": 20}[name]} if name in ("boosted", "svm") else {}
    scored = run_flow(name, *halves, **params)
    truth = passengers.select(F.col("PassengerId").alias("passenger_id"), F.col("Survived").alias("truth"))
    joined = scored.drop("survived").join(truth, "passenger_id")
    right = joined.agg(F.avg((F.col("truth") == F.col("prediction")).cast("double"))).first()[0]
    most = joined.agg(F.greatest(F.avg("truth"), 1 - F.avg("truth"))).first()[0]
    assert joined.count() == 200
    assert right > most + 0.1


def test_unseen_category_when_scoring(spark, halves):
    train, score = halves
    odd = score.withColumn("Embarked", F.lit("X"))
    assert run_flow("forest", train, odd).where("prediction is null").count() == 0


def test_fit_on_all_moves_the_means(halves):
    train, score = halves
    with pytest.raises(ValueError):
        run_flow("forest_union", train, score, fit_on="score")
    assert run_flow("forest_union", train, score, fit_on="all").count() == 200


@pytest.mark.parametrize("search", ["quick", "full"])
def test_search(halves, search):
    assert run_flow("tree", *halves, search=search).count() == 200


def test_search_reports_every_combination(halves):
    model = fit_flow("tree", halves[0], "full", search_rows=300)
    areas = model.avgMetrics
    assert len(areas) == len(model.getEstimatorParamMaps()) == 3
    assert all(0.5 < a <= 1 for a in areas)
    best = model.getEstimatorParamMaps()[areas.index(max(areas))]
    tree = model.bestModel.stages[-1]
    assert {p.name: v for p, v in best.items()} == {"maxDepth": tree.getOrDefault("maxDepth")}


def test_fit_does_not_depend_on_the_cluster(spark, halves):
    """The same forest, whatever the splits of the scans and the partitions of the shuffles."""
    train, score = halves
    settings = {"spark.sql.files.maxPartitionBytes": "4k", "spark.sql.files.openCostInBytes": "1", "spark.sql.shuffle.partitions": "7"}

    def probabilities(df):
        scored = run_flow("forest", df, score)
        return rows(scored.select("passenger_id", vector_to_array("probability")[1]))

    want = probabilities(train)
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        assert probabilities(train.repartition(5, "Fare")) == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_full_grids():
    sizes = {
        name: len(param_maps(classifier(flow.model, "survived"), flow.grid)) for name, flow in FLOWS.items() if flow.folds
    }
    assert sizes == {"forest": 81, "logistic": 4, "forest_union": 81, "svm": 12, "boosted": 81, "tree": 3}


def test_csv_with_quotes_and_modes(spark, passengers, tmp_path):
    path = tmp_path / "train.csv"
    with path.open("w", newline="") as file:
        writer = csv.writer(file)
        writer.writerow([c.split()[0] for c in PASSENGER_SCHEMA.split(", ")])
        writer.writerows(passenger(i) for i in range(1, 51))
    inferred = read_csv(spark, str(path))
    assert dict(inferred.dtypes) == dict(passengers.dtypes)
    assert rows(inferred) == rows(passengers.where("PassengerId <= 50"))
    declared = read_csv(spark, str(path), schema=PASSENGER_SCHEMA)
    assert rows(declared) == rows(inferred)
    assert "Survived" not in SCORING_SCHEMA

    scored = spark.createDataFrame([(1, 1.0), (2, 0.0)], "passenger_id int, prediction double")
    out = str(tmp_path / "out")
    write_predictions(scored, out, key="passenger_id")
    assert rows(read_csv(spark, out, schema="i int, p double", header=False)) == [(1, 1.0), (2, 0.0)]
    with pytest.raises(SPARK_ERRORS):
        write_predictions(scored, out, key="passenger_id")
    write_csv(scored, out, header=True, mode="overwrite")
    assert read_csv(spark, out).count() == 2


def test_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert rows(table_profile(df, "t")) == [("t", "a", 2, 0), ("t", "b", 2, 1)]


def test_command_line(spark, passengers, tmp_path):
    from featureflow.__main__ import main

    train, score = str(tmp_path / "train"), str(tmp_path / "score")
    write_csv(passengers.where("PassengerId <= 400"), train, header=True)
    write_csv(passengers.where("PassengerId > 400").drop("Survived"), score, header=True)
    out = str(tmp_path / "out")
    main(["survival", "--model", "tree", "--train", train, "--score", score, "--out", out])
    assert read_csv(spark, out, schema="i int, p double", header=False).where("p in (0, 1)").count() == 200
    main(["median", "--input", train, "--column", "Fare", "--by", "Sex", "--out", str(tmp_path / "medians")])
    medians = read_csv(spark, str(tmp_path / "medians"))
    want = passengers.where("PassengerId <= 400").groupBy("Sex").agg(F.median("Fare").alias("median"))
    assert rows(medians) == rows(want)
