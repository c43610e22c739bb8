import pytest
from pyspark.sql import functions as F

from featureflow.operators.cluster import assign, centre_sums, extreme_centres, lloyd
from featureflow.plans.positions import POSITION_SCHEMA, cluster_positions
from featureflow.sources.files import read_csv
from tests.conftest import SPARK_ERRORS

AXES = ("x", "y")


@pytest.fixture
def groups(spark):
    noise = F.col("id") % 7 / 10
    return spark.range(400).select(
        F.col("id").cast("string").alias("k"),
        F.when(F.col("id") % 4 == 0, noise).otherwise(10 + noise).alias("x"),
        F.when(F.col("id") % 4 == 0, noise).otherwise(20 - noise).alias("y"),
    )


def test_lloyd_finds_planted_groups(groups):
    centres = lloyd(groups, AXES, extreme_centres(groups, AXES), 5)
    sizes = {r["cluster"]: r["members"] for r in centre_sums(groups, AXES, centres).collect()}
    assert sizes == {0: 100, 1: 300}


def test_inertia_does_not_rise(groups):
    start = [[0.0, 0.0], [1.0, 1.0], [2.0, 0.0]]
    costs = []
    for steps in range(5):
        centres = lloyd(groups, AXES, start, steps)
        costs.append(sum(r["inertia"] for r in centre_sums(groups, AXES, centres).collect()))
    assert all(b <= a + 1e-9 for a, b in zip(costs, costs[1:], strict=False))


def test_tie_goes_to_the_lower_number_and_empty_keeps_its_centre(spark):
    df = spark.createDataFrame([(5.0, 0.0)], "x double, y double")
    assert assign(df, AXES, [[0, 0], [10, 0]]).first()["cluster"] == 0
    assert lloyd(df, AXES, [[0, 0], [100, 100]], 2) == [[5.0, 0.0], [100.0, 100.0]]


def test_null_coordinate_is_an_error(spark):
    df = spark.createDataFrame([(None, 1.0)], "x double, y double")
    with pytest.raises(SPARK_ERRORS):
        assign(df, AXES, [[0, 0], [1, 1]]).collect()


def test_positions_flow(spark, tmp_path):
    lines = [f"{i},{30 + (i % 2) * 5 + i / 1000},{104 - (i % 2) * 5},2118{i % 60:02d}" for i in range(300)]
    (tmp_path / "taxi.csv").write_text("\n".join(lines))
    positions = read_csv(spark, str(tmp_path / "taxi.csv"), schema=POSITION_SCHEMA, header=False)
    model, assigned = cluster_positions(positions)
    assert len(model.stages[-1].clusterCenters()) == 2
    sides = assigned.groupBy((F.col("lat") > 33).alias("north")).agg(F.countDistinct("prediction").alias("n"))
    assert all(r["n"] == 1 for r in sides.collect())
    assert assigned.first()["time"].startswith("2118")
