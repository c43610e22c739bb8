"""Oversampled starting centres."""

import pytest
from pyspark.sql import functions as F

from featureflow.operators.cluster import extreme_centres, lloyd
from featureflow.operators.seeding import inertia, spread_centres, thin_out
from tests.conftest import SPARK_ERRORS

XY = ["x", "y"]


@pytest.fixture(scope="module")
def groups(spark):
    """Four groups of 150 points, two of them close to the line between the extreme corners' opposites."""
    i = F.col("id")
    noise = lambda n: F.pmod(F.xxhash64("id", F.lit(n)), F.lit(1000)) / 1000.0
    centre = F.get(F.array(*[F.struct(F.lit(float(a)).alias("a"), F.lit(float(b)).alias("b")) for a, b in ((0, 0), (0, 50), (50, 0), (50, 50))]), (i % 4).cast("int"))
    return spark.range(600).select("id", (centre["a"] + noise(1)).alias("x"), (centre["b"] + noise(2)).alias("y"))


def test_one_centre_in_every_group(groups):
    centres = spread_centres(groups, XY, "id", 4)
    assert sorted((round(x, -1), round(y, -1)) for x, y in centres) == [(0, 0), (0, 50), (50, 0), (50, 50)]
    ends = lloyd(groups, XY, centres, 3)
    assert inertia(groups, XY, ends) < 600 * 0.5


def test_the_same_on_any_partitioning(groups):
    once = spread_centres(groups, XY, "id", 3)
    assert spread_centres(groups.repartition(7), XY, "id", 3) == once
    assert spread_centres(groups.orderBy(F.desc("x")).coalesce(1), XY, "id", 3) == once


def test_no_worse_than_the_extreme_values(groups):
    ends = [lloyd(groups, XY, start, 4) for start in (spread_centres(groups, XY, "id", 2), extreme_centres(groups, XY))]
    assert inertia(groups, XY, ends[0]) <= inertia(groups, XY, ends[1]) * 1.01


def test_few_and_equal_rows(spark):
    same = spark.createDataFrame([(i, 1.0, 2.0) for i in range(20)], "id int, x double, y double")
    assert spread_centres(same, XY, "id", 3) == [[1.0, 2.0]]
    two = same.unionByName(spark.createDataFrame([(99, 5.0, 5.0)], same.schema))
    assert sorted(spread_centres(two, XY, "id", 3)) == [[1.0, 2.0], [5.0, 5.0]]
    with pytest.raises(ValueError):
        spread_centres(same.where("false"), XY, "id", 2)
    with pytest.raises(SPARK_ERRORS, match="null in y"):
        spread_centres(two.withColumn("y", F.when(F.col("id") != 3, F.col("y"))), XY, "id", 2)


def test_thinning_takes_weight_and_distance():
    candidates = [[0.0], [1.0], [10.0], [10.5]]
    assert thin_out(candidates, [5, 1, 2, 3], 2) == [[0.0], [10.5]]
    assert thin_out(candidates, [5, 0, 0, 0], 3) == [[0.0]]
