import math
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from featureflow.operators.aggregate import (
    approx_median,
    exact_median,
    middle_tally,
    register_middle,
    tally,
)
from tests.conftest import rows

# Few values per window and a coarse sketch: brackets, then running totals over range partitions.
ROUTES = [{}, {"window_rows": 50}, {"window_rows": 1, "accuracy": 100}]


def frame(spark, items):
    return spark.createDataFrame([(float(v) if v is not None else None,) for v in items], "x double")


@pytest.mark.parametrize("route", ROUTES)
@pytest.mark.parametrize(
    ("items", "want"),
    [
        ([3], 3.0),
        ([3, 1, 2], 2.0),
        ([4, 1, 3, 2], 2.5),
        ([1, 2, 4, None], 2.0),
        ([-5, -5, 7, 7], 1.0),
        ([None, None], None),
        ([], None),
        ([1, 1, 1, 1, 9], 1.0),
    ],
)
def test_small_cases(spark, items, want, route):
    assert exact_median(frame(spark, items), "x", **route).first()[0] == want


@pytest.mark.parametrize("route", ROUTES)
def test_nan_sorts_last(spark, route):
    nan, inf = float("nan"), float("inf")
    assert exact_median(frame(spark, [1, 2, nan]), "x", **route).first()[0] == 2.0
    assert math.isnan(exact_median(frame(spark, [1, nan, nan]), "x", **route).first()[0])
    assert exact_median(frame(spark, [inf, inf, nan, 1]), "x", **route).first()[0] == inf


@pytest.mark.parametrize("route", ROUTES)
def test_hot_key_null_key_and_empty_key(spark, route):
    """One key holds a third of the rows; another has nulls only; one is null."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, (F.col("id") % 50).cast("string")).alias("g"),
        ((F.col("id") * 7919) % 10_007 / 3).alias("x"),
    )
    df = df.unionByName(spark.createDataFrame([("empty", None)] * 3, "g string, x double")).repartition(6)
    want = df.groupBy("g").agg(F.median("x").alias("median"))
    assert rows(exact_median(df, "x", ["g"], **route)) == rows(want)


@pytest.mark.parametrize("route", ROUTES)
def test_hot_key_of_nulls(spark, route):
    """A key that is large through its nulls, next to ordinary ones."""
    df = spark.range(3_000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 40).cast("string")).alias("g"),
        F.when((F.col("id") % 3 == 0) | (F.col("id") % 300 == 1), F.col("id") / 7).alias("x"),
    )
    assert rows(exact_median(df, "x", ["g"], **route)) == rows(df.groupBy("g").agg(F.median("x")))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=200), st.sampled_from(ROUTES))
def test_against_statistics(spark, items, route):
    assert exact_median(frame(spark, items), "x", **route).first()[0] == statistics.median(items)


def test_approx_rank_error(spark):
    df = spark.range(1, 100_001).select(F.col("id").cast("double").alias("x")).repartition(8)
    value = approx_median(df, "x", accuracy=100).first()[0]
    assert abs(value - 50_000) <= 100_000 / 100


def test_registered_aggregate(spark):
    df = spark.createDataFrame([("a", 1.0)] * 3 + [("a", 9.0)] * 3 + [("b", 2.0), ("b", None)], "g string, x double")
    name = register_middle(spark, "middle_test")
    tally(df, "x", ["g"]).createOrReplaceTempView("tallied")
    found = spark.sql(f"SELECT g, {name}(x, n) FROM tallied GROUP BY g")
    assert rows(found) == [("a", 5.0), ("b", 2.0)]


def test_middle_tally_is_small_and_keeps_the_middle(spark):
    df = spark.range(200_001).select((F.col("id") % 2).alias("g"), F.pmod(F.col("id") * 7919, F.lit(200_003)).cast("double").alias("x"))
    tallied = middle_tally(df, "x", ["g"])
    assert tallied.count() < 500
    found = tallied.groupBy("g").agg(F.percentile("x", F.lit(0.5), F.col("n")).alias("m"))
    assert rows(found) == rows(df.groupBy("g").agg(F.median("x")))
