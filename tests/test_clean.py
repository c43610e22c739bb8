"""Imputation, splits, folds, unions."""

from pyspark.sql import functions as F

import pytest

from featureflow.operators.impute import (
    TITLE_AGES,
    fill_constants,
    fill_group_medians,
    fill_means,
    fill_numeric_zero,
    fit_group_medians,
    fit_means,
    lookup_value,
    zero_as_null,
)
from featureflow.operators.split import (
    fold_of,
    hash_part,
    random_parts,
    stack_by_name,
    stack_by_position,
)
from tests.conftest import rows


def test_means_come_from_the_fitted_table(spark):
    train = spark.createDataFrame([(10.0, 1.0), (20.0, None)], "a double, b double")
    other = spark.createDataFrame([(None, None), (3.0, 4.0)], "a double, b double")
    assert rows(fill_means(other, fit_means(train, "a", "b"), "a", "b")) == [(3.0, 4.0), (15.0, 1.0)]


def test_constants_and_zero(spark):
    df = spark.createDataFrame([(None, None, None)], "s string, x double, i int")
    assert rows(fill_constants(df, {"s": "S", "x": 0.5})) == [("S", 0.5, None)]
    assert rows(fill_numeric_zero(df)) == [(None, 0.0, 0)]


def test_lookup(spark):
    df = spark.createDataFrame([("Mrs",), ("Judge",), (None,)], "t string")
    assert [r[0] for r in df.select(lookup_value(F.col("t"), TITLE_AGES)).collect()] == [31.0, None, None]
    assert [r[0] for r in df.select(lookup_value(F.col("t"), TITLE_AGES, 30)).collect()] == [31.0, 30.0, 30.0]


def test_zero_as_null(spark):
    df = spark.createDataFrame([(0.0,), (4.0,), (None,)], "x double")
    assert [r[0] for r in df.select(zero_as_null("x")).collect()] == [None, 4.0, None]


def test_group_medians(spark):
    train = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None), (None, 8.0)], "g string, x double")
    other = spark.createDataFrame([("a", None), ("b", None), ("c", None), (None, None), ("a", 7.0)], "g string, x double")
    medians = fit_group_medians(train, "x", ["g"])
    filled = fill_group_medians(other, medians, "x", ["g"])
    assert rows(filled) == [(None, 8.0), ("a", 2.0), ("a", 7.0), ("b", None), ("c", None)]


@pytest.mark.parametrize("seed", [None, 7])
def test_random_parts_are_disjoint_and_complete(spark, seed):
    df = spark.range(1_000).repartition(3)
    parts = [{r[0] for r in p.collect()} for p in random_parts(df, [0.8, 0.3], seed)]
    assert parts[0] | parts[1] == set(range(1_000))
    assert not parts[0] & parts[1]
    assert len(parts[0]) > 2 * len(parts[1])


def test_hash_parts_do_not_depend_on_partitioning(spark):
    df = spark.range(2_000)
    part = hash_part("id", {"train": 60, "valid": 20, "test": 20}).alias("part")
    assert rows(df.repartition(2).select("id", part)) == rows(df.repartition(9).select("id", part))
    shares = {r["part"]: r["count"] / 2_000 for r in df.groupBy(part).count().collect()}
    assert abs(shares["train"] - 0.6) < 0.05 and abs(shares["test"] - 0.2) < 0.05
    with pytest.raises(ValueError):
        hash_part("id", {"train": 60, "test": 30})


def test_folds_are_independent_of_parts(spark):
    df = spark.range(5_000).select(fold_of("id", 5).alias("f"), hash_part("id", {"a": 70, "b": 30}).alias("p"))
    counts = {(r["f"], r["p"]): r["count"] for r in df.groupBy("f", "p").count().collect()}
    assert {f for f, _ in counts} == set(range(5))
    assert all(550 < counts[f, "a"] < 850 for f in range(5))


def test_unions(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "i int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, i int")
    assert rows(stack_by_name(a, b)) == [(1, "x"), (1, "x"), (2, "y")]
    c = spark.createDataFrame([(3, "z")], "other int, name string")
    assert stack_by_position(a, c).columns == ["i", "s"]
    assert stack_by_position(a, c).count() == 3
