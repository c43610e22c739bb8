import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from featureflow.functions.derive import (
    TITLE_RULES,
    age_band,
    code_initial,
    dense_vector,
    fare_band,
    first_match,
    flag_equals,
    size_band,
    title_of,
)


def values(spark, kind, items, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_age_band_edges(spark):
    ages = [None, -1.0, 0.0, 0.5, 10.5, 11.0, 20.5, 21.0, 31.0, 41.0, 51.0, 61.0, 70.9, 71.0, 200.0, float("nan")]
    assert values(spark, "double", ages, age_band("x")) == [7, 7, 7, 0, 0, 1, 1, 2, 3, 4, 5, 6, 6, 7, 7, 7]


def test_fare_band_edges(spark):
    fares = [None, -1.0, 0.0, 7.99, 8.0, 14.99, 15.0, 31.99, 32.0]
    assert values(spark, "double", fares, fare_band("x")) == [3, 3, 0, 0, 1, 1, 2, 2, 3]


def test_size_bands_differ_at_four(spark):
    sizes = [0, 1, 2, 3, 4, 5]
    assert values(spark, "int", sizes, size_band(F.col("x"), 4)) == [1, 1, 2, 2, 2, 3]
    assert values(spark, "int", sizes, size_band(F.col("x"), 3)) == [1, 1, 2, 2, 3, 3]


def test_titles_first_rule_wins(spark):
    names = [
        "Ashby, Dr. Ann", "Ashby, Lady. Ann", "Ashby, Mrs. Ann", "Ashby, Mlle. Ann", "Ashby, Mr. Al",
        "Ashby, Master. Al", "Ashby, Miss. Ann", "Colvert, Mr. Al", "Ashby, mr. al", "", None,
    ]
    assert values(spark, "string", names, title_of("x")) == [
        "Officer", "Royalty", "Mrs", "Miss", "Mr", "Master", "Anyone", "Officer", "Anyone", "Anyone", "Anyone",
    ]
    by_word = values(spark, "string", names[7:8], title_of("x", match="word"))
    assert by_word == ["Mr"]


def test_rules_can_be_extended(spark):
    rules = (*TITLE_RULES[:3], ("Miss", ("Mlle", "Miss")), *TITLE_RULES[4:])
    assert values(spark, "string", ["Ashby, Miss. Ann"], first_match("x", rules, "Anyone")) == ["Miss"]


def test_unknown_match_mode():
    with pytest.raises(ValueError):
        first_match("x", TITLE_RULES, "Anyone", match="prefix")


def test_code_initial_and_flag(spark):
    assert values(spark, "string", ["C85", "", None], code_initial("x")) == ["C", "", "U"]
    assert values(spark, "string", ["male", "Male", None], flag_equals("x", "male")) == [1.0, 0.0, 0.0]


def test_dense_vector(spark):
    assert values(spark, "int", [3], vector_to_array(dense_vector("x", F.col("x") / 2))) == [[3.0, 1.5]]
