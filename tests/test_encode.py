import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from featureflow.operators.encode import (
    apply_index,
    assembler,
    encode_strings,
    indexer,
    label_index,
    one_hot,
    string_columns,
)
from tests.conftest import SPARK_ERRORS, rows


@pytest.fixture
def labels(spark):
    # b is most frequent; a and c tie.
    return spark.createDataFrame([(v,) for v in "bbbaacc"], "s string")


def test_order_of_labels(labels):
    assert [list(a) for a in indexer(["s"]).fit(labels).labelsArray] == [["b", "a", "c"]]
    assert rows(label_index(labels, "s")) == [("a", 1), ("b", 0), ("c", 2)]


def test_unseen_and_null(spark, labels):
    new = spark.createDataFrame([("a",), ("z",), (None,)], "s string")
    kept = indexer(["s"]).fit(labels).transform(new)
    assert [r["sIndex"] for r in kept.collect()] == [1.0, 3.0, 3.0]
    assert rows(apply_index(new, label_index(labels, "s"), "s", "i")) == [(None, 3), ("a", 1), ("z", 3)]
    with pytest.raises(SPARK_ERRORS):
        indexer(["s"], keep=False).fit(labels).transform(new).collect()
    with pytest.raises(SPARK_ERRORS):
        apply_index(new, label_index(labels, "s"), "s", "i", keep=False).collect()


def test_table_equals_indexer_with_many_labels(spark):
    df = spark.range(5_000).select((F.col("id") * F.col("id") % 997).cast("string").alias("s"))
    model = indexer(["s"]).fit(df)
    want = rows(model.transform(df).select("s", F.col("sIndex").cast("bigint")).distinct())
    assert rows(label_index(df.repartition(5), "s")) == want


@pytest.mark.parametrize(
    ("drop_last", "keep", "width"), [(True, False, 3), (True, True, 4), (False, False, 4), (False, True, 5)]
)
def test_one_hot_widths(spark, drop_last, keep, width):
    """Codes 1..3 make four index values, 0 included."""
    df = spark.createDataFrame([(1,), (2,), (3,)], "i int")
    model = one_hot(["i"], keep=keep, drop_last=drop_last, outputs=["v"]).fit(df)
    vectors = [r[0] for r in model.transform(df).select(vector_to_array("v")).collect()]
    assert {len(v) for v in vectors} == {width}
    unseen = spark.createDataFrame([(4,)], "i int")
    if keep:
        assert len(model.transform(unseen).select(vector_to_array("v")).first()[0]) == width
    else:
        with pytest.raises(SPARK_ERRORS):
            model.transform(unseen).collect()


def test_assembler(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0)], "x double, y double")
    kept = assembler(["x", "y"], keep=True, output="v").transform(df).select(vector_to_array("v")).collect()
    assert kept[0][0] == [1.0, 2.0] and kept[1][0][0] != kept[1][0][0]
    with pytest.raises(SPARK_ERRORS):
        assembler(["x", "y"], output="v").transform(df).collect()
    with pytest.raises(SPARK_ERRORS):
        assembler(["x"], output="v").transform(df.na.fill(float("nan"))).collect()


def test_label_among_features_is_refused():
    with pytest.raises(ValueError):
        assembler(["x", "Survived"], label="survived")


def test_encode_strings_by_type(spark):
    df = spark.createDataFrame([("a", 1, "u"), ("b", 2, "u")], "s string, i int, t string")
    assert string_columns(df) == ["s", "t"]
    encoded = encode_strings(string_columns(df)).fit(df).transform(df)
    assert {"s_idx", "s_enc", "t_idx", "t_enc"} <= set(encoded.columns)
