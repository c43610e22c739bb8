"""Statistics joins and running totals."""

import pytest
from pyspark.sql import functions as F

from featureflow.operators.lookup import attach, find_hot, known_hot, pin, with_row
from featureflow.operators.order import running_totals
from tests.conftest import rows


@pytest.fixture
def skewed(spark):
    """A third of 9,000 rows has key 'hot', 3,000 have key null, the others 3,000 keys."""
    return spark.range(9_000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k"),
    )


def stats_of(df):
    """Statistics for every key but a few."""
    counted = df.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("first_id"))
    return counted.where("k is null or k != '4'")


@pytest.mark.parametrize("limit", [100_000, 10])  # broadcast, spread
def test_attach_both_ways(spark, skewed, limit):
    want = rows(
        skewed.alias("a")
        .join(stats_of(skewed).alias("b"), F.col("a.k").eqNullSafe(F.col("b.k")), "left")
        .select("id", "a.k", "n", "first_id")
    )
    found = attach(skewed, stats_of(skewed), ["k"], salt_by=["id"], rows=limit)
    assert found.columns == ["id", "k", "n", "first_id"]
    assert rows(found) == want


def test_hot_key_without_statistics(spark, skewed):
    """A hot key the statistics do not know stays null and is spread all the same."""
    stats = stats_of(skewed).where("k != 'hot'")
    found = attach(skewed, stats, ["k"], salt_by=["id"], rows=10)
    assert found.count() == 9_000
    assert found.where("k = 'hot' and n is null").count() == 3_000
    tasks = found.where("k = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks >= 1


def test_hot_keys_are_found(spark, skewed):
    hashes = {r[0] for r in spark.createDataFrame([("hot",), (None,)], "k string").select(F.xxhash64("k")).collect()}
    assert set(find_hot(skewed, ["k"])) == hashes
    assert set(known_hot(stats_of(skewed), ["k"], "n")) == hashes
    # None at all, and a share every key reaches.
    assert find_hot(spark.range(5_000), ["id"]) == []
    assert len(find_hot(spark.range(100), ["id"])) == 100


def test_negative_zero_is_zero(spark):
    df = spark.range(4_000).select("id", F.when(F.col("id") % 2 == 0, 0.0).otherwise(-0.0).alias("k"))
    stats = spark.createDataFrame([(0.0, "zero")], "k double, name string")
    assert attach(df, stats, ["k"], salt_by=["id"], rows=0).where("name = 'zero'").count() == 4_000


def test_key_types_must_agree(spark):
    stats = spark.createDataFrame([(1, "one")], "id int, name string")
    with pytest.raises(TypeError):
        attach(spark.range(3), stats, ["id"], rows=0)


def test_pin_checks_rows_and_bytes(spark):
    assert pin(spark.range(10), rows=10)[1]
    assert not pin(spark.range(11), rows=10)[1]
    wide = spark.range(100).select(F.concat_ws("", *[F.sha2(F.concat("id", F.lit(i)), 512) for i in range(20)]))
    assert pin(wide)[1]
    assert not pin(wide, size=50_000)[1]


def test_with_row(spark):
    stats = spark.sql("select 2.5D as a, cast(null as int) as b")
    assert rows(with_row(spark.range(2), stats)) == [(0, 2.5, None), (1, 2.5, None)]


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_running_totals(spark, partitions):
    df = spark.range(500).select(((F.col("id") * 37) % 500).alias("o"), (F.col("id") % 5).alias("v"))
    found = running_totals(df.repartition(partitions), [F.col("o").desc()], {"t": F.col("v"), "r": F.lit(1)})
    pdf = found.toPandas().sort_values("o", ascending=False)
    assert pdf["t"].tolist() == pdf["v"].cumsum().tolist()
    assert pdf["r"].tolist() == list(range(1, 501))


def test_running_totals_by_key(spark):
    """One key spreads over all partitions, the others share one."""
    df = spark.range(2_000).select(
        F.when(F.col("id") < 1_900, "hot").otherwise((F.col("id") % 4).cast("string")).alias("k"), "id"
    )
    found = running_totals(df.repartition(5), [F.col("id").asc()], {"r": F.lit(1)}, by=["k"]).toPandas()
    for _, part in found.sort_values("id").groupby("k"):
        assert part["r"].tolist() == list(range(1, len(part) + 1))
    assert len(found) == 2_000
