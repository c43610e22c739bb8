from pyspark.sql import functions as F

from featureflow import session
from featureflow.session import input_bytes, scratch_path, shared_dir, spread, written_table
from tests.conftest import SMALL_SF_DIR, rows


def test_shared_dir_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == spark.sparkContext.getCheckpointDir()
    if named:
        assert named in shared_dir(spark)
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_written_table_keeps_rows_and_types(spark):
    df = spark.createDataFrame([(1, "a", [1.0]), (2, None, [])], "i int, s string, v array<double>")
    again = written_table(df, "test")
    assert again.dtypes == df.dtypes
    assert rows(again.select("i", "s")) == rows(df.select("i", "s"))


def test_spread_moves_small_inputs_only(spark, monkeypatch):
    orders = spark.read.parquet(f"{SMALL_SF_DIR}/orders.parquet")
    assert 0 < input_bytes(orders) < 10_000_000
    assert "Exchange" in spread(orders, "o_orderkey")._jdf.queryExecution().toString()
    monkeypatch.setattr("featureflow.session.CORE_BYTES", 1)
    assert spread(orders, "o_orderkey") is orders


def test_pieces_of_a_training_table_follow_its_rows(spark, monkeypatch):
    """What one task reads is bounded: more rows make more pieces, not larger ones."""
    monkeypatch.setattr(session, "TRAIN_PIECE_ROWS", 50)
    sizes = {}
    for n in (40, 1_000):
        pieces = session.training_table(spark.range(n), "train", "id").withColumn("piece", F.spark_partition_id())
        sizes[n] = [r["count"] for r in pieces.groupBy("piece").count().collect()]
        assert sum(sizes[n]) == n
    assert len(sizes[40]) <= session.TRAIN_PARTS and len(sizes[1_000]) == 20 and max(sizes[1_000]) < 100
    assert session.pieces_for(1_000, parts=30) == 30 and session.pieces_for(1_000, piece_rows=10) == 100
