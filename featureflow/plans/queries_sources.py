"""Queries: scans, sinks, views, projections, splits, unions."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.functions.derive import dense_vector
from featureflow.operators.encode import string_columns, vector_slots
from featureflow.operators.models import linear_score
from featureflow.operators.split import (
    below,
    fold_of,
    from_cutoff,
    hash_part,
    random_parts,
    stack_by_name,
    stack_by_position,
)
from featureflow.plans.positions import POSITION_SCHEMA
from featureflow.plans.registry import query
from featureflow.plans.standin import BASE_SQL, SCHEMAS, base, id_cutoff, split_base, table
from featureflow.session import scratch_path, written_table
from featureflow.sources.files import (
    read_csv,
    read_csv_set_aside,
    read_libsvm,
    register_view,
    write_csv,
    write_libsvm,
    write_predictions,
)
from featureflow.sources.profile import profile_all

# Weights of the linear model the scoring and evaluation queries use.
WEIGHTS = {"Pclass": -0.25, "SibSp": 0.5, "Parch": -0.125, "Fare": 0.0078125}
INTERCEPT = 0.25
MARGIN_SQL = "0.25 + Pclass * (-0.25) + SibSp * 0.5 + Parch * (-0.125) + coalesce(Fare, 0.0) * 0.0078125"


def scored_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in rows with the linear model's margin, probability and prediction."""
    rows = base(spark, sf_dir).withColumn("Fare", F.coalesce("Fare", F.lit(0.0)))
    return rows.withColumn("s", linear_score(WEIGHTS, INTERCEPT)).select("*", "s.*").drop("s")


@query(
    f"""WITH {BASE_SQL}
    SELECT PassengerId, Survived, Pclass, Name, Sex, Age, SibSp, Parch, Ticket, Fare, Cabin, Embarked FROM base"""
)
def scan_csv_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as CSV with header, read back with inferred types; names hold commas and quotes."""
    path = scratch_path(spark, "scan_csv_infer")
    write_csv(base(spark, sf_dir), path, header=True)
    rows = read_csv(spark, path)
    return rows.withColumn("PassengerId", F.col("PassengerId").cast("bigint"))


@query(
    """SELECT CAST(user_id AS VARCHAR) AS tid, value AS lat, event_id / 1000.0::DOUBLE AS lon,
              strftime(ts, '%H%M%S') AS "time" FROM events"""
)
def scan_csv_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions written without header, read with the declared schema."""
    positions = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("tid"),
        F.col("value").alias("lat"),
        (F.col("event_id") / 1000).alias("lon"),
        F.date_format("ts", "HHmmss").alias("time"),
    )
    path = scratch_path(spark, "scan_csv_schema")
    write_csv(positions, path)
    return read_csv(spark, path, schema=POSITION_SCHEMA, header=False)


def _dirty(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders as CSV lines, every 50th with a planted fault, read with the faults set aside."""
    rows, path = table(spark, sf_dir, "orders"), scratch_path(spark, "dirty")
    key = F.col("o_orderkey")
    price = F.when(key % 200 == 50, F.lit("12,5 EUR")).otherwise(F.col("o_totalprice").cast("decimal(20,2)").cast("string"))
    cells = [F.when(key % 200 == 0, F.concat(F.lit("N"), key)).otherwise(key.cast("string")), F.col("o_orderstatus"), price]
    # A cell with a comma of its own makes a line too long; a missing one makes it too short.
    line = F.when(key % 200 == 150, cells[0]).otherwise(F.concat_ws(",", *cells))
    rows.select(line.alias("value")).write.text(path)
    return read_csv_set_aside(spark, path, "o_orderkey bigint, o_orderstatus string, o_totalprice double", header=False)


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 200 NOT IN (0, 50, 150)")
def scan_csv_good_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of CSV files with planted faults that go on: those without one."""
    return _dirty(spark, sf_dir)[0]


@query(
    """SELECT CASE o_orderkey % 200 WHEN 0 THEN 'N' || o_orderkey || ',' || o_orderstatus || ',' || CAST(o_totalprice AS DECIMAL(20, 2))
         WHEN 50 THEN o_orderkey || ',' || o_orderstatus || ',12,5 EUR' ELSE CAST(o_orderkey AS VARCHAR) END AS line, true AS has_file
       FROM orders WHERE o_orderkey % 200 IN (0, 50, 150)"""
)
def scan_csv_set_aside(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The faulty lines as they stand, each with its file."""
    return _dirty(spark, sf_dir)[1].select("line", F.col("file").contains("/dirty-").alias("has_file"))


@query(
    f"""WITH {BASE_SQL}
    SELECT PassengerId, CASE WHEN {MARGIN_SQL} > 0 THEN 1.0::DOUBLE ELSE 0.0 END AS prediction FROM base"""
)
def sink_csv_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions written as headerless CSV, then read back."""
    path = scratch_path(spark, "predictions")
    write_predictions(scored_base(spark, sf_dir), path, key="PassengerId")
    return read_csv(spark, path, schema="PassengerId bigint, prediction double", header=False)


@query(
    f"""WITH {BASE_SQL}
    SELECT Survived::DOUBLE AS label, Pclass::DOUBLE AS x0, SibSp::DOUBLE AS x1, Parch::DOUBLE AS x2,
           coalesce(Fare, 0.0) AS x3 FROM base"""
)
def scan_libsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled vectors written as libsvm text, then read back; zeros are not stored."""
    points = base(spark, sf_dir).select(
        F.col("Survived").cast("double").alias("label"),
        dense_vector("Pclass", "SibSp", "Parch", F.coalesce("Fare", F.lit(0.0))).alias("features"),
    )
    path = scratch_path(spark, "libsvm")
    write_libsvm(points, path)
    rows = read_libsvm(spark, path, features=4).withColumn("x", vector_to_array("features"))
    return rows.select("label", *vector_slots(F.col("x"), 4, "x"))


SQL_VIEW = """SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS rows_n,
  round(avg(l_extendedprice), 4) AS avg_price FROM {view} WHERE l_quantity >= 10
  GROUP BY l_returnflag, l_linestatus"""


@query(SQL_VIEW.format(view="lineitem"))
def sql_temp_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over a registered view."""
    view = register_view(table(spark, sf_dir, "lineitem"), "ff_lineitem")
    return spark.sql(SQL_VIEW.format(view=view))


@query(
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS row_count,"
        f" count(*) - count({c}) AS null_count FROM {t}"
        for t, schema in SCHEMAS.items()
        for c in (column.split()[0] for column in schema.split(","))
    )
)
def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and nulls of every column of every table."""
    return profile_all({name: table(spark, sf_dir, name) for name in SCHEMAS})


@query(
    f"""WITH {BASE_SQL}
    SELECT PassengerId, Age, PassengerId * 2 + SibSp AS twice FROM base"""
)
def project_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns and a computed one."""
    twice = (F.col("PassengerId") * 2 + F.col("SibSp")).alias("twice")
    return base(spark, sf_dir, "PassengerId", "Age", "SibSp").select("PassengerId", "Age", twice)


@query(f"WITH {BASE_SQL} SELECT PassengerId, Survived, Age FROM base, cut WHERE PassengerId < cutoff")
def split_by_id_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows below the id cutoff, through SQL on a view."""
    register_view(base(spark, sf_dir, "PassengerId", "Survived", "Age"), "ff_all_rows")
    register_view(table(spark, sf_dir, "orders"), "ff_orders")
    return spark.sql(
        """SELECT PassengerId, Survived, Age FROM ff_all_rows
           WHERE PassengerId < (SELECT max(o_orderkey) * 2 DIV 3 FROM ff_orders)"""
    )


@query(f"WITH {BASE_SQL} SELECT PassengerId, Fare, Cabin FROM base, cut WHERE PassengerId >= cutoff")
def split_by_id_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows from the id cutoff on."""
    rows = from_cutoff(base(spark, sf_dir), "PassengerId", id_cutoff(spark, sf_dir))
    return rows.select("PassengerId", "Fare", "Cabin")


@query("SELECT l_returnflag, l_linestatus FROM lineitem")
def select_string_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The string columns, picked by type."""
    rows = table(spark, sf_dir, "lineitem")
    return rows.select(string_columns(rows))


@query(
    f"""WITH {BASE_SQL}
    SELECT PassengerId, Survived, Sex FROM base, cut WHERE PassengerId < cutoff
    UNION ALL SELECT PassengerId, -1, Sex FROM base, cut WHERE PassengerId >= cutoff"""
)
def union_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows and scoring rows with label -1 under other names."""
    rows, cutoff = base(spark, sf_dir, "PassengerId", "Survived", "Sex"), id_cutoff(spark, sf_dir)
    train = below(rows, "PassengerId", cutoff)
    score = from_cutoff(rows, "PassengerId", cutoff).select(
        F.col("PassengerId").alias("id"), F.lit(-1).alias("label"), F.col("Sex").alias("s")
    )
    return stack_by_position(train, score)


@query(
    f"""WITH {BASE_SQL}
    SELECT PassengerId, Survived, Sex FROM base, cut WHERE PassengerId < cutoff
    UNION ALL SELECT PassengerId, -1, Sex FROM base, cut WHERE PassengerId >= cutoff"""
)
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows, the second part with its columns in another order."""
    train, score = split_base(spark, sf_dir, "PassengerId", "Survived", "Sex")
    return stack_by_name(
        train,
        score.select("Sex", F.lit(-1).alias("Survived"), "PassengerId"),
    )


@query()
def split_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights 0.8 and 0.3, normalised; every row with the part it fell into."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    train, test = random_parts(rows, [0.8, 0.3], seed=123)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query("SELECT o_orderkey, 1::BIGINT AS parts, true AS same_row, true AS near_share FROM orders")
def split_random_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row is in one part of the random split, unchanged, and the larger part has about its share of all rows."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    # Written: the shares and the rows are read off one split.
    split = written_table(split_random(spark, sf_dir), "split")
    sizes = split.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("part") == "train").alias("train"))
    share, n = sizes.select(F.col("train") / F.col("n")).scalar(), sizes.select("n").scalar()
    # Six standard deviations of a share drawn row by row.
    near = F.abs(share - 8 / 11) <= 6 * F.sqrt(F.lit(8 / 11 * 3 / 11) / n)
    once = split.groupBy("o_orderkey").agg(F.count("part").alias("parts"), F.max("o_totalprice").alias("price"))
    same = F.col("price").eqNullSafe(F.col("o_totalprice"))
    return rows.join(once, "o_orderkey", "left").select("o_orderkey", "parts", same.alias("same_row"), near.alias("near_share"))


HASH_SQL = "CAST('0x' || substr(md5({key}), 1, 7) AS BIGINT) % {buckets}"


@query(
    f"""SELECT o_orderkey, o_totalprice, CASE
      WHEN {HASH_SQL.format(key="CAST(o_orderkey AS VARCHAR)", buckets=100)} < 70 THEN 'train'
      ELSE 'test' END AS part FROM orders"""
)
def split_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """70/30 by the key's md5: the same on any partitioning."""
    part = hash_part("o_orderkey", {"train": 70, "test": 30}).alias("part")
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", part)


@query(
    f"""SELECT o_orderkey, CAST({HASH_SQL.format(key="'fold:' || CAST(o_orderkey AS VARCHAR)", buckets=5)}
        AS INTEGER) AS fold FROM orders"""
)
def kfold_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five stable folds."""
    return table(spark, sf_dir, "orders").select("o_orderkey", fold_of("o_orderkey", 5).alias("fold"))
