"""Queries: indexes, one-hot vectors, assembled vectors, clusters."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.operators.cluster import assign, centre_sums, extreme_centres, lloyd
from featureflow.operators.encode import (
    apply_index,
    assembler,
    encode_strings,
    indexer,
    label_index,
    one_hot,
    string_columns,
    vector_slots,
)
from featureflow.operators.indexing import TableIndexer
from featureflow.operators.lookup import join_table
from featureflow.operators.seeding import inertia, spread_centres
from featureflow.plans.positions import cluster_positions
from featureflow.plans.registry import query
from featureflow.plans.standin import BASE_SQL, base, customers, table
from featureflow.session import scratch_path
from featureflow.sources.files import load_model, save_pipeline

# Label numbers by falling frequency, ties by label; null is one number more.
EMBARKED_INDEX_SQL = """idx AS (SELECT Embarked AS label,
    row_number() OVER (ORDER BY count(*) DESC, Embarked) - 1 AS i FROM base WHERE Embarked IS NOT NULL GROUP BY Embarked),
  coded AS (SELECT base.*, coalesce(i, (SELECT count(*) FROM idx)) AS i FROM base LEFT JOIN idx ON Embarked = label)"""


NAME_INDEX_SQL = """WITH idx AS (SELECT c_name AS label, row_number() OVER (ORDER BY count(*) DESC, c_name) - 1 AS i
         FROM orders JOIN customer ON o_custkey = c_custkey
         WHERE o_orderstatus = 'F' GROUP BY c_name)
       SELECT o_orderkey, coalesce(i, (SELECT count(*) FROM idx)) AS name_index
       FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN idx ON c_name = label"""


def _slots_sql(index: str, width: int, prefix: str = "e") -> str:
    return ", ".join(
        f"CASE WHEN {index} = {s} THEN 1.0::DOUBLE ELSE 0.0 END AS {prefix}{s}" for s in range(width)
    )


def _unpacked(df: DataFrame, vector: str, width: int, *keys: str, prefix: str = "e") -> DataFrame:
    arrays = df.withColumn("__a", vector_to_array(vector))
    return arrays.select(*keys, *vector_slots(F.col("__a"), width, prefix))


def _embarked_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = base(spark, sf_dir, "PassengerId", "Embarked")
    return indexer(["Embarked"], keep=True).fit(rows).transform(rows)


@query(
    f"""WITH {BASE_SQL}, {EMBARKED_INDEX_SQL}
    SELECT PassengerId, i::DOUBLE AS EmbarkedIndex FROM coded"""
)
def string_index_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label numbers; null gets the number after the last label."""
    return _embarked_index(spark, sf_dir).select("PassengerId", "EmbarkedIndex")


@query(
    """WITH idx AS (SELECT o_orderpriority AS label,
         row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS i FROM orders GROUP BY 1)
       SELECT o_orderkey, i::DOUBLE AS o_orderpriorityIndex FROM orders JOIN idx ON o_orderpriority = label"""
)
def string_index_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label numbers; an unseen label would be an error."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    model = indexer(["o_orderpriority"], keep=False).fit(rows)
    return model.transform(rows).select("o_orderkey", "o_orderpriorityIndex")


@query(NAME_INDEX_SQL)
def string_index_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by a pipeline stage whose labels are a table, fitted, saved and loaded again."""
    named = join_table(table(spark, sf_dir, "orders"), customers(spark, sf_dir), ["o_custkey"], salt_by=["o_orderkey"])
    indexer_ = TableIndexer(inputCols=["c_name"], outputCols=["name_index"], handleInvalid="keep")
    path = scratch_path(spark, "indexer")
    save_pipeline(Pipeline(stages=[indexer_]).fit(named.where("o_orderstatus = 'F'")), path)
    return load_model(path).transform(named).select("o_orderkey", F.col("name_index").cast("bigint").alias("name_index"))


@query(NAME_INDEX_SQL)
def string_index_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same numbering for any number of labels: names of customers with filled orders."""
    orders = table(spark, sf_dir, "orders")
    named = join_table(orders, customers(spark, sf_dir), ["o_custkey"], salt_by=["o_orderkey"])
    rows = named.select("o_orderkey", "o_orderstatus", "c_name")
    index = label_index(rows.where("o_orderstatus = 'F'"), "c_name")
    return apply_index(rows, index, "c_name", "name_index", salt_by=["o_orderkey"]).select(
        "o_orderkey", "name_index"
    )


@query(f"WITH {BASE_SQL}, {EMBARKED_INDEX_SQL} SELECT PassengerId, {_slots_sql('i', 6)} FROM coded")
def one_hot_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5 labels and the null number, last slot of the kept width dropped: 6 slots."""
    rows = _embarked_index(spark, sf_dir)
    model = one_hot(["EmbarkedIndex"], keep=True, outputs=["v"]).fit(rows)
    return _unpacked(model.transform(rows), "v", 6, "PassengerId")


@query(f"WITH {BASE_SQL}, {EMBARKED_INDEX_SQL} SELECT PassengerId, {_slots_sql('i', 7)} FROM coded")
def one_hot_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nothing dropped: 7 slots."""
    rows = _embarked_index(spark, sf_dir)
    model = one_hot(["EmbarkedIndex"], keep=True, drop_last=False, outputs=["v"]).fit(rows)
    return _unpacked(model.transform(rows), "v", 7, "PassengerId")


@query(f"WITH {BASE_SQL}, {EMBARKED_INDEX_SQL} SELECT PassengerId, {_slots_sql('i', 5)} FROM coded")
def one_hot_drop_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defaults: the last category is all zeros."""
    rows = _embarked_index(spark, sf_dir)
    model = one_hot(["EmbarkedIndex"], keep=False, outputs=["v"]).fit(rows)
    return _unpacked(model.transform(rows), "v", 5, "PassengerId")


@query(f"WITH {BASE_SQL} SELECT PassengerId, {_slots_sql('Pclass', 6)} FROM base")
def one_hot_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Integer codes 1..5 encoded without an index: 0 has a slot too."""
    rows = base(spark, sf_dir, "PassengerId", "Pclass")
    model = one_hot(["Pclass"], keep=True, outputs=["v"]).fit(rows)
    return _unpacked(model.transform(rows), "v", 6, "PassengerId")


def _line_index_sql(column: str) -> str:
    return (
        f"(SELECT {column} AS label, row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS i"
        f" FROM lineitem GROUP BY 1)"
    )


@query(
    f"""SELECT l_orderkey, l_linenumber, {_slots_sql("f.i", 3, "flag")}, {_slots_sql("s.i", 2, "status")}
    FROM lineitem JOIN {_line_index_sql("l_returnflag")} f ON l_returnflag = f.label
    JOIN {_line_index_sql("l_linestatus")} s ON l_linestatus = s.label"""
)
def auto_encode_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every string column indexed and one-hot encoded, found by type."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    columns = string_columns(rows)
    encoded = encode_strings(columns).fit(rows).transform(rows)
    flags, states = vector_to_array("l_returnflag_enc"), vector_to_array("l_linestatus_enc")
    return encoded.select(
        "l_orderkey", "l_linenumber", *vector_slots(flags, 3, "flag"), *vector_slots(states, 2, "status")
    )


@query(f"WITH {BASE_SQL} SELECT PassengerId, Age AS x0, Fare AS x1, SibSp::DOUBLE AS x2 FROM base")
def assemble_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null becomes NaN in the vector; shown as null again."""
    rows = base(spark, sf_dir, "PassengerId", "Age", "Fare", "SibSp")
    vectors = assembler(["Age", "Fare", "SibSp"], keep=True, output="v").transform(rows)
    slots = _unpacked(vectors, "v", 3, "PassengerId", prefix="x")
    return slots.select("PassengerId", *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in ("x0", "x1", "x2")])


@query(
    f"""WITH {BASE_SQL}
    SELECT PassengerId, coalesce(Age, 30.0) AS x0, coalesce(Fare, 0.0) AS x1, SibSp::DOUBLE AS x2 FROM base"""
)
def assemble_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After filling, the strict assembler accepts every row."""
    rows = base(spark, sf_dir, "PassengerId", "Age", "Fare", "SibSp")
    vectors = assembler(["Age", "Fare", "SibSp"], output="v").transform(rows.na.fill({"Age": 30.0, "Fare": 0.0}))
    return _unpacked(vectors, "v", 3, "PassengerId", prefix="x")


CLUSTER_COLUMNS = ("l_quantity", "l_extendedprice")


def _distance_sql(point: str, centre: str) -> str:
    return (
        f"({point}.l_quantity - {centre}.l_quantity) * ({point}.l_quantity - {centre}.l_quantity)"
        f" + ({point}.l_extendedprice - {centre}.l_extendedprice) * ({point}.l_extendedprice - {centre}.l_extendedprice)"
    )


def _lloyd_sql(steps: int) -> str:
    """Centres c0 (minima, maxima) to c<steps>, as chained tables."""
    parts = [
        """c0 AS (SELECT min(l_quantity) AS l_quantity, min(l_extendedprice) AS l_extendedprice, 0 AS cluster,
            count(*) AS members FROM lineitem UNION ALL
            SELECT max(l_quantity), max(l_extendedprice), 1, count(*) FROM lineitem)"""
    ]
    for n in range(steps):
        parts.append(
            f"""c{n + 1} AS (SELECT avg(l_quantity) AS l_quantity, avg(l_extendedprice) AS l_extendedprice,
                cluster, count(*) AS members FROM (SELECT p.l_quantity, p.l_extendedprice,
                CASE WHEN {_distance_sql("p", "a")} <= {_distance_sql("p", "b")} THEN 0 ELSE 1 END AS cluster
                FROM lineitem p, c{n} a, c{n} b WHERE a.cluster = 0 AND b.cluster = 1) GROUP BY cluster)"""
        )
    return ", ".join(parts)


@query(
    f"""WITH {_lloyd_sql(4)}
    SELECT cluster, round(l_quantity, 4) AS l_quantity, round(l_extendedprice, 4) AS l_extendedprice, members FROM c4"""
)
def kmeans_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four Lloyd steps from the corner centres."""
    rows = table(spark, sf_dir, "lineitem")
    centres = lloyd(rows, CLUSTER_COLUMNS, extreme_centres(rows, CLUSTER_COLUMNS), 3)
    last = centre_sums(rows.select(*CLUSTER_COLUMNS), CLUSTER_COLUMNS, centres)
    return last.select("cluster", *[F.round(c, 4).alias(c) for c in CLUSTER_COLUMNS], "members")


@query(
    f"""WITH {_lloyd_sql(2)}
    SELECT p.l_orderkey, p.l_linenumber,
      CASE WHEN {_distance_sql("p", "a")} <= {_distance_sql("p", "b")} THEN 0 ELSE 1 END AS cluster,
      round(sqrt(least({_distance_sql("p", "a")}, {_distance_sql("p", "b")})), 4) AS distance
    FROM lineitem p, c2 a, c2 b WHERE a.cluster = 0 AND b.cluster = 1"""
)
def kmeans_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row with its nearest centre after two steps."""
    rows = table(spark, sf_dir, "lineitem")
    centres = lloyd(rows, CLUSTER_COLUMNS, extreme_centres(rows, CLUSTER_COLUMNS), 2)
    assigned = assign(rows, CLUSTER_COLUMNS, centres)
    return assigned.select(
        "l_orderkey", "l_linenumber", "cluster", F.round(F.sqrt("distance2"), 4).alias("distance")
    )


@query()
def kmeans_mllib(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k-means fitted on 70% of the orders' lines, the others assigned."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *CLUSTER_COLUMNS)
    _, assigned = cluster_positions(rows, CLUSTER_COLUMNS, key="l_orderkey")
    return assigned.select("l_orderkey", "l_linenumber", "prediction")


@query("SELECT l_orderkey, l_linenumber, true AS is_nearest FROM lineitem")
def kmeans_seeded_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row's centre, from an oversampled start and four steps, against its distances from all three centres."""
    rows = table(spark, sf_dir, "lineitem").withColumn("line", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    centres = lloyd(rows, CLUSTER_COLUMNS, spread_centres(rows, CLUSTER_COLUMNS, "line", 3), 4)
    assigned = assign(rows, CLUSTER_COLUMNS, centres)
    apart = [sum((F.col(c) - F.lit(x)) ** 2 for c, x in zip(CLUSTER_COLUMNS, centre, strict=True)) for centre in centres]
    own = F.get(F.array(*apart), F.col("cluster"))
    return assigned.select("l_orderkey", "l_linenumber", (own <= F.least(*apart) * (1 + 1e-12)).alias("is_nearest"))


@query("SELECT count(*) AS rows_n, true AS no_worse FROM lineitem")
def kmeans_seeded_inertia(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two oversampled starting centres leave no larger inertia than the extreme values do."""
    rows = table(spark, sf_dir, "lineitem").withColumn("line", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    starts = (spread_centres(rows, CLUSTER_COLUMNS, "line", 2), extreme_centres(rows, CLUSTER_COLUMNS))
    seeded, extreme = (inertia(rows, CLUSTER_COLUMNS, s) for s in starts)
    return rows.agg(F.count(F.lit(1)).alias("rows_n")).withColumn("no_worse", F.lit(bool(seeded <= extreme)))
