"""Passenger-shaped rows from the orders and customer tables.

Those tables hold no nulls, so some cells are blanked by key; every order stays a row. ``BASE_SQL``
is the same table in portable SQL, for checking.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.operators.lookup import join_table

# Titles by customer key; one per rule, a few common ones repeated, one that no rule knows.
TITLES = ("Mr.", "Mrs.", "Miss.", "Master.", "Dr.", "Lady.", "Mlle.", "Rev.", "Ms.", "Don.")


# Declared, so that opening a table costs no job that reads footers.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _blank(value: Column, key: str, every: int) -> Column:
    return F.when(F.col(key) % every != 0, value)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer cells under the key that orders carry."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_acctbal", "c_mktsegment"
    )


def base(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """One passenger-shaped row per order, with the given columns or all of them.

    Customers are joined only for the columns that come from them.
    """
    title = F.element_at(F.array(*map(F.lit, TITLES)), (F.col("o_custkey") % len(TITLES) + 1).cast("int"))
    age = F.when(F.col("o_orderkey") % 11 == 0, 0.0).otherwise(F.col("o_totalprice") / 5000)
    cells = {
        "PassengerId": F.col("o_orderkey"),
        "Survived": F.when(F.col("o_orderstatus") == "F", 1).otherwise(0),
        "Pclass": F.substring("o_orderpriority", 1, 1).cast("int"),
        "Name": F.concat("c_name", F.lit(", "), title, F.lit(' "'), F.initcap("c_mktsegment"), F.lit('"')),
        "Sex": F.when(F.col("o_totalprice") < 250000, "male").otherwise("female"),
        "Age": _blank(age, "o_orderkey", 5),
        "SibSp": (F.col("o_orderkey") % 4).cast("int"),
        "Parch": (F.col("o_custkey") % 4).cast("int"),
        "Ticket": F.concat(F.lit("T"), F.col("o_orderkey").cast("string")),
        "Fare": _blank(F.col("c_acctbal") / 100, "o_custkey", 7),
        "Cabin": _blank(F.col("c_mktsegment"), "o_custkey", 4),
        "Embarked": _blank(F.col("o_orderpriority"), "o_orderkey", 13),
    }
    wanted = columns or tuple(cells)
    rows = table(spark, sf_dir, "orders")
    if {"Name", "Fare", "Cabin"} & set(wanted):
        rows = join_table(rows, customers(spark, sf_dir), ["o_custkey"], salt_by=["o_orderkey"])
    return rows.select(*[cells[c].alias(c) for c in wanted])


def id_cutoff(spark: SparkSession, sf_dir: str) -> Column:
    """The id two thirds up the range: rows below train, the others are scored."""
    return table(spark, sf_dir, "orders").agg(F.expr("max(o_orderkey) * 2 div 3")).scalar()


def split_base(spark: SparkSession, sf_dir: str, *columns: str) -> tuple[DataFrame, DataFrame]:
    """Training and scoring rows; the latter without label."""
    rows, cutoff = base(spark, sf_dir, *columns), id_cutoff(spark, sf_dir)
    return (
        rows.where(F.col("PassengerId") < cutoff),
        rows.where(F.col("PassengerId") >= cutoff).drop("Survived"),
    )


_TITLE_SQL = " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(TITLES))

BASE_SQL = f"""base AS (
  SELECT o_orderkey AS PassengerId,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS Survived,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS Pclass,
         c_name || ', ' || CASE o_custkey % {len(TITLES)} {_TITLE_SQL} END || ' "'
           || substr(c_mktsegment, 1, 1) || lower(substr(c_mktsegment, 2)) || '"' AS Name,
         CASE WHEN o_totalprice < 250000 THEN 'male' ELSE 'female' END AS Sex,
         CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN 0.0
              ELSE o_totalprice / 5000 END AS Age,
         CAST(o_orderkey % 4 AS INTEGER) AS SibSp,
         CAST(o_custkey % 4 AS INTEGER) AS Parch,
         'T' || CAST(o_orderkey AS VARCHAR) AS Ticket,
         CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE c_acctbal / 100 END AS Fare,
         CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END AS Cabin,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderpriority END AS Embarked
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey),
cut AS (SELECT max(o_orderkey) * 2 // 3 AS cutoff FROM orders)"""
