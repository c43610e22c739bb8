"""Row and null counts of tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_profile(df: DataFrame, name: str) -> DataFrame:
    """(table_name, column_name, row_count, null_count), one row per column, from one scan."""
    counted = df.agg(
        F.count(F.lit(1)).alias("__rows"), *[F.count(c).alias(c) for c in df.columns]
    )
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("present")) for c in df.columns])
    )
    return counted.select("__rows", pairs.alias("p")).select(
        F.lit(name).alias("table_name"),
        "p.column_name",
        F.col("__rows").alias("row_count"),
        (F.col("__rows") - F.col("p.present")).alias("null_count"),
    )


def profile_all(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Profiles of several tables, stacked."""
    return reduce(DataFrame.unionByName, [table_profile(df, name) for name, df in tables.items()])
