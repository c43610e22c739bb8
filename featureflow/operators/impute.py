"""Filling missing values, with the statistics fitted apart from where they are applied.

``fit_*`` returns a DataFrame of statistics computed from one table (usually the training part);
the ``fill_*`` functions use it on any table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featureflow.operators.aggregate import exact_median
from featureflow.operators.lookup import attach

# Median age per title group, as used to fill missing ages.
TITLE_AGES = {
    "Miss": 24.0,
    "Anyone": 18.0,
    "Officer": 36.0,
    "Royalty": 39.0,
    "Master": 3.0,
    "Mr": 25.0,
    "Mrs": 31.0,
}


def fit_means(df: DataFrame, *columns: str) -> dict[str, float | None]:
    """The average of each column, computed once: one row, held as numbers so that every later use fills the same."""
    return df.agg(*[F.avg(c).alias(c) for c in columns]).first().asDict()


def fill_means(df: DataFrame, means: Mapping[str, float | None], *columns: str) -> DataFrame:
    """Null -> fitted mean; stays null where the fitted column had no value at all."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(means[c]).cast("double")) for c in columns})


def fill_constants(df: DataFrame, constants: Mapping[str, object]) -> DataFrame:
    """Null -> the constant given for the column."""
    return df.na.fill(dict(constants))


def fill_numeric_zero(df: DataFrame) -> DataFrame:
    """Null -> 0 in every numeric column."""
    return df.na.fill(0)


def zero_as_null(column: str | Column) -> Column:
    """Files that wrote 0 for "unknown": make it null again, before any filling."""
    return F.nullif(F.col(column) if isinstance(column, str) else column, F.lit(0.0))


def lookup_value(category: Column, values: Mapping[str, float], default: float | None = None) -> Column:
    """The constant of the category, ``default`` for one that is not listed."""
    rest = F.lit(default).cast("double")
    if not values:
        return rest
    chain = F
    for name, value in values.items():
        chain = chain.when(category == name, F.lit(value))
    return chain.otherwise(rest)


def fit_group_medians(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Exact median of ``value`` per group, groups without any value included as null."""
    return exact_median(df, value, by, out="group_median")


def fill_group_medians(
    df: DataFrame, medians: DataFrame, value: str, by: Sequence[str], salt_by: Sequence[str] | None = None
) -> DataFrame:
    """Null -> the median of the row's group; stays null in an unseen or all-null group."""
    joined = attach(df, medians, by, salt_by=salt_by)
    return joined.withColumn(value, F.coalesce(value, "group_median")).drop("group_median")
