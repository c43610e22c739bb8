"""Averages and medians: exact, approximate, and through a registered aggregate."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from featureflow.operators.lookup import attach, attach_pinned, known_hot, pin, with_row
from featureflow.operators.order import running_totals

# Values of one key that may go through one window task.
WINDOW_ROWS = 50_000


def global_avg(df: DataFrame, *columns: str) -> DataFrame:
    """One row with the average of each column, nulls ignored."""
    return df.agg(*[F.avg(c).alias(c) for c in columns])


def _middle_of(counted: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Pick the middle ranks from running counts ``__reached`` of ``__n`` values per key."""
    lower_rank = F.floor((F.col("__n") + 1) / 2)
    upper_rank = F.floor(F.col("__n") / 2) + 1
    inside = F.col("__zone") == 1
    picked = counted.groupBy(*keys).agg(
        F.min(F.when(inside & (F.col("__reached") >= lower_rank), F.col("__v"))).alias("__low"),
        F.min(F.when(inside & (F.col("__reached") >= upper_rank), F.col("__v"))).alias("__high"),
        F.max("__n").alias("__n"),
        F.max(F.when((F.col("__zone") == 0) & (F.col("__reached") >= lower_rank), True)).alias("__missed"),
    )
    lost = F.coalesce("__missed", F.lit(False)) | F.col("__low").isNull() | F.col("__high").isNull()
    # The sketch's error bound rules this out; should it ever be broken the job must not go on.
    checked = F.when(lost, F.raise_error(F.lit("the median left its bracket"))).otherwise(
        (F.col("__low") + F.col("__high")) / 2
    )
    return picked.select(*keys, F.when(F.col("__n") > 0, checked).alias(out))


def _order() -> list[Column]:
    return [F.col("__zone").asc(), F.col("__v").asc_nulls_first()]


def _numbered(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row of each key numbered in order: one shuffle and a sort."""
    zoned = rows.withColumn("__zone", F.when(F.col("__v").isNull(), 2).otherwise(1))
    return zoned.select(
        "*",
        F.row_number().over(W.partitionBy(*keys).orderBy(*_order())).alias("__reached"),
        F.count("__v").over(W.partitionBy(*keys)).alias("__n"),
    )


def _counted_brackets(
    rows: DataFrame, keys: Sequence[str], largest: int, accuracy: int, window_rows: int
) -> DataFrame:
    """Running counts over the values in a bracket around the middle of each key."""
    sortable = F.nanvl("__v", F.lit(float("inf")))
    margin = 3.0 / accuracy
    ends = F.percentile_approx(sortable, F.array(F.lit(0.5 - margin), F.lit(0.5 + margin)), F.lit(accuracy))
    brackets = (
        rows.groupBy(*keys)
        .agg(ends.alias("__ends"), F.count("__v").alias("__n"), F.count(F.lit(1)).alias("__all"))
        .select(*keys, F.col("__ends")[0].alias("__lo"), F.col("__ends")[1].alias("__hi"), "__n", "__all")
    )
    if keys:
        held, small = pin(brackets)
        hot = [] if small else known_hot(held, keys, "__all")
        bracketed = attach_pinned(rows, held, small, keys, hot=hot)
    else:
        bracketed = with_row(rows, brackets)
    zone = (
        F.when(F.col("__v").isNull() | (sortable > F.col("__hi")), 2)
        .when(sortable < F.col("__lo"), 0)
        .otherwise(1)
    )
    zoned = bracketed.withColumn("__zone", zone).withColumn("__v", F.when(F.col("__zone") == 1, F.col("__v")))
    tallies = zoned.groupBy(*keys, "__zone", "__v").agg(
        F.count(F.lit(1)).alias("__rows"), F.max("__n").alias("__n")
    )
    if largest * 8 <= window_rows * accuracy:
        per_key = W.partitionBy(*keys).orderBy(*_order()).rowsBetween(W.unboundedPreceding, 0)
        return tallies.withColumn("__reached", F.sum("__rows").over(per_key))
    return running_totals(tallies, _order(), {"__reached": F.col("__rows")}, by=keys)


def exact_median(
    df: DataFrame,
    value: str,
    by: Sequence[str] = (),
    out: str = "median",
    accuracy: int = 10_000,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Exact median per key: the middle value, or the mean of the two middle ones.

    Null values are ignored; a key with none left gives null. NaN sorts last.

    Keys with at most ``window_rows`` rows are sorted whole. The values of larger keys are narrowed
    first:

    1. A quantile sketch per key gives a bracket of values sure to hold the middle ranks, a few
       ``1/accuracy`` of the rows wide. Sketches merge map-side, so only sketches are shuffled.
    2. Rows are counted below the bracket and per distinct value inside it; both counts combine
       map-side, so a key with a third of all rows sends little more than its bracket.
    3. The running count covers the brackets, as a window per key if none can exceed
       ``window_rows``, and over range partitions otherwise.
    """
    keys = list(by)
    rows = df.select(*keys, F.col(value).cast("double").alias("__v"))
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__all"))
    is_large = F.col("__all") > window_rows
    found = sizes.agg(
        F.max("__all").alias("largest"),
        F.count_if(is_large).alias("large"),
        F.count_if(~is_large).alias("others"),
    ).first()
    if not found["large"]:
        return _middle_of(_numbered(rows, keys), keys, out)
    if not found["others"]:
        return _middle_of(_counted_brackets(rows, keys, found["largest"], accuracy, window_rows), keys, out)
    flags, small = pin(sizes.where(is_large).select(*keys, F.lit(True).alias("__large")))
    flagged = attach_pinned(rows, flags, small, keys)
    # The same rows are read for both parts, each keeping its own.
    large = flagged.where("__large").drop("__large")
    others = flagged.where("__large is null").drop("__large")
    medians = _middle_of(_counted_brackets(large, keys, found["largest"], accuracy, window_rows), keys, out)
    return medians.unionByName(_middle_of(_numbered(others, keys), keys, out))


def approx_median(
    df: DataFrame, value: str, by: Sequence[str] = (), out: str = "median", accuracy: int = 10_000
) -> DataFrame:
    """An existing value whose rank is within ``rows / accuracy`` of the middle; bounded memory."""
    return df.groupBy(*by).agg(
        F.percentile_approx(F.col(value), F.lit(0.5), F.lit(accuracy)).alias(out)
    )


def middle_tally(
    df: DataFrame, value: str, by: Sequence[str], count: str = "n", accuracy: int = 10_000
) -> DataFrame:
    """(by, value, count): per key the distinct values near the middle and how often each occurs.

    What lies below is one row with the smallest value, what lies above one with the largest, so every
    rank near the middle is where it was. Null values are left out. The sketch's bound on its error
    keeps the middle ranks inside; counts combine map-side.
    """
    keys, margin, v = list(by), 3.0 / accuracy, F.col(value)
    rows = df.where(v.isNotNull()).select(*keys, value)
    ends = F.percentile_approx(v, F.array(F.lit(0.5 - margin), F.lit(0.5 + margin)), F.lit(accuracy))
    bracketed = attach(rows, rows.groupBy(*keys).agg(ends.alias("__ends")), keys)
    zone = F.when(v < F.col("__ends")[0], 0).when(v > F.col("__ends")[1], 2).otherwise(1)
    zoned = bracketed.withColumn("__zone", zone).withColumn("__inside", F.when(F.col("__zone") == 1, v))
    tallied = zoned.groupBy(*keys, "__zone", "__inside").agg(
        F.min(v).alias("__low"), F.max(v).alias("__high"), F.count(F.lit(1)).alias(count)
    )
    shown = F.when(F.col("__zone") == 0, F.col("__low")).when(F.col("__zone") == 2, F.col("__high"))
    return tallied.select(*keys, shown.otherwise(F.col("__inside")).alias(value), count)


def tally(df: DataFrame, value: str, by: Sequence[str] = (), count: str = "n") -> DataFrame:
    """Rows per key and distinct non-null value."""
    return df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias(count))


def register_middle(spark: SparkSession, name: str = "middle_of_tally") -> str:
    """Register the median as a SQL aggregate ``name(value, count)`` over tallied values.

    The name is not that of the SQL function ``middle``, which takes other arguments: both can live in one session.

    A Python aggregate holds the input of one key in one task, so it is meant for the output of
    ``middle_tally``, or of ``tally`` where values repeat; ``exact_median`` has no such limit.
    """

    # Nested and self-contained: executors need no copy of this package to run it.
    @F.pandas_udf("double")
    def middle(values: pd.Series, counts: pd.Series) -> float:
        position = np.argsort(values.to_numpy(), kind="stable")
        ordered, reached = values.to_numpy()[position], np.cumsum(counts.to_numpy()[position])
        if len(reached) == 0 or reached[-1] == 0:
            return None
        low, high = np.searchsorted(reached, [(reached[-1] + 1) // 2, reached[-1] // 2 + 1])
        return float((ordered[low] + ordered[high]) / 2)

    spark.udf.register(name, middle)
    return name
