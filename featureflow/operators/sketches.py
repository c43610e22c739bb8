"""Quantile sketches as stored state: built part by part, merged later, medians read from the merged ones.

A part's sketches are written beside those of earlier parts. Merging reads sketches, never the rows again, so a median
over all parts costs a pass over each part once, whenever it came. Sketches have a bounded size and merge map-side.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Size of a sketch; larger ones are more exact.
SKETCH_K = 1600


def rank_bound(k: int = SKETCH_K) -> float:
    """Largest error of a rank, as a share of the rows, that is expected once in a million sketches.

    Twice the sketches' published error at 99 in 100, which falls with the power 0.9021 of ``k``.
    """
    return 2 * 2.296 / math.pow(k, 0.9021)


def sketches(df: DataFrame, value: str, by: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """(by, sketch, n): a sketch of each key's values and their number. Nulls and NaN are left out; a key without values has an empty sketch."""
    number = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    sketch = F.call_function("kll_sketch_agg_double", number, F.lit(k))
    return df.groupBy(*by).agg(sketch.alias("sketch"), F.count(number).alias("n"))


def store_part(df: DataFrame, path: str, part: str, value: str, by: Sequence[str] = (), k: int = SKETCH_K) -> None:
    """Write the sketches of one part of the rows below ``path``; the same part again replaces its own."""
    sketches(df, value, by, k).write.mode("overwrite").parquet(f"{path}/part={part}")


def stored(spark: SparkSession, path: str) -> DataFrame:
    """The sketches of all parts below ``path``, with their ``part``."""
    return spark.read.parquet(path)


def merged(parts: DataFrame, by: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """(by, sketch, n) over all parts. Sketches of any part, and merged ones too, may be merged again."""
    # Empty sketches carry nothing.
    full = F.when(F.col("n") > 0, F.col("sketch"))
    return parts.groupBy(*by).agg(F.call_function("kll_merge_agg_double", full, F.lit(k)).alias("sketch"), F.sum("n").alias("n"))


def quantile(share: float = 0.5) -> Column:
    """The value at ``share`` of the rows of ``sketch``; null where ``n`` is 0."""
    return F.when(F.col("n") > 0, F.call_function("kll_sketch_get_quantile_double", "sketch", F.lit(float(share))))


def rank_of(value: float) -> Column:
    """The share of the rows of ``sketch`` up to ``value``; null where ``n`` is 0."""
    return F.when(F.col("n") > 0, F.call_function("kll_sketch_get_rank_double", "sketch", F.lit(float(value))))
