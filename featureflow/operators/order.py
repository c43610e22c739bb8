"""Running totals and positions over a whole table, without a one-task window.

The rows are sorted by Spark's range partitioning, numbered and written out. Inside each sorted
partition a window adds up locally; what lies before a partition comes from a table with one row
per partition (and key). No step holds more than one range partition, however few the keys.

Writing them is needed, not a convenience: the partition number is read twice (totals and rows),
and range bounds come from a sample that a recomputation could draw differently.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from featureflow.operators.lookup import attach_pinned, local_copy, pin
from featureflow.session import written_table

# monotonically_increasing_id keeps the partition number above 33 bits of row number.
ROW_BITS = 33


def sorted_and_numbered(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` with its place in the order, ``__id``, and its sorted partition, ``__part``."""
    numbered = df.orderBy(*order).withColumn("__id", F.monotonically_increasing_id())
    return written_table(numbered.withColumn("__part", F.shiftright("__id", ROW_BITS)), "sorted")


def running_totals(
    df: DataFrame,
    order: Sequence[Column],
    totals: Mapping[str, Column],
    by: Sequence[str] = (),
) -> DataFrame:
    """Add inclusive running sums in the given order, restarting for each key in ``by``.

    ``order`` must be total within a key for the result to be unique. ``by`` columns come first in
    the sort, so one key fills whole partitions and a hot key is spread over many.
    """
    rows = sorted_and_numbered(df, [*(F.col(c).asc() for c in by), *order])
    in_key = W.partitionBy(*by) if by else W.partitionBy()
    parts = rows.groupBy(*by, "__part").agg(*[F.sum(e).alias(f"__t_{n}") for n, e in totals.items()])
    earlier = in_key.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    # One row per partition and key touching it: the window over it is as small as that.
    before = parts.select(
        *by,
        "__part",
        *[F.coalesce(F.sum(f"__t_{n}").over(earlier), F.lit(0)).alias(f"__b_{n}") for n in totals],
    )
    local = W.partitionBy("__part", *by).orderBy("__id").rowsBetween(W.unboundedPreceding, 0)
    # Without keys that is one row per partition; no (partition, key) pair exceeds a partition.
    held, small = pin(before) if by else (local_copy(before), True)
    joined = attach_pinned(rows, held, small, ["__part", *by], hot=[])
    return joined.withColumns(
        {n: F.col(f"__b_{n}") + F.sum(e).over(local) for n, e in totals.items()}
    ).drop("__id", "__part", *[f"__b_{n}" for n in totals])
