"""Joining a table of fitted statistics (one row per key) back to the rows.

Statistics are evaluated once and held still before they are joined: they may come from
approximate or order-dependent aggregates, and a retried task must see the values its finished
neighbours saw. Then, by measured size:

* one row in all: its values enter the plan as literals;
* at most ``BROADCAST_ROWS`` rows and ``BROADCAST_BYTES`` bytes: broadcast, the rows stay where
  they are;
* more: a shuffle join in which hot keys are spread. A key is hot with about one in ``HOT_SHARE``
  of the rows or more, so there are few enough of them to broadcast their statistics always. Rows
  of hot keys take those, and go through the join under a salt that matches nothing, evenly over
  all tasks; all other rows meet the table on their key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featureflow.session import input_bytes, written_table

BROADCAST_ROWS = 500_000
# On disk; a broadcast table of this size stays well below what one executor gives a task.
BROADCAST_BYTES = 16 * 1024 * 1024
HOT_SHARE = 1_000
HOT_SALTS = 1 << 20


def local_copy(df: DataFrame) -> DataFrame:
    """``df``, known to be small, evaluated into a local table."""
    return df.sparkSession.createDataFrame(df.toArrow(), schema=df.schema)


def pin(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Evaluate ``df`` once and hold the result; the flag says whether it may be broadcast.

    The result is written to the shared folder, and its bytes and rows are known from the files
    alone. Nothing of it passes through this process.
    """
    written = written_table(df, "stats")
    return written, input_bytes(written) <= size and written.count() <= rows


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], right_keys: Sequence[str]) -> Column:
    """``keys`` equal on both sides, null matching null."""
    pairs = zip(keys, right_keys, strict=True)
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[r]) for k, r in pairs])


def with_row(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Add the columns of a one-row table as literals."""
    (row,) = stats.collect()
    return df.withColumns({c: F.lit(row[c]).cast(stats.schema[c].dataType) for c in stats.columns})


def _key_hash(df: DataFrame, keys: Sequence[str]) -> Column:
    """Hash of the keys. 0.0 is added to floats, since -0.0 equals 0.0 in a join."""
    floats = {f.name for f in df.schema.fields if f.dataType.typeName() in ("float", "double")}
    return F.xxhash64(*[F.col(k) + F.lit(0.0) if k in floats else F.col(k) for k in keys])


def find_hot(df: DataFrame, keys: Sequence[str], share: int = HOT_SHARE) -> list[int]:
    """Hashes of the keys with one in ``share`` of the rows or more.

    One pass with a fixed-size frequency sketch, whose error is far below that share; keys a
    little below it may be reported too. The keys themselves are not shuffled.
    """
    hashed = df.select(_key_hash(df, keys).alias("h"))
    sketch = F.expr(f"approx_top_k(h, {2 * share}, {20 * share})").alias("top")
    found = hashed.agg(sketch, F.count(F.lit(1)).alias("n")).first()
    return [r["item"] for r in found["top"] or [] if r["count"] * share * 1.2 >= found["n"]]


def known_hot(stats: DataFrame, keys: Sequence[str], weight: str, share: int = HOT_SHARE) -> list[int]:
    """The same from statistics that hold the number of rows of each key."""
    total = stats.agg(F.sum(weight)).first()[0] or 0
    hot = stats.where(F.col(weight) * share > total)
    return [r[0] for r in hot.select(_key_hash(stats, keys)).collect()]


def attach(
    df: DataFrame,
    stats: DataFrame,
    keys: Sequence[str],
    salt_by: Sequence[str] | None = None,
    rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Left join ``stats`` (one row per ``keys``) to ``df``; null keys match null keys.

    ``salt_by`` names the columns that tell the rows of one key apart (default: all columns).
    """
    held, small = pin(stats, rows=rows)
    return attach_pinned(df, held, small, keys, salt_by)


def attach_pinned(
    df: DataFrame,
    held: DataFrame,
    small: bool,
    keys: Sequence[str],
    salt_by: Sequence[str] | None = None,
    hot: list[int] | None = None,
) -> DataFrame:
    """``attach`` for statistics that went through ``pin``. ``hot``: the hot keys, where known."""
    for k in keys:
        if df.schema[k].dataType != held.schema[k].dataType:
            raise TypeError(f"{k!r} is {df.schema[k].dataType} in the rows, {held.schema[k].dataType} in the statistics")
    if small:
        return _left_join(df, F.broadcast(held), keys)
    return _spread_join(df, held, keys, salt_by, find_hot(df, keys) if hot is None else hot)


def join_table(
    df: DataFrame, table: DataFrame, keys: Sequence[str], salt_by: Sequence[str] | None = None, size: int | None = None
) -> DataFrame:
    """Left join a stored table with one row per key: broadcast by its size on disk, else spread.

    Nothing is pinned, as the table's files do not change between attempts.
    """
    limit = BROADCAST_BYTES if size is None else size
    return attach_pinned(df, table, input_bytes(table) <= limit, keys, salt_by)


def _left_join(df: DataFrame, side: DataFrame, keys: Sequence[str]) -> DataFrame:
    renamed = [f"__{k}" for k in keys]
    side = side.withColumnsRenamed(dict(zip(keys, renamed, strict=True)))
    return df.join(side, null_safe(df, side, keys, renamed), "left").drop(*renamed)


def _spread_join(
    df: DataFrame, held: DataFrame, keys: Sequence[str], salt_by: Sequence[str] | None, hot: list[int]
) -> DataFrame:
    if not hot:
        return _left_join(df, held, keys)
    values = [c for c in held.columns if c not in keys]
    few = held.where(_key_hash(held, keys).isin(hot))
    few = few.select(*keys, *[F.col(c).alias(f"__h_{c}") for c in values])
    # A hash, not a random number: a retried task sends each row where it went before.
    salt = F.pmod(F.xxhash64(*(salt_by or df.columns)), F.lit(HOT_SALTS)) + 1
    salted = df.withColumn("__salt", F.when(_key_hash(df, keys).isin(hot), salt).otherwise(F.lit(0).cast("bigint")))
    rows = _left_join(salted, F.broadcast(few), keys)
    joined = _left_join(rows, held.withColumn("__salt", F.lit(0).cast("bigint")), [*keys, "__salt"])
    taken = [F.when(F.col("__salt") > 0, F.col(f"__h_{c}")).otherwise(F.col(c)).alias(c) for c in values]
    return joined.select(*df.columns, *taken)
