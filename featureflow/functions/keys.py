"""Stable buckets of a key: the same key always lands in the same bucket, on any partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_bucket(key: str | Column, buckets: int, salt: str = "") -> Column:
    """Bucket 0..buckets-1 from the first 28 bits of the key's md5.

    md5 rather than Spark's own hash, so that other engines can reproduce the split. A ``salt``
    gives an independent assignment (folds inside the training part, for example).
    """
    text = (F.col(key) if isinstance(key, str) else key).cast("string")
    digest = F.md5(F.concat(F.lit(salt), text) if salt else text)
    return (F.conv(F.substring(digest, 1, 7), 16, 10).cast("bigint") % buckets).cast("int")
