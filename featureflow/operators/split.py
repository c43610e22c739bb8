"""Splits, folds and unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featureflow.functions.keys import hash_bucket

BUCKETS = 100


def random_parts(df: DataFrame, weights: Sequence[float], seed: int | None = None) -> list[DataFrame]:
    """Random split with normalised weights.

    The rows of a part depend on the partitioning even with a seed; ``hash_part`` does not.
    """
    return df.randomSplit(list(weights), seed)


def hash_part(key: str, percents: Mapping[str, int], salt: str = "") -> Column:
    """Name of the part a key belongs to; ``percents`` adds up to 100."""
    if sum(percents.values()) != BUCKETS:
        raise ValueError("percents must add up to 100")
    bucket = hash_bucket(key, BUCKETS, salt)
    names = list(percents)
    chain = F
    for name, end in zip(names[:-1], accumulate(percents.values()), strict=False):
        chain = chain.when(bucket < end, F.lit(name))
    return chain.otherwise(F.lit(names[-1])) if len(names) > 1 else F.lit(names[0])


def fold_of(key: str, folds: int) -> Column:
    """Cross-validation fold 0..folds-1, independent of ``hash_part``."""
    return hash_bucket(key, folds, salt="fold:")


def below(df: DataFrame, key: str, cutoff: Column | int) -> DataFrame:
    """Rows with a key below the cutoff (the training side of an id split)."""
    return df.where(F.col(key) < cutoff)


def from_cutoff(df: DataFrame, key: str, cutoff: Column | int) -> DataFrame:
    """Rows with a key at or above the cutoff (the scoring side)."""
    return df.where(F.col(key) >= cutoff)


def stack_by_position(first: DataFrame, second: DataFrame) -> DataFrame:
    """UNION ALL by position; the names of ``first`` win, duplicates stay."""
    return first.union(second)


def stack_by_name(first: DataFrame, second: DataFrame) -> DataFrame:
    """UNION ALL by name."""
    return first.unionByName(second)
