"""Joining narrow tables to documents, whose texts should stay where they are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureflow.operators.lookup import null_safe, pin


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, lengthened where ``df`` has such a column; Spark tells names apart without regard to case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def met(docs: DataFrame, table: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """``docs`` joined to ``table``, whose first columns are the ``keys`` under any name; null matches null.

    ``table`` has one row per key. It is written, and broadcast if it is then seen to be small, so that texts are
    shuffled only beside a large one. Its key columns are dropped; its names must be free in ``docs`` (``free_names``).
    """
    held, small = pin(table)
    own = held.columns[: len(keys)]
    return docs.join(F.broadcast(held) if small else held, null_safe(docs, held, keys, own), how).drop(*own)
