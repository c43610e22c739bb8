"""Shards that each hold the whole table's mixture: proportional stratified interleaving.

The rows of every source are shuffled by a seeded hash and ranked; rank ``r`` of a source with ``n`` rows stands at
the fraction ``(2 r + 1) / (2 n)``. Sorted by that fraction the sources run side by side in proportion, so any stretch
of the order holds of each source its share, to within a row or two. The order is cut into shards of equal counts, at
most one apart.

Both orders are range-partitioned sorts that are written out. Places come from the row numbers that Spark gives within
each sorted partition, and from a table with one row per partition and source of how many stand before: no window over
a source or shard, whatever their sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from featureflow.operators.lookup import attach, attach_pinned, pin
from featureflow.operators.order import sorted_and_numbered

SHARDS = 40
# Bytes that a row takes besides its text.
ROW_BYTES = 16


def places(rows: DataFrame, order: Sequence[Column], name: str, by: Sequence[str] = ()) -> DataFrame:
    """``rows`` with their place from 0 in ``order``, counted anew for each key in ``by``."""
    placed = sorted_and_numbered(rows, [*(F.col(c).asc_nulls_last() for c in by), *order])
    # A key's rows stand together in a partition.
    parts = placed.groupBy(*by, "__part").agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__n"))
    earlier = W.partitionBy(*by).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    before = parts.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0))).drop("__n")
    met = attach(placed, before, [*by, "__part"], salt_by=["__id"])
    return met.withColumn(name, F.col("__before") + F.col("__id") - F.col("__first")).drop("__id", "__part", "__first", "__before")


def shard(
    docs: DataFrame, shards: int = SHARDS, seed: str = "", key: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """(doc_id, source, size, text_crc32, place, shard, slot) per row of ``docs``.

    ``size`` is the text's UTF-8 bytes and ``ROW_BYTES``; ``place`` is the row's in the whole order, ``slot`` its place
    in the shard, without gaps from 0. Counts of shards differ by one at most. A shard of ``m`` rows holds of a source
    with the share ``p`` of all rows between ``m p - 2`` and ``m p + 2`` rows, plus what ties between sources shift.

    Defined results: a null text has no bytes and the checksum of an empty one; null is a source like others, and null
    ids are shuffled as one; rows with the same id are ordered by checksum and size, and rows equal in these too may
    swap places, which changes no row of the result; other columns are not read; fewer rows than shards leave shards
    empty; an empty table gives an empty result.
    """
    if shards < 1:
        raise ValueError("there is one shard at least")
    rows = docs.select(
        F.col(key).alias("doc_id"),
        F.col(source).alias("source"),
        (F.octet_length(F.coalesce(F.col(text), F.lit(""))) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    lot = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    shuffled = [lot.asc(), F.col("doc_id").asc(), F.col("text_crc32").asc(), F.col("size").asc()]
    ranked = places(rows, shuffled, "rank", by=["source"])
    counts, small = pin(ranked.groupBy("source").agg(F.count(F.lit(1)).alias("n")))
    whole = counts.agg(F.sum("n")).first()[0] or 0
    ranked = attach_pinned(ranked, counts, small, ["source"], salt_by=["doc_id", "rank"])
    # Equal fractions give equal doubles; the source decides between them.
    fraction = (2 * F.col("rank") + 1) / (2 * F.col("n"))
    placed = places(ranked, [fraction.asc(), F.col("source").asc_nulls_last(), F.col("rank").asc()], "place").drop("rank", "n")
    at = F.expr(f"(place * {shards}L) div {max(1, whole)}L")
    first = F.expr(f"(shard * {whole}L + {shards - 1}L) div {shards}L")
    cut = placed.withColumn("shard", at.cast("int"))
    return cut.select("doc_id", "source", "size", "text_crc32", "place", "shard", (F.col("place") - first).alias("slot"))
