"""Mixing sources to target weights with a low-discrepancy schedule.

The mix is a series of slots, each a block of words of one source. Slot ``i`` takes the point of the golden-ratio sequence at
``i``, in 32-bit integers, and the source in whose stretch of the cumulative targets the point falls. Slots
are ranked within their source, and rank ``r`` takes block ``r`` of the source's documents, shuffled by a
hash and laid end to end; after the last block the source starts again, at most ``repeats`` times in all.

All of it is joins, windows and aggregations. No step gathers a source: running totals go over range
partitions, and ranks are counted within runs of slots first.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from featureflow.llm.tables import free_names, met
from featureflow.operators.lookup import attach
from featureflow.operators.order import running_totals
from featureflow.session import Scratch

WEIGHTS = (5, 2, 1)
WORD = r"[^\x20\x09-\x0D]+"
# A block is a 65,536th of all words, as long as that is within these bounds.
SLOTS = 1 << 16
LARGEST_BLOCK = 4096
# A source has about this many blocks at least, or one per word: small sources have smaller blocks and more slots.
LEAST_BLOCKS = 256
# Slots whose ranks are counted in one window.
RUN = 1 << 16

GOLDEN = 2654435769  # 2**32 divided by the golden ratio, made odd
UNITS = 1 << 31


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...], repeats: int, scratch: Scratch) -> DataFrame:
    """(source, source_size, idx, weight, target) per source; ``sizes`` has (source, size).

    Sources in code point order, null last, take ``weights`` in turn and share all words by weight. A target
    stops at ``repeats`` times its source's size, and what is over is shared again among the others.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = running_totals(totals, [F.col("source").asc_nulls_last()], {"idx": F.lit(1)})
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("idx") - 1, F.lit(len(weights))) + 1).cast("int"))
    table = ranked.select("source", "source_size", (F.col("idx") - 1).alias("idx"), turn.alias("weight"))
    table = scratch.write(table.withColumn("cap", repeats * F.col("source_size")), "sources")
    level = 0.0
    while True:  # every round but the last one caps a source more
        above = F.col("weight") * F.lit(level) > F.col("cap")
        found = table.agg(
            F.sum("source_size").alias("words"), F.sum(F.when(above, F.col("cap"))).alias("capped"), F.sum(F.when(~above, F.col("weight"))).alias("weight")
        ).first()
        free = found["weight"] or 0
        further = ((found["words"] or 0) - (found["capped"] or 0)) / free if free else level
        if further <= level:
            break
        level = further
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(level))
    return table.select("source", "source_size", "idx", "weight", target.alias("target"))


def _points(i: Column) -> Column:
    """32-bit golden-ratio points; every 2**32 slots they run through all values once."""
    low, high = F.pmod(i, F.lit(1 << 16)), F.pmod(F.shiftright(i, 16), F.lit(1 << 16))
    return F.pmod(F.pmod(high * GOLDEN, F.lit(1 << 16)) * (1 << 16) + low * GOLDEN, F.lit(1 << 32))


def schedule(spark: SparkSession, sources: DataFrame, slots: int) -> DataFrame:
    """(slot, idx, rank): the source of each slot and the slot's number within its source.

    ``sources`` (idx, target) is a written table; its targets set the shares.
    """
    whole = sources.agg(F.sum("target").alias("t"), F.count(F.lit(1)).alias("n")).first()
    total = whole["t"] or 0.0
    units = F.floor(F.col("target") / F.lit(total or 1.0) * UNITS).cast("bigint")
    placed = running_totals(sources.select("idx", units.alias("units")), [F.col("idx").asc()], {"end": F.col("units")})
    placed = placed.where("units > 0").select("idx", (F.col("end") - F.col("units")).alias("lo"), F.col("end").alias("hi"))
    used = placed.agg(F.max("hi")).first()[0] or 0
    # Cells of the line, about as many as sources: each holds few of them, whatever their shares.
    cells = 1 << max(10, (whole["n"] or 1).bit_length() + 1)
    cell = lambda y: F.expr(f"(({y}) * {cells}L) div {max(1, used)}L")
    reach = placed.withColumn("cell", F.explode(F.sequence(cell("lo"), cell("hi - 1"))))
    each = spark.range(slots if used else 0).select(F.col("id").alias("slot"), _points(F.col("id")).alias("p"))
    each = each.select("slot", F.shiftright(F.col("p") * F.lit(used), 32).alias("y")).withColumn("cell", cell("y"))
    taken = each.join(reach, "cell").where("lo <= y and y < hi").select("slot", "idx").withColumn("run", F.expr(f"slot div {RUN}L"))
    runs = taken.groupBy("run", "idx").agg(F.count(F.lit(1)).alias("n"))
    earlier = W.partitionBy("idx").orderBy("run").rowsBetween(W.unboundedPreceding, -1)
    before = runs.select("run", "idx", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = F.row_number().over(W.partitionBy("run", "idx").orderBy("slot"))
    numbered = taken.withColumn("within", within).join(before, ["run", "idx"])
    return numbered.select("slot", "idx", (F.col("before") + F.col("within") - 1).alias("rank"))


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = 3, seed: str = "", key: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, copies) per row of ``docs``.

    ``size`` is the row's words, ``taken`` how many of them the mix takes, repeats counted, and ``copies`` how
    often it takes the block in which the document begins: the whole-document form of the mix.

    Defined results: null and empty texts have size 0 and are never taken; null is a source like others; rows
    of one ``doc_id`` are rows of their own; the shuffle depends on ``seed`` and ``doc_id`` only, so that
    reruns agree; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    with Scratch(spark) as scratch:
        rows = docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), word_count(text).alias("size"))
        sizes = scratch.write(rows, "sizes", keep=True)
        table = scratch.write(targets(sizes, weights, repeats, scratch), "targets", keep=True)
    words = table.agg(F.sum("source_size")).first()[0] or 0
    block = min(LARGEST_BLOCK, max(1, words // SLOTS))
    own = F.least(F.lit(block), F.greatest(F.lit(1), F.expr(f"source_size div {LEAST_BLOCKS}L")))
    table = table.withColumn("block", own.cast("bigint"))
    blocks = F.ceil(F.col("source_size") / F.col("block"))
    # Slots are shared by the words that a source's blocks hold on average, the short last one included.
    shares = table.where("source_size > 0").select("idx", (F.col("target") * blocks / F.col("source_size")).alias("target"))
    slots = math.ceil((shares.agg(F.sum("target")).first()[0] or 0) - 1e-6)

    known = attach(sizes, table, ["source"], salt_by=["doc_id", "size"])
    order = [F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).asc(), F.col("doc_id").asc(), F.col("size").asc()]
    laid = running_totals(known.where("size > 0"), order, {"end": F.col("size")}, by=["idx"])
    laid = laid.withColumn("start", F.col("end") - F.col("size"))

    ranked = schedule(spark, shares, slots).join(table.select("idx", blocks.alias("blocks")), "idx")
    drawn = ranked.where(F.col("rank") < repeats * F.col("blocks")).groupBy("idx", F.pmod("rank", "blocks").alias("block")).agg(F.count(F.lit(1)).alias("draws"))

    first = F.expr("start div length")
    cut = laid.withColumnRenamed("block", "length").withColumn("block", F.explode(F.sequence(first, F.expr("(end - 1) div length"))))
    inside = F.least(F.col("end"), (F.col("block") + 1) * F.col("length")) - F.greatest(F.col("start"), F.col("block") * F.col("length"))
    met = cut.withColumn("words", inside).join(drawn, ["idx", "block"], "left").withColumn("draws", F.coalesce("draws", F.lit(0)))
    columns = ["doc_id", "source", "size", "source_size", "target"]
    # Within a source a start belongs to one row.
    taken = met.groupBy("idx", "start").agg(
        *[F.first(c).alias(c) for c in columns], F.sum(F.col("words") * F.col("draws")).alias("taken"), F.max(F.when(F.col("block") == first, F.col("draws"))).alias("copies")
    )
    nothing = known.where("size = 0").select(*columns, F.lit(0).cast("bigint").alias("taken"), F.lit(0).cast("bigint").alias("copies"))
    return taken.select(*columns, "taken", "copies").unionByName(nothing)


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = 3, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``docs`` with each row as often as the mix takes it (``copies`` of ``mix``), columns unchanged.

    Rows with the same ``doc_id`` and ``source`` share the largest of their copies.
    """
    counts = mix(docs, weights, repeats, "", key, text, source).where("copies > 0")
    own, home, copies, copy = free_names(docs, "mixed_id", "mixed_source", "copies", "copy")
    counts = counts.groupBy(F.col("doc_id").alias(own), F.col("source").alias(home)).agg(F.max("copies").alias(copies))
    joined = met(docs, counts, [key, source], "inner")
    repeated = joined.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(copies))))
    return repeated.drop(copies, copy)
