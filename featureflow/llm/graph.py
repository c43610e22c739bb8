"""Connected components by contraction, as joins and aggregations over an edge table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featureflow.session import Scratch


def _priority(node: str, round_: int) -> Column:
    # Node numbers first, so that stars around their smallest node end in one round; then hashes that
    # change every other round, so that no numbering of a long chain keeps it from shrinking.
    return F.col(node) if round_ < 2 else F.xxhash64(F.col(node), F.lit(round_ // 2))


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``edges`` (a, b: numbers) -> (node, root), one row per node with an edge, root the same throughout a component.

    Every round each node steps to the neighbour (or itself) of least priority and the edges between
    merged nodes vanish, which leaves a constant share of the nodes: the rounds grow with the logarithm
    of the nodes. Each is a few joins over what is left; nothing but a row count comes to the driver.
    """
    left = scratch.write(edges.where("a <> b").select("a", "b").distinct(), "edges")
    found, round_ = None, 0
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ranked = both.select("a", F.struct(_priority("b", round_).alias("p"), F.col("b").alias("n")).alias("other"))
        best = ranked.groupBy("a").agg(F.min("other").alias("other"))
        own = F.struct(_priority("a", round_).alias("p"), F.col("a").alias("n"))
        step = scratch.write(best.select(F.col("a").alias("node"), F.least(own, "other")["n"].alias("to")), "steps")
        ends = {x: step.select(F.col("node").alias(x), F.col("to").alias(f"{x}_to")) for x in "ab"}
        moved = left.join(ends["a"], "a").join(ends["b"], "b")
        moved = moved.where("a_to <> b_to").select(F.col("a_to").alias("a"), F.col("b_to").alias("b")).distinct()
        if found is None:
            found = step.withColumnRenamed("to", "root")
        else:
            joined = found.join(step.select(F.col("node").alias("root"), "to"), "root", "left")
            found = joined.select("node", F.coalesce("to", "root").alias("root"))
        left = scratch.write(moved, "edges")
        round_ += 1
    if found is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found if round_ == 1 else scratch.write(found, "roots")
