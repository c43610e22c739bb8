"""Starting centres for k-means by oversampling (k-means||), the same on any partitioning.

From one row on, each round draws rows with chances in proportion to their squared distance from the centres so far,
about ``factor`` times ``k`` of them. The candidates are weighed by the rows nearest to them and thinned out to ``k``.

Draws are hashes of the row's key, and distances are added up as decimals, so a round takes the same rows whatever the
cores, splits and retries. Every round is a pass over written rows, which carry their distance so far: only the round's
new candidates are compared with them. The driver holds candidates, never rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featureflow.operators.cluster import Centres, assign, nearest
from featureflow.session import Scratch

ROUNDS = 5
FACTOR = 2
# A draw is one of so many numbers.
DRAWS = 1 << 52


def draw(key: str, number: int) -> Column:
    """A number from 0 up to 1, by the key and the number of the draw alone."""
    return F.pmod(F.xxhash64(key, F.lit(number)), F.lit(DRAWS)).cast("double") / F.lit(float(DRAWS))


def thin_out(candidates: Centres, weights: Sequence[float], k: int) -> list[list[float]]:
    """``k`` of the candidates: the heaviest, then always the one with the most weight times squared distance from those taken."""
    taken = [max(range(len(candidates)), key=lambda i: weights[i])]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(candidates[a], candidates[b], strict=True))
    while len(taken) < k:
        rest = [weights[i] * min(far(i, t) for t in taken) for i in range(len(candidates))]
        best = max(range(len(candidates)), key=rest.__getitem__)
        if rest[best] <= 0:
            break
        taken.append(best)
    return [list(candidates[i]) for i in taken]


def spread_centres(df: DataFrame, columns: Sequence[str], key: str, k: int, rounds: int = ROUNDS, factor: int = FACTOR) -> list[list[float]]:
    """``k`` starting centres among the rows of ``df``; fewer if it has fewer different rows.

    ``key`` tells rows apart; rows with one key are drawn together. A null coordinate is an error, as in ``assign``. A
    table without rows raises.
    """
    with Scratch(df.sparkSession) as scratch:
        rows = df.select(F.col(key).alias("key"), *columns)
        first = rows.agg(F.min_by(F.struct(*columns), F.struct(draw("key", 0), "key", *columns))).first()[0]
        if first is None:
            raise ValueError("no rows to take centres from")
        new = candidates = [[float(x) for x in first]]
        known = rows.withColumn("d", F.lit(float("inf")))
        for number in range(1, rounds + 1):
            met = assign(known.select("key", *columns, "d"), columns, new)
            known = scratch.write(met.select("key", *columns, F.least("d", "distance2").alias("d")), f"round-{number}")
            largest = known.agg(F.max("d")).first()[0]
            if not largest:
                break
            share = F.col("d") / F.lit(largest)
            # Shares of the largest distance: their sum is exact, so it does not depend on the order.
            whole = float(known.agg(F.sum(share.cast("decimal(18,15)"))).first()[0])
            drawn = known.where(draw("key", number) * F.lit(whole) < share * F.lit(float(factor * k)))
            new = [[float(x) for x in r] for r in drawn.select(*columns).distinct().orderBy(*columns).collect()]
            if not new:
                new = candidates[:1]  # no draw in this round
            candidates = candidates + [c for c in new if c not in candidates]
        nearest_one = rows.select(nearest(columns, candidates)["cluster"].alias("c"))
        weights = {r["c"]: r["n"] for r in nearest_one.groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
    return thin_out(candidates, [weights.get(i, 0) for i in range(len(candidates))], k)


def inertia(df: DataFrame, columns: Sequence[str], centres: Centres) -> float:
    """Sum of the squared distances from the nearest centres."""
    return assign(df.select(*columns), columns, centres).agg(F.sum("distance2")).first()[0] or 0.0
