"""Nearest neighbours by inner product with multi-index hashing.

A rotation is learned on a bounded sample (principal axes, then iterative quantisation) and turns every
vector into a binary code. Codes are split into substrings, each indexed by its value. Two codes within a
Hamming radius agree in some substring up to a part of that radius, so probing every substring value that
near retrieves all codes within the radius; they are ranked by the exact inner product in double precision.

Vectors are scaled to one length by a further component first, so that the angle between codes follows the
inner product, whatever the vectors' lengths.

Queries meet the base in blocks: every pair of a query block and a base block is one group of bounded size,
in which the index of the base block is built and probed. A block gives the nearest of each query, which are
merged by an aggregation.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

SAMPLE_ROWS = 20_000
QUERY_BLOCK, BASE_BLOCK = 4_096, 32_768
STEPS = 30
# A query's radius widens until a block holds this many times the wanted neighbours within it.
RERANK = 50


@dataclass(frozen=True)
class Codes:
    """A learned code: centre, rotation (dimensions x bits) and the length all vectors are brought to."""

    center: np.ndarray
    rotation: np.ndarray
    length: float
    substrings: int
    radius: int

    def lifted(self, vectors: np.ndarray, base: bool) -> np.ndarray:
        """Base vectors get the component that brings them to ``length``; queries are scaled to it."""
        if base:
            rest = np.sqrt(np.maximum(0.0, self.length**2 - (vectors**2).sum(axis=1)))
        else:
            norms = np.sqrt((vectors**2).sum(axis=1))
            vectors, rest = vectors * (self.length / norms)[:, None], np.zeros(len(vectors))
        return np.concatenate([vectors, rest[:, None]], axis=1)

    def encode(self, vectors: np.ndarray, base: bool) -> np.ndarray:
        """One 16-bit number per substring."""
        bits = (self.lifted(vectors, base) - self.center) @ self.rotation > 0
        weights = (1 << np.arange(16)).astype(np.uint32)
        return (bits.reshape(len(bits), self.substrings, 16) @ weights).astype(np.uint16)


def learn(sample: np.ndarray, length: float, substrings: int, radius: int, seed: int = 7) -> Codes:
    """Principal axes of the sample, filled up with random ones, and a rotation that brings them near signs."""
    bits = 16 * substrings
    plain = Codes(np.zeros(1), np.zeros((1, 1)), length, substrings, radius)
    lifted = plain.lifted(sample, base=True)
    center = lifted.mean(axis=0)
    x = lifted - center
    random = np.random.default_rng(seed)
    _, _, axes = np.linalg.svd(x, full_matrices=False)
    axes = axes[:bits].T
    blocks = []
    for first in range(0, bits, axes.shape[1]):
        width = min(axes.shape[1], bits - first)
        v = x @ axes
        rotation, _ = np.linalg.qr(random.normal(size=(axes.shape[1], axes.shape[1])))
        for _ in range(STEPS):
            left, _, right = np.linalg.svd(np.sign(v @ rotation).T @ v, full_matrices=False)
            rotation = (left @ right).T
        blocks.append((axes @ rotation)[:, :width])
    return Codes(center, np.concatenate(blocks, axis=1), length, substrings, radius)


def _near_values(part: int) -> list[np.ndarray]:
    """16-bit masks by number of set bits, up to ``part``."""
    return [np.array([sum(1 << b for b in c) for c in combinations(range(16), k)], dtype=np.uint16) for k in range(part + 1)]


class _Index:
    """Substring values -> rows of a base block."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = np.asfortranarray(codes)
        self.order = [np.argsort(codes[:, s], kind="stable") for s in range(codes.shape[1])]
        self.first = [np.searchsorted(codes[o, s], np.arange((1 << 16) + 1)) for s, o in enumerate(self.order)]

    def probe(self, code: np.ndarray, parts: list[int], masks: list[np.ndarray]) -> np.ndarray:
        """Rows with some substring at most ``parts[s]`` bits from the query's."""
        flags = np.zeros(len(self.codes), dtype=bool)
        for s, part in enumerate(parts):
            if part < 0:
                continue
            if sum(len(m) for m in masks[: part + 1]) < len(flags):
                values = (np.concatenate(masks[: part + 1]) ^ code[s]).astype(np.int64)
                a, b = self.first[s][values], self.first[s][values + 1]
                sizes = b - a
                at = np.repeat(a - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
                flags[self.order[s][at]] = True
            else:  # there are fewer rows than values to probe
                flags |= np.bitwise_count(self.codes[:, s] ^ code[s]) <= part
        return np.flatnonzero(flags)


def _parts(radius: int, substrings: int) -> list[int]:
    """Radii per substring that by the pigeonhole principle lose no code within ``radius``."""
    small, more = divmod(radius, substrings)
    return [small if s <= more else small - 1 for s in range(substrings)]


def _search(codes: Codes, nearest: int):
    bits = 16 * codes.substrings
    masks = _near_values(16)

    def search(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            queries, base = _matrix(left), _matrix(right)
            ids, own = right["vec_id"].to_numpy(), left["vec_id"].to_numpy()
            base_codes, query_codes = codes.encode(base, True), codes.encode(queries, False)
            index = _Index(base_codes)
            for q, code in enumerate(query_codes):
                radius = codes.radius
                while True:
                    rows = index.probe(code, _parts(radius, codes.substrings), masks)
                    distance = np.bitwise_count(base_codes[rows] ^ code).sum(axis=1, dtype=np.int64)
                    rows = rows[distance <= radius]
                    if radius >= bits or len(rows) > RERANK * nearest:
                        break
                    radius += codes.substrings
                rows = rows[ids[rows] != own[q]]
                score = base[rows] @ queries[q]
                if len(rows) > nearest:
                    least = np.partition(score, len(score) - nearest)[len(score) - nearest]
                    top = score >= least  # ties with the last one stay, the smaller ids are taken later
                    rows, score = rows[top], score[top]
                    order = np.lexsort((ids[rows], -score))[:nearest]
                    rows, score = rows[order], score[order]
                out["query_id"].append(np.full(len(rows), own[q]))
                out["vec_id"].append(ids[rows])
                out["score"].append(score)
        arrays = [np.concatenate(v) if v else np.zeros(0) for v in out.values()]
        return pa.table({"query_id": pa.array(arrays[0], pa.int64()), "vec_id": pa.array(arrays[1], pa.int64()), "score": pa.array(arrays[2], pa.float64())})

    return search


def _matrix(table: pa.Table) -> np.ndarray:
    column = table["vector"].combine_chunks()
    return column.flatten().to_numpy().astype(np.float64).reshape(table.num_rows, -1)


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, vector: doubles, n2) of the vectors without null, zero, or null or non-finite components."""
    rows = vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull())
    rows = rows.select(F.col(key).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.where(~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    return rows.withColumn("n2", F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)).where("n2 > 0")


def nearest_neighbours(
    vectors: DataFrame,
    is_query,
    nearest: int = 20,
    substrings: int = 8,
    radius: int = 54,
    sample: int = SAMPLE_ROWS,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``nearest`` rows found for each row where ``is_query`` holds.

    Score is the inner product of the original vectors in double precision; ties go to the smaller id. Found
    are rows whose code of ``16 * substrings`` bits lies within ``radius`` of the query's, a radius that widens
    where a block holds few such rows. Only the code is
    fitted on ``sample`` rows, those with the smallest hash; every row is indexed and searched.

    Defined results: vectors that are null, zero or hold null or non-finite components take no part; rows with
    the same id are candidates of their own; an empty table gives an empty result. Vectors of several lengths
    are an error.
    """
    rows = usable(vectors, key, vector)
    shape = rows.agg(F.max("n2").alias("n2"), F.count(F.lit(1)).alias("n"), F.min(F.size("vector")).alias("lo"), F.max(F.size("vector")).alias("hi")).first()
    empty = vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    if not shape["n"]:
        return empty
    if shape["lo"] != shape["hi"]:
        raise ValueError(f"vectors have between {shape['lo']} and {shape['hi']} components")
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("vector").toArrow()
    codes = learn(_matrix(chosen), float(np.sqrt(shape["n2"])), substrings, radius)

    asked = rows.where(is_query)
    q_blocks, b_blocks = (max(1, -(-n // size)) for n, size in ((asked.count(), QUERY_BLOCK), (shape["n"], BASE_BLOCK)))
    block = lambda n: F.pmod(F.xxhash64("vec_id", F.lit(n)), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    left = asked.select("vec_id", "vector", block(q_blocks).alias("q"), every(b_blocks).alias("b"))
    right = rows.select("vec_id", "vector", every(q_blocks).alias("q"), block(b_blocks).alias("b"))
    found = left.groupBy("q", "b").cogroup(right.groupBy("q", "b")).applyInArrow(_search(codes, nearest), "query_id bigint, vec_id bigint, score double")
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id").asc())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest)
    return ranked.select("query_id", "rank", "vec_id", "score")
