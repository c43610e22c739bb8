"""Packing tokenised documents into training sequences by vector best-fit.

A sequence has three capacities: tokens, documents and attention cost (the sum of squared piece lengths).
Pieces are placed in descending length, each into the open sequence that fits it in every dimension and
scores best: with the smallest weighted norm of what would be left (``rule="norm"``), or with the largest
weighted dot product of the piece and what is left (``rule="dot"``).

Pieces are dealt by hash to groups of about ``GROUP_ROWS`` rows that are packed independently, which costs
at most one part-filled sequence a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureflow.llm.tables import free_names
from featureflow.llm.tokens import tokenizer
from featureflow.llm.words import map_runs
from featureflow.session import Scratch

GROUP_ROWS = 32_768
# Sequence numbers of one group start here times the group.
GROUP_STEP = 1 << 32


@dataclass(frozen=True)
class Capacity:
    """What one sequence holds. With the defaults documents and attention never bind before tokens do."""

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3)


def token_pieces(docs: DataFrame, path: str, tokens: int = 2048, end_id: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids): every document's ids and ``end_id``, cut into pieces of ``tokens``.

    ``ids`` are little-endian unsigned 32-bit numbers. A null text is empty: its only id is ``end_id``.
    """

    def cut(run: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        coder, end = tokenizer(path), np.array([end_id], dtype="<u4").tobytes()
        rows, piece, start, ids = [], [], [], []
        for i, t in enumerate(run.column(1).to_pylist()):
            raw = coder.encode(t) + end
            for k, at in enumerate(range(0, len(raw), 4 * tokens)):
                rows.append(i)
                piece.append(k)
                start.append(at // 4)
                ids.append(raw[at : at + 4 * tokens])
        columns = [
            run.column(0).take(pa.array(rows, type=pa.int64())),
            pa.array(piece, type=pa.int32()),
            pa.array(start, type=pa.int64()),
            pa.array([len(x) // 4 for x in ids], type=pa.int64()),
            pa.array(ids, type=pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return map_runs(docs.select(key, text), text, cut, f"doc_id {kind}, piece int, start bigint, length bigint, ids binary")


def best_fit(lengths: np.ndarray, capacity: Capacity, rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece."""
    caps = np.array([capacity.tokens, capacity.documents, capacity.attention], dtype=float)
    weights = np.array(capacity.weights)
    if len(lengths) and (lengths.max() > capacity.tokens or float(lengths.max()) ** 2 > capacity.attention or capacity.documents < 1):
        raise ValueError("a piece exceeds the capacity of a sequence")
    sequence, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    order = np.argsort(-lengths, kind="stable")
    left = np.zeros((3, max(1, len(lengths))))  # of open sequences, as shares of the capacities
    number = np.zeros(max(1, len(lengths)), dtype=np.int64)
    open_, made = 0, 0
    for i in order:
        size = float(lengths[i])
        need = np.array([size, 1.0, size * size]) / caps
        rest = left[:, :open_] - need[:, None]
        fits = (rest > -1e-12).all(axis=0)
        at = -1
        if fits.any():
            if rule == "norm":
                score = weights @ (rest * rest)
            else:
                score = -((weights * need) @ left[:, :open_])
            score[~fits] = np.inf
            at = int(np.argmin(score))
        if at < 0:
            at = open_
            left[:, at], number[at] = 1.0, made
            open_, made = open_ + 1, made + 1
        sequence[i] = number[at]
        offset[i] = round((1.0 - left[0, at]) * caps[0])
        left[:, at] -= need
        if left[0, at] * caps[0] < 0.5 or left[1, at] * caps[1] < 0.5 or left[2, at] * caps[2] < 0.5:
            open_ -= 1  # nothing fits any more; the last open one takes its place
            left[:, at], number[at] = left[:, open_], number[open_]
    return sequence, offset


def pack(pieces: DataFrame, capacity: Capacity = Capacity(), length: str = "length", rule: str = "norm") -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length``; other columns pass through.

    Rows with equal values are packed as rows of their own. ``pieces`` should be narrow: leave the ids out
    and join them, or read them again, afterwards. An empty table gives an empty result.
    """
    row, group = free_names(pieces, "__row", "__group")
    with Scratch(pieces.sparkSession) as scratch:
        numbered = scratch.write(pieces.withColumn(row, F.monotonically_increasing_id()), "pieces", keep=True)
        groups = max(1, -(-numbered.count() // GROUP_ROWS))
    dealt = numbered.withColumn(group, F.pmod(F.xxhash64(row), F.lit(groups))).drop(row)

    def fill(table: pa.Table) -> pa.Table:
        sequence, offset = best_fit(table[length].to_numpy(), capacity, rule)
        sequence += np.int64(table[group][0].as_py()) * GROUP_STEP
        kept = table.drop_columns([group])
        return kept.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return dealt.groupBy(group).applyInArrow(fill, f"{fields}, sequence_id bigint, offset bigint")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids): the ids of each sequence joined in order, from packed pieces with ``ids``."""
    held = F.struct("offset", "doc_id", "ids")
    ordered = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(held)).alias("p"))
    joined = F.unhex(F.array_join(F.transform("p", lambda x: F.hex(x["ids"])), ""))
    return ordered.select("sequence_id", joined.alias("ids"), F.col("p.doc_id").alias("doc_ids"))
