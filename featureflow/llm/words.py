"""Words of many texts at once: flat numpy arrays over the bytes of Arrow string columns.

Texts are handled as UTF-8 bytes. Working memory follows ``CHUNK_BYTES``, not the batch: batches
are cut into runs of rows with about that much text, and only a single longer text exceeds it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

CHUNK_BYTES = 1 << 20

# Bytes of words: all but space, tab, line feed, vertical tab, form feed and carriage return.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

# Bytes of words of letters and digits: 0-9, A-Z, a-z and everything beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def multipliers(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) | np.uint64(1)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the base and of its inverse, modulo 2**64."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, CHUNK_BYTES)
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def _hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span; spans are in order and apart."""
    out = np.empty(len(starts), dtype=np.uint64)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + CHUNK_BYTES, side="right")))
        base, top = int(starts[first]), int(ends[last - 1])
        up, down = _powers(top - base)
        sums = np.zeros(top - base + 1, dtype=np.uint64)
        np.cumsum((data[base:top].astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
        a, b = starts[first:last] - base, ends[first:last] - base
        out[first:last] = mix((sums[b] - sums[a]) * down[a])
        first = last
    return out


@dataclass
class Words:
    """The words of a run of texts: word ``i`` is ``data[starts[i]:ends[i]]`` with hash ``hashes[i]``;
    text ``d`` has the words ``bounds[d]`` to ``bounds[d + 1]`` and the bytes ``offsets[d]`` to
    ``offsets[d + 1]``."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.fill_null("").cast(pa.large_binary())
    _, offsets, data = flat.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[flat.offset : flat.offset + len(flat) + 1]
    size = int(offsets[-1] - offsets[0])
    if data is None or not size:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(flat) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def words_of(column: pa.Array, table: np.ndarray = NOT_SPACE, lower: bool = False) -> Words:
    """Words of every text: longest runs of bytes that ``table`` marks. ``lower`` folds A-Z only."""
    data, offsets = text_bytes(column)
    if lower:
        data = LOWER[data]
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = table[data]
    # A text's first byte begins a word, and its last one ends it, whatever the neighbouring text holds.
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | first[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | first[1:])) + 1
    bounds = np.searchsorted(starts, offsets)
    return Words(data, offsets, starts, ends, bounds, _hash_spans(data, starts, ends))


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` between successive offsets."""
    sums = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def rolling(hashes: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Hash of each ``n`` consecutive words, texts run together; the last ``n - 1`` places are absent."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(size, dtype=np.uint64)
    for j, m in enumerate(multipliers(n, seed)):
        out += hashes[j : j + size] * m
    return mix(out)


def window_starts(bounds: np.ndarray, n: int) -> np.ndarray:
    """Flag per place whether ``n`` words from there lie in one text (aligned with ``rolling``)."""
    size = max(0, int(bounds[-1]) - n + 1)
    flags = np.zeros(size + 1, dtype=np.int64)
    long = np.diff(bounds) >= n
    np.add.at(flags, bounds[:-1][long], 1)
    np.add.at(flags, bounds[1:][long] - n + 1, -1)
    return np.cumsum(flags)[:size] > 0


def runs(batch: pa.RecordBatch, text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``limit`` bytes of text."""
    _, offsets = text_bytes(batch.column(batch.schema.get_field_index(text)))
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = max(first + 1, last)
        yield batch.slice(first, last - first)
        first = last


def map_runs(
    df: DataFrame, text: str, function: Callable[[pa.RecordBatch], pa.RecordBatch | Iterable[pa.RecordBatch]], schema: T.StructType | str
) -> DataFrame:
    """Apply ``function`` to runs of rows with about ``CHUNK_BYTES`` of text."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in runs(batch, text):
                out = function(run)
                if isinstance(out, pa.RecordBatch):
                    yield out
                else:
                    yield from out

    return df.mapInArrow(apply, schema)
