"""Alignment of two tokenizers' ids over the same texts, by whitespace anchors.

Both tokenizers encode the whole text, with a space before it. Each id stands for known bytes, so running sums of their
lengths are the byte offsets at which tokens end. An offset is an anchor where tokens of both end and both next ones
begin with a space: there the text is split into windows of some ids of either side, most of them one word.

A window's alignment depends on its ids alone. It is worked out once for a pair of id tuples and kept: the groups
between shared ends, and the links, the pairs of tokens whose bytes overlap. Equal windows of a run of texts are found
by a hash of their ids, and compared id by id with the one whose alignment they take.

Texts whose tokens do not give back their bytes have no tokens; every text is checked, on both sides.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from featureflow.llm.tokens import byte_alphabet
from featureflow.llm.words import mix, multipliers, runs
from featureflow.operators.lookup import attach
from featureflow.session import Scratch

# How byte-level BPE files of this kind cut text before their merges, and the mark of a space in pieces.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE_MARK = "▁"

# Text that is encoded at a time.
RUN_BYTES = 2 << 20
# Bytes of ids and alignments that a worker keeps for windows.
MEMORY = 128 << 20
# What an entry takes besides its own bytes.
ENTRY_BYTES = 400
# tiktoken's pattern search recurses over white space; longer runs of it go to the other library.
LONG_SPACE = re.compile(r"\s{1000}")


class ByteBpe:
    """Ids of byte-level BPE, equal to those of the ``tokenizers`` library on the same file.

    ``tiktoken`` merges by the rank of the merged bytes, the file by pairs. The two agree if ids are numbered in the
    order of merges and each entry's own bytes encode to that entry, which is checked; otherwise the library itself is used.
    """

    def __init__(self, path: str) -> None:
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # their strings in a text are ordinary text
        alphabet = {c: b for b, c in enumerate(byte_alphabet())}
        special = set(self.library.get_added_tokens_decoder())
        entries = {k: i for k, i in self.library.get_vocab(with_added_tokens=True).items() if i not in special}
        self.ranks = {bytes(alphabet[c] for c in k): i for k, i in entries.items()}
        self.fast = None
        if all([t.id for t in self.library.model.tokenize(k)] == [i] for k, i in entries.items()):
            self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens={})
        self.size = max([*self.ranks.values(), *special], default=0) + 1
        self.bytes = {i: b for b, i in self.ranks.items()}

    def encode(self, text: str) -> list[int]:
        if self.fast is not None and not LONG_SPACE.search(text):
            return self.fast.encode_ordinary(text)
        return self.library.encode(text, add_special_tokens=False).ids

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        return [self.encode(" " + t) for t in texts]


class Pieces:
    """Ids of a ``sentencepiece`` model, which puts a space before the text itself."""

    def __init__(self, path: str) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.vocab_size()
        self.bytes = {}
        for i in range(self.size):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                self.bytes[i] = bytes([int(piece[3:5], 16)])
            elif not self.model.is_control(i) and not self.model.is_unknown(i):
                self.bytes[i] = piece.replace(SPACE_MARK, " ").encode()

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1) if texts else []


class Decimals:
    """Ids as decimal numbers, each with a byte for the mark behind it."""

    def __init__(self, size: int) -> None:
        self.size, self.bytes = size, {i: f"{i},".encode() for i in range(size)}


@dataclass
class Side:
    """A coder with its ids' bytes: id ``i`` is ``data[heads[i]:heads[i + 1]]``."""

    coder: ByteBpe | Pieces | Decimals

    def __post_init__(self) -> None:
        each = [self.coder.bytes.get(i, b"") for i in range(self.coder.size)]
        self.data = np.frombuffer(b"".join(each), dtype=np.uint8)
        self.heads = np.append(0, np.cumsum([len(x) for x in each]))
        self.lengths = np.diff(self.heads)

    def flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of each text's."""
        ids = self.coder.encode_all(texts)
        counts = np.array([len(x) for x in ids], dtype=np.int64)
        return np.fromiter(chain.from_iterable(ids), dtype=np.int64, count=int(counts.sum())), counts

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The ids' bytes, one after the other."""
        size = self.lengths[ids]
        ends = np.cumsum(size)
        return self.data[np.repeat(self.heads[ids] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]


@lru_cache(maxsize=4)
def sides(path_a: str, path_b: str) -> tuple[Side, Side, Side]:
    """Both tokenizers, and how their ids are written; once per worker process."""
    one, two = ByteBpe(path_a), Pieces(path_b)
    return Side(one), Side(two), Side(Decimals(max(one.size, two.size)))


def _per_text(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    sums = np.append(0, np.cumsum(values))
    ends = np.cumsum(counts)
    return sums[ends] - sums[ends - counts]


class Windows(dict):
    """Alignments by the bytes of both id tuples, up to ``MEMORY`` bytes of them."""

    held = 0

    def keep(self, key: tuple[bytes, bytes], value: tuple[str, int, bytes]) -> None:
        size = len(key[0]) + len(key[1]) + len(value[0]) + len(value[2]) + ENTRY_BYTES
        if self.held + size > MEMORY:
            self.clear()
            self.held = 0
        self[key] = value
        self.held += size


def _spans(first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all elements of the spans, and the place of each within its span."""
    ends = np.cumsum(size)
    within = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size, size)
    return np.repeat(first, size) + within, within


def _tuple_keys(ids: np.ndarray, heads: np.ndarray, sizes: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit number per window for its ids in their order; windows are apart, in order and not empty."""
    _, within = _spans(heads, sizes)
    weights = multipliers(int(sizes.max()), seed)[within]
    return mix(np.add.reduceat((ids.astype(np.uint64) + np.uint64(1)) * weights, heads) + sizes.astype(np.uint64))


def _equal_to_first(ids: np.ndarray, heads: np.ndarray, sizes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Whether each window has the ids of window ``first`` of it."""
    same = sizes == sizes[first]
    spots, _ = _spans(heads[same], sizes[same])
    other, _ = _spans(heads[first[same]], sizes[same])
    starts = np.cumsum(sizes[same]) - sizes[same]
    if len(starts):
        same[same] = np.logical_and.reduceat(ids[spots] == ids[other], starts)
    return same


@dataclass
class Split:
    """Ids of both sides over the same bytes, with the bytes at which they end, cut into windows at ``anchors``."""

    a: np.ndarray
    b: np.ndarray
    ends_a: np.ndarray
    ends_b: np.ndarray
    starts_a: np.ndarray
    shared: np.ndarray
    anchors: np.ndarray

    def __post_init__(self) -> None:
        stop_a, stop_b = np.searchsorted(self.ends_a, self.anchors) + 1, np.searchsorted(self.ends_b, self.anchors) + 1
        self.head_a, self.head_b = np.append(0, stop_a[:-1]), np.append(0, stop_b[:-1])
        self.size_a, self.size_b = stop_a - self.head_a, stop_b - self.head_b

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """(one window of each kind, the kind of every window); a kind has the same ids on both sides."""
        keys = _tuple_keys(self.a, self.head_a, self.size_a, 13) + _tuple_keys(self.b, self.head_b, self.size_b, 14) * np.uint64(3)
        _, first, which = np.unique(mix(keys), return_index=True, return_inverse=True)
        alike = _equal_to_first(self.a, self.head_a, self.size_a, first[which]) & _equal_to_first(self.b, self.head_b, self.size_b, first[which])
        odd = np.flatnonzero(~alike)  # other ids with the same hash: each such window is a kind of its own
        which[odd] = len(first) + np.arange(len(odd))
        return np.append(first, odd), which

    def tuples(self, windows: np.ndarray) -> list[tuple[bytes, bytes]]:
        """The ids of each of the windows, as bytes."""
        whole_a, whole_b = self.a.astype("<u4").tobytes(), self.b.astype("<u4").tobytes()
        head_a, head_b = 4 * self.head_a[windows], 4 * self.head_b[windows]
        spans = zip(head_a.tolist(), (head_a + 4 * self.size_a[windows]).tolist(), head_b.tolist(), (head_b + 4 * self.size_b[windows]).tolist(), strict=True)
        return [(whole_a[i:j], whole_b[k:m]) for i, j, k, m in spans]

    def align(self, windows: np.ndarray, ids_b: int, names: Side) -> list[tuple[str, int, bytes]]:
        """(groups as text, their number, links as 64-bit numbers) of the windows, which are in order."""
        if not len(windows):
            return []
        size_a, size_b = self.size_a[windows], self.size_b[windows]
        spots_a, _ = _spans(self.head_a[windows], size_a)
        spots_b, _ = _spans(self.head_b[windows], size_b)
        # The group of a token ends at the first shared end from its own on.
        group_a, group_b = np.searchsorted(self.shared, self.ends_a[spots_a]), np.searchsorted(self.shared, self.ends_b[spots_b])
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        last_a, last_b = np.append(group_a[1:] != group_a[:-1], True), np.append(group_b[1:] != group_b[:-1], True)
        marks = np.concatenate([np.where(last_a, ord("|"), ord(",")), np.where(last_b, ord(";"), ord(","))])[order].astype(np.uint8)
        ids = np.concatenate([self.a[spots_a], self.b[spots_b]])[order]
        written = names.joined(ids)
        stops = np.cumsum(names.lengths[ids])
        written[stops - 1] = marks
        text = written.tobytes().decode("ascii")
        ends = stops[np.cumsum(size_a + size_b) - 1].tolist()
        first = np.append(0, np.cumsum(size_a)[:-1])
        groups = (group_a[np.cumsum(size_a) - 1] - group_a[first] + 1).tolist()
        # The tokens of b that overlap one of a: from the one that ends behind its start to the one that reaches its end.
        low = np.searchsorted(self.ends_b, self.starts_a[spots_a], side="right")
        many = np.searchsorted(self.ends_b, self.ends_a[spots_a]) - low + 1
        links = (np.repeat(self.a[spots_a] * ids_b, many) + self.b[_spans(low, many)[0]]).astype("<i8").tobytes()
        bounds = [0, *(8 * np.cumsum(np.add.reduceat(many, first))).tolist()]
        starts = [0, *ends[:-1]]
        return [(text[i : j - 1], n, links[k:m]) for i, j, n, k, m in zip(starts, ends, groups, bounds, bounds[1:], strict=False)]


def align_texts(texts: list[str | None], one: Side, two: Side, names: Side, memory: Windows) -> dict[str, pa.Array]:
    """Per text: n_a, n_b, n_groups, n_links, groups, and its distinct links as a * ids of b + b with their counts."""
    rows = np.array([i for i, t in enumerate(texts) if t], dtype=np.int64)
    kept = [texts[i] for i in rows]
    (a, n_a), (b, n_b) = one.flat(kept), two.flat(kept)
    raw = [(" " + t).encode() for t in kept]
    size = np.array([len(x) for x in raw], dtype=np.int64)
    # Only texts whose tokens give back their bytes go on.
    good = (_per_text(one.lengths[a], n_a) == size) & (_per_text(two.lengths[b], n_b) == size)
    data = np.frombuffer(b"".join(x for x, g in zip(raw, good, strict=True) if g), dtype=np.uint8)
    a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
    differs = (one.joined(a) != data) | (two.joined(b) != data)
    if differs.any():
        sure = _per_text(differs, size[good]) == 0
        data, a, b = data[np.repeat(sure, size[good])], a[np.repeat(sure, n_a[good])], b[np.repeat(sure, n_b[good])]
        good[good] = sure
    rows, size, n_a, n_b = rows[good], size[good], n_a[good], n_b[good]
    numbers = {c: np.zeros(len(texts), dtype=np.int64) for c in ("n_a", "n_b", "n_groups", "n_links")}
    groups, distinct = [""] * len(texts), np.zeros(len(texts), dtype=np.int64)
    links = counts = np.zeros(0, dtype=np.int64)
    if len(rows):
        numbers["n_a"][rows], numbers["n_b"][rows] = n_a, n_b
        found = _align(data, size, a, b, one, two, names, memory)
        numbers["n_groups"][rows], numbers["n_links"][rows], distinct[rows] = found["n_groups"], found["n_links"], found["distinct"]
        for i, text in zip(rows.tolist(), found["groups"], strict=True):
            groups[i] = text
        links, counts = found["links"], found["counts"]
    bounds = pa.array(np.append(0, np.cumsum(distinct)), type=pa.int32())
    lists = {"links": pa.ListArray.from_arrays(bounds, pa.array(links)), "counts": pa.ListArray.from_arrays(bounds, pa.array(counts))}
    return {c: pa.array(v) for c, v in numbers.items()} | {"groups": pa.array(groups, type=pa.string())} | lists


def _align(data: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray, one: Side, two: Side, names: Side, memory: Windows) -> dict:
    """What ``align_texts`` gives for texts of ``size`` bytes in ``data``, whose ids on both sides are ``a`` and ``b``."""
    ends_a, ends_b, edges = np.cumsum(one.lengths[a]), np.cumsum(two.lengths[b]), np.cumsum(size)
    shared = np.intersect1d(ends_a, ends_b, assume_unique=True)
    last = np.zeros(len(data) + 1, dtype=bool)
    last[edges] = True
    anchors = shared[last[shared] | (np.append(data, 0)[shared] == 0x20)]
    split = Split(a, b, ends_a, ends_b, ends_a - one.lengths[a], shared, anchors)
    kinds, which = split.distinct()
    ids = split.tuples(kinds)
    found = [memory.get(k) for k in ids]
    missing = np.array([k for k, x in enumerate(found) if x is None], dtype=np.int64)
    missing = missing[np.argsort(kinds[missing])]
    for k, value in zip(missing.tolist(), split.align(kinds[missing], two.coder.size, names), strict=True):
        found[k] = value
        memory.keep(ids[k], value)
    strings = [x[0] for x in found]
    groups = np.array([x[1] for x in found], dtype=np.int64)
    n_links = np.array([len(x[2]) // 8 for x in found], dtype=np.int64)
    values, local = np.unique(np.frombuffer(b"".join(x[2] for x in found), dtype="<i8"), return_inverse=True)

    of = np.searchsorted(edges, anchors)  # the text of each window
    windows = np.bincount(of, minlength=len(size))
    spots, _ = _spans((np.cumsum(n_links) - n_links)[which], n_links[which])
    pairs, counts = np.unique(np.repeat(of, n_links[which]) * len(values) + local[spots], return_counts=True)
    stops, kind = np.append(0, np.cumsum(windows)).tolist(), which.tolist()
    return {
        "n_groups": _per_text(groups[which], windows),
        "n_links": _per_text(n_links[which], windows),
        "groups": [";".join([strings[w] for w in kind[i:j]]) for i, j in zip(stops, stops[1:], strict=False)],
        "distinct": np.bincount(pairs // len(values), minlength=len(size)),
        "links": values[pairs % len(values)],
        "counts": counts,
    }


COLUMNS = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, links array<bigint>, counts array<bigint>"


def alignments(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups, links, counts) per row of ``docs``.

    ``path_a`` is a byte-level BPE file of the ``tokenizers`` library, ``path_b`` a ``sentencepiece`` model. ``groups``
    lists the ids of each group in order, as ``a1,a2|b1;a3|b2,b3``; ``links`` are the distinct linked ids as
    ``a * ids of b + b``, and ``counts`` how often each pair is linked in the text.

    Defined results: null and empty texts, and texts that either side's tokens do not give back byte for byte, have no
    tokens (zeros, empty lists, empty groups); strings of special tokens are plain text; rows with the same id are rows
    of their own; other columns are not read; an empty table gives an empty result.
    """
    memory = Windows()

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in runs(batch, text, RUN_BYTES):
                out = align_texts(run.column(1).to_pylist(), *sides(path_a, path_b), memory)
                yield pa.RecordBatch.from_arrays([run.column(0), *out.values()], names=["doc_id", *out])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(align, f"doc_id {kind}, {COLUMNS}")


def link_counts(links: DataFrame, ids_b: int) -> DataFrame:
    """(link, count, best) from (link, n): the corpus-wide count of each linked pair, and whether no pair of its id b has more."""
    counts = links.groupBy("link").agg(F.sum("n").alias("count"))
    with_b = counts.withColumn("b", F.pmod("link", F.lit(ids_b)))
    # One row per id of b: as many as its vocabulary has.
    top = with_b.groupBy("b").agg(F.max("count").alias("top"))
    return with_b.join(F.broadcast(top), "b").select("link", "count", (F.col("count") == F.col("top")).alias("best"))


def scored(aligned: DataFrame, ids_b: int) -> DataFrame:
    """``aligned`` without its lists, and with (n_best, count_sum) from the links of all its rows.

    ``n_best`` counts a row's links that no other pair of the same id b exceeds corpus-wide, ``count_sum`` adds up the
    corpus-wide counts of its links. ``aligned`` is read once, and written narrow.
    """
    kept = [c for c in aligned.columns if c not in ("links", "counts")]
    with Scratch(aligned.sparkSession) as scratch:
        table = scratch.write(aligned.withColumn("__row", F.monotonically_increasing_id()), "aligned", keep=True)
        pair = F.explode(F.arrays_zip("links", "counts")).alias("p")
        each = table.select(pair).select(F.col("p.links").alias("link"), F.col("p.counts").alias("n"))
        counts = scratch.write(each.groupBy("link").agg(F.sum("n").alias("n")), "links", keep=True)
    every = table.select("__row", *kept, F.explode_outer(F.arrays_zip("links", "counts")).alias("p"))
    every = every.select("__row", *kept, F.col("p.links").alias("link"), F.col("p.counts").alias("n"))
    known = attach(every, link_counts(counts, ids_b), ["link"], salt_by=["__row"])
    best = F.coalesce(F.sum(F.when(F.col("best"), F.col("n"))), F.lit(0)).alias("n_best")
    total = F.coalesce(F.sum(F.col("n") * F.col("count")), F.lit(0)).alias("count_sum")
    return known.groupBy("__row", *kept).agg(best, total).drop("__row")
