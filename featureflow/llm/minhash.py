"""Near-duplicate documents by b-bit MinHash.

Documents with the same set of shingles are one node. Per node 96 minima are kept: all bits of four
at a time make the 24 band keys, and their low 4 bits, packed into six 64-bit numbers, the signature.
Nodes that share a band key are candidates; equal lanes of two signatures, counted with bit operations
and corrected for lanes that agree by chance, estimate their similarity, and pairs that may reach the
threshold are compared on their full shingle sets.

A band with many members is never expanded into all pairs. Each node is compared with the most similar
of the first members of its bands; after that only bands that hold several components are looked at again.
There the members outside the largest component meet the others, first by signature, to find the components
that may belong together, then on full sets. Both happen inside tasks, in blocks of bounded size, and only
edges that join components come out. What is skipped lies within one component already, so components
stay whole.

At the threshold of 0.8 a pair shares no band with a probability of 3e-6; the estimate's margin is five
standard errors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featureflow.llm.graph import components
from featureflow.llm.tables import free_names, met
from featureflow.llm.words import Words, map_runs, mix, multipliers, words_of
from featureflow.operators.lookup import BROADCAST_BYTES, BROADCAST_ROWS
from featureflow.session import Scratch, input_bytes

BANDS, ROWS = 24, 4
BITS = 4
LANES = 64 // BITS
HASHES = BANDS * ROWS
MARGIN = 0.22
# Rows that are compared with each other in one piece, and rows whose full sets are read off at once.
BLOCK = 2048
LINK_ROWS = 256


def shingle_sets(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``n``-word shingles of every text as sorted hashes, texts run together, and their bounds.

    A text with fewer words, but some, has its whole sequence as one shingle.
    """
    counts, size = words.counts, len(words.hashes)
    m = multipliers(n, 2)
    values = words.hashes * m[0]
    last = np.repeat(words.bounds[1:], counts)
    place = np.arange(size)
    for j in range(1, n):
        further = np.zeros(size, dtype=np.uint64)
        further[: size - j] = words.hashes[j:]
        # A short text ends before the shingle does; the number of words taken tells it from a longer one.
        values += np.where(place + j < last, further * m[j], np.uint64(j))
    values = mix(values)
    first = np.repeat(words.bounds[:-1], counts)
    whole = (place + n <= last) | (place == first)
    kept = np.flatnonzero(whole)
    values, bounds = values[kept], np.searchsorted(kept, words.bounds)
    edges = bounds.tolist()
    for a, b in zip(edges, edges[1:], strict=False):
        values[a:b].sort()
    new = np.ones(len(values), dtype=bool)
    new[1:] = values[1:] != values[:-1]
    new[bounds[:-1][np.diff(bounds) > 0]] = True
    distinct = np.flatnonzero(new)
    return values[distinct], np.searchsorted(distinct, bounds)


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def fingerprints(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """16 bytes per set that depend on the set alone."""
    pair = np.stack([mix(_sums(mix(values + np.uint64(k)), bounds) + np.uint64(k)) for k in (1, 2)], axis=1)
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(pair), [None, pa.py_buffer(np.ascontiguousarray(pair))]).cast(pa.binary())


def _lists(rows: np.ndarray, filled: np.ndarray) -> pa.Array:
    """A list per text, null where ``filled`` is false."""
    width = rows.shape[1]
    offsets = np.concatenate([[0], np.cumsum(np.where(filled, width, 0))]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets, mask=np.append(~filled, False)), pa.array(rows.reshape(-1).astype(np.int64)))
    return lists


def minima_of(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of ``HASHES`` minima per set that is not empty."""
    starts = bounds[:-1][np.diff(bounds) > 0]
    if not len(starts):
        return np.zeros((0, HASHES), dtype=np.uint64)
    return np.stack([np.minimum.reduceat(values * m, starts) for m in multipliers(HASHES, 3)], axis=1)


def band_keys(minima: np.ndarray) -> np.ndarray:
    keys = (minima.reshape(-1, BANDS, ROWS) * multipliers(ROWS, 5)).sum(axis=2, dtype=np.uint64)
    return mix(keys + np.arange(1, BANDS + 1, dtype=np.uint64)).view(np.int64)


def pack(minima: np.ndarray) -> np.ndarray:
    """The low ``BITS`` bits of the minima, ``LANES`` to a number."""
    low = (minima & np.uint64((1 << BITS) - 1)).reshape(-1, HASHES // LANES, LANES)
    shifts = np.arange(LANES, dtype=np.uint64) * np.uint64(BITS)
    return np.bitwise_or.reduce(low << shifts, axis=2).view(np.int64)


def signatures(docs: DataFrame, n: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, fp, bands, sig) per document; bands and sig are null for an empty set."""

    def sign(run: pa.RecordBatch) -> pa.RecordBatch:
        values, bounds = shingle_sets(words_of(run.column(1), lower=True), n)
        filled, minima = np.diff(bounds) > 0, minima_of(values, bounds)
        columns = [run.column(0), pa.array(np.diff(bounds)), fingerprints(values, bounds), _lists(band_keys(minima), filled), _lists(pack(minima), filled)]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "fp", "bands", "sig"])

    kind = docs.schema[key].dataType.simpleString()
    schema = f"doc_id {kind}, n_shingles bigint, fp binary, bands array<bigint>, sig array<bigint>"
    return map_runs(docs.select(key, text), text, sign, schema)


def estimate(a: Column, b: Column) -> Column:
    """Similarity from two packed signatures: equal lanes, less those equal by chance."""
    different = F.lit(0)
    for i in range(HASHES // LANES):
        x = a[i].bitwiseXOR(b[i])
        for shift in (1, 2):  # gather a lane's bits in its lowest one
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        different = different + F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
    chance = 1 / 2**BITS
    return (1 - different / F.lit(float(HASHES)) - chance) / (1 - chance)


def _estimated(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """``pairs`` (node, hub) that may reach the threshold, with ``est``."""
    a = nodes.select("node", F.col("n").alias("n_a"), F.col("sig").alias("sig_a"))
    b = nodes.select(F.col("node").alias("hub"), F.col("n").alias("n_b"), F.col("sig").alias("sig_b"))
    both = pairs.join(a, "node").join(b, "hub")
    sizes = F.least("n_a", "n_b") >= F.lit(threshold - 1e-9) * F.greatest("n_a", "n_b")
    est = estimate(F.col("sig_a"), F.col("sig_b"))
    return both.where(sizes).select("node", "hub", est.alias("est")).where(F.col("est") >= threshold - MARGIN)


def _full_sets(docs: DataFrame, wanted: DataFrame, n: int, key: str, text: str) -> DataFrame:
    """(node, shingles: sorted hashes as bytes) of the nodes in ``wanted`` (node, first_id, fp; a written table).

    The texts stay where they are if ``wanted`` is small enough to be broadcast.
    """
    side = F.broadcast(wanted) if input_bytes(wanted) <= BROADCAST_BYTES and wanted.count() <= BROADCAST_ROWS else wanted
    rows = docs.select(F.col(key).alias("first_id"), F.col(text).alias("__text")).join(side, "first_id")

    def gather(run: pa.RecordBatch) -> pa.RecordBatch:
        values, bounds = shingle_sets(words_of(run.column(0), lower=True), n)
        same = [x == y for x, y in zip(fingerprints(values, bounds).to_pylist(), run.column(2).to_pylist(), strict=True)]
        offsets = pa.py_buffer((bounds * 8).astype(np.int32))
        sets = pa.Array.from_buffers(pa.binary(), run.num_rows, [None, offsets, pa.py_buffer(values)])
        out = pa.RecordBatch.from_arrays([run.column(1), sets], names=["node", "shingles"])
        return out.filter(pa.array(same, type=pa.bool_()))

    return map_runs(rows.select("__text", "node", "fp"), "__text", gather, "node bigint, shingles binary")


def _shared(x: np.ndarray, y: np.ndarray) -> int:
    merged = np.concatenate([x, y])
    merged.sort(kind="stable")
    return int((merged[1:] == merged[:-1]).sum())


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (node, hub) whose full sets have 100 * intersection >= percent * union, as edges (a, b)."""
    a = sets.select("node", F.col("shingles").alias("s_a"))
    b = sets.select(F.col("node").alias("hub"), F.col("shingles").alias("s_b"))
    both = pairs.select("node", "hub").join(a, "node").join(b, "hub").select("node", "hub", "s_a", "s_b")

    def compare(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                shared = _shared(x, y)
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            out = batch.select([0, 1]).rename_columns(["a", "b"])
            yield out.filter(pa.array(keep, type=pa.bool_()))

    return both.mapInArrow(compare, "a bigint, b bigint")


def _in_blocks(rows: DataFrame, key: str, function: Callable[[pa.Table], list[tuple[int, int]]], block: int = BLOCK) -> DataFrame:
    """Edges (a, b) that ``function`` finds among the rows of each ``key``.

    A key with over ``block`` rows is cut into blocks by a hash of ``node``, and every pair of blocks is
    looked at by itself, so ``function`` never gets more than about twice ``block`` rows.
    """
    sizes = rows.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("__n"))
    cut = rows.join(sizes, key).withColumn("__own", F.pmod(F.xxhash64("node"), F.col("__n")).cast("int"))
    met = cut.withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
    group = [key, "__lo", "__hi"]
    placed = met.withColumns({"__lo": F.least("__own", "__other"), "__hi": F.greatest("__own", "__other")}).drop("__own", "__other", "__n")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def found() -> pa.RecordBatch:
            edges = function(pa.Table.from_batches(held).combine_chunks())
            return pa.RecordBatch.from_arrays([pa.array([e[i] for e in edges], type=pa.int64()) for i in (0, 1)], names=["a", "b"])

        for batch in batches:
            ids = np.stack([batch.column(batch.schema.get_field_index(c)).to_numpy().astype(np.int64) for c in group], axis=1)
            edges = [0, *(np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if held and any(held[-1].column(held[-1].schema.get_field_index(c))[0].as_py() != int(v) for c, v in zip(group, ids[a], strict=True)):
                    yield found()
                    held = []
                held.append(batch.slice(a, b - a))
        if held:
            yield found()

    return placed.repartition(*group).sortWithinPartitions(*group).mapInArrow(each, "a bigint, b bigint")


class _Group:
    """Nodes of a block with their components, merged further as links are found."""

    def __init__(self, table: pa.Table, threshold: float) -> None:
        self.threshold = threshold
        self.node, self.n = table["node"].to_numpy(), table["n"].to_numpy()
        self.root = table["root"].to_numpy()
        _, self.label = np.unique(self.root, return_inverse=True)
        self.sig = table["sig"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(self.node), -1)

    def outside(self) -> np.ndarray:
        """Rows outside the largest component."""
        return np.flatnonzero(self.label != np.bincount(self.label).argmax())

    def likely(self, i: int) -> np.ndarray:
        """Rows of other components that may reach the threshold with row ``i``."""
        n, own = self.n, self.n[i]
        rows = np.flatnonzero((self.label != self.label[i]) & (np.minimum(n, own) >= (self.threshold - 1e-9) * np.maximum(n, own)))
        x = self.sig[rows] ^ self.sig[i]
        x |= x >> np.uint64(1)
        x |= x >> np.uint64(2)
        equal = 1 - np.bitwise_count(x & np.uint64(0x1111111111111111)).sum(axis=1) / HASHES
        chance = 1 / 2**BITS
        return rows[(equal - chance) / (1 - chance) >= self.threshold - MARGIN]

    def merge(self, i: int, j: int) -> None:
        self.label[self.label == self.label[j]] = self.label[i]


def _families(table: pa.Table, threshold: float) -> list[tuple[int, int]]:
    """Components of a band that hold likely pairs, as edges that span them."""
    group, edges = _Group(table, threshold), []
    for i in group.outside():
        for j in group.likely(i):
            if group.label[i] != group.label[j]:
                edges.append((int(group.root[i]), int(group.root[j])))
                group.merge(i, j)
    return edges


def _links(table: pa.Table, threshold: float, percent: int) -> list[tuple[int, int]]:
    """Links on full sets that join components of a family."""
    group, edges = _Group(table, threshold), []
    column = table["shingles"].combine_chunks()
    sets = [np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in column]
    for i in group.outside():
        rows = group.likely(i)
        while len(rows):
            # Shingles shared with many others at once; then one link to each component is enough.
            some, rows = rows[:LINK_ROWS], rows[LINK_ROWS:]
            flat = np.concatenate([sets[j] for j in some])
            at = np.minimum(np.searchsorted(sets[i], flat), len(sets[i]) - 1)
            shared = np.add.reduceat(sets[i][at] == flat, np.cumsum([0, *(len(sets[j]) for j in some[:-1])]))
            union = len(sets[i]) + np.array([len(sets[j]) for j in some]) - shared
            for j in some[100 * shared >= percent * union]:
                if group.label[i] != group.label[j]:
                    edges.append((int(group.node[i]), int(group.node[j])))
                    group.merge(i, j)
            rows = rows[group.label[rows] != group.label[i]]
    return edges


def near_duplicates(
    docs: DataFrame, n: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text", min_id: str = "component_id"
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``.

    Linked are documents whose sets of ``n``-word shingles (words between ASCII white space, A-Z folded)
    have 100 * intersection >= ``percent`` * union; ``component_id`` is the smallest ``doc_id`` reachable.

    Defined results: without words a document is linked with nothing; rows with the same ``doc_id`` and
    text are one; a null ``doc_id`` has a null component unless linked with a row that has one, and is never kept;
    an empty table gives an empty result.
    """
    spark, threshold = docs.sparkSession, percent / 100
    with Scratch(spark) as scratch:
        signed = scratch.write(signatures(docs, n, key, text), "signatures", keep=True)
        grouped = signed.where("n_shingles > 0").groupBy("fp").agg(
            F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("sig").alias("sig")
        )
        nodes = scratch.write(grouped.withColumn("node", F.monotonically_increasing_id()), "nodes")

        keyed = nodes.select("node", F.explode("bands").alias("key"))
        shared = keyed.groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("size")).where("size > 1")
        members = scratch.write(keyed.join(shared.select("key", "hub"), "key"), "members")
        star = members.where("node <> hub").select("node", "hub").distinct()
        best = _estimated(star, nodes, threshold).groupBy("node").agg(F.max_by("hub", F.struct("est", "hub")).alias("hub"))
        best = scratch.write(best, "best")

        def sets_of(wanted: DataFrame, known: DataFrame | None = None) -> DataFrame:
            if known is not None:
                wanted = wanted.join(known.select("node"), "node", "left_anti")
            wanted = scratch.write(nodes.select("node", "first_id", "fp").join(wanted, "node"), "wanted")
            return scratch.write(_full_sets(docs, wanted, n, key, text).dropDuplicates(["node"]), "sets")

        sets = sets_of(best.select("node").union(best.select("hub")).distinct())
        links = scratch.write(_confirmed(best, sets, percent), "links")
        comps = components(links, scratch)

        # Bands that hold several components.
        placed = members.select("key", "node").join(comps, "node", "left").withColumn("root", F.coalesce("root", "node"))
        split = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("key")
        signed_nodes = nodes.select("node", "n", "sig")
        open_ = placed.join(split, "key").join(signed_nodes, "node")
        related = scratch.write(_in_blocks(open_, "key", lambda t: _families(t, threshold)), "related")
        families = components(related, scratch).select(F.col("node").alias("root"), F.col("root").alias("family"))
        roots = nodes.select("node").join(comps, "node", "left").withColumn("root", F.coalesce("root", "node"))
        kin = scratch.write(roots.join(families, "root"), "kin")
        if not kin.isEmpty():
            sets = sets.unionByName(sets_of(kin.select("node"), sets))
            late = _in_blocks(kin.join(signed_nodes, "node").join(sets, "node"), "family", lambda t: _links(t, threshold, percent))
            comps = components(scratch.write(links.unionByName(late), "links"), scratch)

        placed = nodes.select("node", "fp", "first_id").join(comps, "node", "left").withColumn("root", F.coalesce("root", "node"))
        smallest = placed.groupBy("root").agg(F.min("first_id").alias("smallest"))
        named = scratch.write(placed.join(smallest, "root").select("fp", "smallest"), "components", keep=True)

    rows = signed.select("doc_id", "n_shingles", "fp").join(named, "fp", "left")
    found = F.when(F.col("n_shingles") > 0, F.col("smallest")).otherwise(F.col("doc_id"))
    out = rows.select("doc_id", "n_shingles", found.alias(min_id))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col(min_id), F.lit(False)))


def without_near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each class of ``near_duplicates``, the one with the smallest id; columns unchanged.

    Rows with the same id stay or go together, but of rows with the same id and text one stays. Rows without
    an id stay.
    """
    known = docs.where(F.col(key).isNotNull())
    own, hashed = free_names(docs, "kept_id", "text_hash")
    found = near_duplicates(known, n, percent, key, text)
    kept = met(known, found.where("kept").select(F.col("doc_id").alias(own)).distinct(), [key], "left_semi")
    # Only rows whose id occurs again are looked at for copies.
    several = known.groupBy(F.col(key).alias(own)).agg(F.count(F.lit(1)).alias(hashed)).where(F.col(hashed) > 1).select(own)
    with Scratch(docs.sparkSession) as scratch:
        several = scratch.write(several, "several", keep=True)
    if several.isEmpty():
        return kept.unionByName(docs.where(F.col(key).isNull()))
    single, again = met(kept, several, [key], "left_anti"), met(kept, several, [key], "left_semi")
    one = again.withColumn(hashed, F.xxhash64(text)).dropDuplicates([key, hashed]).drop(hashed)
    return single.unionByName(one).unionByName(docs.where(F.col(key).isNull()))
