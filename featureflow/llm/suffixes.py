"""Repeated passages by a sparse suffix array.

Texts are sequences of words (between ASCII white space, A-Z folded). A suffix is retained where its
first ``SEED_WORDS`` words have the smallest hash within some window of ``least`` words, so the choice
depends on the window's content alone and every window has exactly one such place, its seed. Suffixes
are counted by their first words; those that occur once are dropped. The others are sorted, equal
neighbours are gathered, and each is extended left and right, over all windows it is the seed of, as far
as another suffix agrees. The result is exact: a window of ``least`` words is found if and only if it
occurs twice.

The earliest place (smallest document, then position) of a window stays, the later ones are removed.
Copies of a whole text are settled by a fingerprint first, so a text takes part once however many
documents hold it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureflow.llm.tables import free_names, met
from featureflow.llm.words import Words, map_runs, rolling, window_starts, words_of
from featureflow.session import Scratch

LEAST_WORDS = 50
SEED_WORDS = 20
# Seeds with more places than this are extended by aggregations that combine before the shuffle.
HOT_PLACES = 50_000
# Windows that are sorted at a time.
CHUNK_WINDOWS = 1 << 20


def fingerprint(words: Words) -> pa.Array:
    """16 bytes per text that depend on its sequence of words."""
    raw, edges = words.hashes.tobytes(), (words.bounds * 8).tolist()
    return pa.array([xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(edges, edges[1:], strict=False)], type=pa.binary())


def window_seeds(words: Words, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window starts, the seed's place of each, hash per place) for all windows of ``least`` words."""
    k = min(SEED_WORDS, least)
    span = least - k + 1
    hashes = rolling(words.hashes, k, 6)
    starts = np.flatnonzero(window_starts(words.bounds, least))
    if not len(starts):
        return starts, starts, hashes
    # Smallest hash in a window, the leftmost if there are several: the place fills the low bits.
    low = np.uint64((1 << max(24, len(hashes).bit_length())) - 1)
    best, width = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64), 1
    while 2 * width <= span:
        best, width = np.minimum(best[:-width], best[width:]), 2 * width
    if width < span:
        best = np.minimum(best[: len(best) - (span - width)], best[span - width :])
    return starts, (best[starts] & low).astype(np.int64), hashes


def _seed_table(docs: DataFrame, least: int, key: str, text: str) -> DataFrame:
    """(doc_id, fp, n_words, seeds) of the texts with ``least`` words or more."""

    def choose(run: pa.RecordBatch) -> pa.RecordBatch:
        words = words_of(run.column(1), lower=True)
        starts, owners, hashes = window_seeds(words, least)
        places = np.unique(owners)
        bounds = np.searchsorted(places, words.bounds)
        seeds = pa.ListArray.from_arrays(pa.array(bounds, type=pa.int32()), pa.array(hashes[places].view(np.int64)))
        columns = [run.column(0), fingerprint(words), pa.array(words.counts), seeds]
        out = pa.RecordBatch.from_arrays(columns, names=["doc_id", "fp", "n_words", "seeds"])
        return out.filter(pa.array(words.counts >= least))

    kind = docs.schema[key].dataType.simpleString()
    return map_runs(docs.select(key, text), text, choose, f"doc_id {kind}, fp binary, n_words bigint, seeds array<bigint>")


def _places(docs: DataFrame, wanted: DataFrame, least: int, key: str, text: str) -> DataFrame:
    """(seed, hot, node, start, windows): the windows of each retained suffix, as hashes from ``start`` on."""
    rows = docs.select(F.col(key).alias("first_id"), F.col(text).alias("__text")).join(wanted, "first_id")

    def extend(run: pa.RecordBatch) -> pa.RecordBatch:
        words = words_of(run.column(0), lower=True)
        same = np.array([x == y for x, y in zip(fingerprint(words).to_pylist(), run.column(2).to_pylist(), strict=True)], dtype=bool)
        starts, owners, hashes = window_seeds(words, least)
        windows = rolling(words.hashes, least, 7)
        text_of = words.doc_of()[starts]
        node = run.column(1).to_numpy()
        # Offsets of a slice count from the start of the whole array of values.
        wanted_seeds, offsets = run.column(3).values.to_numpy().view(np.uint64), run.column(3).offsets.to_numpy()
        keep, hot = np.zeros(len(starts), dtype=bool), np.zeros(len(starts), dtype=bool)
        hot_lists = run.column(4)
        cuts = np.searchsorted(text_of, np.arange(run.num_rows + 1))
        for d in np.flatnonzero(same):
            a, b = cuts[d], cuts[d + 1]
            found = hashes[owners[a:b]]
            keep[a:b] = np.isin(found, wanted_seeds[offsets[d] : offsets[d + 1]])
            if len(hot_lists[d]):
                hot[a:b] = np.isin(found, hot_lists[d].values.to_numpy().view(np.uint64))
        starts, owners, text_of, hot = starts[keep], owners[keep], text_of[keep], hot[keep]
        new = np.ones(len(starts), dtype=bool)
        new[1:] = (owners[1:] != owners[:-1]) | (starts[1:] != starts[:-1] + 1)
        heads = np.flatnonzero(new)
        lists = pa.ListArray.from_arrays(pa.array(np.append(heads, len(starts)), type=pa.int32()), pa.array(windows[starts].view(np.int64)))
        columns = [
            pa.array(hashes[owners[heads]].view(np.int64)),
            pa.array(hot[heads]),
            pa.array(node[text_of[heads]]),
            pa.array(starts[heads] - words.bounds[text_of[heads]]),
            lists,
        ]
        return pa.RecordBatch.from_arrays(columns, names=["seed", "hot", "node", "start", "windows"])

    schema = "seed bigint, hot boolean, node bigint, start bigint, windows array<bigint>"
    return map_runs(rows.select("__text", "node", "fp", "seeds", "hot_seeds"), "__text", extend, schema)


def _agreeing(seed: np.ndarray, node: np.ndarray, start: np.ndarray, window: np.ndarray) -> pa.RecordBatch:
    """Runs (node, lo, hi, later) of window starts whose windows occur at another place too."""
    order = np.lexsort((start, node, window))
    w, n, s = window[order], node[order], start[order]
    new = np.ones(len(w), dtype=bool)
    new[1:] = w[1:] != w[:-1]
    heads = np.flatnonzero(new)
    sizes = np.diff(np.append(heads, len(w)))
    group_first, group_last = np.repeat(heads, sizes), np.repeat(heads + sizes - 1, sizes)
    later_ = (n != n[group_first]) | (s != s[group_first])
    twice = (n[group_first] != n[group_last]) | (s[group_first] != s[group_last])
    n, s, later_ = n[twice], s[twice], later_[twice]
    order = np.lexsort((s, n))
    n, s, later_ = n[order], s[order], later_[order]
    new = np.ones(len(n), dtype=bool)
    new[1:] = (n[1:] != n[:-1]) | (s[1:] > s[:-1] + 1) | (later_[1:] != later_[:-1])
    heads = np.flatnonzero(new)
    ends = np.append(heads[1:], len(n)) - 1 if len(heads) else heads
    return pa.RecordBatch.from_arrays([pa.array(n[heads]), pa.array(s[heads]), pa.array(s[ends]), pa.array(later_[heads])], names=["node", "lo", "hi", "later"])


def _compare_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by seed; neighbours with one seed are compared together, some seeds at a time."""

    def compared(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts).combine_chunks()
        lists = table["windows"].combine_chunks()
        sizes = lists.value_lengths().to_numpy().astype(np.int64)
        flat = lists.flatten().to_numpy()
        row = np.repeat(np.arange(len(sizes)), sizes)
        within = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        column = {c: table[c].to_numpy()[row] for c in ("seed", "node", "start")}
        return _agreeing(column["seed"], column["node"], column["start"] + within, flat)

    held: list[pa.RecordBatch] = []
    windows = 0
    for batch in batches:
        while batch.num_rows:
            sizes = np.cumsum(batch.column("windows").value_lengths().to_numpy())
            take = batch.num_rows
            if windows + sizes[-1] > CHUNK_WINDOWS:
                # Cut where a seed ends, so that equal neighbours stay together.
                seeds = batch.column("seed").to_numpy()
                edges = np.flatnonzero(seeds[1:] != seeds[:-1]) + 1
                if held and held[-1].column("seed")[-1].as_py() != seeds[0]:
                    edges = np.concatenate([[0], edges])
                if len(edges):
                    near = np.searchsorted(sizes, CHUNK_WINDOWS - windows)
                    take = int(edges[min(np.searchsorted(edges, near), len(edges) - 1)])
                    held.append(batch.slice(0, take))
                    yield compared(held)
                    held, windows, batch = [], 0, batch.slice(take)
                    continue
            held.append(batch)
            windows += int(sizes[-1])
            batch = batch.slice(take)
    if held:
        yield compared(held)


def _hot_runs(places: DataFrame) -> DataFrame:
    """What ``_compare_sorted`` finds, for seeds with very many places: counts combine map-side."""
    each = places.select("node", "start", F.posexplode("windows").alias("at", "window"))
    each = each.select("window", F.struct("node", (F.col("start") + F.col("at")).alias("start")).alias("place"))
    ends = each.groupBy("window").agg(F.min("place").alias("first"), F.max("place").alias("last")).where("first <> last")
    met = each.join(ends.select("window", "first"), "window")
    return met.select("place.node", F.col("place.start").alias("lo"), F.col("place.start").alias("hi"), (F.col("place") != F.col("first")).alias("later"))


def _merged(least: int):
    """Runs of window starts of a text -> spans of words: (from, to, removed)."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"node": [], "spans": []}
            for node, runs in zip(batch.column("node").to_pylist(), batch.column("runs").to_pylist(), strict=True):
                size = max(r["hi"] for r in runs) + least
                steps = np.zeros((2, size + 1), dtype=np.int64)
                for r in runs:
                    for which in (0, 1) if r["later"] else (0,):
                        steps[which, r["lo"]] += 1
                        steps[which, r["hi"] + least] -= 1
                state = (np.cumsum(steps, axis=1)[:, :size] > 0).sum(axis=0)
                cuts = np.concatenate([[0], np.flatnonzero(state[1:] != state[:-1]) + 1, [size]])
                out["node"].append(node)
                out["spans"].append(
                    [{"first_word": int(a), "end_word": int(b), "removed": bool(state[a] == 2)} for a, b in zip(cuts, cuts[1:], strict=False) if state[a]]
                )
            spans = pa.list_(pa.struct([("first_word", pa.int64()), ("end_word", pa.int64()), ("removed", pa.bool_())]))
            yield pa.RecordBatch.from_arrays([pa.array(out["node"], type=pa.int64()), pa.array(out["spans"], type=spans)], names=["node", "spans"])

    return merge


SPANS = "array<struct<first_word:bigint,end_word:bigint,removed:boolean>>"


def _text_spans(docs: DataFrame, least: int, key: str, text: str, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(fp, first_id, n_words, copies, spans) per distinct text, and (doc_id, fp) of the documents that hold them."""
    table = scratch.write(_seed_table(docs, least, key, text), "seeds", keep=True)
    texts = table.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.max("n_words").alias("n_words"), F.count_distinct("doc_id").alias("copies"))
    # Numbers in the order of precedence: the earliest document first.
    texts = scratch.write(texts.orderBy("first_id", "fp").withColumn("node", F.monotonically_increasing_id()), "texts", keep=True)
    firsts = table.join(texts.select("fp", F.col("first_id").alias("doc_id"), "node"), ["fp", "doc_id"])
    seeds = firsts.groupBy("node").agg(F.first("seeds").alias("seeds")).select("node", F.explode("seeds").alias("seed"))
    often = seeds.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    hot = F.when(F.col("n") > HOT_PLACES, F.col("seed"))
    per_text = seeds.join(often, "seed").groupBy("node").agg(F.collect_set("seed").alias("seeds"), F.collect_set(hot).alias("hot_seeds"))
    wanted = texts.select("node", "fp", "first_id").join(per_text, "node")
    places = scratch.write(_places(docs, wanted, least, key, text), "places")
    sorted_ = places.where("not hot").repartition("seed").sortWithinPartitions("seed")
    runs = sorted_.drop("hot").mapInArrow(_compare_sorted, "node bigint, lo bigint, hi bigint, later boolean")
    runs = runs.unionByName(_hot_runs(places.where("hot")))
    gathered = runs.groupBy("node").agg(F.collect_list(F.struct("lo", "hi", "later")).alias("runs"))
    spans = gathered.mapInArrow(_merged(least), f"node bigint, spans {SPANS}")
    return scratch.write(texts.join(spans, "node", "left").drop("node"), "spans", keep=True), table.select("doc_id", "fp")


def repeated_spans(docs: DataFrame, least: int = LEAST_WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, first_word, n_words, removed): the runs of words inside repeated windows of ``least`` words.

    ``removed`` runs lie in a window that also stands earlier, in a smaller ``doc_id`` or further left;
    the others are what stays of a repeated passage.

    Defined results: null, empty and shorter texts have none; rows with the same ``doc_id`` and words are one
    document; documents without an id are left out; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    with Scratch(spark) as scratch:
        spans, held = _text_spans(docs.where(F.col(key).isNotNull()), least, key, text, scratch)
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("first_word"), F.col("n_words").alias("end_word"), F.lit(True).alias("removed")))
    rest = F.coalesce("spans", F.array().cast(SPANS))
    # The first of several copies is repeated as a whole, too.
    covered = F.when(F.col("copies") > 1, _whole_cover()).otherwise(rest)
    mine = held.join(spans, "fp").select("doc_id", F.when(F.col("doc_id") == F.col("first_id"), covered).otherwise(whole).alias("spans"))
    each = mine.distinct().select("doc_id", F.inline("spans"))
    return each.select("doc_id", "first_word", (F.col("end_word") - F.col("first_word")).alias("n_words"), "removed")


def _whole_cover():
    """The removed runs, and between them what stays, over all words of a text."""
    gone = F.filter(F.coalesce("spans", F.array().cast(SPANS)), lambda s: s["removed"])
    edges = F.concat(
        F.array(F.lit(0).cast("bigint")), F.flatten(F.transform(gone, lambda s: F.array(s["first_word"], s["end_word"]))), F.array(F.col("n_words"))
    )
    pairs = F.transform(
        F.sequence(F.lit(0), F.size(edges) - 2),
        lambda i: F.struct(F.get(edges, i).alias("first_word"), F.get(edges, i + 1).alias("end_word"), (F.pmod(i, F.lit(2)) == 1).alias("removed")),
    )
    return F.filter(pairs, lambda s: s["first_word"] < s["end_word"])


def without_repeats(docs: DataFrame, least: int = LEAST_WORDS, key: str = "doc_id", text: str = "text", size: str | None = "n_chars") -> DataFrame:
    """``docs`` with the later copies of repeated passages cut out of ``text``, and ``size`` (if a column) set anew.

    A document of which nothing is left is dropped; one without repeated passages stays as it is, null and
    empty texts included. A cut takes the white space after the passage with it.
    """
    spark = docs.sparkSession
    with Scratch(spark) as scratch:
        spans, held = _text_spans(docs.where(F.col(key).isNotNull()), least, key, text, scratch)
    own, cuts, gone = free_names(docs, "cut_id", "cuts", "gone")
    removed = spans.select("fp", F.col("first_id").alias(own), F.filter("spans", lambda s: s["removed"]).alias("cuts")).where("size(cuts) > 0")
    # Documents that hold the whole text of an earlier one.
    several = spans.where("copies > 1").select("fp", "first_id")
    later = held.join(several, "fp").where("doc_id <> first_id")
    touched = removed.select(own, F.struct("fp", "cuts").alias(cuts), F.lit(None).cast("binary").alias(gone))
    touched = touched.unionByName(later.select(F.col("doc_id").alias(own), F.lit(None).cast(touched.schema[cuts].dataType).alias(cuts), F.col("fp").alias(gone)))
    touched = touched.groupBy(own).agg(F.collect_list(cuts).alias(cuts), F.collect_set(gone).alias(gone))
    joined = met(docs, touched, [key], "left")
    names, at = docs.columns, {c: i for i, c in enumerate(docs.columns)}

    def cut(run: pa.RecordBatch) -> pa.RecordBatch:
        column, per_row, gone = run.column(at[text]), run.column(len(names)).to_pylist(), run.column(len(names) + 1).to_pylist()
        touched = [i for i in range(run.num_rows) if per_row[i] or gone[i]]
        keep, texts = np.ones(run.num_rows, dtype=bool), {}
        if touched:
            words = words_of(column.take(pa.array(touched)), lower=True)
            raw = pa.array(column.take(pa.array(touched))).fill_null("").cast(pa.large_binary()).to_pylist()
            for j, (i, fp) in enumerate(zip(touched, fingerprint(words).to_pylist(), strict=True)):
                a, b, base = int(words.bounds[j]), int(words.bounds[j + 1]), int(words.offsets[j])
                if fp in (gone[i] or ()):
                    keep[i] = False
                    continue
                found = next((c["cuts"] for c in per_row[i] or () if c["fp"] == fp), None)
                if not found:
                    continue
                parts, at_byte = [], 0
                for c in found:
                    parts.append(raw[j][at_byte : int(words.starts[a + c["first_word"]]) - base])
                    at_byte = int(words.starts[a + c["end_word"]]) - base if a + c["end_word"] < b else len(raw[j])
                parts.append(raw[j][at_byte:])
                texts[i] = b"".join(parts).decode("utf-8", errors="replace")
                keep[i] = bool(texts[i].strip(" \t\n\r\x0b\x0c"))
        columns = list(run.columns[: len(names)])
        if texts:
            changed = column.to_pylist()
            for i, t in texts.items():
                changed[i] = t
            columns[at[text]] = pa.array(changed, type=column.type)
            if size in at:
                lengths = columns[at[size]].to_pylist()
                for i, t in texts.items():
                    lengths[i] = len(t)
                columns[at[size]] = pa.array(lengths, type=columns[at[size]].type)
        return pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(keep))

    return map_runs(joined, text, cut, docs.schema)

