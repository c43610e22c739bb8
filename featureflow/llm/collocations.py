"""Phrase collocations from count streams in prefix and in suffix order.

Phrases of one to ``most`` words are counted per language, within pieces between punctuation and line ends. Of the
counted ones only those with ``least`` occurrences go on; what a phrase is made of occurs as often as the phrase, so
nothing that is looked up later is lost. The counts then form one stream, sorted twice over all languages:

* in prefix order (by the words from the left) a phrase stands behind its own beginnings, with nothing but longer
  phrases of the same beginning in between. One pass in step with the last phrase of every length gives each phrase the
  counts of all its left parts, and tells a left part that the phrase extends it.
* in suffix order (by the words from the right) the same pass gives the counts of all right parts.

No count is looked up in a hash table, and no language or word is gathered in one task: the streams are cut anywhere by
Spark's range partitioning, and what a partition needs of those before it is one row.

Counting is spared what cannot be frequent. Words are counted first, then pairs of frequent words, then longer phrases
of frequent pairs. Tasks know the frequent ones from a bitmap that errs on one side only and is bounded in size: where
it is too full to rule phrases out they are counted and then dropped, with equal results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from featureflow.llm.words import Words, map_runs, mix, multipliers, words_of
from featureflow.operators.lookup import attach, local_copy
from featureflow.session import Scratch

LEAST_COUNT = 30
MOST_WORDS = 4
# A phrase is left out where a longer one takes this share of it, in percent.
PERCENT = 80
SCALE = 2_000_000
NO_LANG = "und"

# Bytes that end a piece: . , ; : ! ? and line feed, vertical tab, form feed, carriage return.
BREAK = np.zeros(256, dtype=bool)
BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
WORD = ~BREAK
WORD[[0x20, 0x09]] = False

# Bits of the bitmap per frequent phrase, and the most and least there are in all.
BITS_EACH = 16
MOST_BITS = 28
LEAST_BITS = 16


def _lang_keys(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """A 64-bit number per row for its language, and the language's name."""
    names = column.fill_null(NO_LANG).cast(pa.string())
    coded = names.dictionary_encode()
    keys = np.array([xxhash.xxh3_64_intdigest(x.encode()) for x in coded.dictionary.to_pylist()], dtype=np.uint64)
    return keys[coded.indices.to_numpy()], names


def _gram_keys(keys: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit number for the ``n`` words from each place on."""
    if n == 1:
        return keys
    size = max(0, len(keys) - n + 1)
    out = np.zeros(size, dtype=np.uint64)
    for j, m in enumerate(multipliers(n, 11)):
        out += keys[j : j + size] * m
    return mix(out)


def _bits(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two places of each key in a bitmap of ``2 ** bits`` bits."""
    mask = np.uint64((1 << bits) - 1)
    return keys & mask, (keys >> np.uint64(32)) & mask


def _held(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the bitmap may hold each key; true for all that it holds."""
    one, two = _bits(keys, (len(bitmap) * 8).bit_length() - 1)
    get = lambda at: (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1
    return (get(one) & get(two)).astype(bool)


def _phrases(words: Words, at: np.ndarray, n: int) -> pa.Array:
    """The ``n`` words from each of the places ``at``, with one space in between."""
    data = np.append(words.data, np.uint8(0x20))
    first = np.full((len(at), 2 * n - 1), len(data) - 1, dtype=np.int64)
    size = np.ones((len(at), 2 * n - 1), dtype=np.int64)
    for j in range(n):
        first[:, 2 * j] = words.starts[at + j]
        size[:, 2 * j] = words.ends[at + j] - words.starts[at + j]
    offsets = np.append(0, np.cumsum(size.sum(axis=1)))
    first, size = first.ravel(), size.ravel()
    ends = np.cumsum(size)
    which = np.repeat(first - ends + size, size) + np.arange(offsets[-1])
    return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[which])).cast(pa.string())


COUNTS = "lang string, n int, phrase string, f bigint"


def _count(run: pa.RecordBatch, orders: range, bitmap: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """(lang, n, phrase, f) of the run's phrases of ``orders`` words whose words (for 2) or pairs the bitmap may hold.

    With single words come rows without a phrase: the languages' words in all.
    """
    words = words_of(run.column(1), table=WORD, lower=True)
    if not len(words.starts):
        return
    breaks = np.append(0, np.cumsum(BREAK[words.data]))
    of, (row_keys, names) = words.doc_of(), _lang_keys(run.column(0))
    piece = breaks[words.starts] + of
    keys = mix(words.hashes + row_keys[of] * np.uint64(0x9E3779B97F4A7C15))

    def rows(n: int, grams: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
        _, first, counts = np.unique(grams, return_index=True, return_counts=True)
        at = places[first]
        columns = [names.take(pa.array(of[at])), pa.array(np.full(len(at), n, np.int32)), _phrases(words, at, n), pa.array(counts)]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "n", "phrase", "f"])

    if 1 in orders:
        yield rows(1, keys, np.arange(len(keys)))
        _, first, which = np.unique(row_keys, return_index=True, return_inverse=True)
        sums = np.bincount(which[of], minlength=len(first))
        none = pa.nulls(len(first), pa.string())
        yield pa.RecordBatch.from_arrays([names.take(pa.array(first)), pa.array(np.ones(len(first), np.int32)), none, pa.array(sums)], names=["lang", "n", "phrase", "f"])
    if orders[-1] == 1:
        return
    good = piece[1:] == piece[:-1]
    if bitmap is not None and 2 in orders:
        word = _held(bitmap, keys)
        good &= word[1:] & word[:-1]
    elif bitmap is not None:
        pairs = np.flatnonzero(good)
        good[pairs] = _held(bitmap, _gram_keys(keys, 2)[pairs])
    open_ = good
    for n in range(2, orders[-1] + 1):
        if n > 2:
            open_ = open_[:-1] & good[n - 2 :]
        places = np.flatnonzero(open_)
        if not len(places):
            return
        if n in orders:
            yield rows(n, _gram_keys(keys, n)[places], places)


def _counted(docs: DataFrame, orders: range, least: int, bitmap: np.ndarray | None) -> DataFrame:
    """(lang, n, phrase, f) over all of ``docs`` (lang, text): phrases with ``least`` occurrences, and totals."""
    held = docs.sparkSession.sparkContext.broadcast(bitmap)

    found = map_runs(docs, "text", lambda run: _count(run, orders, held.value), COUNTS).groupBy("lang", "n", "phrase").agg(F.sum("f").alias("f"))
    return found.where(F.col("phrase").isNull() | (F.col("f") >= least))


def _bitmap(grams: DataFrame, n: int) -> np.ndarray:
    """The bitmap of frequent phrases of ``n`` words; of bounded size, and put together as 64-bit words."""
    size = grams.where("phrase is not null").count()
    bits = min(MOST_BITS, max(LEAST_BITS, (size * BITS_EACH).bit_length()))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(1 << (bits - 3), dtype=np.uint8)
        for batch in batches:
            words = words_of(batch.column(1), table=WORD)
            keys = mix(words.hashes + _lang_keys(batch.column(0))[0][words.doc_of()] * np.uint64(0x9E3779B97F4A7C15))
            for at in _bits(_gram_keys(keys, n)[:: n], bits):
                np.bitwise_or.at(own, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        parts = own.view(np.int64)
        used = np.flatnonzero(parts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(parts[used])], names=["at", "bits"])

    marks = grams.where("phrase is not null").select("lang", "phrase").mapInArrow(mark, "at bigint, bits bigint")
    table = marks.groupBy("at").agg(F.expr("bit_or(bits)").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    out[table["at"].to_numpy()] = table["bits"].to_numpy()
    return out.view(np.uint8)


def frequent_phrases(docs: DataFrame, scratch: Scratch, most: int = MOST_WORDS, least: int = LEAST_COUNT) -> tuple[DataFrame, DataFrame]:
    """(lang, words, f) of the phrases of up to ``most`` words with ``least`` occurrences, and (lang, n) of all words.

    ``docs`` has (lang, text).
    """
    bitmap, tables = None, []
    for orders in (range(1, 2), range(2, 3), range(3, most + 1)):
        if not orders or orders[0] > most:
            break
        tables.append(scratch.write(_counted(docs, orders, least, bitmap), "phrases", keep=True))
        if orders[-1] < most:
            bitmap = _bitmap(tables[-1], orders[0])
    grams = tables[0]
    for t in tables[1:]:
        grams = grams.unionByName(t)
    totals = tables[0].where("phrase is null").select("lang", F.col("f").alias("n"))
    return grams.where("phrase is not null").select("lang", F.split("phrase", " ", -1).alias("words"), "f"), totals


def _in_step(parts: int, words: str, f: str):
    """One pass over a partition in order: the counts of the last phrase of each length, beside every row.

    Nulls stand where that phrase lies in an earlier partition.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), 0
        last = np.full(parts, -1, dtype=np.int64)
        for batch in filter(len, batches):
            n, count = batch.column(words).value_lengths().to_numpy(), batch.column(f).to_numpy()
            spots, found = np.arange(batch.num_rows), []
            for k in range(1, parts + 1):
                at = np.maximum.accumulate(np.where(n == k, spots, -1))
                value = np.where(at >= 0, count[at], last[k - 1])
                last[k - 1] = value[-1]
                found.append(np.where(n > k, value, 0))
            stack = np.stack(found, axis=1).ravel()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * parts, type=pa.int32()), pa.array(stack, mask=stack < 0))
            place = [pa.array(np.full(batch.num_rows, part, np.int64)), pa.array(spots + seen), pa.array(n.astype(np.int32)), lists]
            seen += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, *place], names=[*batch.schema.names, "part", "spot", "n_words", "found"])

    return walk


def _stream(rows: DataFrame, words: str, most: int, name: str, scratch: Scratch) -> DataFrame:
    """``rows`` with ``name``: the counts of the first 1, 2, ... ``most`` - 1 elements of the array ``words``.

    ``rows`` hold every such beginning as a row of its own, with its count ``f``.
    """
    parts = max(1, most - 1)
    fields = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in rows.schema.fields)
    sorted_ = rows.repartitionByRange("lang", words).sortWithinPartitions("lang", words)
    walked = sorted_.mapInArrow(_in_step(parts, words, "f"), f"{fields}, part bigint, spot bigint, n_words int, found array<bigint>")
    walked = scratch.write(walked, f"stream-{name}", keep=True)
    # One row per partition: what stands last in it, and from that what stands last before it.
    ends = walked.groupBy("part").agg(*[F.max(F.when(F.col("n_words") == k, F.struct("spot", "f")))["f"].alias(f"last{k}") for k in range(1, parts + 1)])
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    before = F.array(*[F.last(f"last{k}", ignorenulls=True).over(earlier) for k in range(1, parts + 1)])
    joined = walked.join(F.broadcast(local_copy(ends.select("part", before.alias("before")))), "part")
    filled = F.slice(F.zip_with("found", "before", lambda a, b: F.coalesce(a, b)), F.lit(1), F.col("n_words") - 1)
    return joined.withColumn(name, filled).drop("part", "spot", "found", "before", "n_words")


def collocations(
    docs: DataFrame, most: int = MOST_WORDS, least: int = LEAST_COUNT, percent: int = PERCENT, scale: int = SCALE, lang: str = "lang", text: str = "text"
) -> DataFrame:
    """(lang, phrase, words, a, l, r, n, score, cut) of all phrases of 2 to ``most`` words with ``least`` occurrences.

    ``a`` is the phrase's count and ``n`` the number of words of its language. Of its cuts in two, the one with the
    smallest ``score = floor(scale * a / (l + r))`` stands, after ``cut`` words; ``l`` and ``r`` are its parts' counts.
    Phrases of which a longer one takes ``percent`` in 100 occurrences are left out.

    Defined results: null and empty texts have no words; a null language is ``und``, together with texts that say so;
    equal rows count as often as they occur; ties between cuts go to the first; other columns are not read; an empty
    table, and one without frequent phrases, gives an empty result. Sums beyond 64 bits are not reached by counts, and
    products are taken in decimals of 38 digits.
    """
    if most < 2:
        raise ValueError("phrases have two words at least")
    rows = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    with Scratch(docs.sparkSession) as scratch:
        grams, totals = frequent_phrases(rows, scratch, most, least)
    return scored_phrases(grams, totals, most, percent, scale)


def scored_phrases(grams: DataFrame, totals: DataFrame, most: int, percent: int, scale: int) -> DataFrame:
    """``collocations`` from the frequent phrases (lang, words, f) and the languages' words (lang, n)."""
    with Scratch(grams.sparkSession) as scratch:
        left = _stream(grams, "words", most, "lefts", scratch)
        both = _stream(left.withColumn("back", F.reverse("words")), "back", most, "rights", scratch).drop("back")
        both = scratch.write(both, "parts", keep=True)
    size = F.size("words")
    wide = lambda c: c.cast("decimal(20,0)")
    # A phrase takes one beginning and one end at most: those shorter by a word.
    takes = lambda part: wide(F.col("f")) * 100 >= wide(F.element_at(part, -1)) * percent
    longer = both.where(size > 2)
    taken = longer.where(takes("lefts")).select("lang", F.slice("words", F.lit(1), size - 1).alias("words"))
    taken = taken.unionByName(longer.where(takes("rights")).select("lang", F.slice("words", F.lit(2), size - 1).alias("words")))
    kept = both.where(size > 1).join(taken, ["lang", "words"], "left_anti")

    def cut(k: Column) -> Column:
        a, b = F.get("lefts", k - 1), F.get("rights", size - k - 1)
        score = F.call_function("div", wide(F.col("f")) * scale, wide(a + b))
        return F.struct(score.alias("score"), k.alias("cut"), a.alias("l"), b.alias("r"))

    best = F.array_min(F.transform(F.sequence(F.lit(1), size - 1), cut)).alias("best")
    scored = kept.select("lang", F.array_join("words", " ").alias("phrase"), "words", F.col("f").alias("a"), best)
    known = attach(scored, totals, ["lang"], salt_by=["phrase"])
    return known.select("lang", "phrase", "words", "a", "best.l", "best.r", "n", "best.score", "best.cut")


def strongest(found: DataFrame, each: int) -> DataFrame:
    """Each language's first ``each`` of ``collocations``, numbered from 1 in ``rank``.

    By score and count, largest first, then by phrase in the order of its bytes.
    """
    order = W.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return found.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= each)
