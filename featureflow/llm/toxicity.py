"""Toxicity scores from the nearest labelled examples by exact TF-IDF cosine.

The index holds a bounded sample of labelled texts as TF-IDF vectors over all their terms, with document frequencies
counted over all documents. A term that no labelled text holds is in no example and lengthens a text's vector only; it
weighs as if one document held it. Examples stand in blocks. The terms in most examples have a dense row, with the largest
weight of every block; the others have postings, few in a block. Texts are scored in batches: a block's bound is what the
postings give its best example and the largest weights of the dense terms, and only blocks whose bound reaches the nearest
found so far are multiplied out. The nearest are exact, whatever is left out.

Labels have no say in who is near, only in what the neighbours' votes are worth: a vote counts by the squared similarity
over terms weighted by how well they tell the labels apart in the examples (the root of their G statistic, 1 at least).
Votes are brought to probabilities on labelled texts that are not in the index. Texts that share no term with an example
have no neighbour and get the rate of toxic ones among such texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import InitVar, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from featureflow.llm.words import ALNUM, map_runs, runs, words_of
from featureflow.session import Scratch

# Bounds on what is learned from; they do not depend on the size of the corpus.
INDEX_ROWS = 16_000
CALIBRATION_ROWS = 8_000
# Terms with dense rows, those in the most examples; it moves work between the two layouts, never a result.
FREQUENT = 512
# Results of equal vectors that a worker keeps.
MEMORY = 50_000
# Chosen on examples and calibration rows, as the votes' weights were; held-out rows had no part in it.
NEAREST = 100
BLOCK = 256
# Texts, and postings that they meet, scored at a time.
BATCH_TEXTS = 128
BATCH_POSTINGS = 1 << 22
BINS = 10
# Scores in single precision choose what is scored in double; they are off by less than this.
SLACK = 1e-5


def labelled(docs: DataFrame, labels: DataFrame, rows: int, label: str = "toxic", key: str = "doc_id") -> DataFrame:
    """Distinct texts with a label outside the held-out fold, from at most ``rows`` ids, those with the smallest hash.

    The bound on the ids is what makes the broadcast safe; a repeated id counts as toxic if one row says so.
    """
    one = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).cast("int").alias("__toxic"))
    chosen = one.where(~held_out(key)).orderBy(F.xxhash64(key), key).limit(rows)
    chosen = chosen.withColumn("__place", F.pmod(F.xxhash64(key, F.lit("place")), F.lit(INDEX_ROWS + CALIBRATION_ROWS)))
    found = docs.select(key, "text").join(F.broadcast(chosen), key)
    # Copies of a text would count its terms many times; the sample is bounded, and so is a group of copies in it.
    first = F.row_number().over(W.partitionBy(F.xxhash64("text")).orderBy(key))
    return found.withColumn("__first", first).where("__first = 1").drop("__first")


def held_out(key: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def vocabulary(sample: DataFrame) -> np.ndarray:
    """Hashes of all terms of the sample's texts, ascending; none without labels of both kinds."""
    whole = sample.agg(F.count(F.lit(1)).alias("n"), F.sum("__toxic").alias("bad")).first()
    if not whole["bad"] or whole["bad"] == whole["n"]:
        return np.zeros(0, dtype=np.uint64)

    def distinct(run: pa.RecordBatch) -> pa.RecordBatch:
        found = np.unique(words_of(run.column(0), table=ALNUM, lower=True).hashes)
        return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["term"])

    found = map_runs(sample.select("text"), "text", distinct, "term bigint").distinct().toArrow()
    return np.sort(found["term"].to_numpy().view(np.uint64))


def document_frequencies(docs: DataFrame, terms: np.ndarray, text: str = "text") -> tuple[np.ndarray, int]:
    """Documents that hold each term, and documents in all: one pass over the corpus."""
    held = docs.sparkSession.sparkContext.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        found, rows = np.zeros(len(own) + 1, dtype=np.int64), 0
        for batch in batches:
            for run in runs(batch, text):
                at, _, _ = _counted(run, text, own)
                found[:-1] += np.bincount(at[at < len(own)], minlength=len(own))
                rows += run.num_rows
        found[-1] = rows
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[at])], names=["at", "n"])

    sums = docs.select(text).mapInArrow(count, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(terms) + 1, dtype=np.int64)
    out[sums["at"].to_numpy()] = sums["n"].to_numpy()
    return out[:-1], int(out[-1])


def _counted(run: pa.RecordBatch, text: str, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, row, count) of the distinct terms of every text, by row and place.

    The place is that in ``terms``; terms outside it have places from ``len(terms)`` on, good for this run only.
    """
    words = words_of(run.column(run.schema.get_field_index(text)), table=ALNUM, lower=True)
    if not len(words.hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    found, which = np.unique(words.hashes, return_inverse=True)
    place = len(terms) + np.arange(len(found))
    if len(terms):
        at = np.minimum(np.searchsorted(terms, found), len(terms) - 1)
        place = np.where(terms[at] == found, at, place)
    span = len(terms) + len(found)
    pairs, counts = np.unique(words.doc_of() * span + place[which], return_counts=True)
    return pairs % span, pairs // span, counts


def _telling(at: np.ndarray, toxic: np.ndarray, texts: int, bad: int, terms: int) -> np.ndarray:
    """Factor per term: the root of the G statistic between term and label, 1 at least.

    ``at`` and ``toxic`` are the term and the label of each term of each example.
    """
    n, a = np.bincount(at, minlength=terms), np.bincount(at, weights=toxic, minlength=terms)
    part = lambda x, e: np.where(x > 0, x * np.log(np.maximum(x, 1) / np.maximum(e, 1e-300)), 0.0)
    rate = bad / max(1, texts)
    g = part(a, n * rate) + part(n - a, n * (1 - rate)) + part(bad - a, (texts - n) * rate) + part(texts - bad - n + a, (texts - n) * (1 - rate))
    return np.sqrt(np.maximum(1.0, 2 * g))


@dataclass
class Vector:
    """A text's known terms with their weights, of unit length over all its terms; ``length`` is that over telling terms."""

    row: int
    at: np.ndarray
    value: np.ndarray
    length: float


def _weights(count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return (1 + np.log(count)) * idf


@dataclass
class Index:
    """Inverted index of the examples, and what turns votes into probabilities."""

    terms: np.ndarray
    idf: np.ndarray
    telling: np.ndarray  # per term, how well it tells the labels apart
    ids: np.ndarray  # of examples, in the order of the blocks
    toxic: np.ndarray
    weights: np.ndarray  # example x dense term, of unit-length examples; whole blocks
    largest: np.ndarray  # block x dense term
    dense: np.ndarray  # term -> dense row, -1 for terms with postings
    heads: np.ndarray  # term -> first posting; one more at the end
    posted: InitVar[np.ndarray]  # example of each posting
    posted_weights: InitVar[np.ndarray]
    lengths: np.ndarray  # of examples, with terms weighted by how telling they are
    unseen: float  # idf of terms in no labelled text
    edges: np.ndarray  # votes -> probabilities
    rates: np.ndarray
    nothing: float = 0.0  # rate of texts without neighbours
    k: int = NEAREST
    postings: np.ndarray = field(init=False)  # example in the upper 32 bits, single precision weight in the lower ones: read together

    def __post_init__(self, posted: np.ndarray, posted_weights: np.ndarray) -> None:
        self.postings = posted.astype("<i8") << 32
        self.postings |= posted_weights.astype("<f4").view("<u4")

    def vectors(self, run: pa.RecordBatch, text: str) -> Iterator[Vector]:
        """Texts with known terms; all terms make up the unit length."""
        at, row, count = _counted(run, text, self.terms)
        known = at < len(self.terms)
        place = np.minimum(at, len(self.terms))
        value = _weights(count, np.append(self.idf, self.unseen)[place])
        telling = value * np.append(self.telling, 1.0)[place]
        for first, last in zip(*_runs(row), strict=True):
            v, own = value[first:last], known[first:last]
            if own.any():
                size = np.sqrt((v * v).sum())
                yield Vector(int(row[first]), at[first:last][own], v[own] / size, float(np.sqrt((telling[first:last] ** 2).sum()) / size))

    def batches(self, vectors: Iterator[Vector]) -> Iterator[list[Vector]]:
        """Vectors in lists that meet a bounded number of postings, unless a single one meets more."""
        held: list[Vector] = []
        postings = 0
        for v in vectors:
            rare = v.at[self.dense[v.at] < 0]
            size = int((self.heads[rare + 1] - self.heads[rare]).sum())
            if held and (len(held) == BATCH_TEXTS or postings + size > BATCH_POSTINGS):
                yield held
                held, postings = [], 0
            held.append(v)
            postings += size
        if held:
            yield held

    def _met(self, at: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Postings of the terms, one term after the other: examples, products with the terms' values, and number per term."""
        first, end = self.heads[at], self.heads[at + 1]
        size = end - first
        which = np.repeat(end - np.cumsum(size), size)
        which += np.arange(len(which))
        found = self.postings[which]
        products = np.repeat(value, size)
        products *= found.view("<f4")[::2]
        found >>= 32
        return found, products, size

    def nearest(self, batch: list[Vector]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per text the ``k`` examples of largest cosine above 0, exactly, ties to the smaller place: places, cosines, and
        similarities over telling terms."""
        none = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0))
        if not len(self.ids):
            return [none for _ in batch]
        texts, blocks, k, width = len(batch), len(self.largest), self.k, len(self.weights)
        full = np.zeros((texts, self.weights.shape[1]))
        part = np.empty((texts, width))
        square = np.zeros(full.shape[1])  # telling, of dense terms
        extra = []
        # Postings text by text: what one text meets stays in the processor's cache.
        for i, v in enumerate(batch):
            column = self.dense[v.at]
            common = column >= 0
            full[i, column[common]] = v.value[common]
            square[column[common]] = self.telling[v.at[common]] ** 2
            at, value = v.at[~common], v.value[~common]
            # Most terms tell nothing; those that do stand last, and what they add is found from the same postings.
            told = self.telling[at]
            order = np.argsort(told > 1, kind="stable")
            at, value, told = at[order], value[order], told[order]
            met, products, size = self._met(at, value)
            part[i] = np.bincount(met, weights=products, minlength=width)
            plain = int(np.searchsorted(told > 1, True))
            skip = int(size[:plain].sum())
            extra.append((met[skip:].copy(), products[skip:].copy(), np.cumsum(size[plain:]), told[plain:] ** 2 - 1))
        single = full.astype(np.float32)
        low, scores = part.astype(np.float32), np.full((texts, width), -1.0, dtype=np.float32)
        bounds = low.reshape(texts, blocks, BLOCK).max(axis=2) + single @ self.largest.T

        def fill(rows: np.ndarray | slice, first: int, last: int) -> None:
            span = slice(first * BLOCK, last * BLOCK)
            found = single[rows] @ self.weights[span].T
            found += low[rows, span]
            scores[rows, span] = found

        # The block with the largest bound first: what it holds rules out others.
        every, first = np.arange(texts), bounds.argmax(axis=1)
        for b in np.unique(first):
            fill(np.flatnonzero(first == b), b, b + 1)
        held = scores.reshape(texts, blocks, BLOCK)[every, first]
        least = np.partition(held, BLOCK - k, axis=1)[:, BLOCK - k] if k <= BLOCK else np.zeros(texts)
        needed = (bounds >= least[:, None] - SLACK) & (bounds > 0)
        needed[every, first] = False
        # One product for neighbouring blocks that most texts need; of the others only the texts that need them.
        shared = needed.sum(axis=0) * 2 > texts
        turns = np.flatnonzero(np.diff(shared, prepend=False, append=False))
        for start, stop in zip(turns[::2], turns[1::2], strict=True):
            fill(slice(None), start, stop)
        for b in np.flatnonzero(needed.any(axis=0) & ~shared):
            fill(np.flatnonzero(needed[:, b]), b, b + 1)
        least = np.partition(scores, -k, axis=1)[:, -k] if k < width else np.zeros(texts)
        chosen, slot = np.zeros(width, dtype=bool), np.zeros(width, dtype=np.int64)
        out = []
        for i, v in enumerate(batch):
            limit = least[i] - 2 * SLACK
            best = np.flatnonzero(scores[i] >= limit if limit > 0 else scores[i] > 0)
            own = np.flatnonzero(full[i])
            rows = self.weights[best[:, None], own].astype(np.float64)
            cosine = part[i, best] + rows @ full[i, own]
            order = np.lexsort((best, -np.round(cosine, 12)))[:k]
            best, cosine, rows = best[order], cosine[order], rows[order]
            met, products, ends, factor = extra[i]
            chosen[best], slot[best] = True, np.arange(len(best))
            hit = np.flatnonzero(chosen[met])
            chosen[best] = False
            products = products[hit] * factor[np.searchsorted(ends, hit, side="right")]
            told = part[i, best] + np.bincount(slot[met[hit]], weights=products, minlength=len(best))
            similar = (told + rows @ (full[i, own] * square[own])) / (self.lengths[best] * v.length)
            out.append((best, cosine, similar))
        return out

    def vote(self, best: np.ndarray, similar: np.ndarray) -> float:
        """The neighbours' vote, -1 without any."""
        if not len(best):
            return -1.0
        weight = similar * similar  # nearer examples count more
        # One clean vote of weight 0.1 keeps a single distant neighbour from deciding alone.
        return float((weight * self.toxic[best]).sum() / (weight.sum() + 0.1))

    def probability(self, vote: float) -> float:
        if vote < 0:
            return self.nothing
        return float(np.interp(vote, self.edges, self.rates))


def _runs(row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(row):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    heads = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    return heads, np.append(heads[1:], len(row))


def _isotonic(votes: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising rates over ``BINS`` equal-width bins of votes, each with a little of the whole rate mixed in."""
    if not len(votes):
        return np.array([0.0, 1.0]), np.array([0.0, 1.0])
    at = np.minimum((votes * BINS).astype(int), BINS - 1)
    n, bad = np.bincount(at, minlength=BINS), np.bincount(at, weights=toxic, minlength=BINS)
    middle = (np.arange(BINS) + 0.5) / BINS
    pools: list[list[float]] = []
    for m, c, b in zip(middle, n, bad, strict=True):
        pools.append([m, c + 1.0, b + m, 1.0])  # an empty bin stands for its own votes
        while len(pools) > 1 and pools[-2][2] / pools[-2][1] > pools[-1][2] / pools[-1][1]:
            last = pools.pop()
            pools[-1] = [(pools[-1][0] * pools[-1][3] + last[0] * last[3]) / (pools[-1][3] + last[3]), *(x + y for x, y in zip(pools[-1][1:], last[1:], strict=True))]
    return np.array([p[0] for p in pools]), np.array([p[2] / p[1] for p in pools])


def fit(docs: DataFrame, labels: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text", k: int = NEAREST) -> Index:
    """Learn the index of ``k`` neighbours from labelled rows outside the held-out fold.

    The driver gets the terms and counts of at most ``INDEX_ROWS + CALIBRATION_ROWS`` texts as numbers; never texts.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    sample = scratch.write(labelled(rows, labels, INDEX_ROWS + CALIBRATION_ROWS), "labelled")
    terms = vocabulary(sample)
    found, size = document_frequencies(rows, terms) if len(terms) else (np.zeros(0, np.int64), 0)
    idf = np.log((1 + size) / (1 + found)) + 1
    held = docs.sparkSession.sparkContext.broadcast(terms)

    def gather(run: pa.RecordBatch) -> pa.RecordBatch:
        at, row, count = _counted(run, "text", held.value)
        known = at < len(held.value)  # all of them, unless nothing is learned
        at, row, count = at[known], row[known], count[known]
        bounds = np.searchsorted(row, np.arange(run.num_rows + 1)).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(x.astype(np.int32))) for x in (at, count)]
        return pa.RecordBatch.from_arrays([run.column(1), run.column(2), run.column(3), *lists], names=["doc_id", "toxic", "place", "at", "n"])

    kind = sample.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, toxic int, place bigint, at array<int>, n array<int>"
    table = map_runs(sample.select("text", "doc_id", "__toxic", "__place"), "text", gather, schema).orderBy("doc_id").toArrow()
    toxic, place, ids = table["toxic"].to_numpy(), table["place"].to_numpy(), table["doc_id"]
    lists = table["at"].combine_chunks()
    lengths, at = lists.value_lengths().to_numpy().astype(np.int64), lists.flatten().to_numpy()
    # Narrow numbers: there are as many as the texts have terms.
    value = (1 + np.log(table["n"].combine_chunks().flatten().to_numpy(), dtype=np.float32)) * idf.astype(np.float32)[at]
    del table, lists
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    example = place < INDEX_ROWS
    own = example[owner]
    telling = _telling(at[own], toxic[owner[own]], int(example.sum()), int(toxic[example].sum()), len(terms))
    value /= np.sqrt(np.bincount(owner, weights=value * value, minlength=len(lengths))).astype(np.float32)[owner]
    own_lengths = np.sqrt(np.bincount(owner, weights=(value * telling[at]) ** 2, minlength=len(lengths)))

    indexed = np.flatnonzero(example & (lengths > 0))
    spots = np.flatnonzero(own).astype(np.int32)  # what the examples hold
    popular = np.bincount(at[spots], minlength=len(terms))
    frequent = np.argsort(-popular, kind="stable")[:FREQUENT]
    dense = np.full(len(terms), -1, dtype=np.int64)
    dense[frequent] = np.arange(len(frequent))
    # Examples with the same strongest dense term stand together, so that blocks differ in their largest weights.
    common = spots[dense[at[spots]] >= 0]
    common = common[np.lexsort((value[common], owner[common]))]
    strongest = np.full(len(lengths), -1, dtype=np.int64)
    strongest[owner[common]] = dense[at[common]]  # the last one of an owner stays
    indexed = indexed[np.argsort(strongest[indexed], kind="stable")]
    rank = np.full(len(lengths), -1, dtype=np.int64)
    rank[indexed] = np.arange(len(indexed))
    blocks = -(-len(indexed) // BLOCK)
    weights = np.zeros((blocks * BLOCK, len(frequent)), dtype=np.float32)
    weights[rank[owner[common]], dense[at[common]]] = value[common]
    rare = spots[dense[at[spots]] < 0]
    rare = rare[np.argsort(at[rare], kind="stable")]
    index = Index(
        terms=terms, idf=idf, telling=telling, toxic=toxic[indexed], weights=weights, largest=weights.reshape(blocks, BLOCK, len(frequent)).max(axis=1),
        ids=ids.take(pa.array(indexed, type=pa.int64())).to_numpy() if len(indexed) else np.zeros(0),
        dense=dense, heads=np.searchsorted(at[rare], np.arange(len(terms) + 1)), posted=rank[owner[rare]].astype(np.int32),
        posted_weights=value[rare].astype(np.float32), lengths=own_lengths[indexed], unseen=float(np.log((1 + size) / 2) + 1),
        edges=np.zeros(0), rates=np.zeros(0), k=k,
    )
    del owner, own, spots, common, rare  # as long as all postings

    held_back = (Vector(i, at[ends[i] - lengths[i] : ends[i]], value[ends[i] - lengths[i] : ends[i]], own_lengths[i]) for i in np.flatnonzero((place >= INDEX_ROWS) & (lengths > 0)))
    votes, truth, without = [], [], toxic[(place >= INDEX_ROWS) & (lengths == 0)].tolist()
    for batch in index.batches(held_back):
        for v, (best, _, similar) in zip(batch, index.nearest(batch), strict=True):
            vote = index.vote(best, similar)
            if vote >= 0:
                votes.append(vote)
                truth.append(toxic[v.row])
            else:
                without.append(toxic[v.row])
    index.edges, index.rates = _isotonic(np.array(votes), np.array(truth, dtype=float))
    index.nothing = (sum(without) + 0.01) / (len(without) + 1)
    return index


def score(docs: DataFrame, index: Index, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, evidence) per row; evidence: ids and cosines of the nearest examples, nearest first."""
    # Its size is that of the labelled sample's distinct terms per text.
    held = docs.sparkSession.sparkContext.broadcast(index)
    known: dict[bytes, tuple[float, list[dict]]] = {}

    def rate(run: pa.RecordBatch) -> pa.RecordBatch:
        own = held.value
        if len(known) > MEMORY:
            known.clear()
        scores = np.full(run.num_rows, own.probability(-1.0))
        evidence: list[list[dict]] = [[] for _ in range(run.num_rows)]
        same, fresh = {}, []
        for v in own.vectors(run, text):
            # Texts with the same terms share their neighbours; 128 bits stand for the vector.
            same[v.row] = mark = hashlib.blake2b(v.at.tobytes() + v.value.tobytes(), digest_size=16).digest()
            if mark not in known:
                known[mark] = own.nothing, []
                fresh.append((mark, v))
        marks = iter([mark for mark, _ in fresh])
        for batch in own.batches(v for _, v in fresh):
            for best, cosine, similar in own.nearest(batch):
                nearest = [{"doc_id": own.ids[b], "cosine": float(c)} for b, c in zip(best[:3], cosine[:3], strict=True)]
                known[next(marks)] = own.probability(own.vote(best, similar)), nearest
        for row, mark in same.items():
            scores[row], evidence[row] = known[mark]
        item = pa.struct([("doc_id", run.schema.field(0).type), ("cosine", pa.float64())])
        return pa.RecordBatch.from_arrays([run.column(0), pa.array(scores), pa.array(evidence, type=pa.list_(item))], names=["doc_id", "score", "evidence"])

    kind = docs.schema[key].dataType.simpleString()
    schema = f"doc_id {kind}, score double, evidence array<struct<doc_id:{kind},cosine:double>>"
    return map_runs(docs.select(key, text), text, rate, schema)


def toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence) per row of ``docs``.

    Defined results: null and empty texts have no known term and get the rate of such texts; rows with the same
    text score alike; a null ``doc_id`` is not held out; without labels of both kinds nothing is learned and every
    score is near 0; an empty table gives an empty result.
    """
    with Scratch(docs.sparkSession) as scratch:
        index = fit(docs, labels, scratch, key, text)
    scored = score(docs, index, key, text)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")
