"""Every corpus operator against a plain version of itself, on small tables with awkward rows."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tests.conftest import SF_DIR, SMALL_SF_DIR

from featureflow.llm import ann, graph, licenses, minhash, mixing, packing, rules, separators, suffixes, toxicity, urls
from featureflow.llm.ship import ship
from featureflow.llm.tokens import PieceTokenizer
from featureflow.llm.words import ALNUM, NOT_SPACE, words_of
from featureflow.session import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    return spark.read.parquet(f"{SMALL_SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SMALL_SF_DIR}/labels.parquet")


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls, empty and one-word texts, repeated rows, a long text, copies, odd characters, a clashing column."""
    ship(spark)
    base = [f"word{i}" for i in range(120)]
    near = [*base[:60], "other", *base[61:]]
    texts = [
        (1, " ".join(base), "a"),
        (2, " ".join(near), "a"),
        (3, None, "b"),
        (4, "", None),
        (5, "One", "b"),
        (6, "one", None),
        (7, " \t\n", "c"),
        (8, "Straße № 7 élan  x\x1cy \u2028 z É", "c"),
        (9, " ".join(f"long{i % 977}" for i in range(30_000)), "hot"),
        (9, " ".join(f"long{i % 977}" for i in range(30_000)), "hot"),
        (10, " ".join(base).upper(), "hot"),
        (11, " ".join(["again and again"] * 40), "hot"),
        (12, "intro words before " + " ".join(base[10:75]) + " and then something else", "hot"),
        (None, "no id here but some words " * 5, "hot"),
        (13, "Released under the MIT License.\nLicensed under the Apache License, Version 2.0, CC-BY-NC 4.0", "x"),
    ]
    rows = [(i, t, "en", s, len(t) if t is not None else None, k) for k, (i, t, s) in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS + ", stats int").repartition(3)


def empty(df):
    return df.where("false")


# --- words and tokens -------------------------------------------------------------------------------


def test_words_are_those_of_the_pattern():
    texts = ["a b", None, "", " x\ty\x0bz ", "é\x1cü \u00a0q", "end", "A1-b2"]
    words = words_of(pa.array(texts, type=pa.string()))
    found = [
        [bytes(words.data[a:b]).decode() for a, b in zip(words.starts[i:j], words.ends[i:j], strict=True)]
        for i, j in zip(words.bounds, words.bounds[1:], strict=False)
    ]
    assert found == [WORD.findall(t or "") for t in texts]
    assert words_of(pa.array(["A1-b2"]), table=ALNUM, lower=True).counts.tolist() == [2]
    assert not NOT_SPACE[0x20]


def test_equal_words_have_equal_hashes_across_texts():
    words = words_of(pa.array(["pre same", "x" * (3 << 20) + " same", "same"]))
    assert words.hashes[1] == words.hashes[3] == words.hashes[4]
    assert len(set(words.hashes.tolist())) == 3


@pytest.mark.parametrize(
    "text",
    ["", "Hello, World! it's 42", "çà Élan STRASSE ß", "<|endoftext|> x", "ΟΔΟΣ ﬁ ½ e\u0301 \x1c\t tab", "日本語 ١٢٣", "a\u00a0b", "İstanbul"],
)
def test_ids_are_the_librarys(text):
    coder = PieceTokenizer(TOKENIZER)
    assert np.frombuffer(coder.encode(text), "<u4").tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_of_documents_are_the_librarys(docs):
    coder = PieceTokenizer(TOKENIZER)
    for r in docs.limit(60).collect():
        assert np.frombuffer(coder.encode(r.text), "<u4").tolist() == coder.tokenizer.encode(r.text, add_special_tokens=False).ids


def test_a_full_cache_changes_nothing():
    coder = PieceTokenizer(TOKENIZER)
    coder.parts.most = coder.pieces.most = 2
    text = "one two three four one two three"
    assert np.frombuffer(coder.encode(text), "<u4").tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids


# --- 1: mixing --------------------------------------------------------------------------------------


def plain_targets(sizes, repeats=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    capped, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(repeats * sizes[s] for s in capped)
        free = sum(weight[s] for s in order if s not in capped)
        got = {s: repeats * sizes[s] if s in capped else weight[s] * rest / free for s in order}
        over = {s for s in order if s not in capped and got[s] > repeats * sizes[s]}
        if not over:
            return got
        capped |= over


@pytest.mark.parametrize("table", ["docs", "awkward"])
def test_mixing_meets_its_targets(request, table):
    df = request.getfixturevalue(table)
    found = mixing.mix(df).collect()
    plain = Counter((r.doc_id, r.source, len(WORD.findall(r.text or ""))) for r in df.collect())
    assert Counter((r.doc_id, r["source"], r["size"]) for r in found) == plain
    sizes = Counter()
    for (_, s, n), k in plain.items():
        sizes[s] += n * k
    target, taken = plain_targets(sizes), Counter()
    for r in found:
        assert r.taken <= 3 * r["size"]
        assert r.source_size == sizes[r["source"]]
        assert r.target == pytest.approx(target[r["source"]])
        taken[r["source"]] += r.taken
    for s, t in target.items():
        assert abs(taken[s] - t) <= 0.02 * t + 64
    again = mixing.mix(df).collect()
    assert Counter(tuple(r) for r in again) == Counter(tuple(r) for r in found)


def test_small_sources_of_a_large_corpus_meet_their_targets(spark, monkeypatch):
    """Blocks of 4,096 words, a large source and sources of 100 to 10,000 words."""
    monkeypatch.setattr(mixing, "SLOTS", 64)
    ship(spark)
    sizes = {"a": 300_000, "b": 400, "c": 1_000, "d": 100, "e": 4_097, "f": 10_000, "g": 2_500}
    rows = [(f"{s}{i}", s, "w " * min(50, n - 50 * i)) for s, n in sizes.items() for i in range(-(-n // 50))]
    df = spark.createDataFrame(rows, "doc_id string, source string, text string")
    assert sum(sizes.values()) // mixing.SLOTS >= mixing.LARGEST_BLOCK
    target, taken, copies = plain_targets(sizes), Counter(), Counter()
    for r in mixing.mix(df).collect():
        assert r.taken <= 3 * r["size"]
        assert r.target == pytest.approx(target[r["source"]])
        taken[r["source"]] += r.taken
        copies[r["source"]] += r.copies * r["size"]
    for s, t in target.items():
        assert abs(taken[s] - t) <= 0.02 * t + 4 * min(mixing.LARGEST_BLOCK, max(1, sizes[s] // mixing.LEAST_BLOCKS))
        assert abs(copies[s] - t) <= 0.05 * t + 50 * 3


def test_mixing_nothing(awkward):
    assert mixing.mix(empty(awkward)).count() == 0
    zero = mixing.mix(awkward.where("doc_id in (3, 4, 7)")).collect()
    assert [(r["size"], r.taken, r.target) for r in zero] == [(0, 0, 0.0)] * 3


def test_mixed_documents_keep_their_columns(awkward):
    out = mixing.mixed_documents(awkward)
    assert out.schema == awkward.schema
    assert max(out.groupBy("stats").count().toPandas()["count"]) <= 3


# --- 2: near duplicates -----------------------------------------------------------------------------


def plain_classes(rows, n, percent):
    sets = []
    for text in rows.values():
        w = WORD.findall(fold(text))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    ids, root = list(rows), {i: i for i in rows}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(ids)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                x, y = sorted((top(ids[a]), top(ids[b])))
                root[y] = x
    return {i: (len(s), top(i)) for i, s in zip(ids, sets, strict=True)}


@pytest.mark.parametrize(("table", "n"), [("docs", 2), ("docs", 5), ("awkward", 2), ("awkward", 5)])
def test_near_duplicates_are_those_of_all_pairs(request, table, n):
    df = request.getfixturevalue(table)
    plain = plain_classes({r.doc_id: r.text for r in df.where("doc_id is not null").collect()}, n, 80)
    found = minhash.near_duplicates(df, n).collect()
    assert len(found) == df.count()
    for r in found:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == plain[r.doc_id]
            assert r.kept == (r.doc_id == r.component_id)
        else:
            assert not r.kept


def test_a_family_without_a_common_centre(spark):
    """A chain in which each text is near the next one only, and a large loose family around one text."""
    rng = np.random.default_rng(3)
    words, rows = [f"w{i}" for i in range(100)], []
    for i in range(12):  # ten per cent of the words change at every step
        rows.append((100 + i, " ".join(words)))
        words = [f"c{i}x{j}" if 9 * i <= j < 9 * i + 9 else w for j, w in enumerate(words)]
    base = [f"b{i}" for i in range(200)]
    for i in range(150):
        text = list(base)
        for j in rng.choice(200, 12, replace=False):
            text[j] = f"e{i}x{j}"
        rows.append((1000 + i, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    plain = plain_classes(dict(rows), 1, 80)
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(df, 1).collect()}
    assert found == {i: c for i, (_, c) in plain.items()}


def test_blocks_of_a_large_group_lose_no_link(spark, monkeypatch):
    rows = spark.range(60).select(F.lit(7).cast("bigint").alias("key"), F.col("id").alias("node"))

    def seen(table):
        ids = sorted(table["node"].to_pylist())
        return [(a, b) for a in ids for b in ids if a < b]

    pairs = {tuple(r) for r in minhash._in_blocks(rows, "key", seen, block=16).collect()}
    assert len(pairs) == 60 * 59 / 2


def test_estimate_follows_the_similarity(spark):
    rng = np.random.default_rng(1)
    a = rng.integers(1, 2**63, 2000, dtype=np.uint64)
    b = np.concatenate([a[:1600], rng.integers(1, 2**63, 400, dtype=np.uint64)])
    minima = minhash.minima_of(np.concatenate([a, b]), np.array([0, 2000, 4000]))
    x, y = minhash.pack(minima).tolist()
    row = spark.createDataFrame([(x, y)], "x array<bigint>, y array<bigint>").select(minhash.estimate(F.col("x"), F.col("y")).alias("e")).first()
    assert row.e == pytest.approx(1600 / 2400, abs=0.15)


def test_without_near_duplicates_keeps_one_of_each(awkward):
    out = minhash.without_near_duplicates(awkward)
    assert out.schema == awkward.schema
    ids = sorted((r.doc_id for r in out.collect()), key=lambda i: (i is None, i))
    assert ids == [1, 2, 3, 4, 5, 7, 8, 9, 11, 12, 13, None] or ids == [1, 3, 4, 5, 7, 8, 9, 11, 12, 13, None]
    assert minhash.near_duplicates(empty(awkward)).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).union(spark.createDataFrame([(500, 501), (501, 500)], "a bigint, b bigint"))
    with Scratch(spark) as scratch:
        found = {r.node: r.root for r in graph.components(edges, scratch).collect()}
    assert len({found[i] for i in range(201)}) == 1
    assert found[500] == found[501] != found[0]


# --- 3: licenses ------------------------------------------------------------------------------------

LICENSE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_base(text):
    words, places = LICENSE_WORD.findall(fold(text)), []
    for label, phrase in licenses.BASE:
        p = phrase.split()
        places += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


@pytest.mark.parametrize("table", ["docs", "awkward"])
def test_license_places(request, table):
    df = request.getfixturevalue(table)
    found = licenses.summary(licenses.scan(df)).collect()
    plain = Counter((r.doc_id, *plain_base(r.text)) for r in df.collect())
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in found) == plain
    for r in found:
        assert 0 <= r.score <= 1
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
    assert licenses.scan(empty(df)).count() == 0


def test_a_notice_with_a_word_left_out(spark):
    notice = licenses.NOTICES[0][1].split()
    bent = " ".join([*notice[:9], *notice[10:]])
    df = spark.createDataFrame([(1, "x y " + bent), (2, "permission is hereby granted to nobody"), (3, "cc by nc cc by nc")], "doc_id bigint, text string")
    found = {r.doc_id: r for r in licenses.summary(licenses.scan(df)).collect()}
    assert found[1].labels == "mit" and found[1].n_base == 0 and 0.7 <= found[1].score < 1
    assert found[2].labels == "" and 0 < found[2].score < 0.7
    assert (found[3].n_base, found[3].first_word, found[3].last_word) == (2, 0, 3)
    with pytest.raises(ValueError, match="fewer than"):
        licenses.template_places(spark, (("x", "two words"),), ())


# --- 4: nearest neighbours --------------------------------------------------------------------------


def test_neighbours_and_recall(spark):
    ship(spark)
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    odd = [(9_000, None), (9_020, []), (9_040, [0.0] * 64), (9_060, [float("nan")] * 64), (9_080, [None] * 64)]
    odd = spark.createDataFrame(odd, "vec_id bigint, embedding array<float>").where("vec_id <> 9020")
    scaled = rows.withColumn("embedding", F.transform("embedding", lambda x: (x * (1 + F.col("vec_id") % 3)).cast("float")))
    df = scaled.select("vec_id", "embedding").union(odd)
    found = ann.nearest_neighbours(df, F.col("vec_id") % 20 == 0).toPandas()
    data = scaled.toPandas().sort_values("vec_id")
    x, ids = np.stack(data.embedding).astype(float), data.vec_id.to_numpy()
    hits = []
    for q, group in found.groupby("query_id"):
        at = np.flatnonzero(ids == q)[0]
        score = x @ x[at]
        score[at] = -np.inf
        best = ids[np.lexsort((ids, -score))[:20]]
        group = group.sort_values("rank")
        assert group["rank"].tolist() == list(range(1, 21))
        assert np.allclose(group.score, [score[np.flatnonzero(ids == v)[0]] for v in group.vec_id], atol=1e-12)
        assert (np.diff(group.score) <= 0).all()
        hits.append(len(set(best) & set(group.vec_id)) / 20)
    assert len(hits) == (ids % 20 == 0).sum()
    assert np.mean(hits) >= 0.9


def test_neighbours_of_little(spark):
    schema = "vec_id bigint, embedding array<double>"
    assert ann.nearest_neighbours(spark.createDataFrame([], schema), F.col("vec_id") % 20 == 0).count() == 0
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [-1.0, 0.0])], schema)
    got = [tuple(r) for r in ann.nearest_neighbours(few, F.col("vec_id") % 20 == 0).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 3, -1.0)]
    with pytest.raises(ValueError, match="components"):
        ann.nearest_neighbours(few.union(spark.createDataFrame([(9, [1.0])], schema)), F.col("vec_id") % 20 == 0)


def test_probing_retrieves_every_code_within_the_radius():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 1 << 16, (3000, 4)).astype(np.uint16)
    codes[:50] = codes[50:51] ^ (rng.random((50, 4)) < 0.5).astype(np.uint16)
    index, masks = ann._Index(codes), ann._near_values(16)
    for radius in (0, 3, 7, 18):
        rows = index.probe(codes[50], ann._parts(radius, 4), masks)
        near = np.flatnonzero(np.bitwise_count(codes ^ codes[50]).sum(axis=1) <= radius)
        assert set(near) <= set(rows)


# --- 5: packing -------------------------------------------------------------------------------------


@pytest.mark.parametrize("table", ["docs", "awkward"])
def test_packing_round_trip(request, table):
    df = request.getfixturevalue(table)
    pieces = packing.token_pieces(df, TOKENIZER, 2048, 0)
    rows = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("crc"))
    found = packing.pack(rows).collect()
    coder, plain = PieceTokenizer(TOKENIZER), Counter()
    for r in df.collect():
        ids = [*coder.tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[at : at + 2048], dtype="<u4")
            plain[r.doc_id, k, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.crc) for r in found) == plain
    bins = defaultdict(list)
    for r in found:
        bins[r.sequence_id].append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in found)
    assert len(bins) <= -(-total // 2048) * 1.03 + 1


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_keeps_every_capacity(rule):
    lengths = np.random.default_rng(1).integers(1, 300, 500)
    capacity = packing.Capacity(300, 4, 40_000, (1.0, 0.5, 0.5))
    lengths = np.minimum(lengths, 200)
    sequence, offset = packing.best_fit(lengths, capacity, rule)
    for s in np.unique(sequence):
        held = lengths[sequence == s]
        assert held.sum() <= 300 and len(held) <= 4 and (held**2).sum() <= 40_000
        assert sorted(offset[sequence == s]) == np.concatenate([[0], np.cumsum(held[np.argsort(offset[sequence == s])])[:-1]]).tolist()
    with pytest.raises(ValueError, match="capacity"):
        packing.best_fit(np.array([301]), capacity)


def test_sequences_hold_the_ids_in_order(spark, awkward):
    pieces = packing.token_pieces(awkward.where("doc_id in (1, 2, 5, 8)"), TOKENIZER, 64, 0)
    packed = packing.pack(pieces.select("doc_id", "piece", "length"), packing.Capacity(64, 64, 64 * 64)).join(pieces.select("doc_id", "piece", "ids"), ["doc_id", "piece"])
    whole = sum(len(r.ids) // 4 for r in packing.sequences(packed).collect())
    assert whole == pieces.agg(F.sum("length")).first()[0]
    assert packing.pack(empty(pieces).drop("ids")).count() == 0


# --- 6: repeated passages ---------------------------------------------------------------------------


def plain_states(rows, least):
    """Per document and word: 0, 1 (repeated, stays) or 2 (stands earlier)."""
    words = {i: WORD.findall(fold(t)) for i, t in rows.items()}
    places = defaultdict(list)
    for i in sorted(words):
        for a in range(len(words[i]) - least + 1):
            places[tuple(words[i][a : a + least])].append((i, a))
    states = {i: np.zeros(len(w), dtype=int) for i, w in words.items()}
    for at in places.values():
        if len(at) > 1:
            for k, (i, a) in enumerate(at):
                states[i][a : a + least] = np.maximum(states[i][a : a + least], 2 if k else 1)
    return words, states


def found_states(df, rows, words, least):
    states = {i: np.zeros(len(w), dtype=int) for i, w in words.items()}
    for r in suffixes.repeated_spans(df, least).collect():
        states[r.doc_id][r.first_word : r.first_word + r.n_words] = 2 if r.removed else 1
    return states


@pytest.mark.parametrize(("table", "least"), [("docs", 50), ("docs", 23), ("awkward", 50)])
def test_repeats_are_those_of_all_windows(request, table, least):
    df = request.getfixturevalue(table).where("doc_id is not null")
    rows = {r.doc_id: r.text for r in df.collect()}
    words, plain = plain_states(rows, least)
    found = found_states(df, rows, words, least)
    for i in rows:
        assert found[i].tolist() == plain[i].tolist(), i


def test_repeats_by_every_route(spark, monkeypatch):
    """Small pieces of work, and seeds treated as hot, give the same spans."""
    rng = np.random.default_rng(5)
    passage = [f"p{i}" for i in range(70)]
    rows = {i: " ".join([*(f"r{x}" for x in rng.integers(0, 10**9, 40)), *passage[i % 15 :], *(f"s{x}" for x in rng.integers(0, 10**9, 30))]) for i in range(40)}
    df = spark.createDataFrame(list(rows.items()), "doc_id bigint, text string")
    words, plain = plain_states(rows, 50)
    for hot, chunk in ((50_000, 64), (3, 1 << 20)):
        monkeypatch.setattr(suffixes, "HOT_PLACES", hot)
        monkeypatch.setattr(suffixes, "CHUNK_WINDOWS", chunk)
        found = found_states(df, rows, words, 50)
        assert all(found[i].tolist() == plain[i].tolist() for i in rows)


def test_long_runs_of_texts_in_one_batch(spark, monkeypatch):
    """Texts that come in several runs of one Arrow batch keep their own seeds."""
    filler = " ".join(f"f{i}" for i in range(200_000))
    rows = {1: "a " + filler, 2: "b " + " ".join(f"q{i}" for i in range(60)), 3: "c " + " ".join(f"q{i}" for i in range(60)), 4: "d " + filler}
    df = spark.createDataFrame(list(rows.items()), "doc_id bigint, text string").coalesce(1)
    got = sorted(tuple(r) for r in suffixes.repeated_spans(df).collect())
    assert got == [(1, 1, 200_000, False), (2, 1, 60, False), (3, 1, 60, True), (4, 1, 200_000, True)]


def test_cutting_repeats(awkward):
    out = suffixes.without_repeats(awkward)
    assert out.schema == awkward.schema
    rows = {r.stats: r for r in out.collect()}
    before = {r.stats: r for r in awkward.collect()}
    _, states = plain_states({r.doc_id: r.text for r in before.values() if r.doc_id is not None}, 50)
    for k, r in before.items():
        if r.doc_id is None or not (states[r.doc_id] == 2).any():
            assert rows[k] == r
            continue
        kept = [w for w, s in zip(WORD.findall(r.text), states[r.doc_id], strict=True) if s < 2]
        assert (k in rows) == bool(kept)
        if kept:
            assert WORD.findall(rows[k].text) == kept
            assert rows[k].n_chars == len(rows[k].text)
    assert suffixes.repeated_spans(empty(awkward)).count() == 0


# --- 7: toxicity ------------------------------------------------------------------------------------


def test_held_out_toxic_documents_are_found(spark):
    ship(spark)
    documents, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    found = toxicity.toxicity(documents, labels).toPandas()
    assert len(found) == documents.count()
    assert (found.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in found.doc_id]).all()
    assert ((found.predicted == 1) == (found.score >= 0.5)).all() and found.score.between(0, 1).all()
    held = found[found.held_out].merge(labels.toPandas(), on="doc_id")
    assert (held.predicted == held.toxic).mean() > held.toxic.eq(0).mean()
    assert held.score[held.toxic == 1].mean() > held.score[held.toxic == 0].mean() + 0.3


@pytest.mark.parametrize(("block", "dense", "postings"), [(256, 12, 1 << 21), (8, 12, 40), (8, 0, 1 << 21), (16, 30, 1)])
def test_nearest_examples_are_exact(monkeypatch, block, dense, postings):
    """Against all products, with ties, few and many blocks, few and many dense terms, small and large batches."""
    monkeypatch.setattr(toxicity, "BLOCK", block)
    monkeypatch.setattr(toxicity, "BATCH_POSTINGS", postings)
    rng = np.random.default_rng(4)
    examples, terms = 300, 30
    weights = np.where(rng.random((examples, terms)) < 0.2, rng.random((examples, terms)), 0).astype(np.float32).astype(float)
    weights[100:110] = weights[0]
    weights /= np.maximum(1e-9, np.sqrt((weights**2).sum(axis=1, keepdims=True)))
    weights = weights.astype(np.float32).astype(float)
    telling = 1 + 3 * rng.random(terms) * (rng.random(terms) < 0.4)
    blocks = -(-examples // block)
    padded = np.zeros((blocks * block, dense), dtype=np.float32)
    padded[:examples] = weights[:, :dense]
    place = np.where(np.arange(terms) < dense, np.arange(terms), -1)
    posted = [(t, e) for t in range(dense, terms) for e in np.flatnonzero(weights[:, t])]
    heads = np.searchsorted([t for t, _ in posted], np.arange(terms + 1))
    lengths = np.sqrt(((weights * telling) ** 2).sum(axis=1))
    toxic = rng.integers(0, 2, examples)
    index = toxicity.Index(
        terms=np.arange(terms), idf=np.ones(terms), telling=telling, ids=np.arange(examples), toxic=toxic, weights=padded,
        largest=padded.reshape(blocks, block, dense).max(axis=1), dense=place, heads=heads, posted=np.array([e for _, e in posted], dtype=np.int32),
        posted_weights=np.array([weights[e, t] for t, e in posted], dtype=np.float32), lengths=lengths, unseen=1.0, edges=np.array([0, 1.0]), rates=np.array([0, 1.0]),
        k=10 if block > 8 else 5,
    )
    texts = []
    for i in range(40):
        at = np.sort(rng.choice(terms, 4, replace=False))
        value = rng.random(4)
        value /= np.sqrt((value**2).sum())
        texts.append(toxicity.Vector(i, at, value, float(np.sqrt(((value * telling[at]) ** 2).sum()))))
    found = [x for batch in index.batches(iter(texts)) for x in index.nearest(batch)]
    for v, (best, cosine, similar) in zip(texts, found, strict=True):
        plain = weights[:, v.at] @ v.value
        order = np.lexsort((np.arange(examples), -np.round(plain, 12)))[: index.k]
        assert best.tolist() == [e for e in order if plain[e] > 0]
        assert cosine == pytest.approx(plain[best])
        told = weights[best][:, v.at] @ (v.value * telling[v.at] ** 2) / lengths[best] / v.length
        assert similar == pytest.approx(told)
        assert index.vote(best, similar) == pytest.approx((told**2 * toxic[best]).sum() / ((told**2).sum() + 0.1))


def test_a_text_reads_the_postings_of_its_terms_once(monkeypatch):
    """Telling terms count in the cosine and in the vote; both come from one reading, and full blocks from one product."""
    monkeypatch.setattr(toxicity, "BLOCK", 8)
    read, products = [], []

    class Heads(np.ndarray):
        def __getitem__(self, at):
            read.append(np.size(at))
            return np.asarray(self)[at]

    class Product(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, slice):
                products.append(at)
            return np.asarray(self)[at]

    rng = np.random.default_rng(5)
    examples, terms, dense = 64, 12, 4
    weights = rng.random((examples, terms)).astype(np.float32)
    telling = np.where(np.arange(terms) % 2, 3.0, 1.0)
    heads = np.maximum(0, np.arange(terms + 1) - dense) * examples
    index = toxicity.Index(
        terms=np.arange(terms), idf=np.ones(terms), telling=telling, ids=np.arange(examples), toxic=np.arange(examples) % 2,
        weights=weights[:, :dense].copy().view(Product), largest=weights[:, :dense].reshape(8, 8, dense).max(axis=1), dense=np.where(np.arange(terms) < dense, np.arange(terms), -1),
        heads=heads.view(Heads), posted=np.tile(np.arange(examples, dtype=np.int32), terms - dense), posted_weights=weights[:, dense:].T.ravel(),
        lengths=np.sqrt(((weights * telling) ** 2).sum(axis=1)), unseen=1.0, edges=np.array([0, 1.0]), rates=np.array([0, 1.0]), k=50,
    )
    texts = [toxicity.Vector(i, np.arange(terms), value, 2.0) for i, value in enumerate(rng.random((6, terms)))]
    found = index.nearest(texts)
    assert sum(read) == len(texts) * (terms - dense) * 2  # where the postings of each term begin and end
    # 50 of 64 examples need every block: the first one of each text, then all of them in one product.
    assert len(products) <= len(texts) + 1
    for v, (best, cosine, similar) in zip(texts, found, strict=True):
        plain = weights.astype(float) @ v.value
        assert best.tolist() == np.lexsort((np.arange(examples), -plain))[:50].tolist()
        assert cosine == pytest.approx(plain[best])
        assert similar == pytest.approx((weights[best] @ (v.value * telling**2)) / index.lengths[best] / 2)


def test_toxicity_without_labels_and_with_awkward_rows(spark, awkward, labels):
    found = toxicity.toxicity(awkward, labels.where("false")).collect()
    assert len(found) == awkward.count() and all(r.score < 0.5 for r in found)
    assert toxicity.toxicity(empty(awkward), labels).count() == 0


def test_scores_follow_from_plain_neighbours_votes_and_calibration(spark, monkeypatch):
    """The whole way again in plain form: cosines over all terms, telling weights, votes, pooled rates, scores."""
    monkeypatch.setattr(toxicity, "INDEX_ROWS", 90)
    monkeypatch.setattr(toxicity, "CALIBRATION_ROWS", 60)
    rng = np.random.default_rng(9)
    bad = [f"bad{j}" for j in range(3)]
    texts = [" ".join([*(f"w{j}" for j in rng.integers(0, 60, 10)), *(rng.choice(bad, 2) if i % 4 == 0 or i % 17 == 0 else [])]) for i in range(220)]
    ship(spark)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(180)], "doc_id bigint, toxic int")
    with Scratch(spark) as scratch:
        index = toxicity.fit(docs, labels, scratch, k=7)
        got = {r.doc_id: r.score for r in toxicity.score(docs, index).collect()}
        sample = {r.doc_id: (r["__place"], r["__toxic"]) for r in toxicity.labelled(docs, labels, 150).collect()}
    assert all(zlib.crc32(str(i).encode()) % 5 for i in sample)
    counts = [Counter(t.split()) for t in texts]
    df = Counter(w for c in counts for w in c)
    seen = {w for i in sample for w in counts[i]}
    idf = lambda w: np.log(221 / (1 + df[w] if w in seen else 2)) + 1
    examples = {i: t for i, (p, t) in sample.items() if p < 90}
    total, toxic = len(examples), sum(examples.values())

    def telling(w):
        n, a = sum(w in counts[i] for i in examples), sum(w in counts[i] for i, t in examples.items() if t)
        table = np.array([[a, n - a], [toxic - a, total - toxic - n + a]], dtype=float)
        expected = table.sum(1, keepdims=True) * table.sum(0) / total
        g = 2 * sum(x * np.log(x / e) for x, e in zip(table.flat, expected.flat, strict=True) if x)
        return max(1.0, g) ** 0.5 if w in seen else 1.0

    tell = {w: telling(w) for w in df}
    vectors = []
    for c in counts:
        v = {w: (1 + np.log(k)) * idf(w) for w, k in c.items()}
        size = sum(x * x for x in v.values()) ** 0.5
        vectors.append({w: x / size for w, x in v.items()})
    inner = lambda a, b, f: sum(x * b.get(w, 0.0) * f(w) for w, x in a.items())

    def vote(i):
        near = sorted(examples, key=lambda e: -round(inner(vectors[i], vectors[e], lambda w: 1.0), 9))
        near = [e for e in near[:7] if inner(vectors[i], vectors[e], lambda w: 1.0) > 0]
        if not near:
            return -1.0
        square = lambda w: tell[w] ** 2
        own = inner(vectors[i], vectors[i], square) ** 0.5
        weights = [(inner(vectors[i], vectors[e], square) / own / inner(vectors[e], vectors[e], square) ** 0.5) ** 2 for e in near]
        return sum(x * examples[e] for x, e in zip(weights, near, strict=True)) / (sum(weights) + 0.1)

    kept = [(vote(i), t) for i, (p, t) in sample.items() if p >= 90]
    pools = []
    for b in range(10):
        inside = [t for v, t in kept if v >= 0 and min(int(v * 10), 9) == b]
        middle = (b + 0.5) / 10
        pools.append([[middle], len(inside) + 1.0, sum(inside) + middle])
        while len(pools) > 1 and pools[-2][2] / pools[-2][1] > pools[-1][2] / pools[-1][1]:
            last = pools.pop()
            pools[-1] = [pools[-1][0] + last[0], pools[-1][1] + last[1], pools[-1][2] + last[2]]
    edges, rates = [np.mean(p[0]) for p in pools], [p[2] / p[1] for p in pools]
    assert len(kept) > 20 and len(pools) > 2
    for i in range(220):
        v = vote(i)
        assert got[i] == pytest.approx(np.interp(v, edges, rates) if v >= 0 else index.nothing, abs=1e-4)


def test_toxicity_vectors_hold_all_terms(spark, monkeypatch):
    """Neighbours and cosines of a plain search over all terms, also of words in one labelled text or in none."""
    monkeypatch.setattr(toxicity, "FREQUENT", 64)
    rng = np.random.default_rng(7)
    texts = [" ".join([*(f"common{j}" for j in rng.integers(0, 150, 12)), f"rare{i // 2}", f"only{i}"]) for i in range(240)]
    ship(spark)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 8 < 2)) for i in range(160)], "doc_id bigint, toxic int")
    with Scratch(spark) as scratch:
        index = toxicity.fit(docs, labels, scratch)
        examples = sorted(index.ids.tolist())
        found = {r.doc_id: r.evidence for r in toxicity.score(docs, index).collect()}
    assert (index.dense < 0).any() and (index.dense >= 0).any()
    counts = [Counter(t.split()) for t in texts]
    df = Counter(w for c in counts for w in c)
    known = {w for i in range(160) if zlib.crc32(str(i).encode()) % 5 for w in counts[i]}

    def weight(w):
        return np.log(241 / (1 + df[w] if w in known else 2)) + 1

    vectors = [{w: (1 + np.log(k)) * weight(w) for w, k in c.items()} for c in counts]
    norms = [sum(x * x for x in v.values()) ** 0.5 for v in vectors]
    for i, v in enumerate(vectors):
        plain = sorted((sum(x * vectors[e].get(w, 0.0) for w, x in v.items()) / norms[i] / norms[e] for e in examples), reverse=True)
        assert [r.cosine for r in found[i]] == pytest.approx(plain[:3], abs=1e-5)
        if i in examples:
            assert found[i][0].doc_id == i and found[i][0].cosine == pytest.approx(1, abs=1e-5)


# --- 8: URLs ----------------------------------------------------------------------------------------


def plain_url(url):
    at = (url or "").find("://")
    if at < 0:
        return "", "", None
    host, path = re.match(r"([^/?#]*)([^?#]*)", url[at + 3 :], re.DOTALL).groups()
    host = fold(host)
    fits = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1:] if fits else None


def test_url_rules(spark):
    made = [None, "", "no scheme", "http://NET/", "http://net", "https://a.example.net/en/x?y#z", "http://xexample.com/de/", "HTTP://Example.COM/de/a\nb",
            "http://org/fr/", "a://b://c/d", "http://x.org?/fr/", "://net/"]
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "url")
    extra = spark.createDataFrame([(10_000 + i, u) for i, u in enumerate(made)], "page_id bigint, url string")
    df = pages.union(extra)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    found = urls.judge(df, labels).collect()
    assert len(found) == df.count()
    plain = {r.page_id: plain_url(r.url) for r in df.collect()}
    for r in found:
        host, path, rule = plain[r.page_id]
        assert (r.host, r.path) == (host, path)
        assert r["rule"] == (rule[0] if rule else None)
        assert r.verdict == (rule[1] if rule else "block" if r.mined else "allow")
    assert urls.judge(empty(df), labels).count() == 0


def test_segments_with_digits_and_queries_are_tokens(spark):
    """/top10/ and ?cat=adult alone tell the pages apart; numbers are ids, and named ids are too rare to matter."""
    bad = ["http://x.io/top10/{}", "http://x.io/a/{}?s=1&cat=adult#f", "http://x.io/mp3/{}.html"]
    good = ["http://x.io/a/{}", "http://x.io/a/{}?s=1&cat=news", "http://x.io/a/{}#?cat=adult"]
    pages = [(6 * i + j, u.format(6 * i + j)) for i in range(40) for j, u in enumerate(bad + good)]
    labels = spark.createDataFrame([(n, 0 if n % 6 < 3 else 1, 0) for n, _ in pages if n % 5], "doc_id bigint, quality int, toxic int")
    found = urls.judge(spark.createDataFrame(pages, "page_id bigint, url string"), labels, support=0.02).collect()
    assert {r.page_id: r.verdict for r in found} == {n: "block" if n % 6 < 3 else "allow" for n, _ in pages}
    tokens = urls.tokens_of(F.lit(""), F.lit("/12/3.html/v2/4x"), F.lit("k&a=1&&=z"))
    assert set(spark.range(1).select(tokens).first()[0]) == {"path:v2", "path:4x", "key:k", "key:a", "query:a=1", "query:=z"}


def test_mined_rules_find_a_planted_combination(spark):
    rows = [(i, ["under:x.org", f"path:{p}"], p == "spam" and i % 10 > 0) for i in range(300) for p in ("spam", "ham")]
    rows += [(i, ["under:y.org", "path:spam"], False) for i in range(300)]
    mined = urls.mine(spark.createDataFrame(rows, "key bigint, tokens array<string>, blocked boolean"), 0.01, 0.6)
    found = [(sorted(r.tokens), round(r.confidence, 2)) for r in mined.collect()]
    assert found == [(["path:spam", "under:x.org"], 0.9)]
    pages = spark.createDataFrame([(1, ["path:spam", "under:x.org", "z"]), (2, ["path:spam"]), (3, [])], "key bigint, tokens array<string>")
    for small in (True, False):
        assert [r.key for r in urls.match(pages, mined, small).collect()] == [1]


# --- 9: token counts --------------------------------------------------------------------------------


@pytest.mark.parametrize(("table", "block"), [("docs", 1 << 21), ("awkward", 1000)])
def test_counts_from_flat_files(request, table, block):
    df = request.getfixturevalue(table)
    coder = PieceTokenizer(TOKENIZER)
    plain = Counter((r.doc_id, len(coder.encode(r.text)) // 4) for r in df.collect())
    found = separators.document_tokens(df, TOKENIZER, block=block).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in found) == plain


def test_a_quoted_separator_is_counted(spark):
    ship(spark)
    texts = ["<|endoftext|>", "one <|endoftext|> two <|endoftext|>", "plain words", None]
    coder = PieceTokenizer(TOKENIZER)
    ids = [np.frombuffer(coder.encode(t), dtype="<u4") for t in texts]
    assert sum((x == separators.SEPARATOR).sum() for x in ids) == 3
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = separators.document_tokens(df, TOKENIZER).collect()
    assert {r.doc_id: r.n_tokens for r in found} == {i: len(x) for i, x in enumerate(ids)}


def test_a_file_of_any_shape(spark, tmp_path):
    ship(spark)
    end = separators.SEPARATOR
    shapes = {"a.bin": [5] * 10 + [end, end] + [7] * 25 + [end], "b.bin": [end], "c.bin": [1, 2, 3], "d.bin": [], "e.bin": [4] * 95 + [end, 9]}
    for name, ids in shapes.items():
        (tmp_path / name).write_bytes(np.array(ids, dtype="<u2").tobytes())
    files = separators.token_files(spark, f"file://{tmp_path}")
    for block in (1, 7, 1000):
        found = sorted((r.file, r.ordinal, r.start, r.n_tokens) for r in separators.count_tokens(files, block=block).collect())
        assert found == [("a.bin", 0, 0, 10), ("a.bin", 1, 11, 0), ("a.bin", 2, 12, 25), ("b.bin", 0, 0, 0), ("c.bin", 0, 0, 3), ("e.bin", 0, 0, 95), ("e.bin", 1, 96, 1)]


# --- 10: quality rules ------------------------------------------------------------------------------


def plain_counts(text):
    text = text or ""
    words, lines = WORD.findall(text), text.split("\n")
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    dup = sum(1 for i, x in enumerate(lines) if WORD.search(x) and x in lines[:i])
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


@pytest.mark.parametrize("table", ["docs", "awkward"])
def test_counts_and_verdicts(request, table, labels):
    df = request.getfixturevalue(table).drop("stats")
    found = rules.judge(df, labels).collect()
    plain = Counter((r.doc_id, *plain_counts(r.text)) for r in df.collect())
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert Counter((r.doc_id, *(r.stats[c] for c in names)) for r in found) == plain
    for r in found:
        assert r.base_failed == (r.stats.n_words < 20 or 100 * r.stats.n_repeat_words > 30 * r.stats.n_words)
        assert r.kept == (not r.base_failed and r["rule"] is None)
    assert rules.judge(empty(df), labels).count() == 0
    assert {r.kept for r in rules.judge(df, labels.where("false")).collect()} <= {True, False}


def test_learned_rules_hold_on_planted_data(spark):
    rng = np.random.default_rng(0)
    values = {"a": rng.random(2000), "b": rng.random(2000)}
    bad = (values["a"] > 0.7) & (values["b"] <= 0.4)
    learned = rules.learn_rules(values, bad, rng.random(2000) < 0.33)
    caught = np.zeros(2000, dtype=bool)
    for r in learned:
        caught |= rules._covers(r, values, 2000)
    assert (caught & bad).sum() > 0.9 * bad.sum() and (caught & ~bad).sum() < 0.05 * caught.sum()


def test_clean_documents_of_the_labels_stay(spark):
    ship(spark)
    documents, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    found = rules.judge(documents, labels).where("not base_failed").join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int"))).collect()
    rate = dict(map(tuple, found))
    assert rate[1] > 0.99 and rate[0] < 0.2


def test_good_documents_keep_clashing_columns(awkward, labels):
    out = rules.good_documents(awkward, labels)
    assert out.schema == awkward.schema
    assert {r.doc_id for r in out.collect()} <= {1, 2, 8, 9, 10, 12, None}
