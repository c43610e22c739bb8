"""Token alignment, collocations and sharding against plain versions of themselves, on small tables with awkward rows."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import __spark_entry__ as entry_point
from featureflow.llm import alignment, collocations, minhash, mixing, packing, sharding, suffixes
from featureflow.llm.ship import ship
from featureflow.llm.tables import free_names
from featureflow.llm.tokens import byte_alphabet
from featureflow.operators import lookup
from tests.conftest import SMALL_SF_DIR

PATH_A, PATH_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    return spark.read.parquet(f"{SMALL_SF_DIR}/documents.parquet")


TEXTS = [
    None, "", " ", "\n", "  two  spaces ", "tab\t\n end ", "One one ONE. one, one; one", "a▁b marks its own space", "<s> <|endoftext|> </s> <unk> <0x41>",
    "x\x00y \x01 z\x0b\x0c\r\n", "é é 日本語 テキスト 🎉🎉 　 ", "ab " * 900, " " * 2500, "don't won't 12345 !!??", "a b a b a b a b", "nolang words nolang words",
]


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls, empty, odd and long texts, repeated rows and ids, null ids, languages and sources, clashing columns."""
    ship(spark)
    rng = np.random.default_rng(5)
    words = ["the", "of", "a", "new", "york", "city", "x\x01", "x", "é", "(the", "\x1c"]
    drawn = [" ".join(rng.choice(words, 40)) + rng.choice([".", ",", "\n", ""]) + " New\tYork  city" for _ in range(60)]
    texts = [*TEXTS, *drawn, drawn[0], drawn[0], " ".join(rng.choice(words, 20_000))]
    langs = [None, "und", "en", "fr"]
    rows = [(i if i % 9 else None, t, langs[i % 4], [None, "s", "hot", "hot"][i % 4], i, "w", 0) for i, t in enumerate(texts)]
    rows += [(5, "same id", "en", "hot", 1, "w", 0), (5, "same id", "en", "hot", 1, "w", 0), (5, "other text", "en", "s", 1, "w", 0)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, part int, words string, size int").repartition(3)


# --- 11: alignment ------------------------------------------------------------------------------------


def plain_tokens(texts):
    """((id, start, end), ...) of both sides per text, by the libraries alone."""
    library = Tokenizer.from_file(PATH_A)
    library.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=PATH_B)
    byte_of = {c: b for b, c in enumerate(byte_alphabet())}
    names = {i: k for k, i in library.get_vocab().items()}

    def piece_bytes(i):
        p = pieces.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode()

    for t in texts:
        a = [(i, bytes(byte_of[c] for c in names[i])) for i in library.encode(" " + t, add_special_tokens=False).ids] if t else []
        b = [(i, piece_bytes(i)) for i in pieces.encode(t)] if t else []
        if not b"".join(x for _, x in a) == b"".join(x for _, x in b) == (" " + t if t else "").encode():
            a = b = []
        sides = []
        for side in (a, b):
            ends = np.cumsum([len(x) for _, x in side]).tolist()
            sides.append([(i, e - len(x), e) for (i, x), e in zip(side, ends, strict=True)])
        yield sides


def plain_alignment(a, b):
    """(groups, links) of two token lists by walking both at once."""
    groups, links, i, j, head = [], [], 0, 0, (0, 0)
    while i < len(a) and j < len(b):
        links.append((a[i][0], b[j][0]))
        end_a, end_b = a[i][2], b[j][2]
        i, j = i + (end_a <= end_b), j + (end_b <= end_a)
        if end_a == end_b:
            sides = (a[head[0] : i], b[head[1] : j])
            groups.append("|".join(",".join(str(x[0]) for x in s) for s in sides))
            head = (i, j)
    return groups, links


def aligned_rows(df):
    found = alignment.alignments(df, PATH_A, PATH_B)
    return alignment.scored(found, alignment.Pieces(PATH_B).size)


@pytest.mark.parametrize("table", ["docs", "awkward"])
@pytest.mark.parametrize("broadcast_rows", [lookup.BROADCAST_ROWS, 0])
def test_alignment_is_that_of_a_plain_walk(request, monkeypatch, table, broadcast_rows):
    df = request.getfixturevalue(table)
    monkeypatch.setattr(lookup.pin, "__defaults__", (broadcast_rows, lookup.BROADCAST_BYTES))
    monkeypatch.setattr(lookup.attach, "__defaults__", (None, broadcast_rows))
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    whole = [plain_alignment(a, b) for a, b in plain_tokens([t for _, t in rows])]
    sizes = [(len(a), len(b)) for a, b in plain_tokens([t for _, t in rows])]
    counts = Counter(p for _, links in whole for p in links)
    top = Counter()
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    want = Counter(
        (i, *size, len(groups), len(links), sum(counts[p] == top[p[1]] for p in links), sum(counts[p] for p in links), ";".join(groups))
        for (i, _), size, (groups, links) in zip(rows, sizes, whole, strict=True)
    )
    got = Counter(tuple(r) for r in aligned_rows(df).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups").collect())
    assert got == want


def test_windows_with_one_hash_keep_their_own_ids(monkeypatch):
    one, two, names = alignment.sides(PATH_A, PATH_B)
    texts = ["some words in a text, and SoMe more; words " * 3, "another wordlike thingummy"]
    want = alignment.align_texts(texts, one, two, names, alignment.Windows())
    monkeypatch.setattr(alignment, "_tuple_keys", lambda ids, heads, sizes, seed: np.zeros(len(heads), dtype=np.uint64))
    monkeypatch.setattr(alignment, "MEMORY", 2000)  # and a memory that is emptied all the time
    got = alignment.align_texts(texts, one, two, names, alignment.Windows())
    assert {c: v.to_pylist() for c, v in got.items()} == {c: v.to_pylist() for c, v in want.items()}


def test_alignment_without_ranks_uses_the_library(monkeypatch):
    coder = alignment.ByteBpe(PATH_A)
    assert coder.fast is not None
    texts = ["plain text", " " * 3000 + "x", "a<|endoftext|>b", "日本   1234"]
    quick = coder.encode_all(texts)
    coder.fast = None
    assert coder.encode_all(texts) == quick


def test_alignment_query_digests(spark):
    found = entry_point.queries()["op11_token_alignment"](spark, SMALL_SF_DIR).toPandas()
    documents = spark.read.parquet(f"{SMALL_SF_DIR}/documents.parquet").toPandas()
    groups = {i: ";".join(plain_alignment(a, b)[0]) for i, (a, b) in zip(documents.doc_id, plain_tokens(documents.text), strict=True)}
    assert {r.doc_id: r.groups_sha256 for r in found.itertuples()} == {i: hashlib.sha256(g.encode()).hexdigest() if g else "" for i, g in groups.items()}


def test_alignment_of_nothing(docs):
    assert aligned_rows(docs.where("false")).count() == 0
    one = aligned_rows(docs.where("false").unionByName(docs.limit(0))).columns
    assert one == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]


# --- 12: collocations ---------------------------------------------------------------------------------


def plain_collocations(rows, most, least, percent):
    """{(lang, phrase): (a, l, r, n, score, cut)} by counting everything."""
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            counts.update((lang, *w[i : i + n]) for n in range(1, most + 1) for i in range(len(w) - n + 1))
    candidates = {p: f for p, f in counts.items() if len(p) > 2 and f >= least}
    out = {}
    for (lang, *w), a in candidates.items():
        inside = lambda q: q[0] == lang and len(q) - 1 > len(w) and any(list(q[i : i + len(w)]) == w for i in range(1, len(q) - len(w) + 1))  # noqa: E731, B023
        if any(100 * f >= percent * a for q, f in candidates.items() if inside(q)):
            continue
        cuts = [(2_000_000 * a // (counts[lang, *w[:k]] + counts[lang, *w[k:]]), k, counts[lang, *w[:k]], counts[lang, *w[k:]]) for k in range(1, len(w))]
        score, k, left, right = min(cuts)
        out[lang, " ".join(w)] = (a, left, right, totals[lang], score, k)
    return out


@pytest.mark.parametrize(("table", "most", "least", "percent"), [("docs", 4, 30, 80), ("awkward", 4, 3, 80), ("awkward", 2, 2, 80), ("awkward", 5, 12, 60)])
def test_collocations_are_those_of_plain_counts(request, table, most, least, percent):
    df = request.getfixturevalue(table)
    got = collocations.collocations(df, most, least, percent).collect()
    want = plain_collocations([(r.lang, r.text) for r in df.collect()], most, least, percent)
    assert {(r.lang, r.phrase): (r.a, r.l, r.r, r.n, r.score, r.cut) for r in got} == want
    assert len(got) == len(want) > 0


def test_streams_cut_anywhere(spark, awkward):
    """As many partitions as phrases, so that nearly every beginning lies in an earlier one."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    few = awkward.where("lang = 'en'")
    want = plain_collocations([(r.lang, r.text) for r in few.collect()], 4, 12, 80)
    spark.conf.set("spark.sql.shuffle.partitions", "41")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = collocations.collocations(few, 4, 12, 80).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {(r.lang, r.phrase): (r.a, r.l, r.r, r.n, r.score, r.cut) for r in got} == want


def test_a_full_bitmap_changes_nothing(monkeypatch, awkward):
    monkeypatch.setattr(collocations, "LEAST_BITS", 6)
    monkeypatch.setattr(collocations, "MOST_BITS", 6)
    got = collocations.collocations(awkward, 4, 3, 80).collect()
    want = plain_collocations([(r.lang, r.text) for r in awkward.collect()], 4, 3, 80)
    assert {(r.lang, r.phrase): (r.a, r.l, r.r, r.n, r.score, r.cut) for r in got} == want


def test_sums_beyond_64_bits(spark):
    """The arithmetic of cuts and of the longer phrases on counts that no test table reaches."""
    big = 9 * 10**15
    rows = [("en", ["a"], big), ("en", ["b"], 4 * big), ("en", ["a", "b"], big - 1)]
    grams, totals = spark.createDataFrame(rows, "lang string, words array<string>, f bigint"), spark.createDataFrame([("en", 10 * big)], "lang string, n bigint")
    (r,) = collocations.scored_phrases(grams, totals, 2, 80, collocations.SCALE).collect()
    assert (r.a, r.l, r.r, r.score) == (big - 1, big, 4 * big, 2_000_000 * (big - 1) // (5 * big))


def test_no_collocations(docs):
    assert collocations.collocations(docs.where("false")).count() == 0
    assert collocations.collocations(docs, least=10**9).count() == 0
    with pytest.raises(ValueError):
        collocations.collocations(docs, most=1)


# --- 13: shards ---------------------------------------------------------------------------------------


@pytest.mark.parametrize(("table", "shards"), [("docs", 40), ("docs", 7), ("awkward", 40), ("awkward", 1), ("awkward", 500)])
def test_shards(request, table, shards):
    df = request.getfixturevalue(table)
    found = sharding.shard(df, shards).toPandas()
    rows = [(r.doc_id, r.text, r.source) for r in df.collect()]
    sized = Counter((i, s, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, s in rows)
    none = lambda x: None if x is None or x != x else x
    assert Counter((none(r.doc_id), none(r.source), r.size, r.text_crc32) for r in found.itertuples()) == sized
    counts = np.bincount(found["shard"], minlength=shards)
    assert len(counts) == shards and counts.max() - counts.min() <= 1
    for _, slots in found.groupby("shard")["slot"]:
        assert sorted(slots) == list(range(len(slots)))
    # Every shard holds the mixture.
    share = Counter(s for _, _, s in rows)
    held = Counter((none(r.source), r.shard) for r in found.itertuples())
    for (source, total), shard in ((x, s) for x in share.items() for s in range(shards)):
        assert abs(held[source, shard] - counts[shard] * total / len(rows)) <= 2


def test_shards_by_another_seed_and_on_other_partitions(docs):
    key = ["doc_id", "shard", "slot"]
    one = sorted(map(tuple, sharding.shard(docs).select(key).collect()))
    assert one == sorted(map(tuple, sharding.shard(docs.repartition(5)).select(key).collect()))
    assert one != sorted(map(tuple, sharding.shard(docs, seed="other").select(key).collect()))


def test_no_shards(docs):
    assert sharding.shard(docs.where("false")).count() == 0
    with pytest.raises(ValueError):
        sharding.shard(docs, 0)


# --- names --------------------------------------------------------------------------------


def test_clashing_names_of_all_kinds(spark, awkward):
    clash = {c: awkward["part"] for c in ("kept_id", "text_hash", "cut_id", "cuts", "gone", "mixed_id", "mixed_source", "copies", "copy", "COPY_")}
    df = awkward.withColumns(clash)
    assert free_names(df, "copy", "x") == ["copy__", "x"]
    for found in (minhash.without_near_duplicates(df), suffixes.without_repeats(df), mixing.mixed_documents(df)):
        assert found.columns == df.columns
        assert found.count() > 0
    pieces = spark.createDataFrame([(1, 5, 1, 2), (2, 7, 3, 4)], "doc_id int, length bigint, __row int, __group int")
    packed = packing.pack(pieces)
    assert packed.columns == [*pieces.columns, "sequence_id", "offset"] and packed.count() == 2


def test_rows_with_an_id_and_text_in_common_leave_one(spark):
    ship(spark)
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "other words stand in this text here"), (None, "x"), (None, "x"), (2, "A b c d e f")]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    found = sorted(minhash.without_near_duplicates(df).collect(), key=str)
    assert found == sorted([(1, rows[0][1]), (1, rows[2][1]), (None, "x"), (None, "x")], key=str)
