"""One registered query per operator of this subpackage, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.llm import alignment, ann, collocations, licenses, minhash, mixing, packing, rules, separators, sharding, suffixes, toxicity, urls
from featureflow.llm.ship import bound_batches, ship
from featureflow.plans import registry


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None) -> Callable:
    """Register a query whose functions may run in Python on executors."""

    def add(function: Callable) -> Callable:
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return function(spark, sf_dir)

        registry.query(sql, name=function.__name__)(shipped)
        return function

    return add


TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

OP1_SQL = """
WITH sizes AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents
), totals AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source
), sources AS (
    SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS idx, 3 * source_size AS cap FROM totals
), weighted AS (
    SELECT *, [5, 2, 1][idx % 3 + 1] AS weight FROM sources
), running AS (
    SELECT *, cap / weight AS ratio,
        sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS free,
        sum(weight) OVER (ORDER BY cap / weight, idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
    FROM weighted
), level AS (
    SELECT first(free::BIGINT / open_weight::BIGINT ORDER BY ratio, idx) AS v FROM running WHERE free::BIGINT / open_weight::BIGINT <= ratio
), targets AS (
    SELECT source, source_size, idx, cap, least(cap::DOUBLE, weight * v) AS target FROM weighted, level
), whole AS (
    SELECT sum(source_size)::BIGINT AS words FROM targets
), sized AS (
    SELECT least(4096, greatest(1, words // 65536)) AS block FROM whole
), parts AS (
    SELECT source, source_size, idx, target, least(block, greatest(1, source_size // 256)) AS block FROM targets, sized
), shares AS (
    SELECT idx, target * ((source_size + block - 1) // block) / source_size AS share FROM parts WHERE source_size > 0
), line AS (
    SELECT idx, floor(share / (SELECT sum(share) FROM shares) * 2147483648)::BIGINT AS units FROM shares
), placed AS (
    SELECT idx, (sum(units) OVER (ORDER BY idx) - units)::BIGINT AS lo, (sum(units) OVER (ORDER BY idx))::BIGINT AS hi FROM line
), points AS (
    SELECT i AS slot, ((i * 2654435769::BIGINT) % 4294967296) AS p
    FROM (SELECT unnest(range((SELECT ceil(sum(share) - 1e-6) FROM shares)::BIGINT)) AS i)
), stretched AS (
    SELECT slot, (p * (SELECT max(hi) FROM placed)) >> 32 AS y FROM points
), slots AS (
    SELECT slot, idx, row_number() OVER (PARTITION BY idx ORDER BY slot) - 1 AS rank FROM stretched JOIN placed ON lo <= y AND y < hi
), draws AS (
    SELECT s.idx, rank % ((source_size + block - 1) // block) AS block_no, count(*) AS draws
    FROM slots s JOIN parts t ON t.idx = s.idx
    WHERE rank < 3 * ((source_size + block - 1) // block) GROUP BY ALL
), laid AS (
    SELECT doc_id, size, t.source_size, t.target, t.idx, t.block,
        (sum(size) OVER (PARTITION BY t.idx ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id, size ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start
    FROM sizes s JOIN parts t ON s.source IS NOT DISTINCT FROM t.source
), cut AS (
    SELECT l.*, unnest(range(start // block, CASE WHEN size = 0 THEN start // block ELSE (start + size - 1) // block + 1 END)) AS block_no FROM laid l
), met AS (
    SELECT c.doc_id, c.idx, c.start, sum((least(start + size, (c.block_no + 1) * block) - greatest(start, c.block_no * block)) * coalesce(draws, 0)) AS taken
    FROM cut c LEFT JOIN draws d ON d.idx = c.idx AND d.block_no = c.block_no GROUP BY ALL
)
SELECT l.doc_id, l.size, l.source_size, l.target, coalesce(m.taken, 0)::BIGINT AS taken
FROM laid l LEFT JOIN met m ON l.size > 0 AND m.doc_id = l.doc_id AND m.idx = l.idx AND m.start = l.start
"""


@query(OP1_SQL)
def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed: weights 5, 2, 1 in turn, no source more than three times."""
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP2_SQL = """
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
        ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
    FROM words
), shingles AS (
    SELECT doc_id, hash(unnest(s)) AS h FROM sets
), shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
    FROM shingles a JOIN shingles b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
    SELECT x, y FROM shared JOIN sets p ON p.doc_id = x JOIN sets q ON q.doc_id = y
    WHERE 100 * n >= 80 * (len(p.s) + len(q.s) - n)
), edges AS (
    SELECT x, y FROM links UNION SELECT y, x FROM links
), reach AS (
    SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x
), smallest AS (
    SELECT x, min(y) AS component_id FROM reach GROUP BY x
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN smallest ON x = doc_id
"""


@query(OP2_SQL)
def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents: two-word shingles, similarity of 0.8 or more."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), n=2, percent=80)


@query()
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in every document."""
    return licenses.summary(licenses.scan(_table(spark, sf_dir, "documents")))


@query()
def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows found for every vector with an id divisible by 20."""
    return ann.nearest_neighbours(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, nearest=20)


@query()
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token pieces in sequences of at most 2048 tokens."""
    pieces = packing.token_pieces(_table(spark, sf_dir, "documents"), TOKENIZER, 2048, end_id=0)
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


OP6_SQL = """
WITH words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents
), places AS (
    SELECT doc_id, w, unnest(range(len(w))) AS i FROM words WHERE len(w) >= 50
), windows AS (
    SELECT doc_id, i, CASE WHEN i + 50 <= len(w) THEN hash(array_to_string(w[i + 1 : i + 50], ' ')) END AS h FROM places
), counted AS (
    SELECT *, CASE WHEN h IS NULL THEN 0 WHEN row_number() OVER (PARTITION BY h ORDER BY doc_id, i) > 1 THEN 2
        WHEN count(*) OVER (PARTITION BY h) > 1 THEN 1 ELSE 0 END AS s
    FROM windows
), covered AS (
    SELECT doc_id, i, max(s) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS s FROM counted
), runs AS (
    SELECT doc_id, i, s, i - row_number() OVER (PARTITION BY doc_id, s ORDER BY i) AS run FROM covered WHERE s > 0
)
SELECT doc_id, min(i)::BIGINT AS first_word, count(*)::BIGINT AS n_words, s = 2 AS removed FROM runs GROUP BY doc_id, s, run
"""


@query(OP6_SQL)
def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words in passages of 50 words or more that stand in the documents twice."""
    return suffixes.repeated_spans(_table(spark, sf_dir, "documents"), least=50)


@query()
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document from its nearest labelled ones."""
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query()
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL: fixed rules, then association rules mined from the documents' labels."""
    return urls.judge(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels"))


@query()
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted in flat token files by their separators alone."""
    return separators.document_tokens(_table(spark, sf_dir, "documents"), TOKENIZER)


@query()
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document; the decision list is learned from ``labels.quality``."""
    judged = rules.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    counts = [f"stats.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return judged.select("doc_id", *counts, "base_failed", "kept", "rule")



@query()
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids of two tokenizers aligned, with corpus-wide counts of the linked ids."""
    bound_batches(spark)
    path_a, path_b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    aligned = alignment.alignments(_table(spark, sf_dir, "documents"), path_a, path_b)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    aligned = aligned.withColumn("groups_sha256", digest).drop("groups")
    scored = alignment.scored(aligned, alignment.Pieces(path_b).size)
    return scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")

OP12_SQL = """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
        unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
), split AS (
    SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
), totals AS (
    SELECT lang, sum(len(w))::BIGINT AS n FROM split GROUP BY lang
), grams AS (
    SELECT lang, w[i : i + k - 1] AS w, count(*) AS f
    FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split), (SELECT unnest([1, 2, 3, 4]) AS k)
    WHERE i + k - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 30
), candidates AS (
    SELECT lang, w, f AS a FROM grams WHERE len(w) > 1
), taken AS (
    SELECT DISTINCT c.lang, c.w
    FROM (SELECT lang, a, w, unnest([2, 3]) AS k FROM candidates) q, (SELECT unnest([1, 2, 3]) AS i) p, candidates c
    WHERE k < len(q.w) AND i + k - 1 <= len(q.w) AND c.lang = q.lang AND c.w = q.w[i : i + k - 1] AND 100 * q.a::HUGEINT >= 80 * c.a::HUGEINT
), cuts AS (
    SELECT c.lang, c.w, c.a, k, l.f AS l, r.f AS r, 2000000 * c.a::HUGEINT // (l.f + r.f) AS score
    FROM (SELECT *, unnest(range(1, len(w))) AS k FROM candidates ANTI JOIN taken USING (lang, w)) c
    JOIN grams l ON l.lang = c.lang AND l.w = c.w[1 : k] JOIN grams r ON r.lang = c.lang AND r.w = c.w[k + 1 :]
), best AS (
    SELECT *, row_number() OVER (PARTITION BY lang, w ORDER BY score, k) AS place FROM cuts
), ranked AS (
    SELECT lang, array_to_string(w, ' ') AS phrase, a, l, r, score,
        row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(w, ' ')) AS rank
    FROM best WHERE place = 1
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


@query(OP12_SQL)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 strongest phrases of two to four words in every language."""
    bound_batches(spark)
    found = collocations.collocations(_table(spark, sf_dir, "documents"), most=4, least=30, percent=80)
    return collocations.strongest(found, 2000).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


OP13_SQL = """
WITH bytes AS (
    SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, b)) AS crc
), rows AS (
    SELECT doc_id, source, octet_length(encode(coalesce(text, ''))) + 16 AS size,
        xor(4294967295, list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT),
            lambda x, y: xor(x >> 8, crc[(xor(x, y) & 255) + 1]), 4294967295::BIGINT)) AS text_crc32
    FROM documents, bytes
), ranked AS (
    SELECT *, count(*) OVER (PARTITION BY source) AS n,
        row_number() OVER (PARTITION BY source ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id NULLS FIRST, text_crc32, size) - 1 AS rank
    FROM rows
), placed AS (
    SELECT *, row_number() OVER (ORDER BY (2 * rank + 1)::DOUBLE / (2 * n)::DOUBLE, source NULLS LAST, rank) - 1 AS place, count(*) OVER () AS n_rows FROM ranked
), cut AS (
    SELECT *, place * 40 // n_rows AS shard FROM placed
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, shard::INTEGER AS shard,
    (place - (shard * n_rows + 39) // 40)::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM cut
"""


@query(OP13_SQL)
def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of equal counts that hold the sources in proportion."""
    dealt = sharding.shard(_table(spark, sf_dir, "documents"), shards=40)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
