"""Tokens, term counts, inverse document frequency, and the hashed text pipeline."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, Tokenizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureflow.operators import lookup
from featureflow.operators.lookup import attach_pinned, pin
from featureflow.session import input_bytes, spread


def tokens(df: DataFrame, text: str = "text", out: str = "words") -> DataFrame:
    """Lower-cased words of the whole text, split at single whitespace characters; none for null."""
    split = Tokenizer(inputCol="__text", outputCol=out).transform(df.withColumn("__text", F.coalesce(text, F.lit(""))))
    none = F.array().cast("array<string>")
    return split.withColumn(out, F.when(F.col(text).isNull(), none).otherwise(F.col(out))).drop("__text")


def _words(df: DataFrame, words: str, *keys: str) -> DataFrame:
    """One row per word. Not a plain explode: that makes the optimizer add a filter on the array,
    which would split every text once more for the filter."""
    return df.select(*keys, F.explode_outer(words).alias("term")).where(F.col("term").isNotNull())


# Bytes of stored texts whose words one task counts at a time.
COUNT_BYTES = 8 * 1024 * 1024
# The optimizer's size of what it knows nothing of.
UNKNOWN_BYTES = 1 << 60


def by_key(df: DataFrame, key: str) -> DataFrame:
    """``df`` dealt by its key alone, in pieces whose number follows the bytes read; adaptive execution merges none of them."""
    size = input_bytes(df)
    if size >= UNKNOWN_BYTES:
        return df.repartition(key)
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, size // COUNT_BYTES + 1), key)


def term_counts(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, term, tf). The texts are shuffled by their key once; the far larger pairs of key and term stay in their task."""
    words = tokens(by_key(df.select(key, text), key), text)
    return _words(words, "words", key).groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def idf_table(documents: DataFrame, text: str = "text") -> DataFrame:
    """(term, df, idf) with idf = ln((N + 1) / (df + 1)), N the rows of ``documents``.

    One row is one document. Its words are made distinct inside the row, so only per-task counts
    per word are shuffled, never (document, word) pairs.
    """
    total = documents.agg(F.count(F.lit(1))).scalar()
    words = tokens(spread(documents.select(text)), text)
    distinct = words.select(F.array_distinct("words").alias("words"))
    frequency = _words(distinct, "words").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return frequency.withColumn("idf", F.log((total + 1) / (F.col("df") + 1)))


def idf_of_counts(counts: DataFrame, documents: DataFrame) -> DataFrame:
    """``idf_table`` from written term counts of ``documents``, without splitting the texts again."""
    total = documents.agg(F.count(F.lit(1))).scalar()
    frequency = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return frequency.withColumn("idf", F.log((total + 1) / (F.col("df") + 1)))


def tfidf(counts: DataFrame, idf: DataFrame, key: str) -> DataFrame:
    """(key, term, tf, idf, tfidf). Common words are hot keys of this join; ``df`` tells which."""
    return attach_terms(counts, idf).withColumn("tfidf", F.col("tf") * F.col("idf"))


def attach_terms(counts: DataFrame, stats: DataFrame) -> DataFrame:
    """Left join (term, df, ...) to term counts; ``df`` says in how many of them a term is.

    Statistics too large to broadcast are split: those of the most frequent terms, as many as may be broadcast, leave
    their rows where they are, and only the rows of rarer terms, few for each term, are shuffled.
    """
    held, small = pin(stats)
    if small:
        return attach_pinned(counts, held.drop("df"), small, ["term"])
    terms, size = held.count(), max(1, input_bytes(held))
    most = min(lookup.BROADCAST_ROWS, terms * lookup.BROADCAST_BYTES // size)
    cut = held.agg(F.percentile_approx("df", max(0.0, 1 - most / max(1, terms)))).first()[0] or 0
    common, rare = held.where(F.col("df") > cut).drop("df"), held.where(F.col("df") <= cut).drop("df")
    near = counts.join(F.broadcast(common), "term").select(*counts.columns, *[c for c in common.columns if c != "term"])
    others = counts.join(F.broadcast(common.select("term")), "term", "left_anti").select(*counts.columns)
    return near.unionByName(attach_pinned(others, rare, False, ["term"], hot=[]))


def hashed_features(text: str = "text", buckets: int = 1000) -> list:
    """Tokenizer -> hashed term counts -> IDF weights, as pipeline stages."""
    return [
        Tokenizer(inputCol=text, outputCol="words"),
        HashingTF(inputCol="words", outputCol="rawFeatures", numFeatures=buckets),
        IDF(inputCol="rawFeatures", outputCol="features", minDocFreq=0),
    ]


def term_buckets(terms: DataFrame, buckets: int = 1000) -> DataFrame:
    """(term, bucket) of distinct terms, numbered by the hash of the pipeline's own stage."""
    hashed = HashingTF(inputCol="__words", outputCol="__v", numFeatures=buckets).transform(terms.select("term", F.array("term").alias("__words")))
    # A vector with one entry; its text names the place, whatever the number of buckets.
    return hashed.select("term", F.regexp_extract(F.col("__v").cast("string"), r"\[(\d+)\]", 1).cast("int").alias("bucket"))


def hashed_counts(counts: DataFrame, key: str, buckets: int = 1000) -> DataFrame:
    """(key, bucket, tf) from written ``term_counts``: each distinct term is hashed once, and joined to its rows."""
    frequency = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    joined = attach_terms(counts, term_buckets(frequency, buckets).join(frequency, "term"))
    return joined.groupBy(key, "bucket").agg(F.sum("tf").alias("tf"))


def hashed_tfidf(hashed: DataFrame, documents: DataFrame, key: str) -> DataFrame:
    """(key, bucket, tf, weight) from written ``hashed_counts``: tf * ln((N + 1) / (df + 1)), df the documents of a bucket.

    There are as many frequencies as buckets at most, so they are broadcast.
    """
    total = documents.agg(F.count(F.lit(1))).scalar()
    frequency = hashed.groupBy("bucket").agg(F.count(F.lit(1)).alias("df"))
    weighted = hashed.join(F.broadcast(frequency), "bucket")
    return weighted.select(key, "bucket", "tf", (F.col("tf") * F.log((total + 1) / (F.col("df") + 1))).alias("weight"))


def sparse_vectors(weighted: DataFrame, key: str, value: str = "weight") -> DataFrame:
    """(key, indices, values): each key's buckets in order; no more entries than there are buckets."""
    entries = F.sort_array(F.collect_list(F.struct("bucket", F.col(value).alias("value"))))
    gathered = weighted.groupBy(key).agg(entries.alias("e"))
    return gathered.select(key, F.col("e.bucket").alias("indices"), F.col("e.value").alias("values"))


def text_classifier(label: str = "label", text: str = "text", buckets: int = 1000) -> Pipeline:
    """Hashed TF-IDF and a logistic regression (10 iterations, regularisation 0.001)."""
    model = LogisticRegression(labelCol=label, maxIter=10, regParam=0.001)
    return Pipeline(stages=[*hashed_features(text, buckets), model])
