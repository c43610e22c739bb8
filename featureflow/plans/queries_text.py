"""Queries: tokens, term frequencies, TF-IDF, the hashed text pipeline and its persistence."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.operators.split import hash_part
from featureflow.operators.text import (
    hashed_counts,
    hashed_features,
    hashed_tfidf,
    idf_of_counts,
    idf_table,
    term_counts,
    text_classifier,
    tfidf,
    tokens,
)
from featureflow.plans.registry import query
from featureflow.plans.standin import table
from featureflow.session import TEXT_PIECE_ROWS, scratch_path, spread, training_table, written_table
from featureflow.sources.files import load_model, load_pipeline, save_pipeline, stage_parameters

WORDS_SQL = r"string_split_regex(lower(regexp_replace(text, '\s+$', '')), '\s')"
COUNTS_SQL = f"""words AS (SELECT doc_id, unnest({WORDS_SQL}) AS term FROM documents),
  counts AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term)"""
IDF_SQL = f"""{COUNTS_SQL}, idf AS (SELECT term, count(*) AS df,
  ln(((SELECT count(*) FROM documents) + 1)::DOUBLE / (count(*) + 1)) AS idf FROM counts GROUP BY term)"""


@query(f"SELECT doc_id, len({WORDS_SQL})::INTEGER AS n_tokens FROM documents")
def tokenize_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words per document, whole texts."""
    words = tokens(spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id"))
    return words.select("doc_id", F.size("words").alias("n_tokens"))


@query(f"WITH {COUNTS_SQL} SELECT doc_id, term, tf FROM counts")
def term_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrences per document and word."""
    return term_counts(table(spark, sf_dir, "documents"), "doc_id")


@query(f"WITH {IDF_SQL} SELECT term, df, round(idf, 6) AS idf FROM idf")
def idf_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document frequency and its weight per word."""
    documents = table(spark, sf_dir, "documents")
    idf = idf_table(documents)
    return idf.withColumn("idf", F.round("idf", 6))


@query(f"WITH {IDF_SQL} SELECT doc_id, term, round(tf * idf, 6) AS tfidf FROM counts JOIN idf USING (term)")
def tfidf_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight of every word in every document."""
    documents = table(spark, sf_dir, "documents")
    counts = written_table(term_counts(documents, "doc_id"), "counts")
    weighted = tfidf(counts, idf_of_counts(counts, documents), "doc_id")
    return weighted.select("doc_id", "term", F.round("tfidf", 6).alias("tfidf"))


@query(f"SELECT doc_id, len({WORDS_SQL})::DOUBLE AS hashed_tokens FROM documents")
def hashed_tf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashed term counts add up to the number of words, whatever collides."""
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    hashed = Pipeline(stages=hashed_features()[:2]).fit(documents).transform(documents)
    total = F.aggregate(vector_to_array("rawFeatures"), F.lit(0.0), lambda a, x: a + x)
    return hashed.select("doc_id", total.alias("hashed_tokens"))


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text, label) of the labelled documents."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    return documents.join(labels, "doc_id")


@query()
def model_text_lr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text classifier fitted on 70% of the labelled documents, the others scored."""
    rows = labelled_documents(spark, sf_dir).withColumn("part", hash_part("doc_id", {"train": 70, "test": 30}))
    rows = training_table(rows, "texts", "doc_id", piece_rows=TEXT_PIECE_ROWS)
    model = text_classifier().fit(rows.where("part = 'train'"))
    scored = model.transform(rows.where("part = 'test'"))
    return scored.select("doc_id", "label", "prediction", vector_to_array("probability")[1].alias("probability"))


@query("SELECT doc_id, true AS same_counts, true AS same_weights FROM documents")
def hashed_tf_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashed counts and weights by joins and sums equal the pipeline's vectors, bucket by bucket in every document."""
    texts = table(spark, sf_dir, "documents").select("doc_id", "text")
    counts = written_table(term_counts(texts, "doc_id"), "counts")
    hashed = written_table(hashed_counts(counts, "doc_id"), "hashed")
    weighted = hashed_tfidf(hashed, texts, "doc_id").select("doc_id", F.struct(F.col("bucket").alias("pos"), "tf", "weight").alias("e"))
    gathered = weighted.groupBy("doc_id").agg(F.sort_array(F.collect_list("e")).alias("summed"))
    documents = spread(texts, "doc_id")
    fitted = Pipeline(stages=hashed_features()).fit(documents).transform(documents)
    raw, features = F.unwrap_udt("rawFeatures"), F.unwrap_udt("features")
    # Both vectors are sparse and hold the same buckets in order; no more entries of a document are made than it has buckets.
    vectors = fitted.select("doc_id", raw.alias("a"), features.alias("w")).where(F.size("a.indices") > 0)
    whole = (F.size("a.indices") == F.size("w.indices")) & (F.col("a.indices") == F.col("w.indices"))
    pairs = F.arrays_zip(F.col("a.indices").alias("pos"), F.col("a.values").alias("a"), F.col("w.values").alias("w"))
    both = vectors.select("doc_id", whole.alias("whole"), pairs.alias("own")).join(gathered, "doc_id", "full_outer")
    aligned = F.col("whole") & (F.size("own") == F.size("summed"))
    fits = lambda test: F.coalesce(aligned & F.forall(F.zip_with("own", "summed", test), lambda x: x), F.lit(False))
    same = lambda o, s: (o["pos"] == s["pos"]) & (o["a"] == s["tf"].cast("double"))
    near = lambda o, s: (o["pos"] == s["pos"]) & (F.abs(o["w"] - s["weight"]) < 1e-9)
    return both.groupBy("doc_id").agg(F.bool_and(fits(same)).alias("same_counts"), F.bool_and(fits(near)).alias("same_weights"))


@query()
def pipeline_params_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An unfitted pipeline saved, loaded, fitted and applied to the labelled documents."""
    path = scratch_path(spark, "pipeline")
    save_pipeline(text_classifier(), path)
    rows = training_table(labelled_documents(spark, sf_dir), "texts", "doc_id", piece_rows=TEXT_PIECE_ROWS)
    return load_pipeline(path).fit(rows).transform(rows).select("doc_id", "label", "prediction")


PARAMETERS = (
    (0, "Tokenizer", "inputCol", "text"), (0, "Tokenizer", "outputCol", "words"),
    (1, "HashingTF", "inputCol", "words"), (1, "HashingTF", "outputCol", "rawFeatures"), (1, "HashingTF", "numFeatures", "1000"),
    (2, "IDF", "inputCol", "rawFeatures"), (2, "IDF", "outputCol", "features"), (2, "IDF", "minDocFreq", "0"),
    (3, "LogisticRegression", "labelCol", "label"), (3, "LogisticRegression", "maxIter", "10"), (3, "LogisticRegression", "regParam", "0.001"),
)


@query(f"SELECT stage, class, parameter, value, true AS kept, true AS in_model FROM (VALUES {', '.join(map(str, PARAMETERS))}) AS t(stage, class, parameter, value)")
def pipeline_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is set in the saved pipeline, stage by stage, and whether saving the loaded one and the fitted one keeps it."""
    first, again, fitted = (scratch_path(spark, "pipeline") for _ in range(3))
    save_pipeline(text_classifier(), first)
    loaded = load_pipeline(first)
    save_pipeline(loaded, again)
    save_pipeline(loaded.fit(training_table(labelled_documents(spark, sf_dir), "texts", "doc_id", piece_rows=TEXT_PIECE_ROWS)), fitted)
    columns = ["stage", "parameter", "value", "is_default"]
    rows, kept, model = (stage_parameters(spark, p) for p in (first, again, fitted))
    both = rows.join(kept.select(*columns, "uid", F.lit(True).alias("kept")), [*columns, "uid"], "left")
    both = both.join(model.select(*columns, F.lit(True).alias("in_model")), columns, "left")
    flags = [F.coalesce(c, F.lit(False)).alias(c) for c in ("kept", "in_model")]
    return both.where("not is_default").select("stage", F.substring_index("class", ".", -1).alias("class"), "parameter", "value", *flags)


@query("SELECT doc_id, true AS same_score FROM documents JOIN labels USING (doc_id)")
def model_roundtrip_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fitted model saved and loaded gives the same probability for every labelled document."""
    rows = training_table(labelled_documents(spark, sf_dir), "texts", "doc_id", piece_rows=TEXT_PIECE_ROWS)
    model = text_classifier().fit(rows)
    path = scratch_path(spark, "model")
    save_pipeline(model, path)
    once = model.transform(rows).select("doc_id", "text", F.col("probability").alias("before"))
    both = load_model(path).transform(once)
    same = vector_to_array("before") == vector_to_array("probability")
    return both.select("doc_id", same.alias("same_score"))
