import math

import pytest
from pyspark.ml.feature import IDF, HashingTF
from pyspark.sql import functions as F

from featureflow.operators import lookup, text
from featureflow.plans import queries_text  # noqa: F401
from featureflow.plans.registry import QUERIES
from tests.conftest import rows


def corpus(spark):
    items = [(0, "The cat  sat "), (1, "the\tdog"), (2, ""), (3, "   "), (4, " Été the the")]
    return spark.createDataFrame(items, "doc_id bigint, text string")


def test_tokens(spark):
    words = {r["doc_id"]: r["words"] for r in text.tokens(corpus(spark)).collect()}
    assert words[0] == ["the", "cat", "", "sat"]
    assert words[1] == ["the", "dog"]
    assert words[2] == [""]
    assert words[3] == []
    assert words[4] == ["", "été", "the", "the"]


def test_counts_and_weights(spark):
    df = corpus(spark)
    counts = text.term_counts(df, "doc_id")
    assert (4, "the", 2) in rows(counts)
    idf = {r["term"]: (r["df"], r["idf"]) for r in text.idf_table(df).collect()}
    assert idf["the"] == (3, pytest.approx(math.log(6 / 4)))
    assert idf[""][0] == 3
    assert idf["dog"][1] == pytest.approx(math.log(6 / 2))


def test_tfidf_both_ways(spark, monkeypatch):
    """Broadcast, and the spread join with a word in every document."""
    df = spark.range(3_000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("the the w"), F.col("id") % 700).alias("text")
    )
    counts, idf = text.term_counts(df, "doc_id"), text.idf_table(df)
    small = rows(text.tfidf(counts, idf, "doc_id"))
    real_pin = lookup.pin
    monkeypatch.setattr(text, "pin", lambda frame: real_pin(frame, rows=10))
    assert rows(text.tfidf(counts, idf, "doc_id")) == small
    assert rows(text.idf_of_counts(counts, df)) == rows(idf)
    assert len(small) == 6_000


def test_large_texts_are_dealt_by_key_alone(spark, monkeypatch):
    """Pairs of key and word are never shuffled, whatever the input's size; repeated keys count as one document."""
    monkeypatch.setattr("featureflow.session.CORE_BYTES", 1)
    df = spark.createDataFrame([(1, "a b a"), (1, "a"), (2, "b"), (None, "c c")], "doc_id bigint, text string")
    counts = text.term_counts(df.repartition(3), "doc_id")
    assert rows(counts) == [(None, "c", 2), (1, "a", 3), (1, "b", 1), (2, "b", 1)]
    plan = counts._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert dealt and not any("term" in line for line in dealt)


def test_rows_of_frequent_terms_stay_where_they_are(spark, monkeypatch):
    df = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("the a w"), F.col("id") % 90).alias("text"))
    counts, idf = text.term_counts(df, "doc_id"), text.idf_table(df)
    whole = rows(text.tfidf(counts, idf, "doc_id"))
    real_pin = lookup.pin
    monkeypatch.setattr(text, "pin", lambda frame: real_pin(frame, rows=10))
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 10)
    split = text.tfidf(counts, idf, "doc_id")
    assert rows(split) == whole and len(whole) == 1_200
    assert "LeftAnti" in split._jdf.queryExecution().executedPlan().toString()


def test_bucket_check_makes_no_entry_per_empty_bucket(spark, tmp_path):
    rows_in = [(1, "a b a"), (2, "c"), (3, "   "), (4, "A  b")]
    df = spark.createDataFrame(rows_in, "doc_id bigint, text string").selectExpr("*", "'en' AS lang", "'s' AS source", "1L AS n_chars")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["hashed_tf_buckets"](spark, str(tmp_path))
    assert rows(found) == [(1, True, True), (2, True, True), (4, True, True)]  # no word, no bucket
    assert "posexplode" not in found._jdf.queryExecution().executedPlan().toString()


def test_idf_equals_the_stage(spark):
    """With a bucket per word, the weights are those of Spark ML's IDF."""
    df = spark.createDataFrame([(0, "a b b"), (1, "b c"), (2, "c c")], "doc_id bigint, text string")
    hashed = HashingTF(inputCol="words", outputCol="tf", numFeatures=1 << 18).transform(text.tokens(df))
    stage = IDF(inputCol="tf", outputCol="w").fit(hashed)
    want = sorted(round(v, 9) for v in stage.idf.toArray() if v < math.log(4) - 1e-9)
    found = sorted(round(r["idf"], 9) for r in text.idf_table(df).collect())
    assert found == want


def test_parameters_of_the_classifier():
    *_, model = text.text_classifier().getStages()
    assert model.getMaxIter() == 10 and model.getRegParam() == 0.001
    assert text.hashed_features()[1].getNumFeatures() == 1000


def test_a_null_text_has_no_words(spark):
    df = spark.createDataFrame([(1, None), (2, "a b")], "doc_id bigint, text string")
    assert rows(text.tokens(df).select("doc_id", F.size("words"))) == [(1, 0), (2, 2)]
    assert text.term_counts(df, "doc_id").count() == 2
