"""From raw documents to packed training sequences: five stages, each written and read again.

``run(spark, sf_dir)`` takes ``documents`` of ``sf_dir`` through ``STAGES``. Every stage but the last one
returns the columns of ``documents``, and works on all that the stage before has kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.llm import minhash, mixing, packing, rules, suffixes
from featureflow.llm.ship import bound_batches, ship
from featureflow.plans import registry
from featureflow.session import written_table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

# The decision list is learned, which SQL cannot state; tests hold every stage against brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learned decision list reject."""
    ship(spark)
    bound_batches(spark)
    return rules.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: five-word shingles, similarity of 0.8 or more."""
    ship(spark)
    bound_batches(spark)
    return minhash.without_near_duplicates(docs, n=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the later copies of passages of 50 words or more."""
    ship(spark)
    bound_batches(spark)
    return suffixes.without_repeats(docs, least=50)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to weights 5, 2, 1 takes them, at most three times."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of at most 2048 tokens."""
    ship(spark)
    bound_batches(spark)
    pieces = packing.token_pieces(docs, TOKENIZER, 2048, end_id=0)
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


STAGES = [
    ("quality_rules", quality),
    ("minhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("source_mixing", mixed),
    ("best_fit_packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written_table(stage(spark, docs, sf_dir), name)
    return docs


registry.query(ORACLE_SQL, name="pipeline")(run)
