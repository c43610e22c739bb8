"""Compiled models, stored sketches, SQL functions and relational hashing on small tables with awkward rows."""

import math

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import MinMaxScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from featureflow.functions.derive import age_band, fare_band, title_of
from featureflow.functions.sql import register
from featureflow.operators import lookup
from featureflow.operators.aggregate import register_middle
from featureflow.operators.compiled import compile_pipeline
from featureflow.operators.models import categorical_pipeline, classifier
from featureflow.operators.sketches import merged, quantile, rank_bound, rank_of, sketches, store_part, stored
from featureflow.operators.text import hashed_counts, hashed_features, sparse_vectors, term_buckets, term_counts
from featureflow.session import written_table
from tests.conftest import SPARK_ERRORS, rows

# --- compiled models ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def records(spark):
    i = F.col("id")
    label = F.pmod(F.xxhash64("id"), F.lit(5)) < F.when(i % 4 == 0, 4).otherwise(1)
    return spark.range(400).select(
        i, F.concat(F.lit("k"), (i % 4).cast("string")).alias("kind"), F.concat(F.lit("w"), (i % 30).cast("string")).alias("wide"),
        (i % 3).cast("int").alias("code"), (i % 17 / 3.0).alias("x"), label.cast("int").alias("label"),
    )


@pytest.mark.parametrize("kind", ["tree", "forest", "boosted"])
@pytest.mark.parametrize(("keep", "drop_last"), [(True, True), (True, False), (False, True)])
def test_scores_are_the_models(spark, records, kind, keep, drop_last):
    params = {"maxIter": 3} if kind == "boosted" else {"numTrees": 5} if kind == "forest" else {}
    pipeline = categorical_pipeline(
        classifier(kind, "label", **params), "label", strings=("kind", "wide"), codes=("code",), numbers=("x",), keep=keep, drop_last=drop_last, wide=("wide",)
    )
    model = pipeline.fit(records)
    scored = records
    if keep:  # categories and codes that the model has not seen
        new = records.limit(3).withColumns({"kind": F.lit("new"), "wide": F.lit(None).cast("string"), "code": F.lit(9), "id": F.col("id") + 1000})
        scored = records.unionByName(new)
    compiled = compile_pipeline(spark, model).score(scored)
    assert compiled.columns == [*records.columns, "prediction", "probability"]
    got = {r.id: (r.prediction, r.probability) for r in compiled.collect()}
    want = {r.id: (r.prediction, r.p) for r in model.transform(scored).withColumn("p", vector_to_array("probability")).collect()}
    assert got.keys() == want.keys() and len({p for p, _ in got.values()}) == 2
    for i, (prediction, probability) in got.items():
        assert prediction == want[i][0]
        assert probability == (pytest.approx(want[i][1], abs=1e-12) if kind == "boosted" else want[i][1])


def test_the_plan_has_no_stage_of_the_library(spark, records):
    model = categorical_pipeline(classifier("forest", "label", numTrees=3), "label", strings=("kind",), numbers=("x",)).fit(records)
    compiled = compile_pipeline(spark, model).score(records)
    assert "UDF" not in compiled._jdf.queryExecution().optimizedPlan().toString()
    assert "UDF" in model.transform(records)._jdf.queryExecution().optimizedPlan().toString()


def test_what_the_pipeline_refuses_is_refused(spark, records):
    strict = categorical_pipeline(classifier("tree", "label"), "label", strings=("kind",), numbers=("x",), keep=False)
    compiled = compile_pipeline(spark, strict.fit(records))
    for bad in (records.withColumn("kind", F.lit("new")), records.withColumn("kind", F.lit(None).cast("string")), records.withColumn("x", F.lit(None).cast("double"))):
        with pytest.raises(SPARK_ERRORS, match="invalid value"):
            compiled.score(bad).collect()
    scaled = Pipeline(stages=[*strict.getStages()[:-1], MinMaxScaler(inputCol="features", outputCol="s"), classifier("tree", "label")]).fit(records)
    with pytest.raises(TypeError, match="MinMaxScaler"):
        compile_pipeline(spark, scaled)
    with pytest.raises(TypeError, match="no tree"):
        compile_pipeline(spark, categorical_pipeline(classifier("logistic", "label"), "label", numbers=("x",)).fit(records))


def test_a_tree_that_is_one_leaf(spark, records):
    same = records.withColumn("label", F.lit(1))
    model = categorical_pipeline(classifier("tree", "label"), "label", numbers=("x",)).fit(same)
    assert {(r.prediction, tuple(r.probability)) for r in compile_pipeline(spark, model).score(same).collect()} == {(1.0, (0.0, 1.0))}


# --- stored sketches ----------------------------------------------------------------------------------


def test_merged_medians_stay_within_the_bound(spark, tmp_path):
    path, by = str(tmp_path / "sketches"), ["g"]
    parts = {f"d{p}": spark.range(p * 20_000, (p + 1) * 20_000).select((F.col("id") % 3).alias("g"), (F.xxhash64("id") / 1e15).alias("v")) for p in range(4)}
    for name, part in parts.items():
        store_part(part, path, name, "v", by)
    store_part(parts["d1"], path, "d1", "v", by)  # again: replaces, does not add
    found = merged(stored(spark, path), by).select("g", "n", quantile().alias("m"), rank_of(0.0).alias("r")).collect()
    values = {g: np.sort([r.v for p in parts.values() for r in p.where(f"g = {g}").collect()]) for g in range(3)}
    assert {r.g: r.n for r in found} == {g: len(v) for g, v in values.items()}
    for r in found:
        assert abs(np.searchsorted(values[r.g], r.m) / r.n - 0.5) <= rank_bound()
        assert r.r == pytest.approx(np.searchsorted(values[r.g], 0.0) / r.n, abs=rank_bound())
    # Merging in steps reads what merging gave.
    halves = [merged(stored(spark, path).where(F.col("part").isin(*p)), by) for p in (["d0", "d1"], ["d2", "d3"])]
    again = merged(halves[0].unionByName(halves[1]), by).select("g", "n", quantile().alias("m")).collect()
    assert {r.g: r.n for r in again} == {g: len(v) for g, v in values.items()}
    assert all(abs(np.searchsorted(values[r.g], r.m) / r.n - 0.5) <= rank_bound() for r in again)


def test_sketches_of_little(spark):
    df = spark.createDataFrame([("a", None), ("a", float("nan")), ("b", 5.0), ("b", None), ("c", 1.0), ("c", 2.0), ("c", 3.0), (None, 7.0)], "k string, v double")
    found = merged(sketches(df, "v", ["k"]), ["k"]).select("k", "n", quantile())
    assert rows(found) == [(None, 1, 7.0), ("a", 0, None), ("b", 1, 5.0), ("c", 3, 2.0)]
    assert rows(merged(sketches(df.where("false"), "v", ["k"]), ["k"]).select("k")) == []
    assert rows(merged(sketches(df, "v")).select("n", quantile(0.0), quantile(1.0))) == [(5, 1.0, 7.0)]


# --- SQL functions ------------------------------------------------------------------------------------


def test_functions_by_name_are_the_expressions(spark):
    register(spark)
    names = ["Ashby, Mr. A", "Colvin, Miss. B", "x, the Countess. of", "O'Dr\\oss", "", None, "Master Mr", "lady", "Lady"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    df.createOrReplaceTempView("ff_test_names")
    assert rows(spark.sql("SELECT name, title_group(name) FROM ff_test_names")) == rows(df.select("name", title_of("name")))
    edges = [None, float("nan"), -1.0, 0.0, 0.5, 7.99, 8.0, 10.5, 11.0, 20.5, 21.0, 31.99, 32.0, 70.9, 71.0, 200.0]
    df = spark.createDataFrame([(x,) for x in edges], "x double")
    df.createOrReplaceTempView("ff_test_edges")
    found = rows(spark.sql("SELECT CAST(x AS STRING), age_band(x), fare_band(x) FROM ff_test_edges"))
    assert found == rows(df.select(F.col("x").cast("string"), age_band("x"), fare_band("x")))


@pytest.mark.parametrize("tallies", [[], [(1.0, 1)], [(2.0, 1), (1.0, 1)], [(3.0, 5), (1.0, 2), (2.0, 2)], [(1.0, 0), (None, 4), (9.0, 2)], [(1.0, 10**12), (5.0, 10**12)], [(-1.0, 1), (-2.0, 2), (0.5, 1)]])
def test_middle_by_name(spark, tallies):
    register(spark)
    df = spark.createDataFrame([(tallies,)], "t array<struct<value: double, count: bigint>>")
    df.createOrReplaceTempView("ff_test_tallies")
    values = sorted(v for v, n in tallies if v is not None for _ in range(min(n, 100)))
    want = float(np.median(values)) if values else None
    assert spark.sql("SELECT middle(t) FROM ff_test_tallies").first()[0] == want


def test_functions_replace_others_of_their_names(spark):
    """A session may hold Python functions of these names, or the aggregate over tallies; neither is in the way."""
    assert register_middle(spark) != "middle"
    spark.udf.register("middle", lambda x: x, "double")
    spark.udf.register("age_band", lambda x: x, "int")
    for _ in range(2):
        register(spark)
        assert spark.sql("SELECT middle(array(named_struct('value', 3D, 'count', 1L))), age_band(3D)").first()[0] == 3.0
    register_middle(spark, "middle")
    register(spark)
    assert spark.sql("SELECT middle(array(named_struct('value', 3D, 'count', 1L)))").first()[0] == 3.0


def test_functions_leave_nothing_but_sql(spark):
    names = register(spark, "ff_")
    assert names == ["ff_title_group", "ff_age_band", "ff_fare_band", "ff_middle", "ff_title_keywords"]
    plan = spark.sql("SELECT ff_title_group(CAST(id AS STRING)), ff_age_band(CAST(id AS DOUBLE)) FROM range(5)")
    text = plan._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "python" not in text and "udf" not in text and "contains" in text


# --- hashed terms -------------------------------------------------------------------------------------


@pytest.mark.parametrize("broadcast_rows", [lookup.BROADCAST_ROWS, 0])
def test_buckets_and_counts_are_the_stages(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(lookup.pin, "__defaults__", (broadcast_rows, lookup.BROADCAST_BYTES))
    texts = ["a b b c", "", " x ", "é ü a a a", "word " * 50 + "other", "Ab aB", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for buckets in (7, 1 << 18):
        counts = written_table(term_counts(df, "doc_id"), "counts")
        got = {r.doc_id: dict(zip(r.indices, r["values"], strict=True)) for r in sparse_vectors(hashed_counts(counts, "doc_id", buckets), "doc_id", "tf").collect()}
        stage = Pipeline(stages=hashed_features(buckets=buckets)[:2]).fit(df).transform(df.where("text is not null")).collect()
        want = {r.doc_id: {int(i): int(v) for i, v in zip(r.rawFeatures.indices, r.rawFeatures.values, strict=True)} for r in stage}
        assert got == {k: v for k, v in want.items() if v}
    table = spark.createDataFrame([("a",), ("",), ("é",)], "term string")
    assert term_buckets(table, 1 << 18).where("bucket is null").count() == 0
    assert math.isfinite(rank_bound(8))
