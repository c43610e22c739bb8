"""The indexer whose fitted state is a table."""

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from featureflow.operators import lookup
from featureflow.operators.indexing import TableIndexer, TableIndexerModel
from featureflow.operators.models import categorical_pipeline, classifier
from featureflow.plans.passengers import FLOWS, flow_pipeline
from featureflow.sources.files import load_model, load_pipeline, save_pipeline
from tests.conftest import SPARK_ERRORS, rows

LABELS = ["b", "a", "b", None, "c", "a", "é", "Z", "b", "", "c"]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([(i, s, f"u{i}") for i, s in enumerate(LABELS)], "id int, s string, u string").repartition(3)


def fitted(df, invalid="keep"):
    return TableIndexer(inputCols=["s", "u"], outputCols=["i", "j"], handleInvalid=invalid).fit(df)


@pytest.mark.parametrize("small", [True, False])
def test_numbers_are_those_of_the_own_indexer(df, monkeypatch, small):
    if not small:
        monkeypatch.setattr(lookup.pin, "__defaults__", (0, 0))
        monkeypatch.setattr(lookup, "BROADCAST_BYTES", 0)
    own = StringIndexer(inputCols=["s", "u"], outputCols=["i", "j"], handleInvalid="keep").fit(df)
    assert rows(fitted(df).transform(df).select("id", "s", "u", "i", "j")) == rows(own.transform(df).select("id", "s", "u", "i", "j"))


def test_unseen_labels(spark, df):
    odd = spark.createDataFrame([(1, "b", "u1"), (2, "new", "u1"), (3, None, "u1")], "id int, s string, u string")
    assert rows(fitted(df, "keep").transform(odd).select("id", "i")) == [(1, 0.0), (2, 6.0), (3, 6.0)]
    assert rows(fitted(df, "skip").transform(odd).select("id", "i")) == [(1, 0.0)]
    with pytest.raises(SPARK_ERRORS, match="Unseen label in s"):
        fitted(df, "error").transform(odd).collect()
    with pytest.raises(ValueError):
        fitted(df, "drop")


def test_nothing_to_number(df):
    model = fitted(df.where("false"))
    assert model.getOrDefault("sizes") == [0, 0]
    assert {r.i for r in model.transform(df).collect()} == {0.0}


def test_no_label_reaches_the_driver(df):
    """Neither the model's parameters nor the column's metadata hold a label; the state is a folder."""
    model = fitted(df)
    held = str({p.name: v for p, v in model.extractParamMap().items()}) + str(model.transform(df).schema["j"].metadata)
    assert "u1" not in held and "u10" not in held
    assert model.transform(df).schema["j"].metadata["ml_attr"]["num_vals"] == len(LABELS) + 1
    assert model.labels(df.sparkSession, 1).count() == len(LABELS)


def test_a_unique_column_fits(spark):
    many = spark.range(20_000).select(F.col("id"), F.md5(F.col("id").cast("string")).alias("code"))
    pipeline = Pipeline(stages=[TableIndexer(inputCols=["code"], outputCols=["n"]), VectorAssembler(inputCols=["n"], outputCol="v")])
    scored = pipeline.fit(many).transform(many)
    found = scored.agg(F.count_distinct("n"), F.min("n"), F.max(vector_to_array("v")[0])).first()
    assert tuple(found) == (20_000, 0.0, 19_999.0)
    # All labels occur once, so their order is that of the labels.
    assert scored.orderBy("n").first()["code"] == many.agg(F.min("code")).first()[0]


def test_a_saved_pipeline_carries_its_tables(df, tmp_path):
    pipeline = Pipeline(stages=[TableIndexer(inputCols=["s"], outputCols=["i"], handleInvalid="keep"), VectorAssembler(inputCols=["i"], outputCol="v")])
    model = pipeline.fit(df)
    before = rows(model.transform(df).select("id", "i"))
    for _ in range(2):  # an existing one is replaced
        save_pipeline(pipeline, str(tmp_path / "plain"))
        save_pipeline(model, str(tmp_path / "model"))
    loaded = load_model(str(tmp_path / "model"))
    assert isinstance(loaded, PipelineModel) and isinstance(loaded.stages[0], TableIndexerModel)
    assert loaded.stages[0].getOrDefault("tables") == [f"{tmp_path}/model/stages/0_{model.stages[0].uid}/labels/0"]
    assert loaded.stages[0].uid == model.stages[0].uid and loaded.stages[0].getHandleInvalid() == "keep"
    assert rows(loaded.transform(df).select("id", "i")) == before
    again = load_pipeline(str(tmp_path / "plain"))
    assert rows(again.fit(df).transform(df).select("id", "i")) == before


def test_wide_columns_make_the_same_features(spark):
    i = F.col("id")
    df = spark.range(200).select(i, F.concat(F.lit("k"), (i % 7).cast("string")).alias("a"), F.concat(F.lit("m"), (i % 5).cast("string")).alias("b"), (i % 3 == 0).cast("int").alias("label"))
    features = []
    for wide in ((), ("a",), ("a", "b")):
        pipeline = categorical_pipeline(classifier("tree", "label"), "label", strings=("a", "b"), wide=wide)
        model = pipeline.fit(df.where("id < 150"))
        odd = df.withColumn("a", F.when(i == 190, F.lit("new")).otherwise(F.col("a")))
        features.append(rows(model.transform(odd).select("id", vector_to_array("features"), "prediction")))
    assert features[0] == features[1] == features[2]


def test_flows_with_raw_cabins_number_them_by_a_table():
    kinds = {name: [type(s).__name__ for s in flow_pipeline(flow).getStages()] for name, flow in FLOWS.items() if flow.record == "plain"}
    assert kinds and all("TableIndexer" in k for k in kinds.values())
