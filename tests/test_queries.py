"""Every registered query: equal to its SQL where there is one, else the expected rows."""

import re

import pytest

import __spark_entry__ as entry_point
from featureflow.operators.lookup import find_hot
from featureflow.plans import passengers
from tests.conftest import SF_DIR, SMALL_SF_DIR
from tests.oracle import compare, duck

# The corpus queries, where present, have tests of their own.
QUERIES, ORACLES = (
    {k: v for k, v in found.items() if not re.match(r"op\d+_|pipeline$", k)}
    for found in (entry_point.queries(), entry_point.oracle_sql())
)


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, connection, name):
    count, problems = compare(QUERIES[name](spark, SF_DIR), connection, ORACLES[name])
    assert not problems
    assert count > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    df = QUERIES[name](spark, SMALL_SF_DIR)
    scored = spark.read.parquet(f"{SMALL_SF_DIR}/orders.parquet").count()
    found = df.toPandas()
    assert len(found) > 0
    assert not found.isna().any().any()
    if "passenger_id" in found and not name.startswith("model_points"):
        # Every order from the cutoff on is scored once.
        cutoff = (scored - 1) * 2 // 3
        assert sorted(found["passenger_id"]) == list(range(cutoff, scored))
    if name == "split_random":
        assert found["o_orderkey"].is_unique and len(found) == scored


REPARTITIONED = (
    "agg_group_median", "split_hash", "string_index_table", "auc_pr_score", "tfidf_terms", "impute_group_median",
)


@pytest.mark.parametrize("name", REPARTITIONED)
def test_partition_count_does_not_matter(spark, connection, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        _, problems = compare(QUERIES[name](spark, SF_DIR), connection, ORACLES[name])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert not problems


@pytest.mark.parametrize("name", ["feature_record_banded", "string_index_table"])
def test_large_dimension(spark, connection, monkeypatch, name):
    """Customers too large to broadcast, with hot customer keys spread over the tasks."""
    monkeypatch.setattr("featureflow.operators.lookup.BROADCAST_BYTES", 0)
    monkeypatch.setattr("featureflow.operators.lookup.find_hot", lambda df, keys: find_hot(df, keys, share=1_200))
    _, problems = compare(QUERIES[name](spark, SF_DIR), connection, ORACLES[name])
    assert not problems


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


SEARCHES = {"cv_dt": "tree", "cv_rf": "forest", "cv_rf_union": "forest_union", "cv_gbt": "boosted", "cv_lr": "logistic", "cv_svc": "svm"}


@pytest.mark.parametrize("name", sorted(SEARCHES))
def test_searches_run_the_whole_grid_and_the_whole_model(spark, monkeypatch, name):
    """The search of a registered query gets every combination and fold, and a model with its defaults."""
    seen = {}

    def search(pipeline, grid, rows, label, key, **rest):
        seen.update(rest, model=pipeline.getStages()[-1], grid=grid)
        raise StopIteration

    monkeypatch.setattr(passengers, "grid_search", search)
    with pytest.raises(StopIteration):
        QUERIES[name](spark, SMALL_SF_DIR)
    flow = passengers.FLOWS[SEARCHES[name]]
    assert (seen["grid"], seen["folds"]) == (flow.grid, flow.folds)
    default = passengers.flow_pipeline(flow).getStages()[-1]
    assert {p.name: v for p, v in seen["model"].extractParamMap().items()} == {p.name: v for p, v in default.extractParamMap().items()}
