"""The registered corpus queries against their SQL, and the pipeline against brute force, stage by stage."""

import os
from collections import Counter

import duckdb
import pytest
from tests.conftest import SF_DIR, SMALL_SF_DIR
from tests.llm.test_operators import WORD, plain_classes, plain_counts, plain_states
from tests.oracle import compare

import corpus_pipeline
import featureflow.llm.queries  # noqa: F401
from featureflow.llm import mixing, rules
from featureflow.plans.registry import ORACLES, QUERIES
from featureflow.session import written_table

OPERATORS = [q for q in QUERIES if q.startswith("op")]


def table(name, sf_dir=SF_DIR):
    path = f"{sf_dir}/{name}.parquet"
    return f"'{path}/*.parquet'" if os.path.isdir(path) else f"'{path}'"


@pytest.mark.parametrize("name", [q for q in OPERATORS if q in ORACLES])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM {table(t)}")
    count, problems = compare(QUERIES[name](spark, SF_DIR), con, ORACLES[name])
    assert not problems
    assert count > 0


def test_one_query_per_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in OPERATORS) == list(range(1, 14))
    assert "pipeline" in QUERIES


def test_every_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL_SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL_SF_DIR}/labels.parquet")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(written_table(stage(spark, seen[-1], SMALL_SF_DIR), name))
    raw, good, single, cut, mixed, packed = seen
    for df in (good, single, cut, mixed):
        assert df.columns == docs.columns

    learned = rules.fit_rules(docs, labels)
    rejected = {r.doc_id for r in rules.judge(docs, labels).where("rule is not null and not base_failed").collect()}
    texts = {r.doc_id: r.text for r in raw.collect()}
    base = {i for i, t in texts.items() if (c := plain_counts(t))[0] < 20 or 100 * c[4] > 30 * c[0]}
    assert bool(learned) or not rejected
    kept = {r.doc_id: r.text for r in good.collect()}
    assert kept == {i: t for i, t in texts.items() if i not in base | rejected}

    classes = plain_classes(kept, 5, 80)
    left = {r.doc_id: r.text for r in single.collect()}
    assert left == {i: t for i, t in kept.items() if classes[i][1] == i}

    words, states = plain_states(left, 50)
    shorter = {r.doc_id: r for r in cut.collect()}
    for i, t in left.items():
        stay = [w for w, s in zip(WORD.findall(t), states[i], strict=True) if s < 2]
        assert WORD.findall(shorter[i].text) == stay if stay else i not in shorter
        if i in shorter and len(stay) == len(words[i]):
            assert shorter[i].text == t
        if i in shorter:
            assert shorter[i].n_chars == len(shorter[i].text)

    copies = {r.doc_id: r.copies for r in mixing.mix(cut).collect()}
    times = Counter(r.doc_id for r in mixed.collect())
    assert times == Counter({i: n for i, n in copies.items() if n})

    pieces = Counter((r.doc_id, r.piece) for r in packed.collect())
    assert {i for i, _ in pieces} == set(times)
    assert all(n == times[i] for (i, _), n in pieces.items())
    filled = packed.groupBy("sequence_id").sum("length").toPandas()["sum(length)"]
    assert filled.max() <= 2048
