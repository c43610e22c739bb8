"""Faulty cells set aside, parameters of saved pipelines."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import Tokenizer
from pyspark.sql import functions as F

from featureflow.operators.text import text_classifier
from featureflow.sources.files import read_csv_set_aside, save_pipeline, stage_parameters
from tests.conftest import SPARK_ERRORS, rows

LINES = ["id,name,x", '1,"a, b",1.5', "two,b,2.5", "3,c,", "4,d,n/a", "5,e", "6,f,1,2", '7,"say ""hi""",7', ",h,8", ""]


@pytest.mark.parametrize("header", [True, False])
def test_faulty_lines_are_set_aside(spark, tmp_path, header):
    path = tmp_path / "in"
    path.mkdir()
    for i in range(2):
        (path / f"f{i}.csv").write_text("\n".join(LINES if header else LINES[1:]))
    good, aside = read_csv_set_aside(spark, str(path), "id int, name string, x double", header=header)
    assert rows(good) == sorted([(None, "h", 8.0), (1, "a, b", 1.5), (3, "c", None), (7, 'say "hi"', 7.0)] * 2, key=lambda r: (r[0] is not None, r[0] or 0))
    assert sorted(r.line for r in aside.collect()) == sorted(["two,b,2.5", "4,d,n/a", "5,e", "6,f,1,2"] * 2)
    assert {r.file.rsplit("/", 1)[1] for r in aside.collect()} == {"f0.csv", "f1.csv"}
    # A fault shows though its column is not asked for, and nothing is parsed again.
    assert good.select("name").count() == 8 and aside.count() == 8


def test_files_without_faults_or_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,x\n")
    (tmp_path / "b.csv").write_text("id,name\n")
    good, aside = read_csv_set_aside(spark, str(tmp_path), "id int, name string")
    assert (good.count(), aside.count(), good.columns) == (1, 0, ["id", "name"])
    with pytest.raises(ValueError):
        read_csv_set_aside(spark, str(tmp_path), "id int, _set_aside string")
    (tmp_path / "c.csv").write_text("name,id\nx,1\n")
    with pytest.raises(SPARK_ERRORS):
        read_csv_set_aside(spark, str(tmp_path), "id int, name string")


def test_parameters_of_a_saved_pipeline(spark, tmp_path):
    path = str(tmp_path / "p")
    save_pipeline(text_classifier(), path)
    found = stage_parameters(spark, path)
    assert found.select("stage").distinct().count() == 4
    assert found.where("parameter = 'tol'").select("stage", "value", "is_default").first() == (3, "1.0E-6", True)
    # A set parameter has one row.
    assert found.groupBy("stage", "parameter").count().where("count > 1").count() == 0
    assert found.where("parameter = 'numFeatures'").select("value", "is_default").first() == ("1000", False)
    many = str(tmp_path / "many")
    save_pipeline(Pipeline(stages=[Tokenizer(inputCol=f"i{k}", outputCol=f"o{k}") for k in range(12)]), many)
    named = stage_parameters(spark, many).where("parameter = 'inputCol'").select("stage", F.regexp_replace("value", "i", "").cast("int"))
    assert rows(named) == [(k, k) for k in range(12)]
