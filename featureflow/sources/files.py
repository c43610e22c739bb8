"""Readers and writers."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from featureflow.session import written_table


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str | StructType | None = None,
    header: bool = True,
    escape: str = '"',
    **options,
) -> DataFrame:
    """CSV with a given schema, or with types inferred by an extra pass over the file.

    Doubled quotes inside quoted fields are read as one quote; ``escape="\\\\"`` gives Spark's
    default instead. Give a schema for large inputs: inference reads them twice.

    A header that does not name the schema's columns in their order raises, as does a cell that is not
    of its column's type; ``mode="PERMISSIVE"`` makes such a cell null.
    """
    checks = {"enforceSchema": False} if header and schema is not None else {}
    reader = spark.read.options(**{"header": header, "escape": escape, "mode": "FAILFAST", **checks, **options})
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_csv_set_aside(
    spark: SparkSession, path: str, schema: str | StructType, header: bool = True, escape: str = '"', **options
) -> tuple[DataFrame, DataFrame]:
    """(good rows, set-aside lines) of CSV files that may hold bad cells.

    A row goes on if it has the schema's number of cells and every cell is of its column's type. The others are set
    aside as (file, line), the line as it stands in the file, and none is lost or half read. The files are parsed once:
    both frames read what that pass has written, and what the caller keeps or counts of either has no say in it.
    """
    bad, kind = "_set_aside", schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    if bad in kind.names:
        raise ValueError(f"{bad!r} is taken")
    checks = {"enforceSchema": False} if header else {}
    marked = StructType([*(StructField(f.name, f.dataType, True) for f in kind.fields), StructField(bad, StringType(), True)])
    reader = spark.read.options(**{"header": header, "escape": escape, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad, **checks, **options})
    # All columns are parsed, so that a bad cell shows whichever column it is in.
    rows = reader.option("columnPruning", False).schema(marked).csv(path)
    parsed = written_table(rows.select("*", F.col("_metadata.file_path").alias("_file")), "parsed")
    return parsed.where(F.col(bad).isNull()).select(*kind.names), parsed.where(F.col(bad).isNotNull()).select(F.col("_file").alias("file"), F.col(bad).alias("line"))


def write_csv(df: DataFrame, path: str, header: bool = False, mode: str = "error", **options) -> None:
    """A directory of CSV files; fails if it exists unless ``mode`` says otherwise."""
    df.write.mode(mode).options(header=header, escape='"', **options).csv(path)


def write_predictions(df: DataFrame, path: str, key: str, mode: str = "error") -> None:
    """Key and prediction of scored rows as CSV without header."""
    write_csv(df.select(key, "prediction"), path, mode=mode)


def read_libsvm(spark: SparkSession, path: str, features: int) -> DataFrame:
    """(label, features) from libsvm text; the feature count is given, not searched for."""
    return spark.read.format("libsvm").option("numFeatures", features).load(path)


def write_libsvm(df: DataFrame, path: str, mode: str = "error") -> None:
    """(label double, features vector) as libsvm text."""
    df.select("label", "features").write.format("libsvm").mode(mode).save(path)


def save_pipeline(pipeline: Pipeline | PipelineModel, path: str) -> None:
    """Save an unfitted pipeline or a fitted model; an existing one is replaced."""
    pipeline.write().overwrite().save(path)


def load_pipeline(path: str) -> Pipeline:
    """An unfitted pipeline."""
    return Pipeline.load(path)


def load_model(path: str) -> PipelineModel:
    """A fitted pipeline."""
    return PipelineModel.load(path)


def stage_parameters(spark: SparkSession, path: str) -> DataFrame:
    """(stage, class, uid, parameter, value, is_default): one row per parameter of the stages of a saved pipeline.

    Read from the metadata files alone, so it shows what is stored, whatever version would load it. Values are JSON
    text; a parameter that is set has no row for its default.
    """
    kind = "class string, uid string, paramMap map<string,string>, defaultParamMap map<string,string>"
    lines = spark.read.text(f"{path}/stages/*/metadata").select(F.col("_metadata.file_path").alias("file"), F.from_json("value", kind).alias("m"))
    stages = lines.select(F.regexp_extract("file", r"/stages/0*(\d+)_[^/]*/metadata/", 1).cast("int").alias("stage"), "m.*")
    of_kind = lambda name, default: stages.select("stage", "class", "uid", "paramMap", F.explode(name).alias("parameter", "value"), F.lit(default).alias("is_default"))
    both = of_kind("paramMap", False).unionByName(of_kind("defaultParamMap", True))
    shown = both.where(~F.col("is_default") | ~F.coalesce(F.map_contains_key("paramMap", F.col("parameter")), F.lit(False)))
    return shown.drop("paramMap")


def register_view(df: DataFrame, name: str) -> str:
    """Make ``df`` available to ``spark.sql`` under ``name``."""
    df.createOrReplaceTempView(name)
    return name
