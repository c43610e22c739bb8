"""Categories to numbers to vectors.

The Spark ML stages keep the label list of a column on the driver and its one-hot width in every
vector, so they suit categories. ``label_index`` / ``apply_index`` give the same numbers for
columns with any number of labels, as a table and a join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import StringType

from featureflow.operators.lookup import attach_pinned, pin
from featureflow.operators.order import running_totals


def indexer(columns: Sequence[str], keep: bool = True, suffix: str = "Index") -> StringIndexer:
    """Labels to 0.. by falling frequency, ties by label. Unseen: one number more, or an error."""
    return StringIndexer(
        inputCols=list(columns),
        outputCols=[f"{c}{suffix}" for c in columns],
        handleInvalid="keep" if keep else "error",
    )


def one_hot(
    columns: Sequence[str], keep: bool = True, drop_last: bool = True, outputs: Sequence[str] | None = None
) -> OneHotEncoder:
    """One-hot vectors of index or small integer code columns."""
    return OneHotEncoder(
        inputCols=list(columns),
        outputCols=list(outputs or [f"{c}Encoded" for c in columns]),
        dropLast=drop_last,
        handleInvalid="keep" if keep else "error",
    )


def assembler(
    columns: Sequence[str], label: str | None = None, keep: bool = False, output: str = "features"
) -> VectorAssembler:
    """Columns to one vector. Refuses the label among the features.

    ``keep=False`` fails on null and NaN, which no model should be trained on; ``keep=True`` turns
    null into NaN.
    """
    if label is not None and label.lower() in {c.lower() for c in columns}:
        raise ValueError(f"the label {label!r} is among the features")
    return VectorAssembler(
        inputCols=list(columns), outputCol=output, handleInvalid="keep" if keep else "error"
    )


def string_columns(df: DataFrame) -> list[str]:
    """Names of the string columns, from the schema alone."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def encode_strings(columns: Sequence[str]) -> Pipeline:
    """Index and one-hot encode columns: ``c`` -> ``c_idx`` -> ``c_enc``."""
    indexes = indexer(columns, keep=True, suffix="_idx")
    vectors = one_hot(
        [f"{c}_idx" for c in columns], keep=False, outputs=[f"{c}_enc" for c in columns]
    )
    return Pipeline(stages=[indexes, vectors])


def label_index(df: DataFrame, column: str) -> DataFrame:
    """Table (column, label_index): the numbers ``indexer`` gives, for any number of labels.

    Counting combines map-side; the numbering of more labels than may be broadcast runs over range partitions.
    """
    counts, small = pin(df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("__n")))
    order = [F.col("__n").desc(), F.col(column).asc()]
    if small:
        return counts.select(column, (F.row_number().over(W.orderBy(*order)) - 1).cast("bigint").alias("label_index"))
    numbered = running_totals(counts, order, {"__row": F.lit(1).cast("bigint")})
    return numbered.select(column, (F.col("__row") - 1).alias("label_index"))


def apply_index(
    df: DataFrame,
    index: DataFrame,
    column: str,
    out: str,
    keep: bool = True,
    salt_by: Sequence[str] | None = None,
) -> DataFrame:
    """Number each row's label. Unseen or null: the number of labels, or an error."""
    held, small = pin(index)
    if keep:
        missing: Column = F.lit(held.count())
    else:
        missing = F.raise_error(F.concat(F.lit("unseen label: "), F.coalesce(column, F.lit("null"))))
    joined = attach_pinned(df, held, small, [column], salt_by)
    return joined.withColumn(out, F.coalesce("label_index", missing.cast("bigint"))).drop("label_index")


def vector_slots(vector: Column, width: int, prefix: str) -> list[Column]:
    """Array elements as columns ``prefix0``.. so that vectors can leave Spark ML."""
    return [F.get(vector, F.lit(i)).alias(f"{prefix}{i}") for i in range(width)]
