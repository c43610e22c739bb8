"""Passenger survival: cleaned records, and supervised flows from raw rows to predictions.

Input rows have the passenger file's columns: PassengerId, Survived (absent when scoring), Pclass,
Name, Sex, Age, SibSp, Parch, Ticket, Fare, Cabin, Embarked.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureflow.functions.derive import (
    age_band,
    code_initial,
    dense_vector,
    fare_band,
    flag_equals,
    size_band,
    title_of,
)
from featureflow.operators.impute import (
    TITLE_AGES,
    fill_constants,
    fill_means,
    fit_group_medians,
    fit_means,
    lookup_value,
    zero_as_null,
)
from featureflow.operators.models import categorical_pipeline, classifier
from featureflow.operators.search import Search, grid_search, run_search
from featureflow.operators.split import stack_by_name
from featureflow.session import TRAIN_PARTS, training_table

ID, LABEL = "passenger_id", "survived"

PASSENGER_SCHEMA = (
    "PassengerId int, Survived int, Pclass int, Name string, Sex string, Age double, SibSp int, "
    "Parch int, Ticket string, Fare double, Cabin string, Embarked string"
)
SCORING_SCHEMA = PASSENGER_SCHEMA.replace("Survived int, ", "")


def _label(df: DataFrame, absent: int):
    """The label column, or the constant scoring rows carry."""
    present = "survived" in {c.lower() for c in df.columns}
    return (F.col("Survived") if present else F.lit(absent)).cast("int").alias(LABEL)


def plain_record(df: DataFrame, means: Mapping[str, float | None], match: str = "substring") -> DataFrame:
    """Cleaned record: mean age of ``means``, constants elsewhere, families of 2 to 4 in the middle."""
    filled = fill_constants(df, {"Embarked": "S", "Cabin": "Unknown", "Fare": 0.0})
    filled = fill_means(filled, means, "Age")
    return filled.select(
        F.col("PassengerId").alias(ID),
        _label(df, 0),
        title_of("Name", match).alias("title"),
        F.col("Pclass").alias("pclass"),
        F.col("Sex").alias("sex"),
        F.col("Age").alias("age"),
        size_band(F.col("SibSp") + F.col("Parch"), 4).alias("family_band"),
        F.col("Fare").alias("fare"),
        F.col("Cabin").alias("cabin"),
        F.col("Embarked").alias("embarked"),
    )


def title_medians(df: DataFrame, match: str = "substring") -> dict[str, float]:
    """Exact median age of each title group that has one; there are no more groups than title rules."""
    titled = df.select("Age", title_of("Name", match).alias("title"))
    found = fit_group_medians(titled, "Age", ["title"]).collect()
    return {r["title"]: r["group_median"] for r in found if r["group_median"] is not None}


def banded_record(
    df: DataFrame,
    means: Mapping[str, float | None],
    match: str = "substring",
    zero_is_null: bool = False,
    ages: Mapping[str, float] = TITLE_AGES,
) -> DataFrame:
    """Banded record: age from the title where missing, mean fare, families of 2 or 3 in the middle.

    ``zero_is_null`` treats age 0 as missing, for files that were written that way. ``ages`` are the ages by
    title: fixed ones, or those of ``title_medians``.
    """
    filled = fill_means(fill_constants(df, {"Embarked": "S"}), means, "Fare")
    title = title_of("Name", match)
    age = zero_as_null("Age") if zero_is_null else F.col("Age")
    return filled.select(
        F.col("PassengerId").alias(ID),
        _label(df, -1),
        title.alias("title"),
        F.col("Pclass").alias("pclass"),
        F.col("Sex").alias("sex"),
        age_band(F.coalesce(age, lookup_value(title, ages))).alias("age_band"),
        size_band(F.col("SibSp") + F.col("Parch"), 3).alias("family_band"),
        fare_band("Fare").alias("fare_band"),
        code_initial("Cabin").alias("cabin"),
        F.col("Embarked").alias("embarked"),
    )


def labelled_points(df: DataFrame, means: Mapping[str, float | None]) -> DataFrame:
    """(passenger_id, label double, features vector of 6)."""
    filled = fill_means(df, means, "Age")
    return filled.select(
        F.col("PassengerId").alias(ID),
        F.col("Survived").cast("double").alias("label"),
        dense_vector(
            "Pclass", flag_equals("Sex", "male"), "Age", "SibSp", "Parch", "Fare"
        ).alias("features"),
    )


@dataclass(frozen=True)
class Flow:
    """One supervised flow: how rows become features, which model, which search."""

    model: str
    record: str
    strings: Sequence[str]
    codes: Sequence[str] = ()
    numbers: Sequence[str] = ()
    keep: bool = True
    drop_last: bool = True
    wide: Sequence[str] = ()
    folds: int = 0
    metric: str = "areaUnderROC"
    grid: Mapping[str, Sequence] = field(default_factory=dict)
    quick_grid: Mapping[str, Sequence] = field(default_factory=dict)
    quick_params: Mapping[str, object] = field(default_factory=dict)


CATEGORIES = ("title", "sex", "cabin", "embarked")
PLAIN_CODES = ("pclass", "family_band")
BANDED_CODES = ("pclass", "age_band", "family_band", "fare_band")

# The search grids.
FOREST_GRID = {
    "maxDepth": (4, 6, 8),
    "maxBins": (8, 16, 32),
    "featureSubsetStrategy": ("auto", "sqrt", "log2"),
    "minInstancesPerNode": (1, 3, 10),
}
LOGISTIC_GRID = {"aggregationDepth": (2, 3, 6, 8)}
SVM_GRID = {"maxIter": (50, 100), "fitIntercept": (True, False), "aggregationDepth": (2, 4, 8)}
TREE_GRID = {"maxDepth": (6, 8, 10)}

# The quick grids keep the shape of a search at a few fits. The logistic one moves the
# regularisation, since aggregationDepth changes the speed and not the model.
FLOWS = {
    "forest": Flow(
        "forest", "plain", CATEGORIES, PLAIN_CODES, wide=("cabin",), folds=5, metric="areaUnderPR",
        grid=FOREST_GRID, quick_grid={"maxDepth": (4, 6)},
    ),
    "logistic": Flow(
        "logistic", "plain", CATEGORIES, PLAIN_CODES, wide=("cabin",), folds=3, metric="areaUnderROC",
        grid=LOGISTIC_GRID, quick_grid={"regParam": (0.0, 0.1)},
    ),
    "forest_union": Flow(
        "forest", "banded", CATEGORIES, BANDED_CODES, folds=5, metric="areaUnderPR",
        grid=FOREST_GRID, quick_grid={"maxDepth": (4, 6)},
    ),
    "svm": Flow(
        "svm", "banded", CATEGORIES, BANDED_CODES, folds=5, metric="areaUnderPR",
        grid=SVM_GRID, quick_grid={"fitIntercept": (True, False)}, quick_params={"maxIter": 10},
    ),
    "boosted": Flow(
        "boosted", "banded", CATEGORIES, BANDED_CODES, folds=5, metric="areaUnderPR",
        grid=FOREST_GRID, quick_grid={"maxDepth": (3, 4)}, quick_params={"maxIter": 4},
    ),
    "tree": Flow(
        "tree", "raw", ("Sex",), numbers=("SibSp", "Parch", "Fare"), keep=False, folds=3,
        metric="areaUnderROC", grid=TREE_GRID, quick_grid={"maxDepth": (6, 8)},
    ),
    "one_hot_logistic": Flow(
        "logistic", "raw", ("Sex",), numbers=("Age", "SibSp", "Parch", "Fare"), drop_last=False,
    ),
}


@dataclass(frozen=True)
class Cleaning:
    """How a flow reads names and ages.

    ``match``: title keywords as "substring" or whole "word". ``zero_is_null``: age 0 is unknown. ``age_from``: ages
    that the banded record fills come from the "constants" per title or the "median" of the title's fitted rows.
    """

    match: str = "substring"
    zero_is_null: bool = False
    age_from: str = "constants"

    def __post_init__(self) -> None:
        if self.age_from not in ("constants", "median"):
            raise ValueError(f"age_from must be 'constants' or 'median', not {self.age_from!r}")

    def ages_of(self, df: DataFrame) -> DataFrame:
        return df.withColumn("Age", zero_as_null("Age")) if self.zero_is_null else df


@dataclass(frozen=True)
class Statistics:
    """What records take from the rows they are fitted on, held as numbers."""

    means: Mapping[str, float | None]
    ages: Mapping[str, float]


def fit_statistics(flow: Flow, df: DataFrame, cleaning: Cleaning = Cleaning()) -> Statistics:  # noqa: B008
    """Means of age and fare, and the ages by title."""
    if cleaning.age_from == "median" and flow.record != "banded":
        raise ValueError("only the banded record takes ages from titles")
    df = cleaning.ages_of(df)
    ages = title_medians(df, cleaning.match) if cleaning.age_from == "median" else TITLE_AGES
    return Statistics(fit_means(df, "Age", "Fare"), ages)


def records(flow: Flow, df: DataFrame, fitted: Statistics, cleaning: Cleaning = Cleaning()) -> DataFrame:  # noqa: B008
    """The flow's record of ``df`` with statistics fitted before."""
    df, means = cleaning.ages_of(df), fitted.means
    if flow.record == "plain":
        return plain_record(df, means, cleaning.match)
    if flow.record == "banded":
        return banded_record(df, means, cleaning.match, ages=fitted.ages)
    used = df.select(F.col("PassengerId").alias(ID), _label(df, 0), "Sex", "Age", "SibSp", "Parch", "Fare")
    return fill_means(used, means, "Age", "Fare")


def flow_pipeline(flow: Flow, **params) -> Pipeline:
    """Indexers, encoders, assembler and the flow's model."""
    return categorical_pipeline(
        classifier(flow.model, LABEL, **params),
        LABEL,
        strings=flow.strings,
        codes=flow.codes,
        numbers=flow.numbers,
        keep=flow.keep,
        drop_last=flow.drop_last,
        wide=flow.wide,
    )


def fit_flow(
    name: str,
    train: DataFrame,
    search: str = "none",
    fitted: Statistics | None = None,
    parts: int = TRAIN_PARTS,
    search_rows: int | None = None,
    cleaning: Cleaning = Cleaning(),  # noqa: B008
    **params,
):
    """Fit a flow on raw training rows.

    ``search``: "full" and "quick" run the cross-validated grid, "none" fits the model as it is.
    ``fitted`` are the statistics of the records (default: those of the training rows). ``parts`` is the least number of
    pieces the training rows are dealt into, large tables into more; fitted models depend on it and on nothing of the cluster.
    ``search_rows`` bounds the rows the search reads (default: all); the model found is fitted on all.
    """
    flow = FLOWS[name]
    rows = records(flow, train, fitted or fit_statistics(flow, train, cleaning), cleaning)
    if search == "none" or not flow.folds:
        # Written once: label counts, widths and the model's own passes read columnar files.
        return flow_pipeline(flow, **params).fit(training_table(rows, "train", ID, parts=parts))
    pipeline, grid, folds = _searched(flow, search, params)
    return grid_search(pipeline, grid, rows, LABEL, ID, folds=folds, metric=flow.metric, parts=parts, search_rows=search_rows)


def _searched(flow: Flow, search: str, params: Mapping) -> tuple[Pipeline, Mapping[str, Sequence], int]:
    """Pipeline, grid and folds of a "full" or "quick" search."""
    if search == "quick":
        return flow_pipeline(flow, **{**flow.quick_params, **params}), flow.quick_grid, 2
    return flow_pipeline(flow, **params), flow.grid, flow.folds


def search_flow(
    name: str,
    train: DataFrame,
    search: str = "full",
    fitted: Statistics | None = None,
    parts: int = TRAIN_PARTS,
    search_rows: int | None = None,
    cleaning: Cleaning = Cleaning(),  # noqa: B008
    finished: str | None = None,
    **params,
) -> Search:
    """The areas that the flow's search reaches, per parameter map and fold, without the final fit.

    ``finished`` is a folder that keeps each area as it is found; the same search goes on from there.
    """
    flow = FLOWS[name]
    rows = records(flow, train, fitted or fit_statistics(flow, train, cleaning), cleaning)
    pipeline, grid, folds = _searched(flow, search, params)
    return run_search(
        pipeline, grid, rows, LABEL, ID, folds=folds, metric=flow.metric, parts=parts, search_rows=search_rows,
        refit=False, finished=finished,
    )


def fit_points(kind: str, points: DataFrame, max_iter: int = 100):
    """Fit "svm" or "logistic" on (label, features) rows, without any encoding."""
    return classifier(kind, "label", maxIter=max_iter).fit(points)


def run_flow(
    name: str,
    train: DataFrame,
    score: DataFrame,
    search: str = "none",
    fit_on: str = "train",
    cleaning: Cleaning = Cleaning(),  # noqa: B008
    **params,
) -> DataFrame:
    """Fit on ``train`` and return ``score`` with prediction columns.

    ``fit_on="all"`` takes means and medians from training and scoring rows together. They are computed once.
    """
    if fit_on not in ("train", "all"):
        raise ValueError(f"fit_on must be 'train' or 'all', not {fit_on!r}")
    used = ["Age", "Fare", *(["Name"] if cleaning.age_from == "median" else [])]
    fitted_on = train if fit_on == "train" else stack_by_name(train.select(*used), score.select(*used))
    fitted = fit_statistics(FLOWS[name], fitted_on, cleaning)
    model = fit_flow(name, train, search, fitted, cleaning=cleaning, **params)
    return model.transform(records(FLOWS[name], score, fitted, cleaning))
