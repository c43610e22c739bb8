"""Fitted trees, forests and boosted trees as Column expressions.

The splits of a fitted model are read once from its saved form. Scoring is then plain SQL expressions over the record's
own columns: index columns for the categories, one leaf number per tree, and sums over the leaves' values. No stage of
the ML library is in the scoring plan, no vector is built, and only columns that some split asks for are read.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassificationModel, GBTClassificationModel, RandomForestClassificationModel
from pyspark.ml.feature import OneHotEncoderModel, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.operators.indexing import TableIndexerModel
from featureflow.session import scratch_path

TREES = (DecisionTreeClassificationModel, RandomForestClassificationModel, GBTClassificationModel)


@dataclass(frozen=True)
class Slot:
    """A feature: a number column, or whether an index column has the number ``hot``."""

    column: str
    hot: int | None = None

    def value(self) -> Column:
        return F.col(self.column) if self.hot is None else (F.col(self.column) == self.hot).cast("double")


@dataclass(frozen=True)
class Node:
    """A split on a feature, or a leaf with what it says."""

    feature: int
    threshold: float
    categories: tuple[float, ...] | None  # that go left; None for a threshold
    left: int
    right: int
    stats: tuple[float, ...]
    prediction: float


def read_trees(spark: SparkSession, model) -> list[dict[int, Node]]:
    """Nodes by id of each tree, from the model's saved form; a fitted model's size does not grow with the rows."""
    path = scratch_path(spark, "trees")
    model.write().save(path)
    data = spark.read.parquet(f"{path}/data")
    if "nodeData" in data.columns:
        data = data.select("treeID", "nodeData.*")
    else:
        data = data.select(F.lit(0).alias("treeID"), "*")
    trees: dict[int, dict[int, Node]] = {}
    for r in data.collect():
        split = r["split"]
        values = tuple(split["leftCategoriesOrThreshold"] or ())
        categories = values if split["numCategories"] != -1 else None
        threshold = values[0] if values and categories is None else 0.0
        node = Node(split["featureIndex"], threshold, categories, r["leftChild"], r["rightChild"], tuple(r["impurityStats"] or ()), r["prediction"])
        trees.setdefault(r["treeID"], {})[r["id"]] = node
    return [trees[i] for i in sorted(trees)]


@dataclass
class Compiled:
    """A fitted pipeline of indexers, one-hot encoder, assembler and tree model, in expressions.

    Where the pipeline fails (unseen categories under "error", null or NaN among the features), so do these.
    """

    trees: list[dict[int, Node]]
    weights: list[float]
    kind: type
    slots: list[Slot]
    indexes: Mapping[str, Column]
    joined: list[TableIndexerModel] = field(default_factory=list)

    def _leaf(self, tree: Mapping[int, Node], leaves: list[Node], at: int = 0) -> Column:
        """The number of the leaf that a row reaches; ``leaves`` takes them in that order."""
        node = tree[at]
        if node.left < 0:
            leaves.append(node)
            return F.lit(len(leaves) - 1)
        value = self.slots[node.feature].value()
        goes_left = value <= node.threshold if node.categories is None else value.isin(*node.categories)
        left, right = self._leaf(tree, leaves, node.left), self._leaf(tree, leaves, node.right)
        return F.when(goes_left, left).otherwise(right)

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction`` and ``probability`` (an array with one number per class)."""
        names = df.columns
        for model in self.joined:
            df = model.transform(df)
        df = df.withColumns(dict(self.indexes))
        reached, leaves = {}, []
        for i, tree in enumerate(self.trees):
            own: list[Node] = []
            reached[f"__leaf{i}"] = self._leaf(tree, own)
            leaves.append(own)
        df = df.withColumns(reached)
        pick = lambda i, values: F.get(F.array(*[F.lit(float(v)) for v in values]), F.col(f"__leaf{i}"))
        add = lambda columns: reduce(lambda a, b: a + b, columns)
        if issubclass(self.kind, GBTClassificationModel):
            margin = add([pick(i, [n.prediction for n in own]) * F.lit(w) for i, (own, w) in enumerate(zip(leaves, self.weights, strict=True))])
            df = df.withColumn("__margin", margin)
            high = 1 / (1 + F.exp(-2 * F.col("__margin")))
            scored = df.select(*names, (F.col("__margin") > 0).cast("double").alias("prediction"), F.array(1 - high, high).alias("probability"))
            return scored
        classes = len(leaves[0][0].stats)
        alone = issubclass(self.kind, DecisionTreeClassificationModel)
        share = lambda n, c: n.stats[c] if alone or not sum(n.stats) else n.stats[c] / sum(n.stats)
        votes = {f"__votes{c}": add([pick(i, [share(n, c) for n in own]) for i, own in enumerate(leaves)]) for c in range(classes)}
        df = df.withColumns(votes)
        every = [F.col(v) for v in votes]
        # The first class with the most votes.
        best = reduce(lambda later, c: F.when(every[c] == F.greatest(*every), F.lit(float(c))).otherwise(later), reversed(range(classes)), F.lit(None).cast("double"))
        return df.select(*names, best.alias("prediction"), F.array(*[v / add(every) for v in every]).alias("probability"))


def _wrong(column: str) -> Column:
    return F.raise_error(F.concat(F.lit(f"invalid value in {column}: "), F.coalesce(F.col(column).cast("string"), F.lit("null"))))


def compile_pipeline(spark: SparkSession, model: PipelineModel) -> Compiled:
    """``model``'s stages in expressions; a stage of another kind raises."""
    *stages, last = model.stages
    if not isinstance(last, TREES):
        raise TypeError(f"{type(last).__name__} is no tree model")
    indexes: dict[str, Column] = {}
    slots: dict[str, list[Slot]] = {}
    joined, features = [], None
    for stage in stages:
        if isinstance(stage, StringIndexerModel):
            keep = stage.getHandleInvalid() == "keep"
            for column, out, labels in zip(stage.getInputCols(), stage.getOutputCols(), stage.labelsArray, strict=True):
                place = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(column)) - 1
                known = F.col(column).isNotNull() & (place >= 0)
                indexes[out] = F.when(known, place.cast("int")).otherwise(F.lit(len(labels)) if keep else _wrong(column).cast("int"))
        elif isinstance(stage, TableIndexerModel):
            joined.append(stage)
        elif isinstance(stage, OneHotEncoderModel):
            keep, drop = stage.getHandleInvalid() == "keep", stage.getDropLast()
            for column, out, size in zip(stage.getInputCols(), stage.getOutputCols(), map(int, stage.categorySizes), strict=True):
                code = indexes.get(column, F.col(column))
                inside = (code >= 0) & (code < size)
                indexes[f"{out}__code"] = F.when(inside, code.cast("int")).otherwise(F.lit(size) if keep else _wrong(column).cast("int"))
                slots[out] = [Slot(f"{out}__code", s) for s in range(size + keep - drop)]
        elif isinstance(stage, VectorAssembler):
            features = stage
        else:
            raise TypeError(f"{type(stage).__name__} has no compiled form")
    every: list[Slot] = []
    for column in features.getInputCols():
        if column in slots:
            every += slots[column]
            continue
        number = indexes.get(column, F.col(column)).cast("double")
        bad = number.isNull() | F.isnan(number)
        indexes[f"{column}__number"] = F.when(bad, _wrong(column).cast("double")).otherwise(number) if features.getHandleInvalid() == "error" else F.coalesce(number, F.lit(float("nan")))
        every.append(Slot(f"{column}__number"))
    weights = list(last.treeWeights) if hasattr(last, "treeWeights") else [1.0]
    return Compiled(read_trees(spark, last), weights, type(last), every, indexes, joined)
