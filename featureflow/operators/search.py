"""Grid search with cross-validation over stable folds, as a table of cells.

A cell is one parameter map on one fold, with the area its model reaches there. All cells of all folds go to one pool,
the costly ones first. Cells that cannot differ are fitted once: where two maps lead to the same fit (``fit_key``), one
area stands for both. Held-out rows that are equal are scored once, and boosted trees learn from equal rows as weights, both to
the same areas. Finished cells can be kept in a folder, from which a search that was interrupted goes on.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.operators.split import fold_of
from featureflow.session import TRAIN_PARTS, Scratch, dealt, pieces_for

Grid = Mapping[str, Sequence]

# Rows per piece, up to ``parts`` pieces; many fits that run together gain nothing from more pieces.
PIECE_ROWS = 50_000
# How many rows a row stands for.
WEIGHT = "__weight"
# Up to here a tree's thresholds come from all rows; beyond, from a sample whose size the bins decide.
EXACT_SPLIT_ROWS = 10_000
# With so few pieces sums are not added up in levels, whatever the depth.
FLAT_PIECES = 4


def param_maps(estimator: Estimator, grid: Grid) -> list[dict]:
    """All combinations of the named parameters."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    return builder.build()


@dataclass(frozen=True)
class Facts:
    """What decides which maps lead to the same fit: of the encoded rows of one fold."""

    rows: int
    features: int
    values: int  # distinct values of the feature that has most
    pieces: int
    numbers: bool = True  # some feature may have more than two values


def fold_facts(rows: DataFrame, pieces: int) -> Facts:
    """Of rows in so many pieces. ``values`` is not counted where it decides nothing: beyond ``EXACT_SPLIT_ROWS`` rows, or
    where no feature is a number.
    """
    size = rows.count()
    width = len(rows.first()["features"]) if size else 0
    values, numbers = size, has_numbers(rows)
    if numbers and 0 < size <= EXACT_SPLIT_ROWS:
        each = vector_to_array("features")
        counted = rows.select(F.posexplode(each)).groupBy("pos").agg(F.count_distinct("col").alias("n"))
        values = counted.agg(F.max("n")).first()[0]
    return Facts(size, width, values, pieces, numbers)


def has_numbers(rows: DataFrame) -> bool:
    """Whether a tree may look for thresholds: false where all features are marked as on or off, as one-hot slots are."""
    marks = rows.schema["features"].metadata.get("ml_attr", {})
    return len(marks.get("attrs", {}).get("binary", ())) < marks.get("num_attrs", math.inf)


def counted(rows: DataFrame, label: str) -> DataFrame:
    """Rows equal in label and features as one, with their number as its weight."""
    return rows.groupBy(label, "features").agg(F.count(F.lit(1)).cast("double").alias(WEIGHT))


def copies(counts: DataFrame, least: int) -> DataFrame:
    """Counted rows as ``least`` rows each, or as many as they stand for: all but the first weigh 1, the first the rest.

    Any set of them has ``least`` rows if and only if it stands for as many.
    """
    some = F.least(F.col(WEIGHT), F.lit(float(least)))
    each = F.explode(F.sequence(F.lit(1), some.cast("int"))).alias("__copy")
    rest = F.when(F.col("__copy") == 1, F.col(WEIGHT) - some + 1).otherwise(1.0)
    return counts.select("*", each).withColumn(WEIGHT, rest)


def learns_from_weights(model: Estimator, rows: DataFrame) -> bool:
    """Whether ``model`` finds the same in equal rows as in one row of their weight, but for how many rows a node has.

    Boosted trees that draw no rows do, where no thresholds follow from the rows. Forests draw rows one by one.
    """
    whole = isinstance(model, GBTClassifier) and model.getSubsamplingRate() == 1 and model.getMinWeightFractionPerNode() == 0
    return whole and not any(map(model.isDefined, (model.weightCol, model.validationIndicatorCol))) and not has_numbers(rows)


def weighed_rows(counts: DataFrame, label: str, least: int, parts: int) -> DataFrame:
    """``copies`` of counted rows, in pieces that follow from the rows and ``parts``."""
    size = int(counts.agg(F.sum(F.least(F.col(WEIGHT), F.lit(float(least))))).first()[0] or 0)
    placed = copies(counts, least).withColumn("__hash", F.xxhash64("features", label))
    return dealt(placed, search_pieces(size, parts), "__hash", "__copy").select(label, "features", WEIGHT)


def search_pieces(rows: int, parts: int) -> int:
    """Pieces of a table that many fits read: as few as its rows allow."""
    return pieces_for(rows, max(1, min(parts, -(-rows // PIECE_ROWS))))


def fit_key(model: Estimator, chosen: Mapping[str, object], facts: Facts) -> tuple:
    """Equal for parameters with which ``model`` makes the same fit of rows with these ``facts``.

    The number of levels in which sums are added up has no effect on few pieces; bins have none where no feature is a
    number, and beyond a feature's distinct values none on few rows; a strategy of drawing features counts by the number
    it draws.
    """
    out = []
    for name, value in sorted(chosen.items()):
        if name == "aggregationDepth" and facts.pieces <= FLAT_PIECES:
            value = None
        elif name == "maxBins" and not facts.numbers:
            value = None
        elif name == "maxBins" and facts.rows <= EXACT_SPLIT_ROWS:
            value = min(value, facts.values)
        elif name == "featureSubsetStrategy":
            value = drawn_features(model, value, facts.features)
        out.append((name, value))
    return tuple(out)


def drawn_features(model: Estimator, strategy: str, features: int) -> int | str:
    """How many features a tree's node draws; other strategies than the three of the grids stand for themselves."""
    if strategy == "auto":  # trees that grow alone, boosted ones too, see all features
        strategy = "sqrt" if isinstance(model, RandomForestClassifier) and model.getNumTrees() > 1 else "all"
    if strategy == "all":
        return features
    if strategy == "sqrt":
        return math.ceil(math.sqrt(features))
    if strategy == "log2" and features:
        return max(1, math.ceil(math.log2(features)))
    return strategy


class Finished:
    """Areas of finished cells in a folder that all attempts can reach: one small file per cell.

    The folder belongs to one search; ``mark`` names it, and another search in the same folder raises.
    """

    def __init__(self, spark: SparkSession, path: str, mark: str) -> None:
        self.spark, self.path = spark, path
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        if not self._add("search.json", {"mark": mark}) and self._read()["mark"].dropna().unique().tolist() != [mark]:
            raise ValueError(f"{path!r} holds the cells of another search")

    def _add(self, name: str, row: dict) -> bool:
        """Write the file as a whole or, where it exists, leave it."""
        target, draft = self._path(f"{self.path}/{name}"), self._path(f"{self.path}/_{name}")
        if self.fs.exists(target):
            return False
        stream = self.fs.create(draft, True)
        stream.write(bytearray(json.dumps(row).encode()))
        stream.close()
        return self.fs.rename(draft, target)

    def _read(self):
        return self.spark.read.schema("mark string, key string, fold int, area double").json(self.path).toPandas()

    def areas(self) -> dict[tuple[str, int], float]:
        found = self._read().dropna(subset=["key"])
        return {(r.key, int(r.fold)): float(r.area) for r in found.itertuples()}

    def add(self, number: int, key: str, fold: int, area: float) -> None:
        self._add(f"cell-{fold}-{number}.json", {"key": key, "fold": fold, "area": area})


@dataclass
class Search:
    """A finished search: its maps as names and values, the area of every map on every fold, and the fitted model."""

    maps: list[dict[str, object]]
    areas: list[list[float]]  # by map, then by fold
    fits: int  # cells that were fitted, not shared or found finished
    model: CrossValidatorModel | None = None

    @property
    def means(self) -> list[float]:
        return [sum(x) / len(x) for x in self.areas]

    @property
    def best(self) -> int:
        """The first of the best maps."""
        means = self.means
        return max(range(len(means)), key=means.__getitem__)

    def cells(self, spark: SparkSession) -> DataFrame:
        """(map, params, fold, area): one row per cell, maps and folds numbered from 0."""
        rows = [(m, {k: str(v) for k, v in self.maps[m].items()}, f, a) for m, x in enumerate(self.areas) for f, a in enumerate(x)]
        return spark.createDataFrame(rows, "map int, params map<string,string>, fold int, area double")


def _named(chosen: Mapping) -> dict[str, object]:
    return {p.name: v for p, v in chosen.items()}


def fit_order(cells: Mapping[tuple[str, int], int], maps: Sequence[Mapping]) -> list[tuple[str, int]]:
    """Cells (key, fold) in the order of their fits: deep trees and long iterations, which last longest, first.

    Among equals each map goes through all folds in turn: a fold's encoded rows lie on few executors, so fits that run at
    the same time should be of different folds.
    """
    cost = lambda m: [v for k, v in sorted(_named(maps[m]).items()) if k in ("maxDepth", "maxIter")]
    in_turn = sorted(cells, key=lambda cell: (cells[cell], cell[1]))
    return sorted(in_turn, key=lambda cell: cost(cells[cell]), reverse=True)


def search_cells(
    pipeline: Pipeline,
    grid: Grid,
    searched: DataFrame,
    label: str,
    folds: int,
    metric: str,
    pieces: int,
    parallelism: int = 8,
    share: bool = True,
    finished: str | None = None,
    parts: int = TRAIN_PARTS,
) -> Search:
    """The areas of all maps of ``grid`` on all folds; ``searched``, in ``pieces``, holds each row's fold in ``__fold``.

    Encoders are fitted once per fold, on its fitting rows. ``share=False`` fits every cell by itself. ``finished`` is a
    folder of cells that earlier attempts at the same search have left.
    """
    *encoders, model = pipeline.getStages()
    spark, maps = searched.sparkSession, param_maps(model, grid)
    evaluator = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="prediction", metricName=metric, weightCol=WEIGHT)
    own_least = model.getMinInstancesPerNode() if isinstance(model, GBTClassifier) else 1
    least_of = [_named(m).get("minInstancesPerNode", own_least) for m in maps]
    held, sides, facts = [], [], []

    def keep(df: DataFrame) -> DataFrame:
        held.append(df.persist())
        return df

    try:
        for fold in range(folds):
            fit_rows = searched.where(F.col("__fold") != fold)
            encoder = Pipeline(stages=encoders).fit(fit_rows)
            held_out = searched.where(F.col("__fold") == fold)
            fit_rows, held_out = (encoder.transform(side).select(label, "features") for side in (fit_rows, held_out))
            if all(learns_from_weights(model.copy(m), fit_rows) for m in maps):
                facts.append(fold_facts(fit_rows, pieces))
                counts = keep(counted(fit_rows, label))
                by_least = {n: keep(weighed_rows(counts, label, n, parts)) for n in set(least_of)}
            else:
                by_least = dict.fromkeys(least_of, keep(fit_rows))
                facts.append(fold_facts(fit_rows, pieces))
            sides.append((by_least, keep(counted(held_out, label))))
        key_of = lambda m, fold: repr(fit_key(model, _named(maps[m]), facts[fold]) if share else (m,))
        cells = {(key_of(m, fold), fold): m for fold in range(folds) for m in reversed(range(len(maps)))}
        kept = None
        areas: dict[tuple[str, int], float] = {}
        if finished is not None:
            rows = searched.agg(F.sum(F.xxhash64(*searched.columns).cast("decimal(20,0)"))).first()[0]
            kept = Finished(spark, finished, repr((type(model).__name__, [_named(m) for m in maps], folds, metric, str(rows))))
            areas = {c: a for c, a in kept.areas().items() if c in cells}

        def area(cell: tuple[str, int]) -> float:
            (by_least, check_rows), m = sides[cell[1]], cells[cell]
            fit_rows = by_least[least_of[m]]
            chosen = maps[m] | ({model.weightCol: WEIGHT} if WEIGHT in fit_rows.columns else {})
            found = evaluator.evaluate(model.fit(fit_rows, chosen).transform(check_rows))
            if kept is not None:
                kept.add(m, *cell, found)
            return found

        todo = fit_order({c: m for c, m in cells.items() if c not in areas}, maps)
        if todo:
            # A fit keeps about as many cores busy as it has pieces, half the time.
            most = max(parallelism, spark.sparkContext.defaultParallelism)
            together = min(most, max(2, 2 * most // pieces)) if parallelism > 1 else 1
            with ThreadPool(min(together, len(todo))) as pool:
                found = pool.map(inheritable_thread_target(spark)(area), todo, chunksize=1)
            areas |= dict(zip(todo, found, strict=True))
    finally:
        for df in held:
            df.unpersist()
    by_map = [[areas[key_of(m, fold), fold] for fold in range(folds)] for m in range(len(maps))]
    return Search([_named(m) for m in maps], by_map, len(todo))


def run_search(
    pipeline: Pipeline,
    grid: Grid,
    train: DataFrame,
    label: str,
    key: str,
    folds: int,
    metric: str,
    parallelism: int = 8,
    parts: int = TRAIN_PARTS,
    search_rows: int | None = None,
    refit: bool = True,
    finished: str | None = None,
) -> Search:
    """Best of ``grid`` for the pipeline's last stage by cross-validated area under ``metric``.

    The area is taken on the predicted class. No parameter of the grid touches the stages before the
    last one, so they are fitted once per fold and every combination reads the same encoded rows.
    Folds come from the key, pieces from the rows, the key and ``parts``: none depends on the cluster.

    The search reads all rows, unless a caller bounds them by ``search_rows`` to those with the smallest hash of the key;
    the best combination, the first of several, is fitted on all rows (unless ``refit`` is false). ``avgMetrics`` and
    ``getEstimatorParamMaps()`` of the model run in parallel.
    """
    *encoders, model = pipeline.getStages()
    with Scratch(train.sparkSession) as scratch:
        written = scratch.write(train, "train")
        size = written.count()
        pieces = pieces_for(size, parts)
        rows = dealt(written, pieces, key)
        searched = written
        if search_rows is not None:
            searched, size = written.orderBy(F.xxhash64(key), key).limit(search_rows), min(size, search_rows)
        pieces = search_pieces(size, parts)
        searched = scratch.write(searched.withColumn("__fold", fold_of(key, folds)), "grid")
        searched = dealt(searched, pieces, key)
        found = search_cells(pipeline, grid, searched, label, folds, metric, pieces, parallelism, finished=finished, parts=parts)
        if refit:
            maps = param_maps(model, grid)
            fitted = Pipeline(stages=[*encoders, model.copy(maps[found.best])]).fit(rows)
            found.model = CrossValidatorModel(fitted, found.means)._set(estimatorParamMaps=maps, numFolds=folds)
    return found


def grid_search(*args, **options) -> CrossValidatorModel:
    """The model of ``run_search``."""
    return run_search(*args, **options).model
