"""Run a flow on files: ``spark-submit --py-files featureflow.zip featureflow/__main__.py <flow> ...``

    survival   --model forest --train train.csv --score test.csv --out predictions [--search full]
    positions  --input taxi.csv --out assigned [--k 2]
    median     --input train.csv --column Fare --out medians [--by Title]
    text       --train labelled.parquet --score texts.parquet --out predictions
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.operators.aggregate import exact_median
from featureflow.operators.text import text_classifier
from featureflow.plans.passengers import FLOWS, ID, PASSENGER_SCHEMA, SCORING_SCHEMA, Cleaning, run_flow
from featureflow.plans.positions import POSITION_SCHEMA, cluster_positions
from featureflow.session import TEXT_PIECE_ROWS, build_session, training_table
from featureflow.sources.files import read_csv, write_csv, write_predictions


def survival(spark: SparkSession, args: argparse.Namespace) -> None:
    train = read_csv(spark, args.train, schema=PASSENGER_SCHEMA)
    score = read_csv(spark, args.score, schema=PASSENGER_SCHEMA if args.score_has_label else SCORING_SCHEMA)
    cleaning = Cleaning(args.match, args.zero_is_null, args.age_from)
    scored = run_flow(args.model, train, score, args.search, args.fit_on, cleaning)
    write_predictions(scored, args.out, key=ID)


def positions(spark: SparkSession, args: argparse.Namespace) -> None:
    rows = read_csv(spark, args.input, schema=POSITION_SCHEMA, header=False)
    model, assigned = cluster_positions(rows, k=args.k)
    for number, centre in enumerate(model.stages[-1].clusterCenters()):
        print(number, *centre)
    write_csv(assigned.select("tid", "lat", "lon", "time", "prediction"), args.out)


def median(spark: SparkSession, args: argparse.Namespace) -> None:
    write_csv(exact_median(read_csv(spark, args.input), args.column, args.by), args.out, header=True)


def text(spark: SparkSession, args: argparse.Namespace) -> None:
    """Parquet in: (id, text, label) to train, (id, text) to score."""
    train = spark.read.parquet(args.train).select("text", F.col("label").cast("double"))
    score: DataFrame = spark.read.parquet(args.score).select("id", "text")
    model = text_classifier().fit(training_table(train, "texts", "text", "label", piece_rows=TEXT_PIECE_ROWS))
    write_predictions(model.transform(score), args.out, key="id")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="featureflow")
    flows = top.add_subparsers(required=True)

    def add(run, *required: str) -> argparse.ArgumentParser:
        flow = flows.add_parser(run.__name__)
        flow.set_defaults(run=run)
        for name in required:
            flow.add_argument(f"--{name}", required=True)
        return flow

    flow = add(survival, "train", "score", "out")
    flow.add_argument("--model", choices=sorted(FLOWS), default="forest")
    flow.add_argument("--search", choices=("none", "quick", "full"), default="none")
    flow.add_argument("--score-has-label", action="store_true", help="the scoring file has a Survived column")
    flow.add_argument("--fit-on", choices=("train", "all"), default="train")
    flow.add_argument("--match", choices=("substring", "word"), default="substring", help="how title keywords are found")
    flow.add_argument("--zero-is-null", action="store_true", help="age 0 is unknown")
    flow.add_argument("--age-from", choices=("constants", "median"), default="constants", help="for the banded flows")
    add(positions, "input", "out").add_argument("--k", type=int, default=2)
    add(median, "input", "column", "out").add_argument("--by", nargs="*", default=[])
    add(text, "train", "score", "out")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(build_session(), args)


if __name__ == "__main__":
    main()
