"""Command line for the two jobs; see ``run.py`` for submitting it."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tallygrove.plans import (
    EVALUATION_METRICS,
    TRAINING_METRICS,
    Source,
    predict_job,
    train_job,
)
from tallygrove.sources import report_lines

# The label and the features, in the order of the weights, of the
# measurement tables that the jobs read unless told otherwise.
LABEL = "quality"
FEATURES = (
    "alcohol",
    "sulphates",
    "pH",
    "density",
    "free sulfur dioxide",
    "total sulfur dioxide",
    "chlorides",
    "residual sugar",
    "citric acid",
    "volatile acidity",
    "fixed acidity",
)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tallygrove", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    train = jobs.add_parser("train", help="fit, report, save model and scored validation rows")
    train.add_argument("training", help="training table (any Hadoop URI)")
    train.add_argument("validation", help="validation table")
    predict = jobs.add_parser("predict", help="load a model, score a table, report")
    predict.add_argument("table", help="table to score")
    for job in (train, predict):
        job.add_argument("--model-path", required=True)
        job.add_argument("--scored-path", required=True)
        job.add_argument("--label", default=LABEL)
        job.add_argument("--features", nargs="+", default=list(FEATURES))
        job.add_argument("--keep", nargs="+", default=[], help="row keys to carry along")
        job.add_argument("--format", default="csv")
        job.add_argument("--schema", help="column types as DDL; inferred if absent")
        job.add_argument("--sep", default=",")
        job.add_argument("--quote", default='"')
        job.add_argument("--arrays", action="store_true", help="write arrays, not vectors")
        job.add_argument("--scorer", choices=("model", "expressions"), default="model")
    train.add_argument("--reuse", choices=("rescan", "stage", "cache"))
    train.add_argument("--partitions", type=int, help="merge splits to this many before the fit")
    return parser


def _print_report(title: str, dataset: str, table: DataFrame, names: dict[str, str]) -> None:
    print(f"\n{title}")
    # At most ten rows: one per metric.
    rows = [r for r in table.collect() if r["dataset"] == dataset]
    for line in report_lines(rows, names):
        print(line)


def main(arguments: Sequence[str] | None = None) -> None:
    options = _parser().parse_args(arguments)
    spark = SparkSession.builder.appName("tallygrove").getOrCreate()

    def source(path: str) -> Source:
        read = {
            "format": options.format,
            "schema": options.schema,
            "sep": options.sep,
            "quote": options.quote,
        }
        return Source(path, options.label, options.features, options.keep, read)

    targets = {
        "model_path": options.model_path,
        "scored_path": options.scored_path,
        "arrays": options.arrays,
        "scorer": options.scorer,
    }
    if options.job == "train":
        report = train_job(
            spark,
            source(options.training),
            source(options.validation),
            reuse=options.reuse,
            partitions=options.partitions,
            **targets,
        )
        _print_report("Training", "training", report.metrics, TRAINING_METRICS)
        scored_as = "validation"
    else:
        report = predict_job(spark, source(options.table), **targets)
        scored_as = "test"
    report.preview.show(truncate=False)
    _print_report(scored_as.capitalize(), scored_as, report.metrics, EVALUATION_METRICS)
