"""The two user-visible jobs: train and predict."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any, NamedTuple

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrove.functions import named
from tallygrove.operators import (
    assemble,
    check_scorer,
    confusion,
    fit,
    linear_scores,
    load,
    metrics,
    predictions,
    prepare_table,
    save,
    score,
    scorer_weights,
)
from tallygrove.sources import (
    held,
    preview,
    read_table,
    write_scored,
)

# Metrics reported for each data set and their printed names.
TRAINING_METRICS = {
    "accuracy": "Accuracy",
    "weightedFalsePositiveRate": "FPR",
    "weightedTruePositiveRate": "TPR",
    "weightedFMeasure": "F-measure",
    "weightedPrecision": "Precision",
    "weightedRecall": "Recall",
}
EVALUATION_METRICS = {
    "accuracy": "Accuracy",
    "f1": "F1 Score",
    "weightedPrecision": "Weighted Precision",
    "weightedRecall": "Weighted Recall",
}


@dataclass(frozen=True)
class Source:
    """A table to prepare: where it is, how to read it, which columns matter."""

    table: str | DataFrame
    label: str
    features: Sequence[str]
    keep: Sequence[str] = ()
    read: dict[str, Any] = field(default_factory=dict)

    @property
    def is_scan(self) -> bool:
        return isinstance(self.table, str)

    @property
    def is_text(self) -> bool:
        return self.is_scan and self.read.get("format", "csv") == "csv"


class TrainReport(NamedTuple):
    model: PipelineModel
    metrics: DataFrame
    preview: DataFrame
    scored: DataFrame


class PredictReport(NamedTuple):
    metrics: DataFrame
    preview: DataFrame
    scored: DataFrame


def prepared(spark: SparkSession, source: Source) -> DataFrame:
    """Read, if need be, and clean a labelled table (J1, without the vector)."""
    table = source.table
    if source.is_scan:
        table = read_table(spark, table, **source.read)
    return prepare_table(table, source.label, source.features, keep=source.keep)


def evaluate(
    scored: DataFrame,
    names: Sequence[str] = tuple(EVALUATION_METRICS),
    *,
    dataset: str | None = None,
) -> DataFrame:
    """All metrics of a scored table in one pass over it.

    The pass runs now. Its result, a row for each name whatever the table, is handed
    back as it is, so that reading the metrics again repeats nothing.
    """
    found = metrics(confusion(scored), names, dataset=dataset)
    return scored.sparkSession.createDataFrame(found.collect(), found.schema)


def _scored(
    model: PipelineModel, flat: DataFrame, source: Source, arrays: bool, scorer: str
) -> DataFrame:
    """``label, features, rawPrediction, probability, prediction`` and keys."""
    if scorer == "model":
        scored = score(model, assemble(flat, source.features, keep=source.keep))
        if not arrays:
            return scored
        return scored.withColumns(
            {c: vector_to_array(c) for c in ("features", "rawPrediction", "probability")}
        )
    rows = linear_scores(flat, *scorer_weights(model), source.features)
    inputs = F.array(*(named(f).cast("double") for f in source.features)).alias("features")
    return rows.select(
        "label", inputs, *source.keep, "rawPrediction", "probability", "prediction"
    )


def _score_and_write(
    spark: SparkSession,
    model: PipelineModel,
    source: Source,
    path: str,
    dataset: str,
    arrays: bool,
    scorer: str,
) -> PredictReport:
    """Score once, straight into the sink; report from what was written.

    Metrics and preview then read back two or three columns instead of
    scoring the table again or holding it in memory.
    """
    check_scorer(scorer)
    if scorer == "expressions" and not arrays:
        raise ValueError("expressions make arrays, not vectors: pass arrays=True")
    result = _scored(model, prepared(spark, source), source, arrays, scorer)
    write_scored(result, path)
    written = spark.read.schema(result.schema).parquet(path)
    return PredictReport(evaluate(written, dataset=dataset), preview(written), written)


def train_job(
    spark: SparkSession,
    training: Source,
    validation: Source,
    *,
    model_path: str,
    scored_path: str,
    reuse: str | None = None,
    partitions: int | None = None,
    spread: int | None = None,
    arrays: bool = False,
    scorer: str = "model",
    **settings: Any,
) -> TrainReport:
    """Fit on one table, report on it, score and report on another.

    Training reads its table three times (twice in the fit, once for its own
    metrics). ``reuse`` says what to keep in between (see ``held``). Unset, text
    and spread rows are staged as Parquet once; anything else is read again.
    ``spread`` deals the rows to that many partitions first: for a file that comes
    in fewer splits than there are cores, such as compressed text.
    ``partitions`` and ``settings`` go to ``fit``. The model is saved as soon
    as it exists. Metrics have columns ``dataset, metric, value``. The model
    comes back as it was saved, without a ``summary``: that one would read the
    training rows again, of which a staged copy is gone by then; the metrics here
    are the same numbers.

    With ``arrays`` the vector columns of the scored rows are written as plain
    arrays, which SQL can read. ``scorer`` (see ``SCORERS``) says who scores, for
    the training metrics and, with ``arrays``, for the scored rows.
    """
    rows = prepared(spark, training)
    if reuse is None:
        reuse = "stage" if training.is_text or spread else "rescan"
    if spread:
        rows = rows.repartition(spread)
    with held(rows, reuse) as flat:
        model = fit(assemble(flat, training.features), partitions=partitions, **settings)
        save(model, model_path)
        trained = evaluate(
            predictions(model, flat, training.features, scorer=scorer),
            tuple(TRAINING_METRICS),
            dataset="training",
        )
    model = load(model_path)
    report = _score_and_write(
        spark, model, validation, scored_path, "validation", arrays, scorer if arrays else "model"
    )
    return TrainReport(
        model, trained.unionByName(report.metrics), report.preview, report.scored
    )


def predict_job(
    spark: SparkSession,
    table: Source,
    *,
    model_path: str,
    scored_path: str,
    arrays: bool = False,
    scorer: str = "model",
) -> PredictReport:
    """Load a model, score a table, save the rows and report on them.

    ``arrays`` and ``scorer`` are those of ``train_job``.
    """
    return _score_and_write(spark, load(model_path), table, scored_path, "test", arrays, scorer)
