"""Fit, open, save and load the classifier."""

from __future__ import annotations

from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.sql import DataFrame

# The optimiser settings results are compared under.
SETTINGS = {"maxIter": 100, "regParam": 0.0, "elasticNetParam": 0.8}


def fit(df: DataFrame, *, partitions: int | None = None, **settings: Any) -> PipelineModel:
    """Fit a multinomial logistic regression on ``label`` and ``features``.

    ``settings`` are MLlib parameters that override or extend ``SETTINGS``.
    Labels are used as they are: the model has max label + 1 classes.

    MLlib makes two passes over ``df`` (statistics, then blocks of rows that
    it caches itself, spilling to disk), so ``df`` should not be cached as
    well. Each optimiser step is then one job over the cached blocks with a
    task per partition. A table read as very many small splits spends its
    steps on task launches: ``partitions`` merges the splits of an unshuffled
    ``df`` without a shuffle, to a few per executor core. For thousands of
    partitions, raise ``aggregationDepth`` to keep gradients off the driver.
    """
    if partitions is not None:
        df = df.coalesce(partitions)
    regression = LogisticRegression(**{**SETTINGS, **settings})
    return Pipeline(stages=[regression]).fit(df)


def classifier(model: PipelineModel) -> LogisticRegressionModel:
    """The fitted regression inside the pipeline (M4).

    Its ``summary`` (M6) exists until the model is saved and loaded.
    """
    return model.stages[0]


def linear_parts(model: PipelineModel) -> tuple[list[list[float]], list[float]]:
    """Weights (one row per margin) and intercepts of a fitted model.

    These are as many numbers as classes times features, all of which MLlib
    holds on the driver already. A binomial model has a single row.
    """
    fitted = classifier(model)
    return fitted.coefficientMatrix.toArray().tolist(), fitted.interceptVector.toArray().tolist()


def save(model: PipelineModel, path: str) -> None:
    """Save the pipeline in place of any earlier one (K2); failure raises."""
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
