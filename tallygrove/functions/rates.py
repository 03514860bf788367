"""Classification metrics as aggregates over per-class counts (A1-A10).

The input has one row per class: ``labelled`` (rows with that label),
``predicted`` (rows given that class), ``hits`` (both) and ``total`` (all
rows). Weighted metrics average over the classes seen as labels; a class that
is predicted but never a label has weight zero.

Of an empty table the accuracy is NaN and every weighted metric is 0.0.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _precision() -> Column:
    return _ratio(F.col("hits"), F.col("predicted"))


def _recall() -> Column:
    return _ratio(F.col("hits"), F.col("labelled"))


def _false_positive_rate() -> Column:
    return _ratio(F.col("predicted") - F.col("hits"), F.col("total") - F.col("labelled"))


def _f_measure() -> Column:
    return _ratio(2 * _precision() * _recall(), _precision() + _recall())


def _accuracy() -> Column:
    return F.coalesce(F.sum("hits") / F.max("total"), F.lit(float("nan")))


def _weighted(rate: Callable[[], Column]) -> Callable[[], Column]:
    """Mean of a rate over classes, weighted by label frequency."""

    def mean() -> Column:
        share = _ratio(F.col("labelled"), F.col("total"))
        return F.coalesce(F.sum(share * rate()), F.lit(0.0))

    return mean


METRICS: dict[str, Callable[[], Column]] = {
    "accuracy": _accuracy,
    "weightedFalsePositiveRate": _weighted(_false_positive_rate),
    "weightedTruePositiveRate": _weighted(_recall),
    "weightedFMeasure": _weighted(_f_measure),
    "weightedPrecision": _weighted(_precision),
    "weightedRecall": _weighted(_recall),
    "f1": _weighted(_f_measure),
}
