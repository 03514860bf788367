"""Evaluation as relations over confusion counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrove.functions import METRICS


def _required(name: str) -> Column:
    """A class number: an error for null and for anything but a whole number."""
    value = F.col(name).cast("double")
    return F.coalesce(
        F.when(value.isNull() | (value == F.floor(value)), value).otherwise(
            F.raise_error(F.lit(f"{name} is not a class number in a scored row")).cast("double")
        ),
        F.raise_error(F.lit(f"{name} is null in a scored row")).cast("double"),
    )


def confusion(
    df: DataFrame, *, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Rows per ``(label, prediction)`` pair (A0): the one pass over the data.

    Counting starts before the shuffle, so a task sends at most one row per
    pair however the rows are spread over classes. A null on either side
    raises instead of being counted as a class of its own.
    """
    pairs = df.select(_required(label).alias("label"), _required(prediction).alias("prediction"))
    return pairs.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("count"))


def per_class(counts: DataFrame) -> DataFrame:
    """``class, labelled, predicted, hits`` from confusion counts.

    Each pair counts once for its label and once for its prediction, so no
    join of the two sides is needed.
    """
    hit = F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(F.lit(0))
    zero = F.lit(0).cast("long")

    def side(name: str, labelled: Column, predicted: Column, hits: Column) -> Column:
        return F.struct(
            F.col(name).alias("class"),
            labelled.alias("labelled"),
            predicted.alias("predicted"),
            hits.alias("hits"),
        )

    sides = F.array(
        side("label", F.col("count"), zero, hit), side("prediction", zero, F.col("count"), zero)
    )
    return (
        counts.select(F.inline(sides))
        .groupBy("class")
        .agg(*(F.sum(c).alias(c) for c in ("labelled", "predicted", "hits")))
    )


def metrics(
    counts: DataFrame, names: Sequence[str] = tuple(METRICS), *, dataset: str | None = None
) -> DataFrame:
    """``metric, value`` rows (K4) from confusion counts, in the order of ``names``.

    ``dataset`` prepends a column of that value.
    """
    # The total is a scalar of its own aggregate: no task sees the rows of all classes.
    classes = per_class(counts)
    totalled = classes.withColumn("total", classes.agg(F.sum("labelled")).scalar())
    wide = totalled.agg(*(METRICS[name]().alias(name) for name in names))
    entries = F.array(
        *(F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names)
    )
    long = wide.select(F.inline(entries))
    if dataset is None:
        return long
    return long.select(F.lit(dataset).alias("dataset"), "metric", "value")
