"""From a raw table to clean labelled features."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from tallygrove.functions import named


def _missing(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """Names that ``df`` does not resolve, under the session's case rule."""
    sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    fold = str if sensitive else str.lower
    present = {fold(c) for c in df.columns}
    return [c for c in wanted if fold(c) not in present]


def _require(df: DataFrame, wanted: Sequence[str]) -> None:
    missing = _missing(df, wanted)
    if missing:
        hint = " (one column only: is the separator right?)" if len(df.columns) == 1 else ""
        raise ValueError(f"missing columns {missing}; the table has {df.columns}{hint}")


def _complete(df: DataFrame, names: Sequence[str]) -> Column:
    """No null and no NaN in any of the columns.

    Spelled per column, so that the null checks reach a columnar source as
    pushed filters, which ``na.drop`` does not.
    """
    tests = []
    for name in names:
        value = named(name)
        tests.append(value.isNotNull())
        if isinstance(df.schema[name].dataType, FloatType | DoubleType):
            tests.append(~F.isnan(value))
    return reduce(and_, tests)


def prepare_table(
    df: DataFrame,
    label: str,
    features: Sequence[str],
    *,
    label_as: str = "label",
    keep: Sequence[str] = (),
) -> DataFrame:
    """The clean flat table: label, then features in the given order.

    ``label`` is renamed to ``label_as``; a table that already has the new
    name only is taken as it is. Columns not named are discarded. A row is
    dropped if its label or any feature is null or NaN. ``keep`` carries
    further columns (row keys, say) through unchecked.
    """
    renamed_before = _missing(df, [label]) and not _missing(df, [label_as])
    source = label_as if renamed_before else label
    _require(df, [source, *features, *keep])
    wanted = df.select(
        named(source).alias(label_as),
        *(named(f).alias(f) for f in features),
        *(named(k).alias(k) for k in keep),
    )
    return wanted.where(_complete(wanted, [label_as, *features]))


def assemble(
    df: DataFrame,
    features: Sequence[str],
    *,
    label: str = "label",
    out: str = "features",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Label and one dense vector of ``features`` widened to double.

    Null or NaN features raise, and so do columns that are not numeric.
    """
    assembler = VectorAssembler(inputCols=list(features), outputCol=out)
    return assembler.transform(df).select(label, out, *keep)
