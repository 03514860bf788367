"""Where results go."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, Row


def write_scored(df: DataFrame, path: str) -> None:
    """Write scored rows as Parquet in place of any earlier output (K1).

    One write per input partition, no shuffle. A failed write raises.
    """
    df.write.mode("overwrite").parquet(path)


def preview(
    df: DataFrame,
    n: int = 5,
    *,
    columns: Sequence[str] = ("features", "label", "prediction"),
    order_by: Sequence[str] = (),
) -> DataFrame:
    """The first ``n`` scored rows (K3, R6); show with ``truncate=False``.

    With ``order_by`` the choice of rows is repeatable, and Spark keeps a
    bounded top-n per task instead of sorting the table.
    """
    if order_by:
        df = df.orderBy(*order_by)
    return df.select(*columns).limit(n)


def report_lines(rows: Iterable[Row], names: Mapping[str, str]) -> Iterator[str]:
    """``name: value`` lines (K4) in the order of ``names``, which maps metric
    to printed name; ``rows`` are those of one dataset's metric table."""
    values = {row["metric"]: row["value"] for row in rows}
    return (f"{shown}: {values[metric]}" for metric, shown in names.items())
