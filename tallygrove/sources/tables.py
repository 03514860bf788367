"""Table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_table(
    spark: SparkSession,
    path: str | list[str],
    *,
    format: str = "csv",
    schema: StructType | str | None = None,
    sep: str = ",",
    quote: str = '"',
    mode: str = "FAILFAST",
) -> DataFrame:
    """Scan a table at any Hadoop URI (``s3a:``, ``hdfs:``, ``file:``, ...).

    CSV files have a header row. Without ``schema`` the types are inferred,
    which costs one extra pass over all the text; large inputs should declare
    theirs. A declared schema is checked against the header names, and text
    that does not parse as its declared type raises, as a column inferred as
    string would later on (``mode="PERMISSIVE"`` turns it into null instead).

    The result is lazy and splittable (no multi-line records), and both CSV
    and columnar scans read only the columns that the query goes on to use.
    """
    reader = spark.read.format(format)
    if schema is not None:
        reader = reader.schema(schema)
    if format == "csv":
        reader = reader.options(header=True, sep=sep, quote=quote)
        if schema is None:
            reader = reader.options(inferSchema=True)
        else:
            reader = reader.options(enforceSchema=False, mode=mode)
    return reader.load(path)
