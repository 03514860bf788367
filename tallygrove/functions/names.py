"""Column references that take a name literally."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def named(name: str) -> Column:
    """The column called exactly ``name``, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")
