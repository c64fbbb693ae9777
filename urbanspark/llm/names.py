"""Names of helper columns beside whatever columns a table has."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free_prefix(df: DataFrame) -> str:
    """The shortest run of two or more underscores that no column of ``df`` begins with, so names after it are new."""
    prefix = "__"
    while any(column.startswith(prefix) for column in df.columns):
        prefix += "_"
    return prefix
