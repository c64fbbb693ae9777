"""Writing datasets and small exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

from urbanspark.functions.clean import ascii_fold
from urbanspark.sources.readers import FORMATS
from urbanspark.sources.schema import TEXT_WIDTH, TEXT_WIDTHS


def write_dataset(
    df: DataFrame,
    target: str,
    fmt: str,
    mode: str = "errorifexists",
    partition_by: list[str] | None = None,
    table_path: str | None = None,
    widths: dict[str, int] | None = None,
) -> None:
    """Write as csv, parquet, fixed or table; ``target`` is a path, or a table name for table."""
    if fmt not in FORMATS:
        raise ValueError(f"Unsupported format: {fmt}")
    if fmt == "fixed":
        df = fixed_width(df, widths)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "table":
        if table_path is not None:
            writer = writer.option("path", table_path)
        writer.format("parquet").saveAsTable(target)
    elif fmt == "csv":
        writer.option("header", True).csv(target)
    else:
        writer.parquet(target)


def fixed_width(df: DataFrame, widths: dict[str, int] | None = None) -> DataFrame:
    """Text and times as ASCII cut to a fixed number of characters, numbers unchanged, null kept."""
    limits = {**TEXT_WIDTHS, **(widths or {})}
    columns = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        width = limits.get(field.name, TEXT_WIDTH)
        if isinstance(field.dataType, StringType):
            c = F.substring(ascii_fold(c), 1, width)
        elif isinstance(field.dataType, (DateType, TimestampType, TimestampNTZType)):
            c = F.substring(c.cast("string"), 1, width)
        columns.append(c.alias(field.name))
    return df.select(*columns)


def export_top(df: DataFrame, path: str, order: list, rows: int = 10) -> None:
    """The first rows as one small CSV file with a header."""
    df.orderBy(*order).limit(rows).coalesce(1).write.option("header", True).csv(path)


def write_sorted_by_time(df: DataFrame, path: str, time: str, partitions: int | None = None) -> None:
    """Range partitions in time order, each sorted, so that readers skip by file statistics."""
    by_range = df.repartitionByRange(*([partitions] if partitions else []), F.col(time))
    by_range.sortWithinPartitions(time).write.parquet(path)


def write_features(df: DataFrame, path: str) -> None:
    """Hourly features, one folder per borough."""
    df.repartition("borough").sortWithinPartitions("datetime").write.partitionBy("borough").parquet(path)
