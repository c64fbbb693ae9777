"""Conversions between formats."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from urbanspark.session import child_names, path_exists
from urbanspark.sources.readers import read_dataset
from urbanspark.sources.schema import TICKET_COLUMNS, struct_of
from urbanspark.sources.writers import write_dataset


def read_ticket_csv(spark: SparkSession, path: str) -> DataFrame:
    """Ticket CSV with any header: the 43 columns get their names by position, then their types.

    Read as text and converted with ``try_cast``, so a bad value becomes null and not a lost row.
    """
    text = struct_of([(name, "string") for name, _ in TICKET_COLUMNS])
    raw = spark.read.schema(text).option("header", True).option("enforceSchema", True).csv(path)
    return raw.select(*[F.col(f"`{name}`").try_cast(t).alias(name) for name, t in TICKET_COLUMNS])


def convert_ticket_files(spark: SparkSession, csv_folder: str, parquet_folder: str) -> list[str]:
    """Each ``<year>.csv`` to ``<year>.parquet``; targets that exist are left alone. Returns new names."""
    converted = []
    for name in child_names(spark, csv_folder):
        if not name.endswith(".csv"):
            continue
        target = f"{parquet_folder}/{name.split('.')[0]}.parquet"
        if path_exists(spark, f"{target}/_SUCCESS"):
            continue
        # A folder without the success mark is left over from a job that was lost: write it again.
        read_ticket_csv(spark, f"{csv_folder}/{name}").write.mode("overwrite").parquet(target)
        converted.append(target.rsplit("/", 1)[1])
    return converted


def create_merged_table(spark: SparkSession, table: str, paths: list[str], table_path: str | None = None) -> DataFrame:
    """One table from many Parquet datasets whose schemas are merged by column name."""
    merged = spark.read.option("mergeSchema", True).parquet(*paths)
    write_dataset(merged, table, "table", table_path=table_path)
    return spark.table(table)


@dataclass
class RawDataset:
    """A raw file family to convert; ``schema`` fixes the types of a CSV input."""

    name: str
    path: str
    schema: StructType
    widths: dict[str, int] = field(default_factory=dict)


def convert_raw(
    spark: SparkSession, datasets: list[RawDataset], target: str, table_prefix: str
) -> dict[tuple[str, str], str]:
    """Convert every raw CSV dataset to parquet, fixed and table. Returns (name, format) -> location."""
    written = {}
    for dataset in datasets:
        df = read_dataset(spark, dataset.path, "csv", schema=dataset.schema)
        safe = dataset.name.replace(" ", "_")
        for fmt in ("parquet", "fixed"):
            location = f"{target}/{fmt}/{safe}.parquet"
            write_dataset(df, location, fmt, widths=dataset.widths)
            written[dataset.name, fmt] = location
        table = f"{table_prefix}_{safe}"
        write_dataset(df, table, "table", table_path=f"{target}/table/{safe}")
        written[dataset.name, "table"] = table
    return written
