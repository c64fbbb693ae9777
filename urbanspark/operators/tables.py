"""Small literal tables, written intermediates and size-checked broadcasts."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanspark.session import work_folder

# Largest side that is shipped to every executor.
BROADCAST_BYTES = 256 * 1024 * 1024
JIT_METHOD_BYTES = 8000


def inline_table(spark: SparkSession, columns: list[str], rows: list[tuple]) -> DataFrame:
    """A small literal table. It becomes a local relation of known size, so joins broadcast it by themselves."""
    table = pa.table({name: [row[i] for row in rows] for i, name in enumerate(columns)})
    return spark.createDataFrame(table)


def compute_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that later filters and projections use without evaluating them again.

    Filters on a computed column are pushed below the projection, with a copy of its expression
    each. A generator that yields one row per row is a step they are not pushed through.
    """
    added = F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()])))
    kept = [c for c in df.columns if c not in columns]
    return df.select(*[F.col(f"`{c}`") for c in kept], added)


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Let Spark fall back to split methods where a fused one is too long for the JVM to compile.

    The JVM interprets methods over 8000 bytes of bytecode, which wide projections easily reach.
    """
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, str(JIT_METHOD_BYTES))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def rows_a_batch(spark: SparkSession, rows: int) -> Iterator[None]:
    """Hand at most ``rows`` rows at a time to Python in the jobs run inside; Spark's default is 10,000, whatever a row holds."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None, rows_a_group: int | None = None) -> DataFrame:
    """Write to the shared work folder and read back: cuts lineage and survives lost executors.

    ``rows_a_group`` is for rows of about a megabyte. A writer closes a row group by its compressed bytes and holds a hundred rows before it
    first looks; a reader then unpacks thousands of rows of one group at a time. With few rows a group neither holds more than those.
    """
    spark = df.sparkSession
    path = work_folder(spark, name)
    writer = df.write
    if rows_a_group:
        writer = writer.option("parquet.block.row.count.limit", rows_a_group)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with compiled_methods(spark):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_bytes(df: DataFrame) -> int:
    """Rough width of a row in a hash table: 16 bytes per fixed-width value, 64 per other value."""
    fixed = ("bigint", "int", "double", "float", "boolean", "date", "timestamp_ntz", "timestamp", "smallint")
    return 32 + sum(16 if f.dataType.simpleString() in fixed else 64 for f in df.schema.fields)


def broadcast_within(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint if ``max_rows``, a proven bound, fits the limit; else leave the join to AQE."""
    if max_rows * row_bytes(df) <= BROADCAST_BYTES:
        return F.broadcast(df)
    return df
