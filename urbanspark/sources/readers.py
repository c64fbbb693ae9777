"""Reading datasets: one entry point for all formats, with column, year and sample selection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from urbanspark.session import child_names

FILE_FORMATS = ("csv", "parquet", "fixed")
FORMATS = (*FILE_FORMATS, "table")
NO_FILES = "No files found for the specified years."


def read_dataset(
    spark: SparkSession,
    path: str,
    fmt: str,
    columns: list[str] | None = None,
    years: list[int] | None = None,
    fraction: float | None = None,
    schema: StructType | None = None,
    seed: int = 0,
) -> DataFrame:
    """Read a dataset as csv, parquet, fixed (fixed-width text in Parquet) or table.

    Columns, years and the sample apply to every format. A folder written by ``partitionBy("year")``
    prunes partitions; in a folder of loose files a file is read if its name contains one of the years.
    A table is pruned by its ``year`` column.
    """
    if fmt not in FORMATS:
        raise ValueError(f"Invalid file format. Please use one of {list(FORMATS)}.")
    if fmt == "table":
        df = spark.table(path)
        if years is not None:
            df = df.filter(F.col("year").isin(*years))
    else:
        df = _read_files(spark, path, fmt, years, schema)
    if columns is not None:
        df = df.select(*[F.col(f"`{c}`") for c in columns])
    if fraction is not None:
        df = df.sample(fraction=fraction, seed=seed)
    return df


def _read_files(
    spark: SparkSession, path: str, fmt: str, years: list[int] | None, schema: StructType | None
) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).format("csv")
    else:
        reader = reader.format("parquet").option("mergeSchema", schema is None)
    if years is None:
        return reader.load(path)
    if any(name.startswith("year=") for name in child_names(spark, path)):
        df = reader.load(path).filter(F.col("year").isin(*years))
        return df
    # One glob with all years: a name that contains two of them is still read once.
    glob = f"{path.rstrip('/')}/*{{{','.join(str(y) for y in years)}}}*"
    try:
        return reader.load(glob)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise ValueError(NO_FILES) from error
        raise


def spread_scan(df: DataFrame) -> DataFrame:
    """Repartition a scan that has fewer parts than the cluster has cores; a large scan is left alone.

    For a scan only: the partition count of a plan with shuffles would have to run it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def read_union(spark: SparkSession, paths: list[str], fmt: str, columns: list[str] | None = None) -> DataFrame:
    """Union of several datasets by column name; a column that a part lacks is null there."""
    parts = [read_dataset(spark, p, fmt) for p in paths]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return merged if columns is None else merged.select(*[F.col(f"`{c}`") for c in columns])


def reservoir_sample(df: DataFrame, fraction: float, seed: int = 0, slots: int = 100_000) -> DataFrame:
    """A random sample of exactly ``round(fraction * rows)`` rows.

    Every row draws a number and falls in one of ``slots`` equal parts of its range. The counts per slot
    (a small table) tell which slots are taken whole; only in the last one are rows ranked. ``df``
    is read twice and not shuffled; it should be a scan, so that both reads draw the same numbers.
    """
    drawn = df.withColumn("__draw", F.rand(seed)).withColumn("__slot", F.floor(F.col("__draw") * slots))
    counts = {r["__slot"]: r["count"] for r in drawn.groupBy("__slot").count().collect()}  # one row per slot
    wanted, last = round(fraction * sum(counts.values())), 0
    while last in range(slots) and counts.get(last, 0) <= wanted:
        wanted -= counts.get(last, 0)
        last += 1
    whole = drawn.filter(F.col("__slot") < last)
    rest = drawn.filter(F.col("__slot") == last).orderBy("__draw").limit(wanted)
    return whole.unionByName(rest).select(*df.columns)


def hash_sample(df: DataFrame, keys: list[str], fraction: float) -> DataFrame:
    """A sample that depends only on the key values, so it is the same on every run and every layout."""
    steps = 1_000_000
    return df.filter(F.pmod(F.xxhash64(*keys), F.lit(steps)) < int(fraction * steps))
