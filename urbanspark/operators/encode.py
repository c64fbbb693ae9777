"""One-hot columns, scaling, constant columns and the split by time."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from urbanspark.functions.hours import wall_clock
from urbanspark.operators.tables import broadcast_within


def one_hot_fixed(df: DataFrame, levels: dict[str, list[str]]) -> DataFrame:
    """Replace each column by 0/1 columns for its listed levels except the first.

    Values outside the list, and nulls, give zeros everywhere. Values compare as text, so a numeric
    code matches its text level.
    """
    flags = {
        f"{column}_{level}": F.coalesce((F.col(column).cast("string") == level).cast("int"), F.lit(0))
        for column, values in levels.items()
        for level in values[1:]
    }
    return df.withColumns(flags).drop(*levels)


def one_hot(df: DataFrame, column: str, levels: list[str] | None = None) -> DataFrame:
    """Replace a column by one 0/1 column per level: the given ones, or those found in the data, which is then read.

    A table can only have so many columns; where a column has many levels, ``design.dictionary`` codes it in one number.
    """
    if levels is None:
        levels = [row["v"] for row in df.select(F.col(column).cast("string").alias("v")).dropna().distinct().orderBy("v").collect()]
    text = F.col(column).cast("string")
    flags = {f"{column}_{v}": F.coalesce((text == v).cast("int"), F.lit(0)) for v in levels}
    return df.withColumns(flags).drop(column)


# Columns aggregated together. More would make one generated method too long for the JVM to compile;
# the groups read their own columns of a columnar file, so the data is still read once.
COLUMNS_PER_PASS = 40


def _per_column(df: DataFrame, columns: list[str], aggregate) -> dict[str, object]:
    """One aggregate per column, one value per column on the driver."""
    found = {}
    for start in range(0, len(columns), COLUMNS_PER_PASS):
        part = columns[start : start + COLUMNS_PER_PASS]
        found.update(df.agg(*[aggregate(F.col(f"`{c}`")).alias(c) for c in part]).first().asDict())
    return found


def constant_columns_by_distinct(df: DataFrame, columns: list[str]) -> list[str]:
    """Columns with exactly one distinct non-null value. Equal min and max say so in one pass,
    without a distinct count; an all-null column has no value and is not constant."""
    same = _per_column(df, columns, lambda c: F.min(c) == F.max(c))
    return [c for c in columns if same[c]]


def constant_columns_by_deviation(df: DataFrame, columns: list[str]) -> list[str]:
    """Columns whose standard deviation is zero or undefined. The deviation is positive exactly when
    the least and the greatest value differ, and those two are the cheapest aggregates there are."""
    varies = _per_column(df, columns, lambda c: F.min(c) < F.max(c))
    return [c for c in columns if not varies[c]]


def column_moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean and sample deviation per column as rows (column, mean, std), in one pass."""
    cells = [
        F.struct(F.lit(c).alias("column"), F.avg(f"`{c}`").alias("mean"), F.stddev_samp(f"`{c}`").alias("std"))
        for c in columns
    ]
    return df.agg(F.array(*cells).alias("rows")).select(F.inline("rows"))


def split_by_time(df: DataFrame, time: str, test_from: datetime) -> tuple[DataFrame, DataFrame]:
    """Training rows before the moment, test rows from it on."""
    moment = wall_clock(test_from)
    return df.filter(F.col(time) < moment), df.filter(F.col(time) >= moment)


def fit_scaler(train: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column; a zero deviation divides by 1."""
    aggregates = [f(F.col(c).cast("double")).alias(f"{c}|{n}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))]
    row = train.agg(*aggregates).first()
    return {c: (row[f"{c}|m"] or 0.0, row[f"{c}|s"] or 1.0) for c in columns}


def apply_scaler(df: DataFrame, scaler: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c).cast("double") - mean) / deviation for c, (mean, deviation) in scaler.items()})


def scale_per_group(df: DataFrame, group: str | list[str], columns: list[str]) -> DataFrame:
    """Standard scores within each group (population deviation); groups are count windows, so bounded."""
    by_group = Window.partitionBy(group)
    return df.withColumns(
        {
            c: (F.col(c).cast("double") - F.avg(c).over(by_group))
            / F.coalesce(F.nullif(F.stddev_pop(c).over(by_group), F.lit(0.0)), F.lit(1.0))
            for c in columns
        }
    )


def label_dictionary(first_window: DataFrame, columns: list[str]) -> DataFrame:
    """Codes from 0 in sorted order of the values of each column: (column, value, code)."""
    long = first_window.select(*[F.col(c).cast("string") for c in columns]).unpivot([], columns, "column", "value")
    by_column = Window.partitionBy("column").orderBy("value")
    return long.dropna().distinct().withColumn("code", F.row_number().over(by_column) - 1)


def encode_labels(df: DataFrame, dictionary: DataFrame, columns: list[str]) -> DataFrame:
    """Replace values by their codes; a value the dictionary lacks becomes -1.

    The dictionary of one count window has at most window x columns rows; it is counted before it is broadcast.
    """
    n = dictionary.count()
    for c in columns:
        codes = dictionary.filter(F.col("column") == c).select(
            F.col("value").alias("__value"), F.col("code").alias("__code")
        )
        df = (
            df.join(broadcast_within(codes, n), F.col(c).cast("string") == F.col("__value"), "left")
            .withColumn(c, F.coalesce("__code", F.lit(-1)))
            .drop("__value", "__code")
        )
    return df


