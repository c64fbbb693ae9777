"""Exploratory aggregates: frequencies, statistics, histograms, cross tables, correlations.

Statistics that need order (median, quartiles) first count equal values. That count is an ordinary
hash aggregation with map-side partial sums, so a group that holds most of the rows costs no more
than its number of distinct values.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanspark.operators.quantiles import COUNT, VALUE, quantiles_of_counts
from urbanspark.operators.tables import materialize

STATISTICS = ["mean", "std", "median", "max", "min"]


def value_counts(df: DataFrame, *columns: str, name: str = "n") -> DataFrame:
    """Rows per value, nulls dropped, most frequent first; ties by value."""
    return (
        df.dropna(subset=list(columns))
        .groupBy(*columns)
        .agg(F.count("*").alias(name))
        .orderBy(F.desc(name), *columns)
    )


def top_k(df: DataFrame, *columns: str, k: int = 10, name: str = "n") -> DataFrame:
    """The k most frequent values; a heap per task, not a full sort."""
    return value_counts(df, *columns, name=name).limit(k)


def distinct_counts(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """Number of distinct non-null values per column, as rows (column, n_distinct)."""
    if approximate:
        row = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
        return row.unpivot([], columns, "column", "n_distinct")
    long = df.select(*[F.col(c).cast("string") for c in columns]).unpivot([], columns, "column", "value")
    # Distinct pairs first: the second count then sees each value once, whatever its frequency.
    return long.distinct().groupBy("column").agg(F.count("value").alias("n_distinct"))


def count_values(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows per key and value as (keys, ``__v``, ``__c``); a null value counts 0."""
    counted = df.select(*keys, F.col(value).cast("double").alias("__v")).groupBy(*keys, "__v").agg(F.count("*").alias("__c"))
    return counted.withColumn("__c", F.when(F.col("__v").isNotNull(), F.col("__c")).otherwise(0))


def stats_of_counts(counted: DataFrame, keys: list[str], center: float = 0.0) -> DataFrame:
    """Mean, sample deviation, exact median, max and min per key of a ``count_values`` table.

    ``center`` is any number near the values; squares are taken around it to keep their digits.
    A group of one value has a null deviation. The median's buffer holds the distinct values of a key, so this is for
    values of a bounded domain such as years; ``quantiles.box_per_key`` has no such buffer.
    """
    shifted, weight = F.col("__v") - F.lit(center), F.col("__c")
    sums = counted.groupBy(*keys).agg(
        F.sum(weight).alias("__n"),
        F.sum(shifted * weight).alias("__s"),
        F.sum(shifted * shifted * weight).alias("__q"),
        F.percentile("__v", F.lit(0.5), F.greatest(weight, F.lit(1).cast("bigint"))).alias("median"),
        F.max("__v").alias("max"),
        F.min("__v").alias("min"),
    )
    n, s, q = F.col("__n"), F.col("__s"), F.col("__q")
    size = F.nullif(n, F.lit(0))
    spread = F.greatest(q - s * s / size, F.lit(0.0)) / F.nullif(n - 1, F.lit(0))
    return sums.select(
        *keys,
        (F.lit(center) + s / size).alias("mean"),
        F.when(n > 1, F.sqrt(spread)).alias("std"),
        "median",
        "max",
        "min",
    )


def group_stats(df: DataFrame, keys: list[str], value: str, center: float = 0.0) -> DataFrame:
    """Mean, sample deviation, exact median, max and min of ``value`` per key; null keys are dropped."""
    return stats_of_counts(count_values(df.dropna(subset=keys), keys, value), keys, center)


def mean_of_groups(stats: DataFrame, keys: list[str]) -> DataFrame:
    """Unweighted mean over groups of each statistic: a second level, not a roll-up of the rows."""
    return stats.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in STATISTICS])


def histogram(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """Equal-width bins between the least and greatest value: (bin, low, high, n), empty bins included."""
    counted = (
        df.select(F.col(value).cast("double").alias("v")).dropna().groupBy("v").agg(F.count("*").alias("c"))
    )
    # Scalar subqueries over the same counts; Spark runs the counting exchange once and reuses it.
    low = counted.select(F.min("v")).scalar()
    high = counted.select(F.max("v")).scalar()
    position = (F.col("v") - F.col("low")) * bins / F.nullif(F.col("high") - F.col("low"), F.lit(0.0))
    placed = counted.withColumns({"low": low, "high": high}).select(
        "low", "high", "c", F.least(F.floor(F.coalesce(position, F.lit(0.0))), F.lit(bins - 1)).alias("bin")
    )
    filled = placed.groupBy("bin").agg(F.sum("c").alias("n"))
    return (
        df.sparkSession.range(bins)
        .withColumnRenamed("id", "bin")
        .join(filled, "bin", "left")
        .withColumns({"lo": low, "hi": high})
        .select(
            "bin",
            (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / bins).alias("low"),
            (F.col("lo") + (F.col("bin") + 1) * (F.col("hi") - F.col("lo")) / bins).alias("high"),
            F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
        )
    )


# Distinct values one task sorts when ranks are wanted.
VALUES_PER_RANGE = 1_000_000


def exact_quantiles(counted: DataFrame, probabilities: list[float]) -> list[float]:
    """Linear-interpolated quantiles of a table of value counts (v, c); NaN if it is empty."""
    renamed = counted.select(F.col("v").alias(VALUE), F.col("c").alias(COUNT))
    row = quantiles_of_counts(renamed, [], probabilities, VALUES_PER_RANGE).first()
    return list(row["quantiles"]) if row else [float("nan")] * len(probabilities)


def box_summary(df: DataFrame, value: str) -> DataFrame:
    """One row: quartiles, whiskers (extreme values within 1.5 IQR) and the number of outliers."""
    counted = materialize(
        df.select(F.col(value).cast("double").alias("v")).dropna().groupBy("v").agg(F.count("*").alias("c")),
        "value_counts",
    )
    q1, q2, q3 = exact_quantiles(counted, [0.25, 0.5, 0.75])
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    within = (F.col("v") >= low) & (F.col("v") <= high)
    return counted.agg(
        F.coalesce(F.sum("c"), F.lit(0)).cast("bigint").alias("n"),
        F.lit(q1).alias("q1"),
        F.lit(q2).alias("median"),
        F.lit(q3).alias("q3"),
        F.min(F.when(within, F.col("v"))).alias("whisker_low"),
        F.max(F.when(within, F.col("v"))).alias("whisker_high"),
        F.coalesce(F.sum(F.when(~within, F.col("c"))), F.lit(0)).cast("bigint").alias("n_outliers"),
    )


def crosstab(df: DataFrame, row: str, column: str, values: list | None = None, prefix: str = "") -> DataFrame:
    """Counts of ``row`` x ``column`` as a wide table, missing pairs 0. Null keys are dropped.

    Without ``values`` the column values are looked up first, bounded by ``spark.sql.pivotMaxValues``.
    """
    pairs = df.select(row, F.concat(F.lit(prefix), F.col(column).cast("string")).alias("__c")).dropna()
    names = [f"{prefix}{v}" for v in values] if values is not None else None
    return pairs.groupBy(row).pivot("__c", names).agg(F.count(F.lit(1))).na.fill(0)


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlations of complete rows as (a, b, r); one pass for all pairs."""
    complete = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).dropna()
    pairs = [(a, a) for a in columns] + list(combinations(columns, 2))
    cells = complete.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    rows = []
    for a, b in pairs:
        r = F.col(f"`{a}|{b}`")
        rows.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), r.alias("r")))
        if a != b:
            rows.append(F.struct(F.lit(b).alias("a"), F.lit(a).alias("b"), r.alias("r")))
    return cells.select(F.inline(F.array(*rows)))


def first_per_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row per key, the first in ``order`` (which should be total). Spark prunes to one row per
    key and task before the shuffle, so a hot key sends one row per task."""
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(ranked)).filter("__rank = 1").drop("__rank")
