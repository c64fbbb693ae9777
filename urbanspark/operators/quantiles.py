"""Exact quantiles per key by narrowing: no buffer per group, no sorted group, no list of all ranges.

Input is a table of value counts, one row per key and distinct value. A group with few distinct values is
ranked by one window. A larger one is cut into ``CUTS + 1`` ranges at approximate quantiles of its distinct
values; the totals of the ranges tell which of them hold a wanted rank, and only the rows of those go on to
the next round. A round leaves a wanted rank about 1/65 of its group, so 10^9 distinct values of one hot
group need two rounds to reach ranges that a task can sort. The cuts decide the effort only: ranks come
from exact totals.

Nulls are left out (a key with nulls only has null quantiles), NaN is the greatest value, equal values
share their ranks, null keys are a group, an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanspark.operators.tables import broadcast_within, materialize

# Distinct values that one task may sort.
SORTED_VALUES = 1_000_000
CUTS = 64
# Error of a cut, as one in so many distinct values of its range.
CUT_ACCURACY = 1000

PART, VALUE, COUNT = "__part", "__v", "__c"


def value_counts_per_key(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys, ``__v`` and ``__c``, written once; tasks count equal values before the shuffle."""
    counted = df.select(*[_named(k) for k in keys], F.col(value).cast("double").alias(VALUE)).groupBy(*map(_named, keys), VALUE)
    return materialize(counted.agg(F.count("*").alias(COUNT)), "value-counts")


def _named(column: str) -> Column:
    return F.col(f"`{column}`")


def _equal(keys: list[str], other: str = "__o_") -> Column:
    """Condition of a join on all keys, nulls equal, with the right side's columns under a prefix."""
    condition = F.lit(True)
    for k in keys:
        condition &= _named(k).eqNullSafe(_named(other + k))
    return condition


def _joined(rows: DataFrame, side: DataFrame, keys: list[str], n_side: int) -> DataFrame:
    """``rows`` with the columns of ``side`` (one row per key), broadcast if its number of rows allows it."""
    renamed = side.withColumnsRenamed({k: f"__o_{k}" for k in keys})
    return rows.join(broadcast_within(renamed, n_side), _equal(keys)).drop(*[f"__o_{k}" for k in keys])


def _wanted_places(counted: DataFrame, keys: list[str], probabilities: list[float]) -> DataFrame:
    """Keys, n, n_values and the two neighbouring ranks of every probability as ``places``."""
    sizes = counted.groupBy(*map(_named, keys)).agg(F.sum(COUNT).alias("__n"), F.count("*").alias("__values"))
    last = F.col("__n") - 1
    low = [F.floor(F.lit(float(p)) * last).cast("bigint") for p in probabilities]
    both = F.array_distinct(F.array(*low, *[F.least(place + 1, last) for place in low]))
    return sizes.withColumns({"__places": both, "__before": F.lit(0).cast("bigint"), PART: F.lit(0).cast("bigint")})


def _inside(before: Column, count: Column) -> Column:
    return F.filter("__places", lambda place: (place >= before) & (place < before + count))


def _ranked(rows: DataFrame, open_: DataFrame, keys: list[str], n_open: int) -> DataFrame:
    """Keys, place and value of the wanted ranks in ranges that a task can sort."""
    in_order = Window.partitionBy(*map(_named, keys), PART).orderBy(VALUE).rowsBetween(Window.unboundedPreceding, -1)
    side = open_.select(*map(_named, keys), PART, "__places", "__before")
    placed = _joined(rows.withColumn("__inner", F.coalesce(F.sum(COUNT).over(in_order), F.lit(0))), side, [*keys, PART], n_open)
    hits = placed.withColumn("__place", F.explode(_inside(F.col("__before") + F.col("__inner"), F.col(COUNT))))
    return hits.select(*map(_named, keys), "__place", VALUE)


def _narrowed(rows: DataFrame, open_: DataFrame, keys: list[str], n_open: int) -> tuple[DataFrame, DataFrame]:
    """Rows and ranges of the next round: each range cut, and the pieces kept that hold a wanted rank."""
    by = [*keys, PART]
    shares = [i / (CUTS + 1) for i in range(1, CUTS + 1)]
    cuts = rows.groupBy(*map(_named, by)).agg(F.percentile_approx(VALUE, shares, CUT_ACCURACY).alias("__cuts"))
    cut = _joined(rows, cuts, by, n_open * CUTS)
    piece = F.size(F.filter("__cuts", lambda low: low <= F.col(VALUE))).cast("bigint")
    cut = materialize(cut.withColumn("__piece", piece).drop("__cuts"), "quantile-pieces")
    totals = cut.groupBy(*map(_named, by), "__piece").agg(F.sum(COUNT).alias("__n"), F.count("*").alias("__values"))
    # At most CUTS + 1 rows per range.
    in_order = Window.partitionBy(*map(_named, by)).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    offset = totals.withColumn("__offset", F.coalesce(F.sum("__n").over(in_order), F.lit(0)))
    pieces = _joined(offset, open_.select(*map(_named, by), "__places", "__before"), by, n_open)
    pieces = pieces.withColumn("__before", F.col("__before") + F.col("__offset"))
    pieces = pieces.withColumn("__places", _inside(F.col("__before"), F.col("__n"))).filter("size(__places) > 0")
    kept = materialize(pieces.drop("__offset"), "quantile-ranges")
    code = F.col(PART) * (CUTS + 1) + F.col("__piece")
    left = _joined(cut, kept.select(*map(_named, by), "__piece"), [*by, "__piece"], kept.count())
    return materialize(left.withColumn(PART, code).drop("__piece"), "quantile-rows"), kept.withColumn(PART, code).drop("__piece")


def quantiles_of_counts(
    counted: DataFrame, keys: list[str], probabilities: list[float], sorted_values: int | None = None
) -> DataFrame:
    """One row per key of a ``value_counts_per_key`` table: keys and ``quantiles``, interpolated linearly."""
    some = counted.filter(F.col(VALUE).isNotNull())
    sizes = materialize(_wanted_places(some, keys, probabilities), "quantile-places")
    open_, rows, found = sizes, some.withColumn(PART, F.lit(0).cast("bigint")), None
    large = F.col("__values") > (sorted_values or SORTED_VALUES)
    while True:
        n_large, n_small = open_.agg(F.count_if(large), F.count_if(~large)).first()
        by = [*keys, PART]
        if n_small:
            small = open_.filter(~large)
            side = rows if not n_large else _joined(rows, small.select(*map(_named, by)), by, n_small)
            ranks = _ranked(side, small, keys, n_small)
            found = ranks if found is None else found.unionByName(ranks)
        if not n_large:
            break
        wide = open_.filter(large)
        rows, open_ = _narrowed(_joined(rows, wide.select(*map(_named, by)), by, n_large), wide, keys, n_large)
    if found is None:
        return counted.select(*map(_named, keys), F.array(F.lit(0.0)).alias("quantiles")).limit(0)
    # Two ranks per probability and key.
    entries = found.groupBy(*map(_named, keys)).agg(F.map_from_entries(F.collect_set(F.struct("__place", VALUE))).alias("__at"))
    every = sizes.select(*map(_named, keys), "__n")
    last = F.col("__n") - 1

    def quantile(p: float) -> Column:
        place = F.lit(float(p)) * last
        floor = F.floor(place).cast("bigint")
        low, high = F.col("__at")[floor], F.col("__at")[F.least(floor + 1, last)]
        return F.when(low == high, low).otherwise(low + (place - floor) * (high - low))

    known = _joined(every, entries, keys, 1 << 40)
    known = known.select(*map(_named, keys), F.array(*[quantile(p) for p in probabilities]).alias("quantiles"))
    if not keys:
        return known
    nulls = F.array(*[F.lit(None).cast("double") for _ in probabilities])
    groups = counted.select(*map(_named, keys)).distinct().withColumnsRenamed({k: f"__o_{k}" for k in keys})
    return groups.join(known, _equal(keys), "left").select(
        *[_named(f"__o_{k}").alias(k) for k in keys], F.coalesce("quantiles", nulls).alias("quantiles")
    )


def box_per_key(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Per key: n, q1, median, q3, whisker_low, whisker_high, n_outliers of ``value``; nulls are left out."""
    counted = value_counts_per_key(df, keys, value)
    quartiles = materialize(quantiles_of_counts(counted, keys, [0.25, 0.5, 0.75]), "quartiles")
    names = ["q1", "median", "q3"]
    sides = quartiles.select(*map(_named, keys), *[F.col("quantiles")[i].alias(name) for i, name in enumerate(names)])
    spread = 1.5 * (F.col("q3") - F.col("q1"))
    rows = _joined(counted, sides, keys, quartiles.count()).filter(F.col(VALUE).isNotNull() | F.col("median").isNull())
    within = (F.col(VALUE) >= F.col("q1") - spread) & (F.col(VALUE) <= F.col("q3") + spread)
    n = F.when(F.col(VALUE).isNotNull(), F.col(COUNT)).otherwise(0)
    return rows.groupBy(*map(_named, keys)).agg(
        F.sum(n).alias("n"),
        *[F.first(name).alias(name) for name in names],
        F.min(F.when(within, F.col(VALUE))).alias("whisker_low"),
        F.max(F.when(within, F.col(VALUE))).alias("whisker_high"),
        F.sum(F.when(~within, F.col(COUNT)).otherwise(0)).alias("n_outliers"),
    )
