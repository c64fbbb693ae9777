"""How many intervals are active in each hour, by sweep line instead of a range join."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanspark.functions.hours import SPINE_END, SPINE_START, from_hour_index, hour_index, hour_index_up, hour_number


def hourly_spine(keys: DataFrame, start: datetime = SPINE_START, end: datetime = SPINE_END) -> DataFrame:
    """Every hour from ``start`` to ``end`` for every row of ``keys``; adds ``datetime``."""
    hours = F.sequence(F.lit(hour_number(start)), F.lit(hour_number(end)))
    return keys.withColumn("hour_no", F.explode(hours)).select(
        *keys.columns, from_hour_index(F.col("hour_no")).alias("datetime")
    )


def active_counts(
    intervals: DataFrame,
    keys: DataFrame,
    start: str,
    end: str,
    counters: dict[str, Column],
    spine_start: datetime = SPINE_START,
    spine_end: datetime = SPINE_END,
) -> DataFrame:
    """Counters per key and hour over the intervals with ``start <= hour <= end``.

    ``keys`` lists the distinct keys to report, each with every hour of the spine, zero where nothing
    is active. ``counters`` maps an output name to the weight one interval adds (1 or 0 to count).
    Intervals with a null end, or that contain no full hour of the spine, add nothing.

    Each interval becomes +w at its first hour and -w after its last, so the work is linear in the
    intervals, not in intervals x hours. Deltas are summed per (key, hour) before the window,
    with map-side partial sums: a key that holds most intervals still brings the window at most
    one row per hour of the spine. The gaps between change points are filled by ``explode(sequence)``,
    not by a join with the spine. Output columns: keys, ``hour_no``, counters.
    """
    names = keys.columns
    low, high = hour_number(spine_start), hour_number(spine_end)
    first = F.greatest(hour_index_up(F.col(start)), F.lit(low))
    last = F.least(hour_index(F.col(end)), F.lit(high))

    def change(hour: Column, sign: int) -> Column:
        weights = [(weight.cast("bigint") * sign).alias(name) for name, weight in counters.items()]
        return F.struct(hour.alias("hour_no"), *weights)

    deltas = (
        intervals.filter(F.col(start).isNotNull() & F.col(end).isNotNull())
        .join(keys, names, "left_semi")
        .withColumns({"__first": first, "__last": last})
        .filter("__first <= __last")
        .withColumn("__change", F.explode(F.array(change(F.col("__first"), 1), change(F.col("__last") + 1, -1))))
        .select(*names, "__change.*")
    )
    # One zero row per key opens the spine and keeps keys without intervals.
    opening = keys.select(
        *names, F.lit(low).cast("bigint").alias("hour_no"), *[F.lit(0).cast("bigint").alias(c) for c in counters]
    )
    summed = deltas.unionByName(opening).groupBy(*names, "hour_no").agg(*[F.sum(c).alias(c) for c in counters])
    by_key = Window.partitionBy(*names).orderBy("hour_no")
    running = by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    levels = summed.select(
        *names,
        "hour_no",
        F.lead("hour_no", 1, high + 1).over(by_key).alias("__next"),
        *[F.sum(c).over(running).alias(c) for c in counters],
    )
    return (
        levels.filter(f"hour_no <= {high}")
        .withColumn("hour_no", F.explode(F.sequence("hour_no", F.col("__next") - 1)))
        .drop("__next")
    )
