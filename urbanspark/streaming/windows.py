"""Count windows: statistics per window of N messages and the state folded over the windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanspark.functions import clean
from urbanspark.operators.explore import STATISTICS, count_values, stats_of_counts
from urbanspark.operators.ranks import global_row_number

# Vehicle years are summed around this year, see stats_of_counts.
YEAR_CENTER = 2000.0


def add_window_number(df: DataFrame, offset: str, size: int, partition: str | None = None) -> DataFrame:
    """Number of the count window a message falls in: ``size`` consecutive messages make one window.

    Offsets count per broker partition, so the windows of each ``partition`` are counted on their own; without
    the name all messages are of one partition. A message is placed by its rank, not by its offset, so
    offsets that are missing (compaction, transactions) leave no hole; one that was delivered more than
    once counts once. ``size`` offsets hold at most ``size`` messages, so no task sorts more than that at once.
    """
    keys = [partition] if partition else []
    once = df.dropDuplicates([*keys, offset]).withColumn("__slot", F.expr(f"`{offset}` div {size}"))
    placed = global_row_number(once, "__slot", F.expr("__slot div 1000"), [offset], "__place", keys)
    return placed.withColumn("batch_no", F.expr(f"__place div {size}")).drop("__slot", "__place")


def split_windows(
    batch: DataFrame, carried: DataFrame | None, positions: DataFrame | None, offset: str, size: int, partition: str
) -> tuple[DataFrame, DataFrame]:
    """Next step of the windows of a stream: (messages with their ``batch_no`` and ``whole``, new positions).

    ``carried`` are the messages of unfinished windows, ``positions`` one row per partition: finished windows and
    the greatest offset so far. A broker hands out the offsets of a partition in rising order, so a message at or
    below that offset is one that comes again, and is left out. Every other message is either in a whole
    window or, with ``whole`` false, to be carried.
    """
    rows = batch
    if positions is not None:
        rows = (
            batch.join(positions.select(partition, "__last"), partition, "left")
            .filter(F.col("__last").isNull() | (F.col(offset) > F.col("__last")))
            .drop("__last")
        )
    if carried is not None:
        rows = rows.unionByName(carried)
    numbered = add_window_number(rows, offset, size, partition)
    if positions is not None:
        numbered = numbered.join(positions.select(partition, "__done"), partition, "left")
    else:
        numbered = numbered.withColumn("__done", F.lit(0))
    numbered = numbered.withColumn("batch_no", F.col("batch_no") + F.coalesce("__done", F.lit(0))).drop("__done")
    inside = F.count("*").over(Window.partitionBy(partition, "batch_no"))
    numbered = numbered.withColumn("whole", inside == size)
    reached = numbered.groupBy(partition).agg(
        # The number of the open window is the number of finished ones.
        F.max(F.col("batch_no") + F.col("whole").cast("bigint")).alias("__done"),
        F.max(offset).alias("__last"),
    )
    if positions is not None:
        reached = positions.unionByName(reached).groupBy(partition).agg(
            F.max("__done").alias("__done"), F.max("__last").alias("__last")
        )
    return numbered, reached


def usable_year(min_year: int) -> Column:
    """A message counts if its vehicle year is usable and it was issued after ``min_year``."""
    issued = clean.to_date_or_null("issue_date")
    return F.coalesce(clean.is_usable_number("vehicle_year") & (F.year(issued) > min_year), F.lit(False))


def live_columns(messages: DataFrame) -> DataFrame:
    """Month, county code and street name of each message, as the live statistics group them."""
    combo = clean.street_combo("street_code1", "street_code2", "street_code3")
    return messages.withColumns(
        {
            "year_month": clean.month_period(clean.to_date_or_null("issue_date")),
            "violation_county": clean.county_live("violation_county"),
            "street": clean.street_name(combo),
            "vehicle_year_number": clean.to_number("vehicle_year"),
        }
    )


def window_stats(
    messages: DataFrame, group: str, offset: str, size: int, min_year: int = 2012, partition: str | None = None
) -> DataFrame:
    """Five statistics of the vehicle year per complete window, month and ``group``.

    ``group`` is ``violation_county`` or ``street``; messages without a group (streets outside the
    known list) do not count. A window with fewer than ``size`` messages is not complete and gives
    nothing. With ``partition`` the windows are those of each broker partition.
    """
    return stats_of_windows(add_window_number(messages, offset, size, partition), group, size, min_year, partition)


def stats_of_windows(
    numbered: DataFrame, group: str, size: int, min_year: int = 2012, partition: str | None = None
) -> DataFrame:
    """``window_stats`` of messages that have their ``batch_no``.

    Equal values are counted first, with unusable messages under a null key, so that the same counts tell
    whether a window is complete.
    """
    window = [partition, "batch_no"] if partition else ["batch_no"]
    keys = ["year_month", group]
    live = live_columns(numbered.withColumn("__usable", usable_year(min_year)))
    flagged = live.withColumn("__usable", F.col("__usable") & F.col(group).isNotNull())
    masked = flagged.select(
        *window,
        "__usable",
        *[F.when(F.col("__usable"), F.col(c)).alias(c) for c in [*keys, "vehicle_year_number"]],
    )
    counted = masked.groupBy(*window, "__usable", *keys, "vehicle_year_number").agg(F.count("*").alias("__rows"))
    whole = F.sum("__rows").over(Window.partitionBy(*window))
    kept = counted.withColumn("__whole", whole).filter((F.col("__whole") == size) & F.col("__usable"))
    values = kept.select(
        *window,
        *keys,
        F.col("vehicle_year_number").alias("__v"),
        F.when(F.col("vehicle_year_number").isNotNull(), F.col("__rows")).otherwise(0).alias("__c"),
    )
    return stats_of_counts(values, [*window, *keys], YEAR_CENTER)


def month_stats(messages: DataFrame, group: str, min_year: int = 2012) -> DataFrame:
    """Exact statistics per month and group over all messages, without windows."""
    usable = messages.filter(usable_year(min_year))
    live = live_columns(usable).dropna(subset=[group])
    return stats_of_counts(count_values(live, ["year_month", group], "vehicle_year_number"), ["year_month", group], YEAR_CENTER)


# --- state: new = mean(old, value) ---------------------------------------------------------------
#
# One window turns a state s into a*s + b, and starts a state g where there was none: a = 1/2, b = x/2,
# g = x for a value x; a = 1, b = 0, no g for a null. Such steps compose, so a long history can
# be folded in segments of bounded length, each a small sorted array.


def _step(value: Column) -> Column:
    value = value.cast("double")
    return F.struct(
        F.when(value.isNull(), 1.0).otherwise(0.5).alias("a"),
        F.coalesce(value / 2, F.lit(0.0)).alias("b"),
        value.alias("g"),
    )


def _compose(one: Column, two: Column) -> Column:
    return F.struct(
        (one["a"] * two["a"]).alias("a"),
        (two["a"] * one["b"] + two["b"]).alias("b"),
        F.coalesce(two["a"] * one["g"] + two["b"], two["g"]).alias("g"),
    )


def _fold(steps: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Compose the steps of each key in ``__order``."""
    identity = F.struct(
        F.lit(1.0).alias("a"), F.lit(0.0).alias("b"), F.lit(None).cast("double").alias("g")
    )
    ordered = steps.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("__order", *values))).alias("__steps"))

    def folded(v: str) -> Column:
        return F.aggregate("__steps", identity, lambda state, step: _compose(state, step[v])).alias(v)

    return ordered.select(*keys, *[folded(v) for v in values])


def fold_windows(
    stats: DataFrame, keys: list[str], order: str = "batch_no", values: list[str] | None = None, span: int = 1000, levels: int = 2
) -> DataFrame:
    """All windows of a key as one step (a, b, g) per value.

    Each level folds runs of ``span`` windows, so no array is longer than ``span`` up to span^(levels+1)
    windows, however many of them one key has.
    """
    values = values or STATISTICS
    steps = stats.select(*keys, F.col(order).alias("__order"), *[_step(F.col(v)).alias(v) for v in values])
    for _ in range(levels):
        segment = F.expr(f"__order div {span}").alias("__segment")
        steps = _fold(steps.withColumn("__segment", segment), [*keys, "__segment"], values).withColumnRenamed(
            "__segment", "__order"
        )
    return _fold(steps, keys, values)


def running_half_mean(stats: DataFrame, keys: list[str], order: str = "batch_no", values: list[str] | None = None) -> DataFrame:
    """State per key after all windows, when each window's value is averaged with the state before.

    Depends on the order: the last window weighs one half. Nulls leave the state as it is.
    """
    values = values or STATISTICS
    return fold_windows(stats, keys, order, values).select(*keys, *[F.col(v)["g"].alias(v) for v in values])


def advance_state(state: DataFrame, folded: DataFrame, keys: list[str], values: list[str] | None = None) -> DataFrame:
    """Apply folded windows to an earlier state (both one row per key)."""
    values = values or STATISTICS
    old = state.withColumnsRenamed({v: f"__old_{v}" for v in values})
    joined = old.join(folded, keys, "full")

    def advanced(v: str) -> Column:
        before, step = F.col(f"__old_{v}"), F.col(v)
        started = F.coalesce(step["a"] * before + step["b"], step["g"])
        return F.coalesce(started, before).alias(v)

    return joined.select(*keys, *[advanced(v) for v in values])
