"""Live statistics as streaming queries, and the views over their sinks.

Sinks write one folder per micro-batch, ``epoch=<n>``, by overwriting it. A micro-batch that is run again
after a failure therefore replaces its own output and reads the same earlier state; with the stream's
checkpoint this gives each message exactly one effect.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from urbanspark.operators.explore import STATISTICS, mean_of_groups, stats_of_counts
from urbanspark.session import child_names, delete_folder, path_exists
from urbanspark.streaming.windows import (
    YEAR_CENTER,
    advance_state,
    fold_windows,
    live_columns,
    split_windows,
    stats_of_windows,
    usable_year,
)


def epochs(spark: SparkSession, folder: str) -> list[int]:
    """Epochs of a sink folder, oldest first, finished or not."""
    names = child_names(spark, folder)
    return sorted(int(n.split("=")[1]) for n in names if n.startswith("epoch="))


def read_epoch(spark: SparkSession, folder: str, before: int | None = None) -> DataFrame | None:
    """The newest finished epoch, or the newest one older than ``before``; None if there is none."""
    for epoch in reversed(epochs(spark, folder)):
        path = f"{folder}/epoch={epoch}"
        if (before is None or epoch < before) and path_exists(spark, f"{path}/_SUCCESS"):
            return spark.read.parquet(path)
    return None


def write_epoch(df: DataFrame, folder: str, epoch: int) -> None:
    df.write.mode("overwrite").parquet(f"{folder}/epoch={epoch}")


def forget_epochs(spark: SparkSession, folder: str, keep: int | None) -> None:
    """Delete all epochs of a sink folder older than the ``keep`` newest finished ones; with None all stay.

    A micro-batch that is run again reads the epoch before its own, so at least two are kept.
    """
    if keep is None:
        return
    if keep < 2:
        raise ValueError("a repeated micro-batch needs the epoch before its own: keep 2 or more")
    finished = [e for e in epochs(spark, folder) if path_exists(spark, f"{folder}/epoch={e}/_SUCCESS")]
    if len(finished) > keep:
        for epoch in epochs(spark, folder):
            if epoch < finished[-keep]:
                delete_folder(spark, f"{folder}/epoch={epoch}")


def start_month_stats(
    messages: DataFrame, group: str, sink: str, checkpoint: str, min_year: int = 2012, keep: int | None = None
) -> StreamingQuery:
    """Exact running statistics per month and group; each epoch holds the whole result table.

    State is one count per (month, group, vehicle year), so it grows with distinct values and not with messages;
    the statistics are read from the counts of a micro-batch. Source time never bounds it: a late
    ticket still belongs to its month, so there is no watermark.
    """
    live = live_columns(messages.filter(usable_year(min_year))).dropna(subset=[group])
    keys = ["year_month", group]
    counts = live.groupBy(*keys, F.col("vehicle_year_number").alias("__v")).agg(F.count("*").alias("__c"))

    def step(counted: DataFrame, epoch: int) -> None:
        known = counted.withColumn("__c", F.when(F.col("__v").isNotNull(), F.col("__c")).otherwise(0))
        write_epoch(stats_of_counts(known, keys, YEAR_CENTER), sink, epoch)
        forget_epochs(counted.sparkSession, sink, keep)

    return (
        counts.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(step)
        .start()
    )


ONE_PARTITION = "__partition"


def read_windows(
    batch: DataFrame, epoch: int, sink: str, offset: str, size: int, partition: str | None
) -> DataFrame:
    """Messages of a micro-batch with ``batch_no`` and ``whole``, after those carried over; writes what is carried now.

    The carry is less than one window per broker partition. The result is cached; the caller lets it go.
    """
    spark = batch.sparkSession
    rows = batch if partition else batch.withColumn(ONE_PARTITION, F.lit(0))
    key = partition or ONE_PARTITION
    carried, positions = read_epoch(spark, f"{sink}/carry", epoch), read_epoch(spark, f"{sink}/positions", epoch)
    numbered, reached = split_windows(rows, carried, positions, offset, size, key)
    numbered = numbered.persist()
    write_epoch(numbered.filter(~F.col("whole")).drop("batch_no", "whole"), f"{sink}/carry", epoch)
    write_epoch(reached, f"{sink}/positions", epoch)
    return numbered


def half_mean_batch(
    group: str, sink: str, offset: str, size: int, min_year: int = 2012, partition: str | None = None, keep: int | None = None
) -> Callable[[DataFrame, int], None]:
    """Micro-batch step of the windowed state: complete windows update it, the rest is carried over.

    The order of the windows is given inside a broker partition only, so each ``partition`` has a state of
    its own and the result does not depend on how the stream is cut into micro-batches. ``keep`` bounds the epochs of
    each sink folder, see ``forget_epochs``.
    """
    keys = [*([partition] if partition else []), "year_month", group]

    def step(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        numbered = read_windows(batch, epoch, sink, offset, size, partition)
        whole = numbered.filter("whole").drop("whole")
        folded = fold_windows(stats_of_windows(whole, group, size, min_year, partition), keys)
        before = read_epoch(spark, f"{sink}/state", epoch)
        if before is None:
            state = folded.select(*keys, *[F.col(v)["g"].alias(v) for v in STATISTICS])
        else:
            state = advance_state(before, folded, keys)
        write_epoch(state, f"{sink}/state", epoch)
        numbered.unpersist()
        for part in ("state", "carry", "positions"):
            forget_epochs(spark, f"{sink}/{part}", keep)

    return step


def start_half_mean(
    messages: DataFrame,
    group: str,
    sink: str,
    checkpoint: str,
    offset: str,
    size: int,
    min_year: int = 2012,
    partition: str | None = None,
    keep: int | None = None,
) -> StreamingQuery:
    """Windowed state (new = mean of old and window) kept by a stream; read with ``read_epoch(sink/state)``."""
    return (
        messages.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(half_mean_batch(group, sink, offset, size, min_year, partition, keep))
        .start()
    )


def merge_partitions(state: DataFrame, group: str) -> DataFrame:
    """State per month and group: unweighted mean over the states of the broker partitions."""
    return mean_of_groups(state, ["year_month", group])


def view_overall(state: DataFrame) -> DataFrame:
    """City view: unweighted mean over the groups of a month, in month order."""
    return mean_of_groups(state, ["year_month"]).orderBy("year_month")


def view_groups(state: DataFrame, group: str) -> DataFrame:
    """Borough or street view: the state in (month, group) order."""
    return state.orderBy("year_month", group)
