"""Row numbers over a global order without one sorted task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def global_row_number(
    df: DataFrame, slot: str, block: Column, order: list[Column | str], name: str = "row_no", keys: list[str] | None = None
) -> DataFrame:
    """Number the rows from 0 by (``slot``, ``order``), on their own for each value of ``keys`` if there are any.

    ``slot`` is an ordered whole number with boundedly many rows each; ``block`` groups consecutive slots, a
    few thousand at a time. Offsets come from counts: blocks are accumulated over all blocks, slots
    inside their block, rows inside their slot. The rows themselves shuffle once, on ``slot``.
    """
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    keys = keys or []
    slots = df.groupBy(*keys, slot).agg(F.count("*").alias("__n")).withColumn("__block", block)
    blocks = slots.groupBy(*keys, "__block").agg(F.sum("__n").alias("__t"))
    over_blocks = Window.partitionBy(*keys).orderBy("__block") if keys else Window.orderBy("__block")
    block_offset = F.coalesce(F.sum("__t").over(before(over_blocks)), zero)
    slot_offset = F.coalesce(F.sum("__n").over(before(Window.partitionBy(*keys, "__block").orderBy(slot))), zero)
    offsets = (
        slots.withColumn("__inside", slot_offset)
        .join(blocks.select(*keys, "__block", block_offset.alias("__offset")), [*keys, "__block"])
        .select(*keys, slot, (F.col("__inside") + F.col("__offset")).alias("__before"))
    )
    inside = F.row_number().over(Window.partitionBy(*keys, slot).orderBy(*order))
    return df.join(offsets, [*keys, slot]).withColumn(name, F.col("__before") + inside - 1).drop("__before")


def time_slots(
    df: DataFrame, hour_no: str, time: str, spread_by: list[str], rows_per_slot: int = 1_000_000
) -> tuple[DataFrame, int]:
    """Add ``place``, the order inside an hour, and ``slot``, an hour number split along that order.

    Returns the frame and the number of splits per hour. The order is by second; rows of one second have no
    order of their own and get one from a hash, so a hot second spreads over many slots. ``place`` does not
    depend on the number of rows, so the order is the same at every size.
    """
    second = F.minute(time) * 60 + F.second(time)
    tie = F.pmod(F.xxhash64(*spread_by), F.lit(1 << 30)) / F.lit(float(1 << 30))
    fullest = df.groupBy(hour_no, second.alias("__second")).count().agg(F.max("count")).first()[0] or 1
    per_second = max(1, -(-fullest // rows_per_slot))
    placed = df.withColumn("place", second + tie)
    part = F.floor(F.col("place") * per_second)
    return placed.withColumn("slot", F.col(hour_no) * (3600 * per_second) + part), 3600 * per_second
