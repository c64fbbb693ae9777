"""Wall-clock hours as whole numbers (hours since 1970), free of any time zone."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# The calendar of the hourly feature tables.
SPINE_START = datetime(2013, 1, 1)
SPINE_END = datetime(2024, 12, 31, 23)

_EPOCH = datetime(1970, 1, 1)


def hour_number(moment: datetime) -> int:
    """Hour number of a Python wall-clock time (rounded down)."""
    return int((moment - _EPOCH).total_seconds() // 3600)


def wall_clock(moment: datetime) -> Column:
    """A Python wall-clock time as a literal. Text, because a datetime literal would pass through time zones."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def hour_index(ts: Column) -> Column:
    """Hour number of a timestamp column, rounded down."""
    return F.unix_date(ts.cast("date")).cast("bigint") * 24 + F.hour(ts)


def hour_index_up(ts: Column) -> Column:
    """Hour number of a timestamp column, rounded up to the next full hour."""
    past_the_hour = (F.minute(ts) > 0) | (F.extract(F.lit("SECOND"), ts) > 0)
    return hour_index(ts) + F.when(past_the_hour, 1).otherwise(0)


def from_hour_index(index: Column) -> Column:
    """Wall-clock timestamp of an hour number."""
    epoch = F.lit(date(1970, 1, 1)).cast("timestamp_ntz")
    return epoch + F.make_dt_interval(hours=index.cast("int"))
