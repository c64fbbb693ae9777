"""Hourly and daily context features per borough, keyed (borough, datetime)."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from urbanspark.functions import rules
from urbanspark.functions.clean import lookup
from urbanspark.functions.holidays import add_holiday_flags
from urbanspark.functions.hours import SPINE_END, SPINE_START, from_hour_index, wall_clock
from urbanspark.operators.explore import first_per_key
from urbanspark.operators.intervals import active_counts, hourly_spine
from urbanspark.operators.tables import broadcast_within, inline_table

KEYS = ["borough", "datetime"]


def borough_table(spark: SparkSession, boroughs: list[str] | None = None) -> DataFrame:
    return inline_table(spark, ["borough"], [(b,) for b in boroughs or rules.BOROUGHS])


# --- schools -------------------------------------------------------------------------------------


def open_schools(schools: DataFrame) -> DataFrame:
    """Located, dated and not closed schools; a missing status means open."""
    status = F.coalesce("status", F.lit("Open"))
    return schools.filter(status == "Open").dropna(subset=["open_date", "lon", "lat"]).drop("status")


def open_schools_hourly(
    schools: DataFrame,
    start: datetime = SPINE_START,
    end: datetime = SPINE_END,
    hours: list[tuple[str, int, int]] = rules.SCHOOL_HOURS,
) -> DataFrame:
    """Open schools per borough and hour; ``schools`` has borough and category.

    Only counts per borough and opening times leave the school table; each hour then adds up the
    counts whose times cover it. Weekends are not excluded.
    """
    spark = schools.sparkSession
    times = inline_table(spark, ["category", "opens", "closes"], hours)
    counts = (
        schools.join(times, "category")
        .groupBy("borough", "opens", "closes")
        .agg(F.count("*").alias("n"))
        .groupBy("borough")
        .agg(F.collect_list(F.struct("opens", "closes", "n")).alias("groups"))
    )
    spine = hourly_spine(borough_table(spark).join(counts, "borough", "left"), start, end)
    hour = F.hour("datetime")
    open_now = F.aggregate(
        F.filter("groups", lambda g: (hour >= g["opens"]) & (hour < g["closes"])),
        F.lit(0).cast("bigint"),
        lambda total, g: total + g["n"],
    )
    in_term = F.month("datetime").isin(*rules.SCHOOL_MONTHS)
    return spine.select(*KEYS, F.when(in_term, F.coalesce(open_now, F.lit(0))).otherwise(0).cast("bigint").alias("open_schools"))


# --- businesses and events -----------------------------------------------------------------------


def open_businesses_hourly(
    licences: DataFrame,
    start: datetime = SPINE_START,
    end: datetime = SPINE_END,
    hours: list[tuple[str, int, int, bool]] = rules.INDUSTRY_HOURS,
) -> DataFrame:
    """Licensed and open businesses per borough and hour.

    ``licences`` has borough, industry, created and expires. A business counts in the hours of its
    licence, both ends included, that its industry is open: opening hour to closing hour inclusive,
    at weekends only where the industry works then. Industries without opening hours do not count.

    Industries with the same opening times are one key of the sweep line, so the hours expanded are
    boroughs x distinct opening times, not boroughs x industries.
    """
    spark = licences.sparkSession
    times = inline_table(spark, ["industry", "opens", "closes", "weekends"], hours)
    distinct_times = sorted({row[1:] for row in hours})
    keys = inline_table(
        spark,
        ["borough", "opens", "closes", "weekends"],
        [(borough, *row) for borough in rules.BOROUGHS for row in distinct_times],
    )
    active = active_counts(
        licences.select("borough", "industry", "created", "expires").join(times, "industry").drop("industry"),
        keys,
        "created",
        "expires",
        {"n": F.lit(1)},
        start,
        end,
    )
    hour = F.pmod("hour_no", F.lit(24))
    # Day 0 (1970-01-01) was a Thursday; Monday is 0.
    weekday = F.pmod(F.floor(F.col("hour_no") / 24) + 3, F.lit(7))
    is_open = (hour >= F.col("opens")) & (hour <= F.col("closes")) & (F.col("weekends") | (weekday < 5))
    return (
        active.groupBy("borough", "hour_no")
        .agg(F.sum(F.when(is_open, F.col("n")).otherwise(0)).alias("open_businesses"))
        .select("borough", from_hour_index(F.col("hour_no")).alias("datetime"), "open_businesses")
    )


def event_counts_hourly(events: DataFrame, start: datetime = SPINE_START, end: datetime = SPINE_END) -> DataFrame:
    """Running events, constructions and street closures per borough and hour, in one pass.

    ``events`` has borough, event_type, street_closure_type, start_ts and end_ts. A closure is an
    event whose closure type is present.
    """
    counters = {
        "num_events": F.lit(1),
        "num_constructions": F.coalesce((F.col("event_type") == "Construction").cast("int"), F.lit(0)),
        "num_street_closures": F.col("street_closure_type").isNotNull().cast("int"),
    }
    counts = active_counts(events, borough_table(events.sparkSession), "start_ts", "end_ts", counters, start, end)
    return counts.select("borough", from_hour_index(F.col("hour_no")).alias("datetime"), *counters)


# --- landmarks, weather, holidays ----------------------------------------------------------------


def landmark_summary(landmarks: DataFrame, areas: DataFrame) -> DataFrame:
    """Density, total length and number of landmarks per borough of ``areas`` (borough, area).

    ``landmarks`` has object_id, borough (two letters), length, area and a ``tie`` column that says
    which row of a repeated object comes first.
    """
    located = first_per_key(landmarks.dropna(subset=["borough"]), ["object_id"], ["tie"])
    named = located.withColumn("borough", lookup(F.col("borough"), rules.LANDMARK_BOROUGH, F.lit(None).cast("string")))
    totals = named.groupBy("borough").agg(
        F.sum("area").alias("total_area"), F.sum("length").alias("total_length"), F.count("*").alias("n")
    )
    return areas.join(totals, "borough", "left").select(
        "borough",
        (F.coalesce("total_area", F.lit(0.0)) / F.col("area")).alias("landmark_density"),
        F.coalesce("total_length", F.lit(0.0)).alias("total_landmark_length"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("total_landmarks"),
    )


def landmark_hourly(summary: DataFrame, start: datetime = SPINE_START, end: datetime = SPINE_END) -> DataFrame:
    """The landmark summary repeated for every hour."""
    spine = hourly_spine(summary, start, end)
    return spine.select(*KEYS, *[c for c in summary.columns if c != "borough"])


def weather_union(parts: dict[str, DataFrame]) -> DataFrame:
    """One weather table from one per borough; the column ``time`` becomes ``datetime``."""
    named = [df.withColumnRenamed("time", "datetime").withColumn("borough", F.lit(b)) for b, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def holidays_hourly(spark: SparkSession, start: datetime = SPINE_START, end: datetime = SPINE_END) -> DataFrame:
    """The five holiday flags per hour, the same in every borough."""
    return add_holiday_flags(hourly_spine(borough_table(spark), start, end), "datetime")


# --- assembly ------------------------------------------------------------------------------------


def merge_features(tables: list[DataFrame], keys: list[str] = KEYS) -> DataFrame:
    """Full outer join of tables that are each unique in ``keys``.

    Written as one union and one aggregation: with unique keys a column has at most one value per
    key, so ``max`` picks it. A chain of n full outer joins would shuffle n times, since the
    coalesced keys of one join are not known to be partitioned for the next.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    values = [c for c in stacked.columns if c not in keys]
    return stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in values])


def resample_daily(hourly: DataFrame, time: str = "datetime") -> DataFrame:
    """Daily means per borough; a day without rows between the first and last day is a null row."""
    values = [c for c in hourly.columns if c not in ("borough", time)]
    daily = hourly.groupBy("borough", F.to_date(time).alias("day")).agg(*[F.avg(c).alias(c) for c in values])
    next_day = F.lead("day").over(Window.partitionBy("borough").orderBy("day"))
    days = F.sequence(F.col("day"), F.coalesce(F.date_sub(next_day, 1), F.col("day")))
    filled = daily.withColumn("__days", days).withColumn("__day", F.explode("__days"))
    present = F.col("__day") == F.col("day")
    return filled.select("borough", F.col("__day").alias("day"), *[F.when(present, F.col(c)).alias(c) for c in values])


def feature_table_hourly(tables: list[DataFrame]) -> DataFrame:
    return merge_features(tables)


def write_store(hourly: DataFrame, path: str) -> DataFrame:
    """Store hourly features in folders by year and borough, one file each, and return the stored table.

    A ticket range then reads only the years and boroughs it needs (``prune_store``); features of a new year are a new folder.
    """
    dated = hourly.withColumn("year", F.year("datetime"))
    dated.repartition("year", "borough").write.partitionBy("year", "borough").parquet(path)
    return read_store(hourly.sparkSession, path)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def prune_store(store: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Stored hours with ``start <= datetime < end``; the years of the range are a filter on folders."""
    years = F.col("year").between(start.year, (end - timedelta(microseconds=1)).year)
    inside = (F.col("datetime") >= wall_clock(start)) & (F.col("datetime") < wall_clock(end))
    return store.filter(years & inside)


def needed_folders(rows: DataFrame, time: str, borough: str) -> DataFrame:
    """(year, borough) of the rows: at most years x boroughs rows, so a join on them prunes folders at run time."""
    return rows.select(F.year(time).alias("year"), F.col(borough).alias("borough")).distinct()


def read_needed(store: DataFrame, rows: DataFrame, time: str, borough: str) -> DataFrame:
    """Stored hours in the folders that ``rows`` touch, by dynamic partition pruning."""
    n_boroughs, years = len(rules.BOROUGHS) + 1, 10_000
    needed = broadcast_within(needed_folders(rows, time, borough), n_boroughs * years)
    return store.join(needed, ["year", "borough"], "left_semi")


def feature_table_daily(tables: list[DataFrame]) -> DataFrame:
    """Each table to daily means first, then merged on (borough, day)."""
    return merge_features([resample_daily(t) for t in tables], ["borough", "day"])


def daily_from_store(store: DataFrame) -> DataFrame:
    """Daily means of the stored hours: a mean leaves out missing hours, so merging first changes nothing but the number of shuffles."""
    return resample_daily(store.drop("year"))


