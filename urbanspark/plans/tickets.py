"""Ticket tables for the two prediction tasks, and the street analysis."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanspark.functions import clean, rules
from urbanspark.functions.clean import to_timestamp_or_null, to_timestamp_strict
from urbanspark.functions.hours import wall_clock
from urbanspark.operators.encode import (
    constant_columns_by_distinct,
    one_hot,
    split_by_time,
)
from urbanspark.operators.explore import first_per_key, top_k
from urbanspark.operators.design import Design, Moments, code_fixed, fit_design
from urbanspark.operators.geo import interpolate_house
from urbanspark.operators.tables import broadcast_within, compute_once, materialize
from urbanspark.plans.features import prune_store

START, END, TEST = datetime(2014, 1, 1), datetime(2024, 1, 1), datetime(2023, 1, 1)


def in_range(df: DataFrame, time: str, start: datetime, end: datetime) -> DataFrame:
    """Rows with ``start <= time < end``."""
    return df.filter((F.col(time) >= wall_clock(start)) & (F.col(time) < wall_clock(end)))


def parse_dates(strict: bool):
    return to_timestamp_strict if strict else to_timestamp_or_null


def tickets_per_day(tickets: DataFrame, start: datetime = START, end: datetime = END, strict: bool = False) -> DataFrame:
    """Tickets per day and borough; rows of an unknown county are dropped."""
    cleaned = {
        "issue_date": parse_dates(strict)("issue_date"),
        "violation_county": clean.county_clean("violation_county"),
    }
    dated = compute_once(tickets.select("issue_date", "violation_county"), cleaned)
    kept = in_range(dated, "issue_date", start, end).filter(F.col("violation_county") != "-")
    return kept.groupBy(F.to_date("issue_date").alias("issue_date"), "violation_county").agg(F.count("*").alias("tickets"))


def join_daily(per_day: DataFrame, daily: DataFrame) -> DataFrame:
    """Left join of daily ticket counts with daily borough features."""
    renamed = daily.withColumnsRenamed({"borough": "violation_county", "day": "issue_date"})
    return per_day.join(renamed, ["violation_county", "issue_date"], "left")


def daily_ticket_features(
    tickets: DataFrame, daily: DataFrame, start: datetime = START, end: datetime = END, strict: bool = False
) -> DataFrame:
    """Regression set: tickets per day and borough with features, county one-hot, no constant columns."""
    joined = join_daily(tickets_per_day(tickets, start, end, strict), daily)
    table = materialize(one_hot(joined, "violation_county", sorted(rules.BOROUGHS)), "daily_features")
    inputs = [c for c in table.columns if c not in ("issue_date", "tickets")]
    return table.drop(*constant_columns_by_distinct(table, inputs))


def clean_tickets(tickets: DataFrame, start: datetime = START, end: datetime = END, strict: bool = False) -> DataFrame:
    """Cleaned tickets with an exact ``issue_time``; unreadable times and unknown counties are dropped.

    Needs issue_date, violation_time and violation_county; other known columns are cleaned if present.
    """
    # One step per long expression: a step is one generated method, and the JVM compiles only methods
    # of limited size. A null hour or date gives a null time, which the range drops.
    time = clean.issue_time(parse_dates(strict)("issue_date"), clean.clock_hour("violation_time"))
    timed = compute_once(tickets, {"issue_time": time}).drop("violation_time", "issue_date")
    located = compute_once(timed, {"violation_county": clean.county_clean("violation_county")})
    cleaned = in_range(located, "issue_time", start, end).filter(F.col("violation_county") != "-")
    steps = {
        "vehicle_body_type": clean.body_type_spelling("vehicle_body_type"),
        "from_hours_in_effect": clean.hour_in_effect("from_hours_in_effect", 0),
        "to_hours_in_effect": clean.hour_in_effect("to_hours_in_effect", 24),
    }
    for column, rule in steps.items():
        if column in tickets.columns:
            cleaned = compute_once(cleaned, {column: rule})
    last = {
        "vehicle_body_type": clean.keep_listed("vehicle_body_type", rules.BODY_TYPES, "other"),
        "vehicle_make": clean.make_initial("vehicle_make"),
        "plate_type": clean.plate_type("plate_type"),
    }
    return cleaned.withColumns({c: rule for c, rule in last.items() if c in tickets.columns})


def join_hourly(cleaned: DataFrame, store: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Left join of tickets with the stored borough features of their exact hour.

    Only the years of the ticket range are read. The feature side is unique in (borough, hour) and is cut to the known
    boroughs, so boroughs x hours bounds its rows. Within the limit it is broadcast and the tickets do not move; a longer range falls
    back to a shuffle join.
    """
    hours = int((end - start).total_seconds() // 3600)
    side = prune_store(store, start, end).filter(F.col("borough").isin(*rules.BOROUGHS)).drop("year")
    side = side.withColumnsRenamed({"borough": "violation_county", "datetime": "issue_time"})
    return cleaned.join(
        broadcast_within(side, hours * len(rules.BOROUGHS)), ["violation_county", "issue_time"], "left"
    )


@dataclass(frozen=True)
class StateSet:
    """The classification set: a coded table with ``issue_time`` and ``label``, which of its inputs vary in training, and their moments."""

    table: DataFrame
    design: Design
    moments: Moments
    test_from: datetime

    def parts(self) -> tuple[DataFrame, DataFrame]:
        return split_by_time(self.table, "issue_time", self.test_from)

    def wide(self, columns: list[str] | None = None) -> DataFrame:
        """One column per input that varies, made on the way out; the stored table stays narrow."""
        every = self.design.expressions()
        return self.table.select("issue_time", "label", *[every[c].alias(c) for c in columns or every])


def state_features(
    tickets: DataFrame,
    store: DataFrame,
    start: datetime = START,
    end: datetime = END,
    test_from: datetime = TEST,
    strict: bool = False,
    levels: dict[str, list[str]] = rules.CATEGORY_LEVELS,
) -> StateSet:
    """Classification set, one row per ticket: label 1 for vehicles of the home state, numbers (null is 0) and one code
    per categorical column, whose first listed level is the base. Inputs that are constant in the training part are left out."""
    joined = join_hourly(clean_tickets(tickets, start, end, strict), store, start, end)
    timed = clean.add_cyclic_time(joined, "issue_time")
    numeric = [c for c in timed.columns if c not in ("issue_time", "registration_state", *levels)]
    coded = timed.select(
        "issue_time",
        F.coalesce((F.col("registration_state") == "NY").cast("int"), F.lit(0)).alias("label"),
        *[F.coalesce(F.col(f"`{c}`").cast("float"), F.lit(0.0).cast("float")).alias(c) for c in numeric],
        *[code_fixed(F.col(f"`{c}`"), values[1:]).alias(c) for c, values in levels.items()],
    )
    # Written once: the constant check, the fit and the scoring all read it.
    table = materialize(coded, "state_features")
    train, _ = split_by_time(table, "issue_time", test_from)
    design, moments = fit_design(train, Design(numeric, {c: values[1:] for c, values in levels.items()}))
    return StateSet(table, design, moments, test_from)


# --- streets -------------------------------------------------------------------------------------


def with_street_codes(tickets: DataFrame) -> DataFrame:
    """Rows with a post code and three non-zero street codes."""
    return tickets.filter(
        F.col("violation_post_code").isNotNull()
        & (F.col("street_code1") != 0)
        & (F.col("street_code2") != 0)
        & (F.col("street_code3") != 0)
    )


def top_streets(tickets: DataFrame, k: int = 20) -> DataFrame:
    keys = ["street_code1", "street_code2", "street_code3", "violation_post_code"]
    return top_k(with_street_codes(tickets), *keys, k=k)


def with_combo(df: DataFrame) -> DataFrame:
    codes = ["street_code1", "street_code2", "street_code3"]
    return df.withColumn("street_code", clean.street_combo(*codes)).drop(*codes)


def name_streets(streets: DataFrame, tickets: DataFrame, order: list[str]) -> DataFrame:
    """Each street with one name from the tickets: the first in ``order``, "W " spelled out.

    The names left are at most one per listed street. A short list is broadcast by Spark's own size check.
    """
    listed = with_combo(streets)
    names = with_combo(tickets).join(listed.select("street_code").distinct(), "street_code", "left_semi")
    first = first_per_key(names, ["street_code"], [*order, "street_name"])
    named = first.select("street_code", clean.spell_out_west("street_name").alias("street_name"))
    return listed.join(named, "street_code", "left")


def house_bounds(tickets: DataFrame) -> DataFrame:
    """Least and greatest readable house number per street; zero means unreadable."""
    numbered = tickets.withColumn("house", clean.to_number_or_zero("house_number")).filter("house <> 0")
    return numbered.groupBy("street_code").agg(F.min("house").alias("house_min"), F.max("house").alias("house_max"))


def locate_houses(tickets: DataFrame, ends: DataFrame, streets: DataFrame) -> DataFrame:
    """Position of each ticket of the listed streets, interpolated between the street's ends.

    ``ends`` has street_code, first_lon, first_lat, last_lon, last_lat. Bounds and ends
    are one row per street of the list ``streets``; Spark broadcasts them where their size allows it.
    """
    listed = streets.select("street_code").distinct()
    on_street = tickets.join(listed, "street_code", "left_semi")
    bounds = house_bounds(on_street)
    ends = ends.join(listed, "street_code", "left_semi")
    placed = on_street.join(bounds, "street_code").join(ends, "street_code")
    house = clean.to_number_or_zero("house_number")
    low, high = F.col("house_min"), F.col("house_max")
    return placed.select(
        "street_code",
        house.alias("house"),
        interpolate_house(house, low, high, F.col("first_lat"), F.col("last_lat")).alias("lat"),
        interpolate_house(house, low, high, F.col("first_lon"), F.col("last_lon")).alias("lon"),
    )
