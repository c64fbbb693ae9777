from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from checks import holiday_dates as dates
from tests.conftest import values
from urbanspark.functions import holidays
from urbanspark.functions.hours import from_hour_index, hour_index, hour_index_up, hour_number


def flags_at(spark, moments):
    df = spark.createDataFrame([(m,) for m in moments], "ts timestamp_ntz")
    wide = holidays.add_holiday_flags(df, "ts")
    return {row["ts"]: row.asDict() for row in wide.collect()}


def test_known_flags(spark):
    cases = [
        (datetime(2022, 2, 14, 0), "special_day", 1),
        (datetime(2022, 2, 14, 1), "special_day", 0),
        (datetime(2022, 7, 4, 13), "national_holiday", 1),
        (datetime(2022, 6, 25, 0), "school_holiday", 1),
        (datetime(2022, 7, 10, 15), "school_holiday", 1),
        (datetime(2022, 9, 6, 0), "school_holiday", 1),
        (datetime(2022, 9, 6, 1), "school_holiday", 0),
        (datetime(2022, 1, 1, 0), "school_holiday", 0),
        (datetime(2021, 12, 31, 9), "national_holiday", 1),  # New Year 2022 fell on a Saturday
        (datetime(2022, 6, 20, 9), "national_holiday", 1),  # Juneteenth on a Sunday
        (datetime(2016, 6, 19, 0), "national_holiday", 0),  # not yet a holiday
        (datetime(2022, 5, 31, 9), "federal_holiday", 1),  # rule day, not the true Memorial Day
        (datetime(2022, 5, 30, 9), "federal_holiday", 0),
        (datetime(2022, 12, 10, 0), "religious_holiday", 1),
        (datetime(2022, 12, 10, 1), "religious_holiday", 0),
    ]
    found = flags_at(spark, [c[0] for c in cases])
    assert [(m, f, found[m][f]) for m, f, _ in cases] == cases


def test_flags_of_every_day(spark):
    """At hours 0 and 5 of every day of several years, against dates found by counting."""
    years = [1995, 1996, 2000, 2022, 2023, 2024]
    days = [date(y, 1, 1) + timedelta(n) for y in years for n in range(366) if (date(y, 1, 1) + timedelta(n)).year == y]
    moments = [datetime(d.year, d.month, d.day, h) for d in days for h in (0, 5)]
    whole, midnight = dates.school_days()
    national, state, special = dates.national(), dates.state(), dates.special_midnights()
    religious = dates.religious_midnights()
    for moment, row in flags_at(spark, moments).items():
        day, zero = moment.date(), moment.hour == 0
        assert row["national_holiday"] == (day in national), moment
        assert row["special_day"] == (day in state or (zero and day in special)), moment
        assert row["religious_holiday"] == (zero and day in religious), moment
        assert row["school_holiday"] == (day in whole or (zero and day in midnight)), moment


def test_true_federal_holidays(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2022-05-30 10:00:00' AS ts")
    assert values(df.select(holidays.federal_holiday(F.col("ts"), by_observed_day=True))) == [(True,)]


def test_weekday_dates(spark):
    df = spark.sql("SELECT 2022 AS y")
    row = df.select(
        holidays.nth_weekday(F.col("y"), 11, holidays.THURSDAY, 4), holidays.last_weekday(F.col("y"), 5, holidays.MONDAY)
    ).first()
    assert tuple(row) == (date(2022, 11, 24), date(2022, 5, 30))


def test_hour_numbers(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2020-03-08 02:00:00' AS a, TIMESTAMP_NTZ '2020-03-08 02:00:00.000001' AS b")
    a, b = F.col("a"), F.col("b")
    n = hour_number(datetime(2020, 3, 8, 2))
    assert values(df.select(hour_index(a), hour_index_up(a), hour_index(b), hour_index_up(b))) == [(n, n, n, n + 1)]
    assert values(df.select(from_hour_index(hour_index(a)) == a)) == [(True,)]
