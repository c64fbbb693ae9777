"""Holiday flags of an hourly timestamp as column expressions.

A day flag counts in one of two ways. Public holidays hold for the whole day. Named single days are
compared with an exact timestamp, so they hold at hour 0 only; for the same reason the last day of a
school recess counts only its hour 0. The flags test the parts of the date itself (month and day as
one number, weekday, which weekday of the month), so no calendar table is built or joined.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanspark.functions import rules

MONDAY, TUESDAY, WEDNESDAY, THURSDAY, FRIDAY, SATURDAY, SUNDAY = range(7)

FLAGS = ["federal_holiday", "national_holiday", "religious_holiday", "special_day", "school_holiday"]

# Public holidays on the same date each year.
PUBLIC_FIXED_DAYS = [(1, 1), (7, 4), (11, 11), (12, 25)]
JUNETEENTH, JUNETEENTH_SINCE = (6, 19), 2021
# Public holidays by (month, weekday, which); -1 is the last.
PUBLIC_WEEKDAYS = [(1, MONDAY, 3), (2, MONDAY, 3), (5, MONDAY, -1), (9, MONDAY, 1), (10, MONDAY, 2), (11, THURSDAY, 4)]
# Days that New York State adds.
LINCOLN, ANTHONY, ANTHONY_SINCE = (2, 12), (2, 15), 2004
# Special days by (month, weekday, which): Arbor, Mother's and Father's Day.
SPECIAL_WEEKDAYS = [(4, FRIDAY, -1), (5, SUNDAY, 2), (6, SUNDAY, 3)]
# School holidays by (month, weekday, which).
SCHOOL_WEEKDAYS = [(1, MONDAY, 3), (5, MONDAY, -1), (9, MONDAY, 1), (10, MONDAY, 2)]


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


# --- dates by rule -------------------------------------------------------------------------------


def nth_weekday(year: Column, month: int, weekday: int, n: int) -> Column:
    """Date of the n-th given weekday of a month (Monday = 0)."""
    first = F.make_date(year, F.lit(month), F.lit(1))
    return F.date_add(first, F.pmod(F.lit(weekday) - F.weekday(first), F.lit(7)) + 7 * (n - 1))


def last_weekday(year: Column, month: int, weekday: int) -> Column:
    """Date of the last given weekday of a month."""
    last = F.last_day(F.make_date(year, F.lit(month), F.lit(1)))
    return F.date_sub(last, F.pmod(F.weekday(last) - F.lit(weekday), F.lit(7)))


# --- tests of a date -----------------------------------------------------------------------------


def month_day(day: Column) -> Column:
    """Month and day as one number, 704 for the fourth of July."""
    return F.month(day) * 100 + F.dayofmonth(day)


def number(date: tuple[int, int]) -> int:
    return date[0] * 100 + date[1]


def on_dates(day: Column, dates: Iterable[tuple[int, int]]) -> Column:
    return month_day(day).isin(*[number(d) for d in dates])


def observed(holds, day: Column) -> Column:
    """A holiday test that also holds on the Friday before a Saturday and the Monday after a Sunday."""
    weekday = F.weekday(day)
    return (
        holds(day)
        | ((weekday == FRIDAY) & holds(F.date_add(day, 1)))
        | ((weekday == MONDAY) & holds(F.date_sub(day, 1)))
    )


def is_nth_weekday(day: Column, month: int, weekday: int, n: int) -> Column:
    """Whether a date is the n-th given weekday of the month; n = -1 is the last."""
    if n == -1:
        which = F.dayofmonth(day) > F.dayofmonth(F.last_day(day)) - 7
    else:
        which = F.dayofmonth(day).between(7 * n - 6, 7 * n)
    return (F.month(day) == month) & (F.weekday(day) == weekday) & which


def on_weekdays(day: Column, entries: Iterable[tuple[int, int, int]]) -> Column:
    return any_of(is_nth_weekday(day, *entry) for entry in entries)


def is_election_day(day: Column) -> Column:
    """The November date of the source rule, which adds the weekday of the 1st where it should subtract it."""
    first_weekday = F.pmod(F.weekday(day) - F.dayofmonth(day) + 1, F.lit(7))
    return (F.month(day) == 11) & (F.dayofmonth(day) == F.pmod(first_weekday + 2, F.lit(7)) + 2)


def us_public_holiday(day: Column) -> Column:
    """Whether a date is a national public holiday or its observed day."""
    juneteenth = observed(lambda d: on_dates(d, [JUNETEENTH]), day)
    return (
        observed(lambda d: on_dates(d, PUBLIC_FIXED_DAYS), day)
        | on_weekdays(day, PUBLIC_WEEKDAYS)
        | ((F.year(day) >= JUNETEENTH_SINCE) & juneteenth)
    )


def state_public_holiday(day: Column) -> Column:
    """National holidays plus the days that New York State adds."""
    year = F.year(day)
    # The Tuesday after the first Monday, every second year until 2014.
    election = (F.month(day) == 11) & (F.weekday(day) == TUESDAY) & F.dayofmonth(day).between(2, 8)
    return (
        us_public_holiday(day)
        | observed(lambda d: on_dates(d, [LINCOLN]), day)
        | ((year >= ANTHONY_SINCE) & on_dates(day, [ANTHONY]))
        | (((year >= 2015) | ((year >= 2008) & (year % 2 == 0))) & election)
    )


# --- flags of a timestamp ------------------------------------------------------------------------


def _midnight(ts: Column) -> Column:
    return ts == ts.cast("date").cast("timestamp_ntz")


def federal_holiday(ts: Column, by_observed_day: bool = False) -> Column:
    """Whole-day flag by (month, day) of the federal rules without their weekday offsets.

    ``by_observed_day`` gives the true holidays instead.
    """
    day = ts.cast("date")
    return us_public_holiday(day) if by_observed_day else on_dates(day, rules.FEDERAL_RULE_DAYS)


def national_holiday(ts: Column) -> Column:
    return us_public_holiday(ts.cast("date"))


def religious_holiday(ts: Column) -> Column:
    return _midnight(ts) & on_dates(ts.cast("date"), rules.RELIGIOUS_DAYS.values())


def special_day(ts: Column) -> Column:
    day = ts.cast("date")
    named = (
        on_dates(day, rules.SPECIAL_DAYS.values())
        | on_weekdays(day, SPECIAL_WEEKDAYS)
        | ((F.year(day) % 2 == 0) & is_election_day(day))
    )
    return state_public_holiday(day) | (_midnight(ts) & named)


def school_holiday(ts: Column) -> Column:
    day = ts.cast("date")
    today = month_day(day)
    # Recesses: every day before the last one, and the last one at midnight. The winter recess
    # starts in the date's own year, so its two days in January never count.
    whole = [
        (today >= number(first)) & (today < number(last)) if last else today >= number(first)
        for first, last in rules.SCHOOL_RECESSES.values()
    ]
    last_days = [last for _, last in rules.SCHOOL_RECESSES.values() if last]
    thanksgiving = (11, THURSDAY, 4)
    single = (
        on_dates(day, [*last_days, *rules.SCHOOL_SINGLE_DAYS.values()])
        | on_weekdays(day, SCHOOL_WEEKDAYS)
        | is_election_day(day)
        | is_nth_weekday(F.date_sub(day, 1), *thanksgiving)
    )
    return any_of([*whole, is_nth_weekday(day, *thanksgiving)]) | (_midnight(ts) & single)


def add_holiday_flags(df: DataFrame, ts: str) -> DataFrame:
    """The five flags as 0/1 columns."""
    c = F.col(ts)
    values = [federal_holiday(c), national_holiday(c), religious_holiday(c), special_day(c), school_holiday(c)]
    return df.withColumns({name: value.cast("int") for name, value in zip(FLAGS, values)})
