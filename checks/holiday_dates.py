"""Explicit holiday dates per year, for the comparison only: found by counting calendar days, not by
date arithmetic, so they are an independent statement of the rules."""

from __future__ import annotations

import calendar
from datetime import date, timedelta

from urbanspark.functions import rules

# The years of the driver tables' dates, and the events' year.
YEARS = [*range(1994, 2004), *range(2022, 2027)]


def days_of(year: int, month: int, weekday: int) -> list[date]:
    return [d for d in calendar.Calendar().itermonthdates(year, month) if d.month == month and d.weekday() == weekday]


def with_observed(day: date) -> list[date]:
    if day.weekday() == calendar.SATURDAY:
        return [day, day - timedelta(1)]
    if day.weekday() == calendar.SUNDAY:
        return [day, day + timedelta(1)]
    return [day]


def election(year: int) -> date:
    first = date(year, 11, 1)
    return first + timedelta((2 + first.weekday()) % 7 + 1)


def national() -> set[date]:
    found = set()
    for y in YEARS:
        for day in (date(y, 1, 1), date(y, 7, 4), date(y, 11, 11), date(y, 12, 25)):
            found.update(with_observed(day))
        found |= {days_of(y, 1, 0)[2], days_of(y, 2, 0)[2], days_of(y, 5, 0)[-1], days_of(y, 9, 0)[0], days_of(y, 10, 0)[1]}
        found.add(days_of(y, 11, 3)[3])
        if y >= 2021:
            found.update(with_observed(date(y, 6, 19)))
    return found


def state() -> set[date]:
    found = national()
    for y in YEARS:
        found.update(with_observed(date(y, 2, 12)))
        if y >= 2004:
            found.add(date(y, 2, 15))
        if y >= 2015 or (y >= 2008 and y % 2 == 0):
            found.add(days_of(y, 11, 0)[0] + timedelta(1))
    return found


def special_midnights() -> set[date]:
    found = set()
    for y in YEARS:
        found |= {date(y, m, d) for m, d in rules.SPECIAL_DAYS.values()}
        found |= {days_of(y, 5, 6)[1], days_of(y, 6, 6)[2], days_of(y, 4, 4)[-1]}
        if y % 2 == 0:
            found.add(election(y))
    return found


def religious_midnights() -> set[date]:
    return {date(y, m, d) for y in YEARS for m, d in rules.RELIGIOUS_DAYS.values()}


def school_days() -> tuple[set[date], set[date]]:
    """Whole days, and days that count at midnight only."""
    whole, midnight = set(), set()
    for y in YEARS:
        thanksgiving = days_of(y, 11, 3)[3]
        spans = [(date(y, 6, 25), date(y, 9, 6)), (date(y, 2, 15), date(y, 2, 19)), (date(y, 4, 1), date(y, 4, 9))]
        spans += [(date(y, 12, 24), date(y + 1, 1, 1)), (thanksgiving, thanksgiving + timedelta(1))]
        for first, last in spans:
            day = first
            while day < last and day.year == y:
                whole.add(day)
                day += timedelta(1)
            if last.year == y:
                midnight.add(last)
        midnight |= {days_of(y, 9, 0)[0], days_of(y, 10, 0)[1], days_of(y, 1, 0)[2], days_of(y, 5, 0)[-1], election(y)}
        midnight |= {date(y, 9, 6), date(y, 9, 15), date(y, 11, 11), date(y, 2, 12)}
    return whole, midnight


def date_list(days: set[date]) -> str:
    return "(" + ", ".join(f"DATE '{d}'" for d in sorted(days)) + ")"


def flag_sql(ts: str = "datetime") -> dict[str, str]:
    """SQL expression of each flag, 0 or 1."""
    day, at_midnight = f"CAST({ts} AS DATE)", f"hour({ts}) = 0"
    federal = " OR ".join(f"(month({ts}) = {m} AND day({ts}) = {d})" for m, d in rules.FEDERAL_RULE_DAYS)
    whole, midnight = school_days()
    conditions = {
        "federal_holiday": federal,
        "national_holiday": f"{day} IN {date_list(national())}",
        "religious_holiday": f"{at_midnight} AND {day} IN {date_list(religious_midnights())}",
        "special_day": f"{day} IN {date_list(state())} OR ({at_midnight} AND {day} IN {date_list(special_midnights())})",
        "school_holiday": f"{day} IN {date_list(whole)} OR ({at_midnight} AND {day} IN {date_list(midnight)})",
    }
    return {name: f"CAST(({c}) AS INTEGER)" for name, c in conditions.items()}
