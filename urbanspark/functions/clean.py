"""Cleaning rules as native column expressions (one Arrow function for Unicode folding)."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from urbanspark.functions import rules

# Date patterns, each with the shape a text must have for the pattern to be tried.
DATE_PATTERNS = (
    ("M/d/yyyy", r"^\d{1,2}/\d{1,2}/\d{4}$"),
    ("M/d/yyyy h:mm:ss a", r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2} [AaPp][Mm]$"),
    ("M/d/yyyy h:mm a", r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2} [AaPp][Mm]$"),
    ("M/d/yyyy H:mm", r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}$"),
    ("MMMM d, yyyy", r"^[A-Za-z]+ \d{1,2}, \d{4}$"),
)
WHOLE_NUMBER = r"^\s*[+-]?\d+\s*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- numbers -------------------------------------------------------------------------------------


def to_number(c: Column | str, type_name: str = "double") -> Column:
    """Number or null; text that is no number gives null, never an error."""
    return _col(c).try_cast(type_name)


def whole_number(text: Column) -> Column:
    """Whole number or null. The shape is tested first: a failing cast costs an exception per row."""
    return F.when(text.rlike(WHOLE_NUMBER), text.try_cast("int"))


def to_number_or_zero(c: Column | str) -> Column:
    return F.coalesce(whole_number(_col(c).cast("string")), F.lit(0))


def is_usable_number(c: Column | str) -> Column:
    """Present and neither blank nor zero, for a value that may arrive as text or as a number."""
    text = _col(c).cast("string")
    return text.isNotNull() & ~text.isin("", "0") & (F.coalesce(text.try_cast("double"), F.lit(1.0)) != 0)


# --- dates ---------------------------------------------------------------------------------------


def to_timestamp_or_null(c: Column | str, patterns: tuple[tuple[str, str], ...] = DATE_PATTERNS) -> Column:
    """Wall-clock time from ISO text (fast path) or one of ``patterns``; anything else is null."""
    text = _col(c)
    parsed = [F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(p)).cast("timestamp_ntz")) for p, shape in patterns]
    return F.coalesce(text.try_cast("timestamp_ntz"), *parsed)


def to_timestamp_strict(c: Column | str, patterns: tuple[tuple[str, str], ...] = DATE_PATTERNS) -> Column:
    """As ``to_timestamp_or_null`` but text that matches no format stops the job."""
    text = _col(c)
    parsed = to_timestamp_or_null(text, patterns)
    bad = F.raise_error(F.concat(F.lit("not a date: "), text)).cast("timestamp_ntz")
    return F.when(text.isNotNull() & parsed.isNull(), bad).otherwise(parsed)


def to_date_or_null(c: Column | str, patterns: tuple[tuple[str, str], ...] = DATE_PATTERNS) -> Column:
    return to_timestamp_or_null(c, patterns).cast("date")


def month_period(ts: Column | str) -> Column:
    return F.date_format(_col(ts), "yyyy-MM")


def clock_hour(c: Column | str) -> Column:
    """Hour of a ``hhmmA`` / ``hhmmP`` clock text, rounded up from minute 30; null if unreadable.

    The conversion keeps three habits of the rule it reproduces: 12:xx AM loses its last digit and so
    is always hour 0; every text that ends neither in A nor is a 12:xx PM gets 12 hours added and
    its last character dropped; the result may be 24 or more, which later rolls into the next day.
    """
    text = _col(c)
    size = F.length(text)
    noon_hour = text.startswith("12")
    afternoon_hour = (F.substring(text, 1, 2).try_cast("int") + 12).cast("string")
    digits = (
        F.when(text.endswith("A") & noon_hour, F.concat(F.lit("00"), text.substr(F.lit(3), size - 4)))
        .when(text.endswith("A") | (text.endswith("P") & noon_hour), text.substr(F.lit(1), size - 1))
        .otherwise(F.concat(afternoon_hour, text.substr(F.lit(3), size - 3)))
    )
    # Texts without any digit ("ALL") are settled first, a failing cast costs an exception per row.
    hhmm = F.when(text.rlike(r"\d"), digits.try_cast("int"))
    # Minutes 30 to 99 carry into the hour.
    return F.floor((hhmm + 70) / 100).cast("int")


def hour_in_effect(c: Column | str, default: int) -> Column:
    return F.coalesce(clock_hour(c), F.lit(default))


def issue_time(date: Column | str, hour: Column | str) -> Column:
    """Date plus whole hours; hours of 24 or more land on a later day."""
    return _col(date).cast("timestamp_ntz") + F.make_dt_interval(hours=_col(hour))


# --- codes ---------------------------------------------------------------------------------------


def lookup(c: Column, table: dict[str, list[str]], default: Column) -> Column:
    """Value of the entry that lists ``c``; a few dozen literal keys compile to one CASE."""
    result = F
    for value, keys in table.items():
        result = result.when(c.isin(*keys), F.lit(value))
    return result.otherwise(default)


def county_clean(c: Column | str) -> Column:
    """Borough name of a county code in any case; ``-`` where the code is missing or unknown."""
    return lookup(F.upper(_col(c)), rules.COUNTY_TO_BOROUGH, F.lit("-"))


def county_live(c: Column | str) -> Column:
    """Short county code for live statistics; unknown codes pass through unchanged."""
    return lookup(_col(c), rules.COUNTY_TO_LIVE_CODE, _col(c))


def county_pass_through(c: Column | str) -> Column:
    """Borough name of a county code, case-sensitive; unknown codes pass through unchanged."""
    return lookup(_col(c), rules.COUNTY_TO_BOROUGH, _col(c))


def body_type_spelling(c: Column | str) -> Column:
    """Body type in upper case with the known long spellings shortened."""
    upper = F.upper(_col(c))
    shortened = F
    for first, spellings in rules.BODY_TYPE_SPELLINGS.items():
        text = upper
        for old, new in spellings:
            text = F.replace(text, F.lit(old), F.lit(new))
        shortened = shortened.when(upper.startswith(first), text)
    return shortened.otherwise(upper)


def body_type(c: Column | str) -> Column:
    return keep_listed(body_type_spelling(c), rules.BODY_TYPES, "other")


def keep_listed(c: Column | str, allowed: list[str], other: str) -> Column:
    """``c`` where it is in the list, else ``other`` (also for null)."""
    return F.when(_col(c).isin(*allowed), _col(c)).otherwise(F.lit(other))


def plate_type(c: Column | str) -> Column:
    return keep_listed(c, rules.PLATE_TYPES, "OTHER")


def make_initial(c: Column | str) -> Column:
    """Upper-case first letter of the make; ``other`` for a missing or non-letter start."""
    text = _col(c)
    return F.when(
        (text != "other") & text.rlike(r"^\p{L}"), F.substring(F.upper(F.substring(text, 1, 1)), 1, 1)
    ).otherwise(F.lit("other"))


# --- streets and text ----------------------------------------------------------------------------


def street_combo(*codes: Column | str) -> Column:
    """``a-b-c`` from the street codes, as whole numbers; null if one is missing."""
    parts = [_col(c).cast("int").cast("string") for c in codes]
    joined = parts[0]
    for part in parts[1:]:
        joined = F.concat(joined, F.lit("-"), part)
    return joined


def street_name(combo: Column | str) -> Column:
    by_name: dict[str, list[str]] = {}
    for code, name in rules.STREET_NAMES.items():
        by_name.setdefault(name, []).append(code)
    return lookup(_col(combo), by_name, F.lit(None).cast("string"))


def spell_out_west(c: Column | str, anchored: bool = False) -> Column:
    """``W `` -> ``WEST ``; by default anywhere, so also inside words; ``anchored`` only at the start."""
    if anchored:
        return F.regexp_replace(_col(c), "^W ", "WEST ")
    return F.replace(_col(c), F.lit("W "), F.lit("WEST "))


def lat_lon(c: Column | str) -> tuple[Column, Column]:
    """Latitude and longitude of a ``"(lat, lon)"`` text; null where a part is no number."""
    parts = F.split(F.regexp_replace(_col(c), r"[()]", ""), ",", 3)
    return F.get(parts, F.lit(0)).try_cast("double"), F.get(parts, F.lit(1)).try_cast("double")


def address(house_number: Column | str, street: Column | str) -> Column:
    """Address line in capitalised words; streets with "West" get the borough appended."""
    line = F.initcap(
        F.concat(_col(house_number).cast("string"), F.lit(" "), _col(street), F.lit(", New York, NY"))
    )
    return F.when(line.contains("West"), F.concat(line, F.lit(", Manhattan"))).otherwise(line)


@pandas_udf(StringType())
def ascii_fold(texts: pd.Series) -> pd.Series:
    """Compatibility-decomposed text without its non-ASCII characters. Spark has no such function."""

    def fold(text):
        if text is None or text.isascii():
            return text
        return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()

    return texts.map(fold, na_action="ignore")


# --- date parts ----------------------------------------------------------------------------------


def cyclic(part: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a date part on a circle of ``period`` steps."""
    angle = F.lit(2.0) * F.pi() * part / period
    return F.sin(angle), F.cos(angle)


def add_cyclic_time(df: DataFrame, ts: str) -> DataFrame:
    month = cyclic(F.month(ts), 12)
    day = cyclic(F.dayofmonth(ts), 31)
    hour = cyclic(F.hour(ts), 24)
    return df.withColumns(
        {
            "month_sine": month[0],
            "month_cosine": month[1],
            "day_sine": day[0],
            "day_cosine": day[1],
            "hour_sine": hour[0],
            "hour_cosine": hour[1],
        }
    )
