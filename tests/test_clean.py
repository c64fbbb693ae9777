import unicodedata

import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from urbanspark.functions import clean


def apply(spark, rule, inputs):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, c string")
    return [r[0] for r in values(rows.orderBy("i").select(rule("c")))]


CLOCK = {
    "0930A": 10,
    "0929A": 9,
    "1200A": 0,
    "1245A": 0,
    "1230P": 13,
    "0130P": 14,
    "1145P": 24,
    "1330P": 26,
    "0900": 2,
    "BAD": None,
    "": None,
    None: None,
    "ALL": None,
    "12A": 0,
    "A": None,
    "0800A": 8,
    "0730P": 20,
    " 930A": 10,
}


def test_clock_hour(spark):
    assert apply(spark, clean.clock_hour, CLOCK) == list(CLOCK.values())


def literal_clock(text):
    """The rule, step by step in plain Python."""
    try:
        if text[-1:] == "A":
            digits = "00" + text[2:-2] if text[:2] == "12" else text[:-1]
        elif text[-1:] == "P" and text[:2] == "12":
            digits = text[:-1]
        else:
            digits = f"{int(text[:2]) + 12}{text[2:-1]}"
        hours, minutes = divmod(int(digits), 100)
        return hours + (minutes >= 30)
    except (TypeError, ValueError):
        return None


def test_clock_hour_on_every_clock_text(spark):
    texts = [f"{h:02d}{m:02d}{s}" for h in range(0, 25) for m in range(0, 70, 7) for s in ("A", "P", "", "X")]
    texts += ["1A", "12P", "12", "5", "-1A", "1 A", "12 0A", "99999A", "1.5A", "0a00A"]
    assert apply(spark, clean.clock_hour, texts) == [literal_clock(t) for t in texts]


def test_hours_in_effect(spark):
    assert apply(spark, lambda c: clean.hour_in_effect(c, 24), ["ALL", None, "0730P"]) == [24, 24, 20]


def test_issue_time_rolls_to_next_day(spark):
    row = spark.sql("SELECT DATE '2020-02-28' AS d").select(clean.issue_time("d", F.lit(26)).cast("string")).first()
    assert row[0] == "2020-02-29 02:00:00"


DATES = {
    "2014-06-05": "2014-06-05 00:00:00",
    "06/05/2014": "2014-06-05 00:00:00",
    "6/5/2014": "2014-06-05 00:00:00",
    "06/05/2014 01:30:00 PM": "2014-06-05 13:30:00",
    "6/5/2014 1:30 pm": "2014-06-05 13:30:00",
    "2014-06-05T07:08:09": "2014-06-05 07:08:09",
    "June 5, 2014": "2014-06-05 00:00:00",
    "13/45/2014": None,
    "not a date": None,
    "": None,
    None: None,
}


def test_dates(spark):
    found = apply(spark, lambda c: clean.to_timestamp_or_null(c).cast("string"), DATES)
    assert found == list(DATES.values())


def test_strict_dates_stop_the_job(spark):
    with pytest.raises(Exception, match="not a date: soon"):
        apply(spark, clean.to_timestamp_strict, ["2014-06-05", "soon"])
    assert len(apply(spark, clean.to_timestamp_strict, ["2014-06-05", None])) == 2


def test_body_types(spark):
    cases = {"SEDN": "SD", "sdn": "SD", "SUBN": "SU", "4DSD": "SDSD", "2DSD": "SDSD", "4 DR": "4 DR", "VAN": "VN"}
    cases |= {"PICK": "PK", "UTIL": "UT", "MOPD": "MP", "ZZZ": "other", None: "other", "SEDA": "SD", "other": "other"}
    # "other" is upper-cased before it is looked up, so only the default yields it.
    assert apply(spark, clean.body_type, cases) == list(cases.values())


def test_makes_and_plates(spark):
    makes = {"honda": "H", "TOYOT": "T", "9X": "other", None: "other", "other": "other", "": "other", "élan": "É"}
    assert apply(spark, clean.make_initial, makes) == list(makes.values())
    assert apply(spark, clean.plate_type, ["PAS", "XYZ", None, "999"]) == ["PAS", "OTHER", "OTHER", "999"]


def test_counties(spark):
    assert apply(spark, clean.county_clean, ["kings", "NY", "R", "??", None]) == [
        "Brooklyn",
        "Manhattan",
        "Staten Island",
        "-",
        "-",
    ]
    assert apply(spark, clean.county_live, ["NY", "R", "kings", "QUEEN", "", None]) == ["TOTAL", "TOTAL", "kings", "QS", "TOTAL", None]
    assert apply(spark, clean.county_pass_through, ["NY", "kings", "K"]) == ["Manhattan", "kings", "Brooklyn"]


def test_numbers(spark):
    assert apply(spark, clean.to_number_or_zero, ["12", " 9", "1.0", "12A", None, "-3"]) == [12, 9, 0, 0, 0, -3]
    assert apply(spark, clean.to_number, ["12", "1.5", "x", None]) == [12.0, 1.5, None, None]
    usable = apply(spark, clean.is_usable_number, ["2001", "", "0", None, "n/a", "0.0"])
    assert usable == [True, False, False, False, True, False]


def test_text_rules(spark):
    assert apply(spark, clean.spell_out_west, ["W 30 ST", "NEW ST"]) == ["WEST 30 ST", "NEWEST ST"]
    assert apply(spark, lambda c: clean.spell_out_west(c, anchored=True), ["W 30 ST", "NEW ST"]) == ["WEST 30 ST", "NEW ST"]
    assert apply(spark, lambda c: clean.lat_lon(c)[0], ["(40.7, -74.0)", "x"]) == [40.7, None]
    assert apply(spark, lambda c: clean.lat_lon(c)[1], ["(40.7, -74.0)", "40.7"]) == [-74.0, None]
    assert apply(spark, lambda c: clean.address(F.lit(12), c), ["WEST 30 ST", "RICHMOND AVE"]) == [
        "12 West 30 St, New York, Ny, Manhattan",
        "12 Richmond Ave, New York, Ny",
    ]


def test_street_codes(spark):
    row = spark.sql("SELECT 44750.0D AS a, 10575L AS b, 10575 AS c, CAST(NULL AS INT) AS n")
    combo = clean.street_combo("a", "b", "c")
    assert values(row.select(combo, clean.street_name(combo), clean.street_combo("a", "n"))) == [
        ("44750-10575-10575", "RICHMOND AVE", None)
    ]


def test_ascii_fold(spark):
    texts = ["Élan vital", "ﬁne ½", "straße", "plain", None, "日本"]
    expected = [t and unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode() for t in texts]
    assert apply(spark, clean.ascii_fold, texts) == expected
