from collections import Counter
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import plan_of
from urbanspark.functions.hours import from_hour_index, hour_number, wall_clock
from urbanspark.operators.intervals import active_counts
from urbanspark.plans.features import event_counts_hourly, merge_features, open_businesses_hourly, open_schools_hourly, resample_daily

START, END = datetime(2020, 1, 1), datetime(2020, 1, 3, 23)
HOURS = [START + timedelta(hours=h) for h in range(72)]
SCHEMA = "k string, a timestamp_ntz, b timestamp_ntz, w int"


def count(spark, rows, keys=("x", "y")):
    intervals = spark.createDataFrame(rows, SCHEMA)
    key_table = spark.createDataFrame([(k,) for k in keys], "k string")
    found = active_counts(intervals, key_table, "a", "b", {"n": F.lit(1), "w": F.col("w")}, START, END)
    return {(r["k"], r["hour_no"]): (r["n"], r["w"]) for r in found.collect()}


def brute_force(rows, keys=("x", "y")):
    expected = {(k, hour_number(h)): (0, 0) for k in keys for h in HOURS}
    for k, a, b, w in rows:
        for h in HOURS:
            if k in keys and a is not None and b is not None and a <= h <= b:
                n, total = expected[k, hour_number(h)]
                expected[k, hour_number(h)] = (n + 1, total + w)
    return expected


moment = st.one_of(
    st.none(),
    st.integers(-600, 72 * 60 + 600).map(lambda m: START + timedelta(minutes=m)),
    st.integers(0, 72).map(lambda h: START + timedelta(hours=h)),
)
interval = st.tuples(st.sampled_from(["x", "y", "z"]), moment, moment, st.integers(0, 1))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(interval, min_size=1, max_size=12))
def test_sweep_line_equals_brute_force(spark, rows):
    assert count(spark, rows) == brute_force(rows)


def test_full_hours_only(spark):
    at = lambda h, m: datetime(2020, 1, 1, h, m)
    rows = [("x", at(10, 15), at(12, 0), 1), ("x", at(10, 0), at(10, 0), 1), ("x", at(10, 15), at(10, 45), 1), ("x", at(1, 0), None, 1)]
    found = count(spark, rows)
    active = {h: n for (k, h), (n, _) in found.items() if n}
    base = hour_number(START)
    assert active == {base + 10: 1, base + 11: 1, base + 12: 1}


def test_no_nested_loop(spark):
    intervals = spark.createDataFrame([("x", START, END, 1)], SCHEMA)
    df = active_counts(intervals, spark.createDataFrame([("x",)], "k string"), "a", "b", {"n": F.lit(1)}, START, END)
    assert "NestedLoop" not in plan_of(df) and "Cartesian" not in plan_of(df)


def test_opening_hours(spark):
    rows = [
        ("Bronx", "Employment Agency", START, END),  # 9 to 17, weekdays
        ("Bronx", "Cabaret", START, END),  # overnight, so never
        ("Bronx", "Garage", START, END),  # all day
        ("Queens", "Unknown", START, END),
        ("Nowhere", "Garage", START, END),
    ]
    df = spark.createDataFrame(rows, "borough string, industry string, created timestamp_ntz, expires timestamp_ntz")
    found = {(r[0], r[1]): r[2] for r in open_businesses_hourly(df, START, END).collect()}
    assert len(found) == 5 * 72
    # 2020-01-01 was a Wednesday, so all three days are weekdays.
    expected = {h: 1 + (9 <= h.hour <= 17) for h in HOURS}
    assert {h: found["Bronx", h] for h in HOURS} == expected
    assert not any(n for (b, _), n in found.items() if b != "Bronx")


def test_weekend_rule(spark):
    saturday = datetime(2020, 1, 4)
    df = spark.createDataFrame(
        [("Bronx", "Employment Agency", saturday, saturday + timedelta(days=3))],
        "borough string, industry string, created timestamp_ntz, expires timestamp_ntz",
    )
    found = open_businesses_hourly(df, saturday, saturday + timedelta(hours=71)).filter("open_businesses > 0")
    assert Counter(r["datetime"].date().isoformat() for r in found.collect()) == {"2020-01-06": 9}


def test_event_counters(spark):
    rows = [("Bronx", "Construction", "Full", START, START), ("Bronx", "Parade", None, START, START)]
    df = spark.createDataFrame(rows, "borough string, event_type string, street_closure_type string, start_ts timestamp_ntz, end_ts timestamp_ntz")
    first = event_counts_hourly(df, START, END).filter((F.col("borough") == "Bronx") & (F.col("datetime") == wall_clock(START)))
    assert [tuple(r)[2:] for r in first.collect()] == [(2, 1, 1)]


def test_schools_by_hour_and_variant(spark):
    from urbanspark.functions import rules

    df = spark.createDataFrame([("Bronx", "Elementary"), ("Bronx", "High school"), (None, "K-8")], "borough string, category string")
    at = datetime(2020, 1, 1, 13)
    one = lambda hours: open_schools_hourly(df, at, at, hours).filter("borough = 'Bronx'").first()["open_schools"]
    assert one(rules.SCHOOL_HOURS) == 1  # only the six-hour school is open at 13
    at = datetime(2020, 1, 1, 12)
    assert one(rules.SCHOOL_HOURS) == 1  # the slip: elementary schools do not count
    assert one(rules.SCHOOL_HOURS_FIXED) == 2
    at = datetime(2020, 7, 1, 12)
    assert one(rules.SCHOOL_HOURS_FIXED) == 0


def test_merge_is_a_full_outer_join(spark):
    a = spark.createDataFrame([("x", 1, 10), ("y", 1, None)], "borough string, datetime int, a int")
    b = spark.createDataFrame([("x", 1, 5.0), ("x", 2, 6.0)], "borough string, datetime int, b double")
    joined = a.join(b, ["borough", "datetime"], "full")
    assert sorted(merge_features([a, b]).collect()) == sorted(joined.select("borough", "datetime", "a", "b").collect())


def test_daily_means_keep_gaps(spark):
    rows = [("x", datetime(2020, 1, 1, 3), 1.0), ("x", datetime(2020, 1, 1, 4), 3.0), ("x", datetime(2020, 1, 3, 0), 5.0)]
    df = spark.createDataFrame(rows, "borough string, datetime timestamp_ntz, v double")
    found = [(r["day"].day, r["v"]) for r in resample_daily(df).orderBy("day").collect()]
    assert found == [(1, 2.0), (2, None), (3, 5.0)]


def test_hour_round_trip(spark):
    df = spark.range(1).select(from_hour_index(F.lit(hour_number(END))).alias("t"))
    assert df.first()["t"] == END
