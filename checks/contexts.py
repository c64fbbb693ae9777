"""Calendar, intervals, places and the assembled hourly features."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from checks import views as V
from checks.aggregates import rounded, rounded_sql
from checks.columns import COUNTY_SQL, DATE_SQL, ISSUE_SQL
from checks.holiday_dates import flag_sql
from checks.registry import check
from checks.views import with_views
from urbanspark.functions import clean, holidays, rules
from urbanspark.functions.hours import from_hour_index
from urbanspark.operators import geo
from urbanspark.operators.intervals import active_counts, hourly_spine
from urbanspark.operators.tables import inline_table, materialize
from urbanspark.plans import features, tickets
from urbanspark.session import work_folder

BOROUGHS_SQL = f"(SELECT unnest({rules.BOROUGHS}) AS borough)"


def spine_sql(start, end) -> str:
    return f"(SELECT unnest(generate_series(TIMESTAMP '{start}', TIMESTAMP '{end}', INTERVAL 1 HOUR)) AS datetime)"


# All hours of the years from the first licence or ticket to the last.
CONTEXT_SPINE = f"""(SELECT unnest(generate_series(
    least(TIMESTAMP '{V.START}', (SELECT date_trunc('year', min(created)) FROM licences)),
    greatest(TIMESTAMP '{V.END}', (SELECT date_trunc('year', max(expires)) + INTERVAL 1 YEAR FROM licences)) - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS datetime)"""
EVENT_SPINE = spine_sql(V.EVENT_START, V.EVENT_END)

# --- calendar ------------------------------------------------------------------------------------


@check(
    "hourly_spine",
    f"""WITH spans AS (SELECT event_type, date_trunc('day', min(ts)) AS lo, date_trunc('day', max(ts)) AS hi FROM events GROUP BY 1)
        SELECT event_type, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS datetime FROM spans""",
)
def hourly_spine_of_events(spark, sf_dir):
    """One spine per event type over the days its events span."""
    events = V.table(spark, sf_dir, "events")
    first, last = events.agg(F.min("ts").cast("date"), F.max("ts").cast("date")).first()
    spans = events.groupBy("event_type").agg(F.min("ts").cast("date").alias("lo"), F.max("ts").cast("date").alias("hi"))
    midnight = datetime.min.time()
    spine = hourly_spine(spans, datetime.combine(first, midnight), datetime.combine(last, midnight))
    return spine.filter("datetime BETWEEN lo AND hi").select("event_type", "datetime")


def hours_of_tickets(spark, sf_dir):
    """Distinct issue hours with their tickets."""
    source = V.tickets(spark, sf_dir, "issue_date", "violation_time", spread=True)
    time = clean.issue_time(clean.to_timestamp_or_null("issue_date"), clean.clock_hour("violation_time"))
    return source.select(time.alias("issue_time")).dropna().groupBy("issue_time").agg(F.count("*").alias("n"))


def flag_check(name: str, flag: str, expression):
    sql = with_views(
        f"SELECT issue_time, count(*) AS n, {flag_sql('issue_time')[flag]} AS {flag} FROM (SELECT {ISSUE_SQL} AS issue_time FROM tickets) WHERE issue_time IS NOT NULL GROUP BY 1",
        "tickets",
    )

    @check(name, sql)
    def query(spark, sf_dir):
        return hours_of_tickets(spark, sf_dir).withColumn(flag, expression(F.col("issue_time")).cast("int"))

    return query


flag_check("holiday_federal", "federal_holiday", holidays.federal_holiday)
flag_check("holiday_national", "national_holiday", holidays.national_holiday)
flag_check("holiday_religious", "religious_holiday", holidays.religious_holiday)
flag_check("holiday_special", "special_day", holidays.special_day)
flag_check("holiday_school", "school_holiday", holidays.school_holiday)

# Weekday rules as window functions over all days of the years with orders.
NTH_SQL = """WITH days AS (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS d),
  numbered AS (SELECT d, isodow(d) AS w, row_number() OVER (PARTITION BY year(d), month(d), isodow(d) ORDER BY d) AS k,
                 row_number() OVER (PARTITION BY year(d), month(d), isodow(d) ORDER BY d DESC) AS from_end FROM days),
  pick AS (SELECT year(d) AS year,
    max(d) FILTER (month(d) = 1 AND w = 1 AND k = 3) AS third_monday_january,
    max(d) FILTER (month(d) = 4 AND w = 5 AND from_end = 1) AS last_friday_april,
    max(d) FILTER (month(d) = 5 AND w = 7 AND k = 2) AS second_sunday_may,
    max(d) FILTER (month(d) = 5 AND w = 1 AND from_end = 1) AS last_monday_may,
    max(d) FILTER (month(d) = 6 AND w = 7 AND k = 3) AS third_sunday_june,
    max(d) FILTER (month(d) = 9 AND w = 1 AND k = 1) AS first_monday_september,
    max(d) FILTER (month(d) = 10 AND w = 1 AND k = 2) AS second_monday_october,
    max(d) FILTER (month(d) = 11 AND w = 4 AND k = 4) AS fourth_thursday_november
    FROM numbered GROUP BY 1)
SELECT CAST(p.year AS INTEGER) AS year, count(*) AS n, any_value(p.* EXCLUDE (year)) FROM orders o JOIN pick p ON p.year = year(o_orderdate) GROUP BY 1"""
NTH_NAMES = [
    "third_monday_january",
    "last_friday_april",
    "second_sunday_may",
    "last_monday_may",
    "third_sunday_june",
    "first_monday_september",
    "second_monday_october",
    "fourth_thursday_november",
]
NTH_SQL = NTH_SQL.replace("any_value(p.* EXCLUDE (year))", ", ".join(f"any_value(p.{n}) AS {n}" for n in NTH_NAMES))


@check("nth_weekday_dates", NTH_SQL)
def nth_weekday_dates(spark, sf_dir):
    years = V.table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n"))
    y, h = F.col("year"), holidays
    days = [
        h.nth_weekday(y, 1, h.MONDAY, 3),
        h.last_weekday(y, 4, h.FRIDAY),
        h.nth_weekday(y, 5, h.SUNDAY, 2),
        h.last_weekday(y, 5, h.MONDAY),
        h.nth_weekday(y, 6, h.SUNDAY, 3),
        h.nth_weekday(y, 9, h.MONDAY, 1),
        h.nth_weekday(y, 10, h.MONDAY, 2),
        h.nth_weekday(y, 11, h.THURSDAY, 4),
    ]
    return years.withColumns(dict(zip(NTH_NAMES, days)))


# --- intervals: the comparison is the plain range join ------------------------------------------

INDUSTRIES_SQL = "(VALUES ('Garage'), ('Employment Agency'), ('Cabaret'), ('Newsstand'), ('Unlisted')) AS i(industry)"


@check(
    "interval_active_counts",
    with_views(
        f"""SELECT b.borough, i.industry, h.datetime, count(l.licence_id) AS n
            FROM {BOROUGHS_SQL} b CROSS JOIN {INDUSTRIES_SQL} CROSS JOIN {CONTEXT_SPINE} h
            LEFT JOIN licences l ON l.borough = b.borough AND l.industry = i.industry AND h.datetime >= l.created AND h.datetime <= l.expires
            GROUP BY 1, 2, 3""",
        "licences",
    ),
)
def interval_active_counts(spark, sf_dir):
    industries = ["Garage", "Employment Agency", "Cabaret", "Newsstand", "Unlisted"]
    keys = inline_table(spark, ["borough", "industry"], [(b, i) for b in rules.BOROUGHS for i in industries])
    counts = active_counts(
        V.view(spark, sf_dir, "licences"), keys, "created", "expires", {"n": F.lit(1)}, *V.context_span(spark, sf_dir)
    )
    return counts.select("borough", "industry", from_hour_index(F.col("hour_no")).alias("datetime"), "n")


HOURS_SQL = "(VALUES " + ", ".join(f"('{i}', {a}, {b}, {w})" for i, a, b, w in rules.INDUSTRY_HOURS) + ") AS t(industry, opens, closes, weekends)"
BUSINESSES_SQL = f"""SELECT b.borough, h.datetime, count(l.licence_id) AS open_businesses
    FROM {BOROUGHS_SQL} b CROSS JOIN {CONTEXT_SPINE} h
    LEFT JOIN (SELECT * FROM licences JOIN {HOURS_SQL} USING (industry)) l
      ON l.borough = b.borough AND h.datetime >= l.created AND h.datetime <= l.expires
      AND hour(h.datetime) BETWEEN l.opens AND l.closes AND (l.weekends OR isodow(h.datetime) < 6)
    GROUP BY 1, 2"""


@check("open_businesses_hourly", with_views(BUSINESSES_SQL, "licences"))
def open_businesses_hourly(spark, sf_dir):
    return features.open_businesses_hourly(V.view(spark, sf_dir, "licences"), *V.context_span(spark, sf_dir))


def events_sql(spine: str, events: str) -> str:
    return f"""SELECT b.borough, h.datetime, count(e.start_ts) AS num_events,
                 count(e.start_ts) FILTER (e.event_type = 'Construction') AS num_constructions, count(e.street_closure_type) AS num_street_closures
               FROM {BOROUGHS_SQL} b CROSS JOIN {spine} h
               LEFT JOIN {events} e ON e.borough = b.borough AND h.datetime BETWEEN e.start_ts AND e.end_ts GROUP BY 1, 2"""


@check("event_counts_hourly", with_views(events_sql(EVENT_SPINE, "city_events"), "city_events"))
def event_counts_hourly(spark, sf_dir):
    return features.event_counts_hourly(V.view(spark, sf_dir, "city_events"), V.EVENT_START, V.EVENT_END)


# --- places --------------------------------------------------------------------------------------

PLACED_SQL = f"""SELECT point_id, category, lon, lat, arg_max(region, region_no) AS region FROM (
    SELECT p.point_id, p.category, p.lon, p.lat, e.region, e.region_no,
           sum(CASE WHEN (e.y1 > p.lat) <> (e.y2 > p.lat) AND p.lon < (e.x2 - e.x1) * (p.lat - e.y1) / (e.y2 - e.y1) + e.x1 THEN 1 ELSE 0 END) AS crossings
    FROM {{points}} p CROSS JOIN {V.edges_sql()} e WHERE e.y1 <> e.y2 GROUP BY ALL) WHERE crossings % 2 = 1 GROUP BY 1, 2, 3, 4"""


@check(
    "geo_point_in_polygon",
    with_views(f"SELECT p.point_id, g.region FROM points p LEFT JOIN ({PLACED_SQL.format(points='points')}) g USING (point_id)", "points"),
)
def geo_point_in_polygon(spark, sf_dir):
    placed = geo.assign_region(V.view(spark, sf_dir, "points"), V.polygons(spark), "lon", "lat")
    return placed.select("point_id", "region")


# Corners of two regions that share an edge; order lines stand on a grid over both, many of them on edges and corners.
NOTCHED = [(1, "west", [(0, 0), (6, 0), (6, 9), (3, 4), (0, 9)]), (2, "east", [(6, 0), (12, 3), (6, 9)])]
NOTCHED_SQL = "(VALUES " + ", ".join(
    f"({no}, '{name}', {x1}, {y1}, {x2}, {y2})"
    for no, name, corners in NOTCHED
    for (x1, y1), (x2, y2) in zip(corners, corners[1:] + corners[:1])
) + ") AS e(no, region, x1, y1, x2, y2)"


@check(
    "geo_exact_edges",
    f"""WITH p AS (SELECT CAST(l_partkey % 15 - 1 AS BIGINT) AS x, CAST(l_suppkey % 12 - 1 AS BIGINT) AS y, count(*) AS n FROM lineitem GROUP BY 1, 2),
      t AS (SELECT p.*, no, region,
          bool_or((x2 - x1) * (y - y1) = (y2 - y1) * (x - x1) AND x BETWEEN least(x1, x2) AND greatest(x1, x2) AND y BETWEEN least(y1, y2) AND greatest(y1, y2)) AS touched,
          count(*) FILTER ((y1 > y) != (y2 > y) AND ((x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)) * sign(y2 - y1) > 0) % 2 = 1 AS odd
        FROM p CROSS JOIN {NOTCHED_SQL} GROUP BY ALL)
      SELECT x, y, any_value(n) AS n, max_by(region, no) FILTER (odd AND NOT touched) AS region, max_by(region, no) FILTER (touched) AS edge_of FROM t GROUP BY x, y""",
)
def geo_exact_edges(spark, sf_dir):
    rows = [(no, name, 0, i, float(x) / 10, float(y) / 10) for no, name, corners in NOTCHED for i, (x, y) in enumerate(corners)]
    regions = inline_table(spark, ["region_no", "region", "part", "seq", "x", "y"], rows)
    x, y = F.col("l_partkey") % 15 - 1, F.col("l_suppkey") % 12 - 1
    lines = V.table(spark, sf_dir, "lineitem").select(x.cast("bigint").alias("x"), y.cast("bigint").alias("y"))
    # Tenths have no exact binary form.
    points = lines.groupBy("x", "y").agg(F.count("*").alias("n")).withColumns({"lon": F.col("x") / 10, "lat": F.col("y") / 10})
    return geo.assign_region_exactly(points, regions, "lon", "lat").select("x", "y", "n", "region", "edge_of")


@check(
    "geo_grid_cell",
    with_views(
        """SELECT CAST(trunc((lon - -74.25e0) / (-73.7e0 - -74.25e0) * 1000) AS INTEGER) AS x, CAST(trunc((lat - 40.5e0) / (40.9e0 - 40.5e0) * 1000) AS INTEGER) AS y,
                  count(*) AS n FROM points GROUP BY 1, 2""",
        "points",
    ),
)
def geo_grid_cell(spark, sf_dir):
    x, y = geo.grid_cell(F.col("lat"), F.col("lon"))
    return V.view(spark, sf_dir, "points").groupBy(x.alias("x"), y.alias("y")).agg(F.count("*").alias("n"))


def located_schools(spark, sf_dir):
    schools = features.open_schools(V.view(spark, sf_dir, "schools"))
    return geo.assign_region(schools, V.polygons(spark), "lon", "lat", "borough")


OPEN_SCHOOLS_SQL = f"""SELECT s.point_id, s.category, g.region AS borough FROM (SELECT * FROM schools WHERE coalesce(status, 'Open') = 'Open') s
    LEFT JOIN ({PLACED_SQL.format(points='schools')}) g USING (point_id)"""


@check(
    "points_by_category",
    with_views(f"SELECT borough, category, count(*) AS n FROM ({OPEN_SCHOOLS_SQL}) GROUP BY 1, 2", "schools"),
)
def points_by_category(spark, sf_dir):
    return located_schools(spark, sf_dir).groupBy("borough", "category").agg(F.count("*").alias("n"))


SCHOOLS_SQL = f"""SELECT b.borough, h.datetime,
      count(s.point_id) FILTER (month(h.datetime) NOT IN (7, 8) AND hour(h.datetime) >= 8
        AND hour(h.datetime) < CASE s.category WHEN 'K-8' THEN 13 WHEN 'High school' THEN 14 WHEN 'Secondary School' THEN 14 ELSE 0 END) AS open_schools
    FROM {BOROUGHS_SQL} b CROSS JOIN {CONTEXT_SPINE} h LEFT JOIN ({OPEN_SCHOOLS_SQL}) s ON s.borough = b.borough GROUP BY 1, 2"""


@check("open_schools_hourly", with_views(SCHOOLS_SQL, "schools", "licences"))
def open_schools_hourly(spark, sf_dir):
    return features.open_schools_hourly(located_schools(spark, sf_dir), *V.context_span(spark, sf_dir))


AREAS_SQL = "(VALUES " + ", ".join(f"('{b}', {a}e0)" for b, a in V.BOROUGH_AREAS) + ") AS a(borough, area)"
LANDMARKS_SQL = f"""SELECT a.borough, round(coalesce(sum(l.area), 0) / any_value(a.area), 6) AS landmark_density,
      round(coalesce(sum(l.length), 0), 6) AS total_landmark_length, count(l.object_id) AS total_landmarks
    FROM {AREAS_SQL} LEFT JOIN (
      SELECT *, CASE borough WHEN 'SI' THEN 'Staten Island' WHEN 'QN' THEN 'Queens' WHEN 'MN' THEN 'Manhattan' WHEN 'BK' THEN 'Brooklyn' WHEN 'BX' THEN 'Bronx' END AS name
      FROM landmarks WHERE borough IS NOT NULL QUALIFY row_number() OVER (PARTITION BY object_id ORDER BY tie) = 1) l ON l.name = a.borough GROUP BY 1"""


def landmark_summary(spark, sf_dir):
    summary = features.landmark_summary(V.view(spark, sf_dir, "landmarks"), V.areas(spark))
    return rounded(summary, ["landmark_density", "total_landmark_length"])


@check("landmark_density", with_views(LANDMARKS_SQL, "landmarks"))
def landmark_density(spark, sf_dir):
    return landmark_summary(spark, sf_dir)


LANDMARKS_HOURLY_SQL = f"SELECT borough, datetime, landmark_density, total_landmark_length, total_landmarks FROM ({LANDMARKS_SQL}) CROSS JOIN {CONTEXT_SPINE}"


@check("landmark_hourly", with_views(LANDMARKS_HOURLY_SQL, "landmarks", "licences"))
def landmark_hourly(spark, sf_dir):
    return features.landmark_hourly(landmark_summary(spark, sf_dir), *V.context_span(spark, sf_dir))


@check("weather_union", with_views(f"SELECT borough, datetime, {rounded_sql(['temperature'])} FROM weather", "weather"))
def weather_union(spark, sf_dir):
    weather = V.view(spark, sf_dir, "weather").withColumnRenamed("datetime", "time")
    parts = {b: weather.filter(F.col("borough") == b).drop("borough") for b in rules.BOROUGHS}
    return rounded(features.weather_union(parts), ["temperature"])


@check(
    "resample_daily_mean",
    with_views(
        """, days AS (SELECT borough, unnest(generate_series(CAST(min(datetime) AS DATE), CAST(max(datetime) AS DATE), INTERVAL 1 DAY)) AS day FROM weather GROUP BY 1)
           SELECT d.borough, CAST(d.day AS DATE) AS day, round(avg(w.temperature), 6) AS temperature
           FROM days d LEFT JOIN weather w ON w.borough = d.borough AND CAST(w.datetime AS DATE) = CAST(d.day AS DATE) GROUP BY 1, 2""",
        "weather",
    ),
)
def resample_daily_mean(spark, sf_dir):
    return rounded(features.resample_daily(V.view(spark, sf_dir, "weather")), ["temperature"])


# --- assembly ------------------------------------------------------------------------------------

FLAG_SELECT = ", ".join(f"{e} AS {name}" for name, e in flag_sql("datetime").items())
# Holidays begin five days before the events and end ten days before them, so every side has rows that others lack.
HOLIDAY_SPAN = V.EVENT_START - timedelta(days=5), V.EVENT_END - timedelta(days=10)
HOLIDAY_SPINE = spine_sql(*HOLIDAY_SPAN)


@check(
    "join_outer_chain",
    with_views(
        f""", e AS ({events_sql(EVENT_SPINE, "city_events")}),
             h AS (SELECT borough, datetime, {FLAG_SELECT} FROM {BOROUGHS_SQL} CROSS JOIN {HOLIDAY_SPINE})
           SELECT borough, datetime, num_events, num_constructions, num_street_closures, round(temperature, 6) AS temperature,
                  {", ".join(holidays.FLAGS)}
           FROM e FULL JOIN weather USING (borough, datetime) FULL JOIN h USING (borough, datetime)""",
        "city_events",
        "weather",
    ),
)
def join_outer_chain(spark, sf_dir):
    """Events cover their month, weather the hours with events, holidays days of their own: unmatched rows on every side."""
    parts = [
        features.event_counts_hourly(V.view(spark, sf_dir, "city_events"), V.EVENT_START, V.EVENT_END),
        V.view(spark, sf_dir, "weather"),
        features.holidays_hourly(spark, *HOLIDAY_SPAN),
    ]
    return rounded(features.merge_features(parts), ["temperature"])


def feature_parts(spark, sf_dir):
    """The six feature tables over all years of licences and tickets."""
    span = V.context_span(spark, sf_dir)
    return [
        features.open_businesses_hourly(V.view(spark, sf_dir, "licences"), *span),
        features.event_counts_hourly(V.view(spark, sf_dir, "city_events_all"), *span),
        features.landmark_hourly(landmark_summary(spark, sf_dir), *span),
        features.open_schools_hourly(located_schools(spark, sf_dir), *span),
        rounded(V.view(spark, sf_dir, "weather_all"), ["temperature"]),
        features.holidays_hourly(spark, *span),
    ]


_STORES: dict[tuple[str, str], str] = {}


def stored_hourly(spark, sf_dir):
    """The hourly features as a stored table by year and borough, written once per session and table."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _STORES:
        path = work_folder(spark, "hourly_features")
        features.write_store(features.feature_table_hourly(feature_parts(spark, sf_dir)), path)
        _STORES[key] = path
    return features.read_store(spark, _STORES[key])


FEATURE_VIEWS = ["licences", "city_events_all", "landmarks", "schools", "weather_all"]
FEATURE_COLUMNS = [
    "open_businesses",
    "num_events",
    "num_constructions",
    "num_street_closures",
    "landmark_density",
    "total_landmark_length",
    "total_landmarks",
    "open_schools",
    "temperature",
    *holidays.FLAGS,
]
# Means of values with six digits often end half-way; both sides round those up, whatever the last bit says.
NUDGE = "1e-9"
HOURLY_SQL = f""", f_business AS MATERIALIZED ({BUSINESSES_SQL}), f_events AS MATERIALIZED ({events_sql(CONTEXT_SPINE, "city_events_all")}),
    f_landmarks AS MATERIALIZED ({LANDMARKS_HOURLY_SQL}), f_schools AS MATERIALIZED ({SCHOOLS_SQL}),
    f_weather AS MATERIALIZED (SELECT borough, datetime, round(temperature, 6) AS temperature FROM weather_all),
    f_holidays AS MATERIALIZED (SELECT borough, datetime, {FLAG_SELECT} FROM {BOROUGHS_SQL} CROSS JOIN {CONTEXT_SPINE}),
    hourly AS MATERIALIZED (SELECT borough, datetime, {", ".join(FEATURE_COLUMNS)} FROM f_business FULL JOIN f_events USING (borough, datetime)
      FULL JOIN f_landmarks USING (borough, datetime) FULL JOIN f_schools USING (borough, datetime)
      FULL JOIN f_weather USING (borough, datetime) FULL JOIN f_holidays USING (borough, datetime))"""
DAILY_SQL = HOURLY_SQL + f""", daily AS (SELECT borough, CAST(datetime AS DATE) AS day,
      {", ".join(f"round(avg({c}) + {NUDGE}, 6) AS {c}" for c in FEATURE_COLUMNS)} FROM hourly GROUP BY 1, 2)"""


@check("feature_table_hourly", with_views(HOURLY_SQL + " SELECT * FROM hourly", *FEATURE_VIEWS))
def feature_table_hourly(spark, sf_dir):
    return features.feature_table_hourly(feature_parts(spark, sf_dir))


def rounded_means(daily):
    return rounded(daily.withColumns({c: F.col(c) + F.lit(float(NUDGE)) for c in FEATURE_COLUMNS}), FEATURE_COLUMNS)


def daily_features(spark, sf_dir):
    """Daily means of the stored hours."""
    return rounded_means(features.daily_from_store(stored_hourly(spark, sf_dir)))


@check("feature_table_daily", with_views(DAILY_SQL + " SELECT * FROM daily", *FEATURE_VIEWS))
def feature_table_daily(spark, sf_dir):
    return rounded_means(features.feature_table_daily(feature_parts(spark, sf_dir)))


PER_DAY_SQL = f"""SELECT CAST({DATE_SQL} AS DATE) AS issue_date, {COUNTY_SQL} AS violation_county, count(*) AS tickets FROM tickets
    WHERE {DATE_SQL} >= TIMESTAMP '{V.START}' AND {DATE_SQL} < TIMESTAMP '{V.END}' AND {COUNTY_SQL} <> '-' GROUP BY 1, 2"""


@check(
    "join_daily_features",
    with_views(
        DAILY_SQL
        + f"""SELECT t.*, {", ".join(FEATURE_COLUMNS)} FROM ({PER_DAY_SQL}) t LEFT JOIN daily d ON d.borough = t.violation_county AND d.day = t.issue_date""",
        *FEATURE_VIEWS,
        "tickets",
    ),
)
def join_daily_features(spark, sf_dir):
    per_day = tickets.tickets_per_day(V.tickets(spark, sf_dir, "issue_date", "violation_county"), V.START, V.END)
    return tickets.join_daily(per_day, daily_features(spark, sf_dir))


@check(
    "daily_ticket_features",
    with_views(
        DAILY_SQL
        + f"""SELECT t.issue_date, t.tickets, {", ".join(FEATURE_COLUMNS)},
              {", ".join(f"CAST(t.violation_county = '{b}' AS INTEGER) AS \"violation_county_{b}\"" for b in rules.BOROUGHS)}
            FROM ({PER_DAY_SQL}) t LEFT JOIN daily d ON d.borough = t.violation_county AND d.day = t.issue_date""",
        *FEATURE_VIEWS,
        "tickets",
    ),
)
def daily_ticket_features(spark, sf_dir):
    source = V.tickets(spark, sf_dir, "issue_date", "violation_county")
    return tickets.daily_ticket_features(source, daily_features(spark, sf_dir), V.START, V.END)


@check(
    "join_hourly_features",
    with_views(
        HOURLY_SQL
        + f"""SELECT issue_time, violation_county, count(*) AS n, {", ".join(FEATURE_COLUMNS)} FROM (
                SELECT {ISSUE_SQL} AS issue_time, {COUNTY_SQL} AS violation_county FROM tickets
                WHERE {ISSUE_SQL} >= TIMESTAMP '{V.START}' AND {ISSUE_SQL} < TIMESTAMP '{V.END}' AND {COUNTY_SQL} <> '-') t
              LEFT JOIN hourly ON hourly.borough = t.violation_county AND hourly.datetime = t.issue_time GROUP BY ALL""",
        *FEATURE_VIEWS,
        "tickets",
    ),
)
def join_hourly_features(spark, sf_dir):
    """Every ticket meets its hour; only then are tickets counted."""
    source = V.tickets(spark, sf_dir, "issue_date", "violation_time", "violation_county", spread=True)
    cleaned = tickets.clean_tickets(source, V.START, V.END)
    joined = tickets.join_hourly(cleaned, stored_hourly(spark, sf_dir), V.START, V.END)
    # The features of an hour are the same on all its tickets: grouping by the hour groups by them.
    values = [F.first(c).alias(c) for c in FEATURE_COLUMNS]
    return joined.groupBy("issue_time", "violation_county").agg(F.count("*").alias("n"), *values)


@check(
    "join_stored_features",
    with_views(
        HOURLY_SQL
        + f""", late AS (SELECT {ISSUE_SQL} AS issue_time, {COUNTY_SQL} AS violation_county FROM tickets
                WHERE {ISSUE_SQL} >= TIMESTAMP '{V.TEST}' AND {ISSUE_SQL} < TIMESTAMP '{V.END}' AND {COUNTY_SQL} IN ('Bronx', 'Queens'))
           SELECT violation_county, count(*) AS n, count(open_businesses) AS n_met, CAST(sum(open_businesses) AS BIGINT) AS open_businesses,
                  CAST(sum(num_events) AS BIGINT) AS num_events, count(temperature) AS n_temperature
           FROM late LEFT JOIN hourly ON hourly.borough = late.violation_county AND hourly.datetime = late.issue_time GROUP BY 1""",
        *FEATURE_VIEWS,
        "tickets",
    ),
)
def join_stored_features(spark, sf_dir):
    """Tickets of two boroughs in the last year; the folders to read follow from the tickets at run time."""
    source = V.tickets(spark, sf_dir, "issue_date", "violation_time", "violation_county", spread=True)
    cleaned = materialize(tickets.clean_tickets(source, V.TEST, V.END), "late_tickets")
    late = cleaned.filter(F.col("violation_county").isin("Bronx", "Queens"))
    store = features.read_needed(stored_hourly(spark, sf_dir), late, "issue_time", "violation_county")
    joined = tickets.join_hourly(late, store, V.TEST, V.END)
    return joined.groupBy("violation_county").agg(
        F.count("*").alias("n"),
        F.count("open_businesses").alias("n_met"),
        F.sum("open_businesses").alias("open_businesses"),
        F.sum("num_events").alias("num_events"),
        F.count("temperature").alias("n_temperature"),
    )
