"""Exploratory aggregates, joins, top-k and the street analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views as V
from checks.columns import COMBO_SQL, COUNTY_SQL, DATE_SQL, USABLE_SQL
from checks.registry import check
from checks.views import with_views
from urbanspark.functions import clean
from urbanspark.operators import explore, quantiles
from urbanspark.plans import tickets
from urbanspark.streaming import windows

STATS = explore.STATISTICS


def rounded(df, columns, digits=6):
    """Columns as doubles of ``digits`` (0 or more) decimals. Spark rounds a double as a decimal number; whole ones need none (0.0 is added for the sign of -0.0)."""

    def short(c):
        number = F.col(c).cast("double")
        return F.when(F.rint(number) == number, number + F.lit(0.0)).otherwise(F.round(number, digits))

    return df.withColumns({c: short(c) for c in columns})


def rounded_sql(columns, digits=6):
    return ", ".join(f"round(CAST({c} AS DOUBLE), {digits}) AS {c}" for c in columns)


# --- frequencies ---------------------------------------------------------------------------------


def frequency(name, column, k=None):
    limit = f" ORDER BY n DESC, {column} LIMIT {k}" if k else ""
    sql = with_views(f"SELECT {column}, count(*) AS n FROM tickets WHERE {column} IS NOT NULL GROUP BY 1{limit}", "tickets")

    @check(name, sql)
    def query(spark, sf_dir):
        source = V.tickets(spark, sf_dir, column)
        return explore.top_k(source, column, k=k) if k else explore.value_counts(source, column)

    return query


frequency("freq_state", "registration_state")
frequency("freq_agency", "issuing_agency")
frequency("hist_violation_time", "violation_time")
frequency("top_body", "vehicle_body_type", 10)
frequency("top_code", "violation_code", 10)
frequency("top_precinct", "violation_precinct", 10)
frequency("top_make", "vehicle_make", 10)


@check(
    "violations_over_time",
    with_views("SELECT try_cast(issue_date AS DATE) AS day, count(*) AS n FROM tickets WHERE try_cast(issue_date AS DATE) IS NOT NULL GROUP BY 1", "tickets"),
)
def violations_over_time(spark, sf_dir):
    days = V.tickets(spark, sf_dir, "issue_date").select(clean.to_date_or_null("issue_date").alias("day")).dropna()
    return days.groupBy("day").agg(F.count("*").alias("n")).orderBy("day")


STREET_KEYS = ["street_code1", "street_code2", "street_code3", "violation_post_code"]
STREET_FILTER = "violation_post_code IS NOT NULL AND street_code1 <> 0 AND street_code2 <> 0 AND street_code3 <> 0"
STREET_COUNT_SQL = f"SELECT {', '.join(STREET_KEYS)}, count(*) AS n FROM tickets WHERE {STREET_FILTER} GROUP BY ALL"
TOP_SQL = f"{STREET_COUNT_SQL} ORDER BY n DESC, {', '.join(STREET_KEYS)} LIMIT 20"


@check("street_group_count", with_views(STREET_COUNT_SQL, "tickets"))
def street_group_count(spark, sf_dir):
    return explore.value_counts(tickets.with_street_codes(V.tickets(spark, sf_dir, *STREET_KEYS)), *STREET_KEYS)


@check("top_streets", with_views(TOP_SQL, "tickets"))
def top_streets(spark, sf_dir):
    return tickets.top_streets(V.tickets(spark, sf_dir, *STREET_KEYS))


@check(
    "tickets_per_day_county",
    with_views(
        f"""SELECT CAST({DATE_SQL} AS DATE) AS issue_date, {COUNTY_SQL} AS violation_county, count(*) AS tickets FROM tickets
            WHERE {DATE_SQL} >= TIMESTAMP '{V.START}' AND {DATE_SQL} < TIMESTAMP '{V.END}' AND {COUNTY_SQL} <> '-' GROUP BY 1, 2""",
        "tickets",
    ),
)
def tickets_per_day_county(spark, sf_dir):
    return tickets.tickets_per_day(V.tickets(spark, sf_dir, "issue_date", "violation_county"), V.START, V.END).orderBy(
        "issue_date", "violation_county"
    )


@check("distinct_values", with_views("SELECT DISTINCT registration_state, issuing_agency FROM tickets", "tickets"))
def distinct_values(spark, sf_dir):
    return V.tickets(spark, sf_dir, "registration_state", "issuing_agency").distinct()


# --- statistics ----------------------------------------------------------------------------------

LIVE_VIEW = """, live AS (SELECT message_offset, message_offset // 1000 AS batch_no, strftime(try_cast(issue_date AS DATE), '%Y-%m') AS year_month,
    {county} AS violation_county, split_part({street}, '|', 1) AS street, try_cast(vehicle_year AS DOUBLE) AS v
    FROM messages WHERE {usable})"""


def live_sql(body: str) -> str:
    from checks.columns import LIVE_SQL, STREET_SQL

    return with_views(LIVE_VIEW.format(county=LIVE_SQL, street=STREET_SQL, usable=USABLE_SQL) + body, "messages")


STATS_SQL = """avg(v) AS mean, stddev_samp(v) AS std, median(v) AS median, max(v) AS max, min(v) AS min"""


def month_stats_sql(group: str) -> str:
    return live_sql(
        f"SELECT year_month, {group}, {rounded_sql(STATS)} FROM (SELECT year_month, {group}, {STATS_SQL} FROM live WHERE {group} IS NOT NULL GROUP BY 1, 2)"
    )


@check("month_borough_stats", month_stats_sql("violation_county"))
def month_borough_stats(spark, sf_dir):
    return rounded(windows.month_stats(V.view(spark, sf_dir, "messages"), "violation_county", V.MIN_YEAR), STATS)


@check("month_street_stats", month_stats_sql("street"))
def month_street_stats(spark, sf_dir):
    return rounded(windows.month_stats(V.view(spark, sf_dir, "messages"), "street", V.MIN_YEAR), STATS)


@check(
    "month_overall_stats",
    live_sql(
        f"""SELECT year_month, {rounded_sql(STATS)} FROM (SELECT year_month, {", ".join(f"avg({c}) AS {c}" for c in STATS)} FROM
            (SELECT year_month, violation_county, {STATS_SQL} FROM live WHERE violation_county IS NOT NULL GROUP BY 1, 2) GROUP BY 1)"""
    ),
)
def month_overall_stats(spark, sf_dir):
    stats = windows.month_stats(V.view(spark, sf_dir, "messages"), "violation_county", V.MIN_YEAR)
    return rounded(explore.mean_of_groups(stats, ["year_month"]), STATS)


@check(
    "sort_month_group",
    with_views(
        f"""SELECT strftime({DATE_SQL}, '%Y-%m') AS year_month, registration_state,
              round(avg(vehicle_year), 6) AS mean, round(stddev_samp(vehicle_year), 6) AS std, CAST(median(vehicle_year) AS DOUBLE) AS median,
              CAST(max(vehicle_year) AS DOUBLE) AS max, CAST(min(vehicle_year) AS DOUBLE) AS min
            FROM tickets WHERE {DATE_SQL} IS NOT NULL AND vehicle_year <> 0 GROUP BY 1, 2""",
        "tickets",
    ),
)
def sort_month_group(spark, sf_dir):
    source = V.tickets(spark, sf_dir, "issue_date", "registration_state", "vehicle_year").filter("vehicle_year <> 0")
    dated = source.withColumn("year_month", clean.month_period(clean.to_timestamp_or_null("issue_date")))
    stats = explore.group_stats(dated, ["year_month", "registration_state"], "vehicle_year", windows.YEAR_CENTER)
    return rounded(stats, STATS).orderBy("year_month", "registration_state")


@check(
    "crosstab_counts",
    with_views(
        "SELECT violation_precinct, "
        + ", ".join(f"count(*) FILTER (violation_location = {i}) AS location_{i}" for i in range(10))
        + " FROM tickets GROUP BY 1",
        "tickets",
    ),
)
def crosstab_counts(spark, sf_dir):
    source = V.tickets(spark, sf_dir, "violation_precinct", "violation_location")
    return explore.crosstab(source, "violation_precinct", "violation_location", list(range(10)), "location_")


@check(
    "corr_pairs",
    with_views(
        """, complete AS (SELECT CAST(vehicle_year AS DOUBLE) AS x, CAST(feet_from_curb AS DOUBLE) AS y FROM tickets
             WHERE vehicle_year IS NOT NULL AND feet_from_curb IS NOT NULL)
           SELECT 'vehicle_year' AS a, 'vehicle_year' AS b, round(corr(x, x), 6) AS r FROM complete
           UNION ALL SELECT 'feet_from_curb', 'feet_from_curb', round(corr(y, y), 6) FROM complete
           UNION ALL SELECT 'vehicle_year', 'feet_from_curb', round(corr(x, y), 6) FROM complete
           UNION ALL SELECT 'feet_from_curb', 'vehicle_year', round(corr(x, y), 6) FROM complete""",
        "tickets",
    ),
)
def corr_pairs(spark, sf_dir):
    source = V.tickets(spark, sf_dir, "vehicle_year", "feet_from_curb")
    return rounded(explore.correlation_matrix(source, ["vehicle_year", "feet_from_curb"]), ["r"])


YEAR_FILTER_SQL = "coalesce(try_cast(vehicle_year AS INTEGER), 0) <> 0"


@check(
    "hist_vehicle_year",
    with_views(
        f""", years AS (SELECT CAST(vehicle_year AS DOUBLE) AS v FROM tickets WHERE {YEAR_FILTER_SQL}),
             ends AS (SELECT min(v) AS lo, max(v) AS hi FROM years),
             placed AS (SELECT least(CAST(floor((v - lo) * 30 / (hi - lo)) AS BIGINT), 29) AS bin, count(*) AS n FROM years, ends GROUP BY 1)
           SELECT b.bin, round(lo + b.bin * (hi - lo) / 30, 6) AS low, round(lo + (b.bin + 1) * (hi - lo) / 30, 6) AS high, coalesce(n, 0) AS n
           FROM (SELECT unnest(range(30)) AS bin) b CROSS JOIN ends LEFT JOIN placed ON b.bin = placed.bin""",
        "tickets",
    ),
)
def hist_vehicle_year(spark, sf_dir):
    source = V.tickets(spark, sf_dir, "vehicle_year").withColumn("vehicle_year", clean.to_number_or_zero("vehicle_year"))
    return rounded(explore.histogram(source.filter("vehicle_year <> 0"), "vehicle_year", 30), ["low", "high"])


def box_sql(column: str, where: str) -> str:
    return with_views(
        f""", x AS (SELECT CAST({column} AS DOUBLE) AS v FROM tickets WHERE {where}),
             q AS (SELECT quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM x),
             f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
           SELECT count(*) AS n, any_value(q1) AS q1, any_value(median) AS median, any_value(q3) AS q3,
                  min(v) FILTER (v BETWEEN lo AND hi) AS whisker_low, max(v) FILTER (v BETWEEN lo AND hi) AS whisker_high,
                  count(*) FILTER (NOT v BETWEEN lo AND hi) AS n_outliers FROM x, f""",
        "tickets",
    )


@check("box_feet", box_sql("feet_from_curb", "feet_from_curb IS NOT NULL"))
def box_feet(spark, sf_dir):
    return explore.box_summary(V.tickets(spark, sf_dir, "feet_from_curb"), "feet_from_curb")


@check("box_vehicle_year", box_sql("vehicle_year", YEAR_FILTER_SQL))
def box_vehicle_year(spark, sf_dir):
    source = V.tickets(spark, sf_dir, "vehicle_year").withColumn("vehicle_year", clean.to_number_or_zero("vehicle_year"))
    return explore.box_summary(source.filter("vehicle_year <> 0"), "vehicle_year")


@check(
    "box_price",
    """WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem),
          f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
       SELECT count(*) AS n, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
              min(l_extendedprice) FILTER (l_extendedprice BETWEEN lo AND hi) AS whisker_low,
              max(l_extendedprice) FILTER (l_extendedprice BETWEEN lo AND hi) AS whisker_high,
              count(*) FILTER (NOT l_extendedprice BETWEEN lo AND hi) AS n_outliers FROM lineitem, f""",
)
def box_price(spark, sf_dir):
    """Nearly all values differ here, so the quartiles come from ranges, not from a short value list."""
    return rounded(explore.box_summary(V.table(spark, sf_dir, "lineitem"), "l_extendedprice"), ["q1", "median", "q3"])


@check(
    "box_price_by_flag",
    """WITH q AS (SELECT l_returnflag, l_linestatus, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median,
                    quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY 1, 2),
          f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
       SELECT l_returnflag, l_linestatus, count(*) AS n, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median,
              round(any_value(q3), 6) AS q3, min(l_extendedprice) FILTER (l_extendedprice BETWEEN lo AND hi) AS whisker_low,
              max(l_extendedprice) FILTER (l_extendedprice BETWEEN lo AND hi) AS whisker_high,
              CAST(count(*) FILTER (NOT l_extendedprice BETWEEN lo AND hi) AS BIGINT) AS n_outliers
       FROM lineitem JOIN f USING (l_returnflag, l_linestatus) GROUP BY 1, 2""",
)
def box_price_by_flag(spark, sf_dir):
    """Few groups with nearly as many distinct values as rows."""
    boxes = quantiles.box_per_key(V.table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice")
    return rounded(boxes, ["q1", "median", "q3"])


# --- sets, dedup, joins --------------------------------------------------------------------------


@check(
    "union_parts",
    with_views(
        f"SELECT {COUNTY_SQL} AS borough, count(*) AS n, count(feet) AS n_feet FROM (SELECT violation_county, CASE WHEN issuing_agency = 'T' THEN feet_from_curb END AS feet FROM tickets) GROUP BY 1",
        "tickets",
    ),
)
def union_parts(spark, sf_dir):
    source = V.tickets(spark, sf_dir, "violation_county", "issuing_agency", "feet_from_curb")
    one = source.filter("issuing_agency = 'T'").select("violation_county", "feet_from_curb")
    two = source.filter("issuing_agency <> 'T'").select("violation_county")
    both = one.unionByName(two, allowMissingColumns=True)
    return both.groupBy(clean.county_clean("violation_county").alias("borough")).agg(
        F.count("*").alias("n"), F.count("feet_from_curb").alias("n_feet")
    )


@check(
    "dedup_first",
    with_views("SELECT object_id, borough, length, area FROM landmarks QUALIFY row_number() OVER (PARTITION BY object_id ORDER BY tie) = 1", "landmarks"),
)
def dedup_first(spark, sf_dir):
    return explore.first_per_key(V.view(spark, sf_dir, "landmarks"), ["object_id"], ["tie"]).drop("tie")


@check(
    "semi_join_streets",
    with_views(
        f""", top AS ({TOP_SQL}) SELECT {COMBO_SQL} AS street_code, violation_code, count(*) AS n FROM tickets
            WHERE {COMBO_SQL} IN (SELECT {COMBO_SQL} FROM top) GROUP BY 1, 2""",
        "tickets",
    ),
)
def semi_join_streets(spark, sf_dir):
    source = V.tickets(spark, sf_dir, *STREET_KEYS, "violation_code")
    listed = tickets.with_combo(tickets.top_streets(source)).select("street_code").distinct()
    on_top = tickets.with_combo(source).join(F.broadcast(listed), "street_code", "left_semi")  # at most 20 keys
    return on_top.groupBy("street_code", "violation_code").agg(F.count("*").alias("n"))


@check(
    "join_street_names",
    with_views(
        f""", top AS ({TOP_SQL}),
             names AS (SELECT {COMBO_SQL} AS street_code, replace(street_name, 'W ', 'WEST ') AS street_name,
                         row_number() OVER (PARTITION BY {COMBO_SQL} ORDER BY issue_date, summons_number, tickets.street_name) AS r FROM tickets)
           SELECT {COMBO_SQL} AS street_code, violation_post_code, n, street_name
           FROM top LEFT JOIN names ON names.street_code = {COMBO_SQL} AND r = 1""",
        "tickets",
    ),
)
def join_street_names(spark, sf_dir):
    source = V.tickets(spark, sf_dir, *STREET_KEYS, "street_name", "issue_date", "summons_number")
    return tickets.name_streets(tickets.top_streets(source), source, ["issue_date", "summons_number"])


@check(
    "street_number_bounds",
    with_views(
        f"""SELECT {COMBO_SQL} AS street_code, min(house) AS house_min, max(house) AS house_max
            FROM (SELECT *, coalesce(try_cast(house_number AS INTEGER), 0) AS house FROM tickets) WHERE house <> 0 GROUP BY 1""",
        "tickets",
    ),
)
def street_number_bounds(spark, sf_dir):
    return tickets.house_bounds(tickets.with_combo(V.tickets(spark, sf_dir, *STREET_KEYS[:3], "house_number")))


def street_ends(combos):
    """End points of each street, as a geocoder would give them: arithmetic on its codes."""
    a, b, c = (F.element_at(F.split("street_code", "-"), i).cast("double") for i in (1, 2, 3))
    return combos.select(
        "street_code",
        (F.lit(-74.2) + a / 1000).alias("first_lon"),
        (F.lit(40.6) + b / 1000).alias("first_lat"),
        (F.lit(-74.1) + a / 1000 + c / 1000).alias("last_lon"),
        (F.lit(40.7) + b / 2000).alias("last_lat"),
    )


@check(
    "geo_interpolate",
    with_views(
        f""", top AS (SELECT DISTINCT {COMBO_SQL} AS street_code FROM ({TOP_SQL})),
             houses AS (SELECT {COMBO_SQL} AS street_code, coalesce(try_cast(house_number AS INTEGER), 0) AS house,
                          -74.2e0 + street_code1 / 1000e0 AS x1, 40.6e0 + street_code2 / 1000e0 AS y1,
                          -74.1e0 + street_code1 / 1000e0 + street_code3 / 1000e0 AS x2, 40.7e0 + street_code2 / 2000e0 AS y2
                        FROM tickets WHERE {COMBO_SQL} IN (SELECT street_code FROM top)),
             bounds AS (SELECT street_code, min(house) AS lo, max(house) AS hi FROM houses WHERE house <> 0 GROUP BY 1)
           SELECT street_code, house, count(*) AS n,
             round(CASE WHEN house = 0 THEN (y1 + y2) / 2 ELSE y1 + (house - hi) / nullif(CAST(lo - hi AS DOUBLE), 0) * (y2 - y1) END, 6) AS lat,
             round(CASE WHEN house = 0 THEN (x1 + x2) / 2 ELSE x1 + (house - hi) / nullif(CAST(lo - hi AS DOUBLE), 0) * (x2 - x1) END, 6) AS lon
           FROM houses JOIN bounds USING (street_code) GROUP BY ALL""",
        "tickets",
    ),
)
def geo_interpolate(spark, sf_dir):
    source = V.tickets(spark, sf_dir, *STREET_KEYS, "house_number")
    streets = tickets.with_combo(tickets.top_streets(source)).select("street_code").distinct()
    placed = tickets.locate_houses(tickets.with_combo(source), street_ends(streets), streets)
    return rounded(placed, ["lat", "lon"]).groupBy("street_code", "house", "lat", "lon").agg(F.count("*").alias("n"))
