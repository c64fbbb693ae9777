"""Projections, filters and scalar rules. Results are grouped by the input text, over all rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views as V
from checks.registry import check
from checks.scans import FOLD
from checks.views import with_views
from urbanspark.functions import clean, rules
from urbanspark.operators import encode
from urbanspark.operators.explore import distinct_counts
from urbanspark.operators.tables import materialize
from urbanspark.plans import features, tickets
from urbanspark.streaming.windows import usable_year


def case_of(column: str, table: dict[str, list[str]], default: str) -> str:
    """SQL CASE of a lookup table, for the comparison."""
    branches = " ".join(f"WHEN {column} = '{key}' THEN '{value}'" for value, keys in table.items() for key in keys)
    return f"CASE {branches} ELSE {default} END"


COUNTY_SQL = case_of("upper(violation_county)", rules.COUNTY_TO_BOROUGH, "'-'")
LIVE_SQL = case_of("violation_county", rules.COUNTY_TO_LIVE_CODE, "violation_county")
DATE_SQL = "try_cast(issue_date AS TIMESTAMP)"


def counted(df, *columns):
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


# --- projections and filters ---------------------------------------------------------------------


@check("proj_drop", "SELECT o_orderkey, o_orderdate, o_orderpriority FROM orders")
def proj_drop(spark, sf_dir):
    return V.table(spark, sf_dir, "orders").drop("o_custkey", "o_orderstatus", "o_totalprice")


@check(
    "dropna_subset",
    with_views(
        "SELECT issuing_agency, count(*) AS n FROM tickets WHERE plate_type IS NOT NULL AND vehicle_make IS NOT NULL GROUP BY 1",
        "tickets",
    ),
)
def dropna_subset(spark, sf_dir):
    source = V.tickets(spark, sf_dir, "issuing_agency", "plate_type", "vehicle_make")
    return counted(source.dropna(subset=["plate_type", "vehicle_make"]), "issuing_agency")


@check(
    "fillna_const",
    with_views(
        "SELECT coalesce(vehicle_make, 'other') AS vehicle_make, coalesce(vehicle_year, 0) AS vehicle_year, count(*) AS n FROM tickets GROUP BY 1, 2",
        "tickets",
    ),
)
def fillna_const(spark, sf_dir):
    source = V.tickets(spark, sf_dir, "vehicle_make", "vehicle_year")
    return counted(source.fillna({"vehicle_make": "other", "vehicle_year": 0}), "vehicle_make", "vehicle_year")


@check(
    "filter_default_open",
    with_views(
        "SELECT point_id, category, open_date FROM schools WHERE coalesce(status, 'Open') = 'Open' AND open_date IS NOT NULL", "schools"
    ),
)
def filter_default_open(spark, sf_dir):
    return features.open_schools(V.view(spark, sf_dir, "schools")).select("point_id", "category", "open_date")


@check(
    "filter_time_range",
    with_views(
        f"""SELECT issuing_agency, count(*) AS n, min({DATE_SQL}) AS first_day, max({DATE_SQL}) AS last_day FROM tickets
            WHERE {DATE_SQL} >= TIMESTAMP '{V.START}' AND {DATE_SQL} < TIMESTAMP '{V.END}' GROUP BY 1""",
        "tickets",
    ),
)
def filter_time_range(spark, sf_dir):
    source = V.tickets(spark, sf_dir, "issuing_agency", "issue_date")
    dated = source.withColumn("issue_date", clean.to_timestamp_or_null("issue_date"))
    return (
        tickets.in_range(dated, "issue_date", V.START, V.END)
        .groupBy("issuing_agency")
        .agg(F.count("*").alias("n"), F.min("issue_date").alias("first_day"), F.max("issue_date").alias("last_day"))
    )


@check(
    "filter_street_codes",
    with_views(
        """SELECT street_code1, street_code2, street_code3, count(*) AS n FROM tickets WHERE violation_post_code IS NOT NULL
           AND street_code1 <> 0 AND street_code2 <> 0 AND street_code3 <> 0 GROUP BY 1, 2, 3""",
        "tickets",
    ),
)
def filter_street_codes(spark, sf_dir):
    codes = ["street_code1", "street_code2", "street_code3"]
    return counted(tickets.with_street_codes(V.tickets(spark, sf_dir, *codes, "violation_post_code")), *codes)


USABLE_SQL = f"""vehicle_year IS NOT NULL AND vehicle_year NOT IN ('', '0') AND coalesce(try_cast(vehicle_year AS DOUBLE), 1) <> 0
           AND year(try_cast(issue_date AS DATE)) > {V.MIN_YEAR}"""


@check(
    "filter_vehicle_year",
    with_views(f"SELECT vehicle_year, issue_date, count(*) AS n FROM messages WHERE {USABLE_SQL} GROUP BY 1, 2", "messages"),
)
def filter_vehicle_year(spark, sf_dir):
    return counted(V.view(spark, sf_dir, "messages").filter(usable_year(V.MIN_YEAR)), "vehicle_year", "issue_date")


@check(
    "label_binary",
    with_views(
        "SELECT registration_state, CAST(registration_state = 'NY' AS INTEGER) AS label, count(*) AS n FROM tickets GROUP BY 1, 2",
        "tickets",
    ),
)
def label_binary(spark, sf_dir):
    source = V.tickets(spark, sf_dir, "registration_state")
    return counted(source.withColumn("label", (F.col("registration_state") == "NY").cast("int")), "registration_state", "label")


NUNIQUE_COLUMNS = ["plate_type", "issuing_agency", "vehicle_year", "feet_from_curb", "street_code1", "same", "nothing"]


@check(
    "drop_constant_nunique",
    with_views(
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS column, count(DISTINCT {c}) AS n_distinct FROM (SELECT *, 1 AS same, NULL AS nothing FROM tickets)"
            for c in NUNIQUE_COLUMNS
        )
        + ") WHERE n_distinct <> 1",
        "tickets",
    ),
)
def drop_constant_nunique(spark, sf_dir):
    source = V.tickets(spark, sf_dir, *NUNIQUE_COLUMNS[:-2])
    source = source.withColumns({"same": F.lit(1), "nothing": F.lit(None).cast("int")})
    kept = source.drop(*encode.constant_columns_by_distinct(source, NUNIQUE_COLUMNS))
    return distinct_counts(kept, kept.columns)


STD_COLUMNS = ["violation_code", "vehicle_year", "feet_from_curb", "same"]


@check(
    "drop_constant_std",
    with_views(
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS column, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std
                FROM (SELECT *, 1 AS same FROM tickets) WHERE {DATE_SQL} < TIMESTAMP '{V.TEST}'"""
            for c in STD_COLUMNS
        )
        + ") WHERE std > 0",
        "tickets",
    ),
)
def drop_constant_std(spark, sf_dir):
    source = V.tickets(spark, sf_dir, *STD_COLUMNS[:-1], "issue_date").withColumn("same", F.lit(1))
    dated = source.withColumn("issue_date", clean.to_timestamp_or_null("issue_date"))
    train, _ = encode.split_by_time(dated, "issue_date", V.TEST)
    # Written once: joining the view shuffles far more than these columns hold, and two passes read them.
    train = materialize(train.select(*STD_COLUMNS), "std_columns")
    kept = [c for c in STD_COLUMNS if c not in encode.constant_columns_by_deviation(train, STD_COLUMNS)]
    moments = encode.column_moments(train, kept)
    return moments.select("column", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@check(
    "split_by_time",
    with_views(
        f"""SELECT part, violation_code, count(*) AS n FROM (
              SELECT violation_code, CASE WHEN {DATE_SQL} < TIMESTAMP '{V.TEST}' THEN 'train' ELSE 'test' END AS part
              FROM tickets WHERE {DATE_SQL} IS NOT NULL) GROUP BY 1, 2""",
        "tickets",
    ),
)
def split_by_time(spark, sf_dir):
    source = V.tickets(spark, sf_dir, "violation_code", "issue_date")
    dated = source.withColumn("issue_date", clean.to_timestamp_or_null("issue_date"))
    train, test = encode.split_by_time(dated, "issue_date", V.TEST)
    labelled = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return counted(labelled, "part", "violation_code")


# --- codes ---------------------------------------------------------------------------------------


@check(
    "county_clean",
    with_views(
        f"SELECT violation_county, {COUNTY_SQL} AS borough, count(*) AS n FROM tickets WHERE {COUNTY_SQL} <> '-' GROUP BY 1, 2", "tickets"
    ),
)
def county_clean(spark, sf_dir):
    source = V.tickets(spark, sf_dir, "violation_county").withColumn("borough", clean.county_clean("violation_county"))
    return counted(source.filter("borough <> '-'"), "violation_county", "borough")


@check(
    "borough_passthrough",
    with_views(
        f"""SELECT violation_county, {LIVE_SQL} AS live,
                   {case_of("violation_county", rules.COUNTY_TO_BOROUGH, "violation_county")} AS borough, count(*) AS n
            FROM tickets GROUP BY 1, 2, 3""",
        "tickets",
    ),
)
def borough_passthrough(spark, sf_dir):
    source = V.tickets(spark, sf_dir, "violation_county").withColumns(
        {"live": clean.county_live("violation_county"), "borough": clean.county_pass_through("violation_county")}
    )
    return counted(source, "violation_county", "live", "borough")


# The clock rule as arithmetic on the text, written without the conversion step.
CLOCK_SQL = """CASE
    WHEN {c} IS NULL OR length({c}) < 2 THEN NULL
    WHEN right({c}, 1) = 'A' AND left({c}, 2) = '12' THEN 0
    WHEN right({c}, 1) = 'A' OR (right({c}, 1) = 'P' AND left({c}, 2) = '12')
      THEN CAST(floor(try_cast({c}[:-2] AS INTEGER) / 100.0) AS INTEGER) + CAST(try_cast({c}[:-2] AS INTEGER) % 100 >= 30 AS INTEGER)
    ELSE CAST(floor(try_cast(CAST(try_cast(left({c}, 2) AS INTEGER) + 12 AS VARCHAR) || {c}[3:-2] AS INTEGER) / 100.0) AS INTEGER)
       + CAST(try_cast(CAST(try_cast(left({c}, 2) AS INTEGER) + 12 AS VARCHAR) || {c}[3:-2] AS INTEGER) % 100 >= 30 AS INTEGER) END"""
HOUR_SQL = CLOCK_SQL.format(c="violation_time")
ISSUE_SQL = f"({DATE_SQL} + {HOUR_SQL} * INTERVAL 1 HOUR)"


@check("clock_to_hour", with_views(f"SELECT violation_time, {HOUR_SQL} AS hour, count(*) AS n FROM tickets GROUP BY 1, 2", "tickets"))
def clock_to_hour(spark, sf_dir):
    source = V.tickets(spark, sf_dir, "violation_time").withColumn("hour", clean.clock_hour("violation_time"))
    return counted(source, "violation_time", "hour")


@check(
    "hours_in_effect",
    with_views(
        f"""SELECT from_hours_in_effect, to_hours_in_effect, coalesce({CLOCK_SQL.format(c="from_hours_in_effect")}, 0) AS from_hour,
                   coalesce({CLOCK_SQL.format(c="to_hours_in_effect")}, 24) AS to_hour, count(*) AS n FROM tickets GROUP BY 1, 2, 3, 4""",
        "tickets",
    ),
)
def hours_in_effect(spark, sf_dir):
    columns = ["from_hours_in_effect", "to_hours_in_effect"]
    source = V.tickets(spark, sf_dir, *columns).withColumns(
        {
            "from_hour": clean.hour_in_effect("from_hours_in_effect", 0),
            "to_hour": clean.hour_in_effect("to_hours_in_effect", 24),
        }
    )
    return counted(source, *columns, "from_hour", "to_hour")


@check("issue_time", with_views(f"SELECT {ISSUE_SQL} AS issue_time, count(*) AS n FROM tickets GROUP BY 1", "tickets"))
def issue_time(spark, sf_dir):
    source = V.tickets(spark, sf_dir, "issue_date", "violation_time", spread=True)
    date = clean.to_timestamp_or_null("issue_date")
    return counted(source.select(clean.issue_time(date, clean.clock_hour("violation_time")).alias("issue_time")), "issue_time")


@check(
    "date_coerce",
    with_views("SELECT issue_date, try_cast(issue_date AS DATE) AS day, count(*) AS n FROM tickets GROUP BY 1, 2", "tickets"),
)
def date_coerce(spark, sf_dir):
    source = V.tickets(spark, sf_dir, "issue_date").withColumn("day", clean.to_date_or_null("issue_date"))
    return counted(source, "issue_date", "day")


@check(
    "date_mixed",
    """SELECT o_orderdate AS parsed, count(*) AS n FROM orders GROUP BY 1""",
)
def date_mixed(spark, sf_dir):
    orders = V.table(spark, sf_dir, "orders")
    # Each priority writes its dates in another format.
    texts = orders.select(
        F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format("o_orderdate", "MM/dd/yyyy"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.date_format("o_orderdate", "MM/dd/yyyy hh:mm:ss a"))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .when(F.col("o_orderpriority") == "5-LOW", F.date_format("o_orderdate", "MMMM d, yyyy"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("text")
    )
    return counted(texts.select(clean.to_timestamp_strict("text").alias("parsed")), "parsed")


@check(
    "num_coerce",
    with_views(
        """SELECT house_number, try_cast(house_number AS DOUBLE) AS number, coalesce(try_cast(house_number AS INTEGER), 0) AS whole, count(*) AS n
           FROM tickets GROUP BY 1, 2, 3""",
        "tickets",
    ),
)
def num_coerce(spark, sf_dir):
    source = V.tickets(spark, sf_dir, "house_number").withColumns(
        {"number": clean.to_number("house_number"), "whole": clean.to_number_or_zero("house_number")}
    )
    return counted(source, "house_number", "number", "whole")


# Written out by value, not by rule: the stand-in has these body types only.
BODY_SQL = """CASE vehicle_body_type WHEN 'SEDN' THEN 'SD' WHEN 'subn' THEN 'SU' WHEN '4DSD' THEN 'SDSD' WHEN 'VAN' THEN 'VN' ELSE 'other' END"""
MAKE_SQL = r"CASE WHEN regexp_matches(vehicle_make, '^[A-Za-z]') AND vehicle_make <> 'other' THEN upper(left(vehicle_make, 1)) ELSE 'other' END"
PLATE_SQL = "CASE WHEN plate_type IN ('PAS', 'COM', 'OMT') THEN plate_type ELSE 'OTHER' END"


@check(
    "body_type_norm",
    with_views(f"SELECT vehicle_body_type, {BODY_SQL} AS body_type, count(*) AS n FROM tickets GROUP BY 1, 2", "tickets"),
)
def body_type_norm(spark, sf_dir):
    source = V.tickets(spark, sf_dir, "vehicle_body_type").withColumn("body_type", clean.body_type("vehicle_body_type"))
    return counted(source, "vehicle_body_type", "body_type")


@check("plate_type_norm", with_views(f"SELECT plate_type, {PLATE_SQL} AS plate, count(*) AS n FROM tickets GROUP BY 1, 2", "tickets"))
def plate_type_norm(spark, sf_dir):
    return counted(
        V.tickets(spark, sf_dir, "plate_type").withColumn("plate", clean.plate_type("plate_type")), "plate_type", "plate"
    )


@check("make_initial", with_views(f"SELECT vehicle_make, {MAKE_SQL} AS initial, count(*) AS n FROM tickets GROUP BY 1, 2", "tickets"))
def make_initial(spark, sf_dir):
    source = V.tickets(spark, sf_dir, "vehicle_make").withColumn("initial", clean.make_initial("vehicle_make"))
    return counted(source, "vehicle_make", "initial")


COMBO_SQL = "concat(street_code1, '-', street_code2, '-', street_code3)"
STREET_SQL = case_of(COMBO_SQL, {v + "|" + k: [k] for k, v in rules.STREET_NAMES.items()}, "NULL")


@check(
    "street_combo",
    with_views(
        f"SELECT {COMBO_SQL} AS street_code, split_part({STREET_SQL}, '|', 1) AS street, count(*) AS n FROM messages GROUP BY 1, 2", "messages"
    ),
)
def street_combo(spark, sf_dir):
    code = clean.street_combo("street_code1", "street_code2", "street_code3")
    source = V.view(spark, sf_dir, "messages").select(code.alias("street_code"))
    return counted(source.withColumn("street", clean.street_name("street_code")), "street_code", "street")


@check(
    "str_replace",
    with_views(
        r"""SELECT street_name, replace(street_name, 'W ', 'WEST ') AS everywhere, regexp_replace(street_name, '^W ', 'WEST ') AS at_start,
                  count(*) AS n FROM tickets GROUP BY 1, 2, 3""",
        "tickets",
    ),
)
def str_replace(spark, sf_dir):
    source = V.tickets(spark, sf_dir, "street_name").withColumns(
        {"everywhere": clean.spell_out_west("street_name"), "at_start": clean.spell_out_west("street_name", anchored=True)}
    )
    return counted(source, "street_name", "everywhere", "at_start")


@check("parse_lat_lon", with_views("SELECT point_id, round(lat, 6) AS lat, round(lon, 6) AS lon FROM points", "points"))
def parse_lat_lon(spark, sf_dir):
    text = F.concat(F.lit("("), F.col("lat").cast("string"), F.lit(", "), F.col("lon").cast("string"), F.lit(")"))
    source = V.view(spark, sf_dir, "points").select("point_id", text.alias("location"))
    lat, lon = clean.lat_lon("location")
    return source.select("point_id", F.round(lat, 6).alias("lat"), F.round(lon, 6).alias("lon"))


@check(
    "address_format",
    with_views(
        """SELECT house_number, street_name, count(*) AS n,
             CASE WHEN street_name LIKE 'W %' THEN house || ' West ' || words || ', New York, Ny, Manhattan'
                  ELSE house || ' New ' || words || ', New York, Ny' END AS address
           FROM (SELECT house_number, street_name, CASE WHEN house_number = 'N/A' THEN 'N/a' ELSE house_number END AS house,
                   replace(replace(regexp_replace(street_name, '^(W|NEW) ', ''), 'STREET', 'Street'), 'ST', 'St') AS words FROM tickets)
           GROUP BY ALL""",
        "tickets",
    ),
)
def address_format(spark, sf_dir):
    source = V.tickets(spark, sf_dir, "house_number", "street_name")
    spelled = clean.spell_out_west("street_name", anchored=True)
    return counted(source.withColumn("address", clean.address("house_number", spelled)), "house_number", "street_name", "address")


@check("ascii_fold", f"SELECT doc_id, {FOLD.format('text')} AS folded FROM documents")
def ascii_fold(spark, sf_dir):
    return V.table(spark, sf_dir, "documents").select("doc_id", clean.ascii_fold("text").alias("folded"))


# --- dates ---------------------------------------------------------------------------------------


@check("month_period", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS year_month FROM orders")
def month_period(spark, sf_dir):
    return V.table(spark, sf_dir, "orders").select("o_orderkey", clean.month_period("o_orderdate").alias("year_month"))


@check(
    "date_parts",
    """SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
              CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS weekday FROM events""",
)
def date_parts(spark, sf_dir):
    return V.table(spark, sf_dir, "events").select(
        "event_id",
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
        F.dayofmonth("ts").alias("day"),
        F.hour("ts").alias("hour"),
        F.weekday("ts").alias("weekday"),
    )


CYCLES = {"month": ("month", 12), "day": ("day", 31), "hour": ("hour", 24)}


def cyclic_sql(ts: str) -> str:
    return ", ".join(
        f"round({f}(2 * pi() * {part}({ts}) / {period}), 6) AS {name}_{label}"
        for name, (part, period) in CYCLES.items()
        for f, label in (("sin", "sine"), ("cos", "cosine"))
    )


@check("cyclic_time", f"SELECT event_id, {cyclic_sql('ts')} FROM events")
def cyclic_time(spark, sf_dir):
    wide = clean.add_cyclic_time(V.table(spark, sf_dir, "events").select("event_id", "ts"), "ts")
    return wide.select("event_id", *[F.round(c, 6).alias(c) for c in wide.columns[2:]])
