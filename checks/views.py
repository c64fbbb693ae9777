"""Stand-ins for the ticket tables over the driver tables: as DataFrames, and as SQL text.

The SQL text is what the comparison runs. The DataFrames hold the same expressions, but the ticket view joins
only the tables that the asked-for columns need: its foreign keys are complete, so an unused
table would join every row to exactly one row and change nothing (``tests/test_queries.py`` checks the keys).
"""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from urbanspark.operators.tables import compute_once, inline_table
from urbanspark.sources.readers import spread_scan

START, END, TEST = datetime(1996, 1, 1), datetime(2001, 1, 1), datetime(2000, 1, 1)
EVENT_START, EVENT_END = datetime(2024, 1, 1), datetime(2024, 1, 31, 23)
MIN_YEAR = 1995

# column -> (tables needed besides lineitem, expression)
_BOROUGH_CODE = """CASE WHEN qty = 1 THEN NULL WHEN qty = 2 THEN '??'
       WHEN l_linenumber % 2 = 0 THEN CASE n_regionkey WHEN 0 THEN 'BX' WHEN 1 THEN 'K' WHEN 2 THEN 'NY' WHEN 3 THEN 'Q' ELSE 'R' END
       ELSE CASE n_regionkey WHEN 0 THEN 'bronx' WHEN 1 THEN 'KINGS' WHEN 2 THEN 'MN' WHEN 3 THEN 'QUEEN' ELSE 'ST' END END"""
TICKETS = {
    "summons_number": ("", "l_orderkey * 8 + l_linenumber"),
    "registration_state": (
        "nation",
        "CASE WHEN n_nationkey % 3 = 0 THEN 'NY' WHEN n_nationkey % 3 = 1 THEN 'NJ' ELSE n_name END",
    ),
    "plate_type": (
        "orders",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'PAS' WHEN '2-HIGH' THEN 'COM' WHEN '3-MEDIUM' THEN 'OMT' WHEN '5-LOW' THEN 'XYZ' END",
    ),
    "issue_date": ("orders", "CASE WHEN qty = 47 THEN 'not a date' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END"),
    "violation_code": ("", "qty"),
    "vehicle_body_type": (
        "part",
        """CASE p_type WHEN 'ECONOMY' THEN 'SEDN' WHEN 'LARGE' THEN 'subn' WHEN 'MEDIUM' THEN '4DSD'
       WHEN 'PROMO' THEN 'VAN' WHEN 'SMALL' THEN 'ZZZ' END""",
    ),
    "vehicle_make": ("part", "CASE WHEN p_size % 10 = 0 THEN NULL WHEN p_size % 10 = 1 THEN '9X' ELSE p_name END"),
    "issuing_agency": ("", "CASE l_returnflag WHEN 'A' THEN 'T' WHEN 'N' THEN 'X' ELSE 'P' END"),
    "violation_time": (
        "",
        """CASE WHEN qty = 50 THEN NULL WHEN qty = 49 THEN '0900' WHEN qty = 48 THEN 'BAD'
       ELSE concat(lpad(CAST(CASE WHEN m < 60 THEN 12 ELSE CAST(floor(m / 60) AS INT) END AS STRING), 2, '0'),
                   lpad(CAST(m % 60 AS STRING), 2, '0'),
                   CASE WHEN l_linenumber % 2 = 0 THEN 'A' ELSE 'P' END) END""",
    ),
    "violation_county": ("nation", _BOROUGH_CODE),
    "vehicle_year": ("part", "CASE WHEN p_size % 10 = 0 THEN 0 WHEN p_size % 10 = 1 THEN NULL ELSE 1970 + p_size END"),
    "feet_from_curb": ("", "CAST(round(l_discount * 100) AS INT)"),
    "street_code1": ("", "(l_partkey % 20) * 10"),
    "street_code2": ("", "(l_suppkey % 4) * 10"),
    "street_code3": ("", "(l_linenumber % 3) * 10"),
    "violation_post_code": ("customer", "CASE WHEN l_tax = 0 THEN NULL ELSE c_mktsegment END"),
    "house_number": ("", "CASE WHEN qty % 7 = 0 THEN 'N/A' ELSE CAST(l_suppkey * 3 + qty AS STRING) END"),
    "violation_precinct": ("", "l_suppkey % 25"),
    "violation_location": ("", "l_suppkey % 10"),
    "from_hours_in_effect": ("", "CASE WHEN qty % 3 = 0 THEN 'ALL' WHEN qty % 3 = 1 THEN '0800A' END"),
    "to_hours_in_effect": ("", "CASE WHEN qty % 3 = 0 THEN 'ALL' WHEN qty % 3 = 1 THEN '0730P' END"),
    # Streets are named by code, with a second spelling on some tickets.
    "street_name": (
        "",
        """CASE WHEN l_partkey % 4 = 0 THEN concat('NEW ', CAST(l_partkey % 20 AS STRING), ' ST')
       ELSE concat('W ', CAST(l_partkey % 20 AS STRING), CASE WHEN l_linenumber % 2 = 0 THEN ' ST' ELSE ' STREET' END) END""",
    ),
}
_DERIVED = {"qty": "CAST(l_quantity AS INT)", "m": "(l_partkey * 37 + l_suppkey * 11 + l_linenumber) % 720"}

SQL = {}
SQL["tickets"] = (
    "SELECT "
    + ",\n  ".join(f"{expression} AS {name}" for name, (_, expression) in TICKETS.items())
    + """
FROM (SELECT l.*, o.*, c.*, n.*, p.*, CAST(l.l_quantity AS INT) AS qty,
             (l.l_partkey * 37 + l.l_suppkey * 11 + l.l_linenumber) % 720 AS m
      FROM lineitem l
      JOIN orders o ON l.l_orderkey = o.o_orderkey
      JOIN customer c ON o.o_custkey = c.c_custkey
      JOIN nation n ON c.c_nationkey = n.n_nationkey
      JOIN region r ON n.n_regionkey = r.r_regionkey
      JOIN part p ON l.l_partkey = p.p_partkey)"""
)

SQL["licences"] = """
SELECT o_orderkey AS licence_id,
       CASE n_regionkey WHEN 0 THEN 'Bronx' WHEN 1 THEN 'Brooklyn' WHEN 2 THEN 'Manhattan' WHEN 3 THEN 'Queens' ELSE 'Staten Island' END AS borough,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Garage' WHEN '2-HIGH' THEN 'Employment Agency' WHEN '3-MEDIUM' THEN 'Cabaret'
            WHEN '4-NOT SPECIFIED' THEN 'Newsstand' ELSE 'Unlisted' END AS industry,
       CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_orderdate + INTERVAL '37' MINUTE END AS created,
       CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE o_orderdate + (CAST(o_custkey % 400 AS INT) - 5) * INTERVAL '1' DAY END AS expires
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""

SQL["city_events"] = """
SELECT event_id,
       CASE user_id % 5 WHEN 0 THEN 'Bronx' WHEN 1 THEN 'Brooklyn' WHEN 2 THEN 'Manhattan' WHEN 3 THEN 'Queens' ELSE 'Staten Island' END AS borough,
       CASE event_type WHEN 'error' THEN 'Construction' ELSE event_type END AS event_type,
       CASE event_type WHEN 'view' THEN NULL ELSE 'Full' END AS street_closure_type,
       ts AS start_ts,
       ts + CAST(floor(value) AS INT) * INTERVAL '1' MINUTE AS end_ts,
       value
FROM events"""

# The same events spread over the ticket years, 1996 to 2000, and over the days of a year.
SQL["city_events_all"] = f"""
SELECT borough, event_type, street_closure_type, value,
       start_ts - INTERVAL '28' YEAR + CAST(event_id % 5 AS INT) * INTERVAL '1' YEAR + CAST(event_id % 331 AS INT) * INTERVAL '1' DAY AS start_ts,
       end_ts - INTERVAL '28' YEAR + CAST(event_id % 5 AS INT) * INTERVAL '1' YEAR + CAST(event_id % 331 AS INT) * INTERVAL '1' DAY AS end_ts
FROM ({SQL["city_events"]})"""

SQL["points"] = """
SELECT c_custkey AS point_id, c_mktsegment AS category,
       -74.25e0 + ((c_custkey * 7919) % 1000) / 1000e0 * 0.55e0 AS lon,
        40.50e0 + ((c_custkey * 104729) % 997) / 997e0 * 0.40e0 AS lat
FROM customer"""

SQL["schools"] = f"""
SELECT point_id, lon, lat, '2001-09-01' AS open_date,
       CASE category WHEN 'BUILDING' THEN 'High school' WHEN 'MACHINERY' THEN 'K-8' WHEN 'FURNITURE' THEN 'Elementary' ELSE 'Secondary School' END AS category,
       CASE point_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'Closed' ELSE 'Open' END AS status
FROM ({SQL["points"]})"""

SQL["landmarks"] = """
SELECT p_partkey % 1500 AS object_id,
       CASE p_size % 6 WHEN 0 THEN 'SI' WHEN 1 THEN 'QN' WHEN 2 THEN 'MN' WHEN 3 THEN 'BK' WHEN 4 THEN 'BX' END AS borough,
       CAST(p_size AS DOUBLE) AS length, p_retailprice AS area, p_partkey AS tie
FROM part"""

# Hourly measures per borough; hours without events are missing.
SQL["weather"] = f"""
SELECT borough, CAST(date_trunc('hour', start_ts) AS TIMESTAMP) AS datetime, avg(value) AS temperature
FROM ({SQL["city_events"]}) GROUP BY 1, 2"""

SQL["weather_all"] = SQL["weather"].replace(SQL["city_events"], SQL["city_events_all"])

# Ticket messages in offset order.
SQL["messages"] = """
SELECT event_id AS message_offset,
       CASE WHEN event_id % 41 = 0 THEN 'soon' ELSE CAST(DATE '1995-10-01' + CAST(event_id * 37 % 400 AS INT) AS STRING) END AS issue_date,
       CASE user_id % 9 WHEN 0 THEN 'BX' WHEN 1 THEN 'KINGS' WHEN 2 THEN 'NY' WHEN 3 THEN 'Q' WHEN 4 THEN 'ST' WHEN 5 THEN ''
            WHEN 6 THEN 'xx' WHEN 7 THEN 'MN' END AS violation_county,
       CASE event_id % 11 WHEN 0 THEN '0' WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN 'n/a'
            ELSE CAST(1970 + (event_id * 7 + user_id) % 50 AS STRING) END AS vehicle_year,
       CASE event_id % 6 WHEN 0 THEN 44750 WHEN 1 THEN 34370 WHEN 2 THEN 34430 WHEN 3 THEN 34430 WHEN 4 THEN 77150 ELSE 0 END AS street_code1,
       CASE event_id % 6 WHEN 0 THEN 10575 WHEN 1 THEN 10810 WHEN 2 THEN 10410 WHEN 3 THEN 10510 WHEN 4 THEN 47520 ELSE 1 END AS street_code2,
       CASE event_id % 6 WHEN 0 THEN 10575 WHEN 1 THEN 10910 WHEN 2 THEN 13610 WHEN 3 THEN 10610 WHEN 4 THEN 57720 ELSE 1 END AS street_code3,
       CASE WHEN user_id % 3 = 0 THEN 'NJ' ELSE 'NY' END AS registration_state,
       CASE event_type WHEN 'error' THEN 'COM' WHEN 'click' THEN NULL ELSE 'PAS' END AS plate_type,
       CAST(user_id % 20 AS INT) AS violation_code,
       CAST(floor(value) AS INT) AS feet_from_curb,
       concat('B', CAST(event_id % 7 + event_id % 5000 / 2500 AS STRING)) AS vehicle_body_type,
       concat('M', CAST(user_id % 13 AS STRING)) AS vehicle_make,
       CASE WHEN event_id % 4 = 0 THEN 'T' ELSE 'X' END AS issuing_agency
FROM events"""
# Whole-number division is written differently in the two engines.
SQL["messages"] = SQL["messages"].replace(
    "event_id % 7 + event_id % 5000 / 2500", "CAST(event_id % 7 + floor(event_id % 5000 / 2500.0) AS INT)"
)

# The same messages over three partitions: offsets start at 100 and every seventh is missing; some messages come twice.
SQL["part_messages"] = f"""
SELECT m.*, CAST(message_offset % 3 AS INT) AS partition_no,
       100 + CAST(floor(message_offset / 3.0) AS BIGINT) + CAST(floor(floor(message_offset / 3.0) / 6.0) AS BIGINT) AS part_offset
FROM ({SQL["messages"]}) m JOIN (SELECT 1 AS copy_no UNION ALL SELECT 2) c ON copy_no = 1 OR message_offset % 10 = 4"""

# Closed rings inside the map box; corners are chosen so that no point lies on an edge.
# (region_no, region, part, corners)
POLYGONS = [
    (1, "Bronx", 0, [(-74.20137, 40.52237), (-74.05137, 40.52237), (-74.05137, 40.61237), (-74.20137, 40.61237)]),
    (2, "Brooklyn", 0, [(-74.05137, 40.52237), (-73.95237, 40.55137), (-73.95237, 40.60137), (-74.05137, 40.61237)]),
    (3, "Manhattan", 0, [(-73.90137, 40.52137), (-73.72237, 40.55137), (-73.80137, 40.68137)]),
    (
        4,
        "Queens",
        0,
        [
            (-74.18137, 40.65137),
            (-73.98237, 40.65137),
            (-73.98237, 40.71237),
            (-74.08137, 40.71237),
            (-74.08137, 40.83137),
            (-74.18137, 40.83137),
        ],
    ),
    (5, "Staten Island", 0, [(-73.93137, 40.70237), (-73.86237, 40.70237), (-73.86237, 40.77137), (-73.93137, 40.77137)]),
    (5, "Staten Island", 1, [(-73.80237, 40.75137), (-73.72137, 40.78237), (-73.76137, 40.87237)]),
]
BOROUGH_AREAS = [
    ("Bronx", 11850.5),
    ("Brooklyn", 19340.25),
    ("Manhattan", 6365.75),
    ("Queens", 30450.0),
    ("Staten Island", 16237.5),
]


def polygon_rows() -> list[tuple]:
    return [(no, name, part, seq, x, y) for no, name, part, ring in POLYGONS for seq, (x, y) in enumerate(ring)]


def polygons(spark: SparkSession) -> DataFrame:
    return inline_table(spark, ["region_no", "region", "part", "seq", "x", "y"], polygon_rows())


def edges_sql() -> str:
    """VALUES list of the explicit edges, for the comparison only."""
    rows = []
    for no, name, _, ring in POLYGONS:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            rows.append(f"({no}, '{name}', {x1}e0, {y1}e0, {x2}e0, {y2}e0)")
    return f"(SELECT * FROM (VALUES {', '.join(rows)}) AS t(region_no, region, x1, y1, x2, y2))"


def areas(spark: SparkSession) -> DataFrame:
    return inline_table(spark, ["borough", "area"], BOROUGH_AREAS)


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is looked up in the file once and then given."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def tickets(spark: SparkSession, sf_dir: str, *columns: str, spread: bool = False) -> DataFrame:
    """The ticket view with the given columns (all by default); ``spread`` for much work per row."""
    columns = columns or tuple(TICKETS)
    needed = {TICKETS[c][0] for c in columns}
    base = table(spark, sf_dir, "lineitem")
    if spread:
        base = spread_scan(base)
    if needed & {"part"}:
        base = base.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    if needed & {"orders", "customer", "nation"}:
        base = base.join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    if needed & {"customer", "nation"}:
        base = base.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    if needed & {"nation"}:
        base = base.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    base = base.withColumns({name: F.expr(expression) for name, expression in _DERIVED.items()})
    # The clock text is a long expression; hold it like the stored column it stands for.
    stored = {c: F.expr(TICKETS[c][1]) for c in columns if c == "violation_time"}
    if stored:
        base = compute_once(base, stored)
    return base.select(*[F.col(c) if c in stored else F.expr(TICKETS[c][1]).alias(c) for c in columns])


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stand-in other than the tickets, from its SQL text."""
    text = SQL[name].replace("AS TIMESTAMP)", "AS TIMESTAMP_NTZ)")
    text = re.sub(r"\b(FROM|JOIN) (orders|customer|nation|events|part)\b", r"\1 {\2}", text)
    used = {t: table(spark, sf_dir, t) for t in set(re.findall(r"\{(\w+)\}", text))}
    return spark.sql(text, **used)


_SPANS: dict[str, tuple[datetime, datetime]] = {}


def context_span(spark: SparkSession, sf_dir: str) -> tuple[datetime, datetime]:
    """First and last hour of the years from the first licence or ticket to the last; looked up once per table."""
    if sf_dir not in _SPANS:
        licences = view(spark, sf_dir, "licences").agg(F.year(F.min("created")), F.year(F.max("expires"))).first()
        first, last = min(licences[0], START.year), max(licences[1], END.year - 1)
        _SPANS[sf_dir] = datetime(first, 1, 1), datetime(last, 12, 31, 23)
    return _SPANS[sf_dir]


def with_views(body: str, *names: str) -> str:
    """SQL that starts with the named stand-ins; ``body`` may bring further ones in a leading ``, x AS (...)``."""
    head = ",\n".join(f"{n} AS ({SQL[n]})" for n in names)
    return f"WITH {head}\n{body}" if names else body
