"""Sources, sinks and conversions."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from checks import views as V
from checks.registry import check
from checks.views import with_views
from urbanspark.functions import rules
from urbanspark.operators.tables import materialize
from urbanspark.plans import features, tickets
from urbanspark.session import work_folder
from urbanspark.sources.convert import RawDataset, convert_raw, convert_ticket_files, create_merged_table
from urbanspark.sources.readers import read_dataset, read_union
from urbanspark.sources.schema import TICKET_COLUMNS, struct_of
from urbanspark.sources.writers import export_top, write_dataset, write_features, write_sorted_by_time
from urbanspark.streaming.messages import decode_rows, encode_rows

# ASCII folding in SQL: accents off, then everything that is still not ASCII.
FOLD = r"regexp_replace(strip_accents({}), '[^\x00-\x7F]', '', 'g')"
CSV_COLUMNS = ["summons_number", "registration_state", "issue_date", "vehicle_year", "feet_from_curb", "vehicle_make"]


def table_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


@check("scan_csv_roundtrip", with_views(f"SELECT {', '.join(CSV_COLUMNS)} FROM tickets", "tickets"))
def scan_csv_roundtrip(spark, sf_dir):
    source = V.tickets(spark, sf_dir, *CSV_COLUMNS, "plate_type", "violation_time", spread=True)
    path = work_folder(spark, "csv")
    write_dataset(source, path, "csv")
    return read_dataset(spark, path, "csv", columns=CSV_COLUMNS, schema=source.schema)


@check("scan_parquet_project", "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem")
def scan_parquet_project(spark, sf_dir):
    return read_dataset(spark, f"{sf_dir}/lineitem.parquet", "parquet", columns=["l_orderkey", "l_partkey", "l_quantity"])


@check(
    "scan_table_quoted",
    with_views('SELECT summons_number AS "Summons Number", violation_county AS "Violation County" FROM tickets', "tickets"),
)
def scan_table_quoted(spark, sf_dir):
    source = V.tickets(spark, sf_dir, "summons_number", "violation_county", "violation_precinct").toDF(
        "Summons Number", "Violation County", "Violation Precinct"
    )
    name = table_name("tickets")
    write_dataset(source, name, "table", table_path=work_folder(spark, "table"))
    return read_dataset(spark, name, "table", columns=["Summons Number", "Violation County"])


@check(
    "scan_union_parts",
    """SELECT l_orderkey, l_quantity, l_discount, CAST(NULL AS DOUBLE) AS l_tax FROM lineitem WHERE l_linestatus = 'O'
       UNION ALL SELECT l_orderkey, l_quantity, NULL, l_tax FROM lineitem WHERE l_linestatus <> 'O'""",
)
def scan_union_parts(spark, sf_dir):
    lines = V.table(spark, sf_dir, "lineitem")
    parts = {
        "one": lines.filter("l_linestatus = 'O'").select("l_orderkey", "l_quantity", "l_discount"),
        "two": lines.filter("l_linestatus <> 'O'").select("l_orderkey", "l_quantity", "l_tax"),
    }
    base = work_folder(spark, "parts")
    for name, part in parts.items():
        write_dataset(part, f"{base}/{name}", "fixed")
    return read_union(spark, [f"{base}/{name}" for name in parts], "fixed", ["l_orderkey", "l_quantity", "l_discount", "l_tax"])


@check(
    "scan_dispatch",
    """SELECT f.format, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys, round(sum(o_totalprice), 2) AS price
       FROM orders, (VALUES ('csv'), ('parquet'), ('fixed'), ('table')) AS f(format) GROUP BY f.format""",
)
def scan_dispatch(spark, sf_dir):
    orders = V.table(spark, sf_dir, "orders")
    results = []
    for fmt in ("csv", "parquet", "fixed", "table"):
        path = work_folder(spark, fmt)
        target = table_name("orders") if fmt == "table" else path
        write_dataset(orders, target, fmt, table_path=path)
        df = read_dataset(spark, target, fmt, schema=orders.schema if fmt == "csv" else None)
        results.append(
            df.agg(
                F.lit(fmt).alias("format"),
                F.count("*").alias("n"),
                F.sum("o_orderkey").alias("keys"),
                F.round(F.sum("o_totalprice"), 2).alias("price"),
            )
        )
    return reduce(lambda a, b: a.unionByName(b), results)


@check("sink_roundtrip", "SELECT o_orderkey, o_orderdate, o_totalprice, o_orderpriority FROM orders")
def sink_roundtrip(spark, sf_dir):
    orders = V.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority")
    path, name = work_folder(spark, "parquet"), table_name("orders")
    write_dataset(orders, path, "parquet")
    write_dataset(read_dataset(spark, path, "parquet"), name, "table", table_path=work_folder(spark, "table"))
    return read_dataset(spark, name, "table")


def wide_tickets(spark, sf_dir):
    """The ticket view under the 43 names; columns the view lacks are null."""
    source = V.tickets(spark, sf_dir, spread=True)
    known = {name.lower().replace(" ", "_"): name for name, _ in TICKET_COLUMNS}
    return source.select(
        *[
            (F.col(key) if key in source.columns else F.lit(None)).cast(dict(TICKET_COLUMNS)[name]).alias(name)
            for key, name in known.items()
        ]
    )


@check(
    "convert_csv_parquet",
    with_views(
        """SELECT coalesce(CAST(year(try_cast(issue_date AS DATE)) AS VARCHAR), 'undated') AS file, registration_state, count(*) AS n,
                  CAST(sum(vehicle_year) AS BIGINT) AS years, count(plate_type) AS plates
           FROM tickets GROUP BY 1, 2""",
        "tickets",
    ),
)
def convert_csv_parquet(spark, sf_dir):
    file = F.coalesce(F.year(F.col("Issue Date").try_cast("date")).cast("string"), F.lit("undated"))
    staged = materialize(wide_tickets(spark, sf_dir).withColumn("file", file), "staged", ["file"])
    base = work_folder(spark, "convert")
    for row in staged.select("file").distinct().collect():  # one raw file per year
        raw = staged.filter(F.col("file") == row["file"]).drop("file")
        raw.toDF(*[f"c{i}" for i in range(len(raw.columns))]).write.option("header", True).csv(f"{base}/csv/{row['file']}.csv")
    convert_ticket_files(spark, f"{base}/csv", f"{base}/parquet")
    assert convert_ticket_files(spark, f"{base}/csv", f"{base}/parquet") == []  # existing targets are skipped
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    converted = spark.read.option("mergeSchema", True).parquet(f"{base}/parquet/*").withColumn("file", F.split(name, r"\.")[0])
    return converted.groupBy("file", F.col("Registration State").alias("registration_state")).agg(
        F.count("*").alias("n"), F.sum("Vehicle Year").cast("bigint").alias("years"), F.count("Plate Type").alias("plates")
    )


@check(
    "export_fixed_width",
    f"SELECT doc_id, substr({FOLD.format('text')}, 1, 20) AS text, substr(source, 1, 5) AS source, n_chars FROM documents",
)
def export_fixed_width(spark, sf_dir):
    docs = V.table(spark, sf_dir, "documents").select("doc_id", "text", "source", "n_chars")
    path = work_folder(spark, "fixed")
    write_dataset(docs, path, "fixed", widths={"source": 5})
    return read_dataset(spark, path, "fixed")


@check(
    "ctas_union_by_name",
    """SELECT o_orderstatus, count(*) AS n, count(price) AS n_price, count(priority) AS n_priority FROM (
         SELECT o_orderstatus, o_totalprice AS price, NULL AS priority FROM orders WHERE o_orderpriority < '3'
         UNION ALL SELECT o_orderstatus, NULL, o_orderpriority FROM orders WHERE o_orderpriority >= '3') GROUP BY 1""",
)
def ctas_union_by_name(spark, sf_dir):
    orders = V.table(spark, sf_dir, "orders")
    base = work_folder(spark, "years")
    urgent, other = orders.filter("o_orderpriority < '3'"), orders.filter("o_orderpriority >= '3'")
    write_dataset(urgent.selectExpr("o_orderkey", "o_orderstatus", "o_totalprice AS price"), f"{base}/one", "parquet")
    write_dataset(other.selectExpr("o_orderkey", "o_orderstatus", "o_orderpriority AS priority"), f"{base}/two", "parquet")
    merged = create_merged_table(spark, table_name("merged"), [f"{base}/one", f"{base}/two"], work_folder(spark, "table"))
    return merged.groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.count("price").alias("n_price"), F.count("priority").alias("n_priority")
    )


RAW = {
    "school_locations": ("schools", ["open_date", "lon", "lat", "status", "category"]),
    "business_locations": ("licences", ["created", "expires", "industry", "borough"]),
    "events": ("city_events", ["start_ts", "end_ts", "event_type", "street_closure_type", "borough"]),
    "landmarks": ("landmarks", ["object_id", "borough", "length", "area"]),
}


@check(
    "convert_raw_tables",
    with_views(
        "SELECT dataset, format, n FROM ("
        + " UNION ALL ".join(f"SELECT '{name}' AS dataset, count(*) AS n FROM {v}" for name, (v, _) in RAW.items())
        + "".join(f" UNION ALL SELECT '{b}_weather', count(*) FROM weather WHERE borough = '{b}'" for b in rules.BOROUGHS)
        + "), (VALUES ('parquet'), ('fixed'), ('table')) AS f(format)",
        "schools",
        "licences",
        "city_events",
        "landmarks",
        "weather",
    ),
)
def convert_raw_tables(spark, sf_dir):
    base = work_folder(spark, "raw")
    sources = {name: V.view(spark, sf_dir, v).select(*columns) for name, (v, columns) in RAW.items()}
    weather = materialize(V.view(spark, sf_dir, "weather"), "weather", ["borough"])
    for borough in rules.BOROUGHS:
        sources[f"{borough}_weather"] = weather.filter(F.col("borough") == borough).drop("borough")
    datasets = []
    for name, df in sources.items():
        path = f"{base}/csv/{name.replace(' ', '_')}.csv"
        write_dataset(df, path, "csv")
        datasets.append(RawDataset(name, path, struct_of([(f.name, f.dataType.simpleString()) for f in df.schema.fields])))
    written = convert_raw(spark, datasets, base, table_name("raw"))
    counts = [
        read_dataset(spark, location, fmt).agg(
            F.lit(name).alias("dataset"), F.lit(fmt).alias("format"), F.count("*").alias("n")
        )
        for (name, fmt), location in written.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counts)


@check(
    "scan_year_prune",
    "SELECT year(o_orderdate) AS year, count(*) AS n, round(sum(o_totalprice), 2) AS price FROM orders WHERE year(o_orderdate) IN (1997, 1999) GROUP BY 1",
)
def scan_year_prune(spark, sf_dir):
    orders = V.table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    path = work_folder(spark, "years")
    write_dataset(orders, path, "parquet", partition_by=["year"])
    return (
        read_dataset(spark, path, "parquet", years=[1997, 1999])
        .groupBy(F.col("year").cast("bigint").alias("year"))
        .agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("price"))
    )


@check("sample_fraction")
def sample_fraction(spark, sf_dir):
    return read_dataset(
        spark, f"{sf_dir}/lineitem.parquet", "parquet", columns=["l_orderkey", "l_linenumber"], fraction=0.1, seed=7
    )


JSON_COLUMNS = ["summons_number", "registration_state", "issue_date", "violation_code", "vehicle_make", "violation_county"]


@check(
    "json_encode_rows",
    with_views(
        "SELECT CAST(summons_number AS VARCHAR) AS key, CAST(to_json({"
        + ", ".join(f"'{c}': {c}" for c in JSON_COLUMNS)
        + "}) AS VARCHAR) AS value FROM tickets",
        "tickets",
    ),
)
def json_encode_rows(spark, sf_dir):
    return encode_rows(V.tickets(spark, sf_dir, *JSON_COLUMNS), "summons_number")


@check("json_decode_rows", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_decode_rows(spark, sf_dir):
    events = V.table(spark, sf_dir, "events").withColumnRenamed("props", "value_json")
    messages = events.select("event_id", F.col("value_json").alias("value"))
    return decode_rows(messages, "k bigint", keep=["event_id"])


STREETS = """street_code1, street_code2, street_code3, violation_post_code, count(*) AS n FROM tickets
           WHERE violation_post_code IS NOT NULL AND street_code1 <> 0 AND street_code2 <> 0 AND street_code3 <> 0 GROUP BY 1, 2, 3, 4"""


@check(
    "export_top_csv",
    with_views(f"SELECT {STREETS} ORDER BY n DESC, 1, 2, 3, 4 LIMIT 10", "tickets"),
)
def export_top_csv(spark, sf_dir):
    source = V.tickets(spark, sf_dir, "street_code1", "street_code2", "street_code3", "violation_post_code")
    streets = tickets.top_streets(source)
    path = work_folder(spark, "top")
    export_top(streets, path, [F.desc("n"), *streets.columns[:4]])
    return spark.read.schema(streets.schema).option("header", True).csv(path)


@check("repartition_rows", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def repartition_rows(spark, sf_dir):
    return V.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity").repartition(10)


@check(
    "feature_store_partitioned",
    with_views(
        f"""SELECT b.borough, h.datetime, count(e.start_ts) AS num_events FROM
            (SELECT unnest({rules.BOROUGHS}) AS borough) b
            CROSS JOIN (SELECT unnest(generate_series(TIMESTAMP '{V.EVENT_START}', TIMESTAMP '{V.EVENT_END}', INTERVAL 1 HOUR)) AS datetime) h
            LEFT JOIN city_events e ON e.borough = b.borough AND h.datetime BETWEEN e.start_ts AND e.end_ts
            GROUP BY 1, 2""",
        "city_events",
    ),
)
def feature_store_partitioned(spark, sf_dir):
    counts = features.event_counts_hourly(V.view(spark, sf_dir, "city_events"), V.EVENT_START, V.EVENT_END)
    path = work_folder(spark, "features")
    write_features(counts, path)
    return read_dataset(spark, path, "parquet", columns=["borough", "datetime", "num_events"])


@check(
    "range_partition_time",
    "SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem",
)
def range_partition_time(spark, sf_dir):
    lines = V.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    path = work_folder(spark, "by_time")
    write_sorted_by_time(lines, path, "l_shipdate")
    return spark.read.parquet(path)
