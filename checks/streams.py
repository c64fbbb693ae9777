"""Count windows, running state, streams and clustering."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views as V
from checks.aggregates import STATS, STATS_SQL, live_sql, month_stats_sql, rounded, rounded_sql
from checks.columns import USABLE_SQL
from checks.registry import check
from checks.views import with_views
from urbanspark.operators import encode
from urbanspark.operators.tables import materialize
from urbanspark.session import work_folder
from urbanspark.streaming import cluster, live, windows
from urbanspark.streaming.messages import replay_files

WINDOW = 1000
OFFSET = "message_offset"
# Epochs a sink keeps: the newest, and the one a repeated micro-batch starts from.
KEEP = 2

# The last window counts only when it is full.
WINDOW_SQL = """, whole AS (SELECT message_offset // 1000 AS batch_no FROM messages GROUP BY 1 HAVING count(*) = 1000),
    stats AS (SELECT batch_no, year_month, {group}, """ + STATS_SQL + """ FROM live JOIN whole USING (batch_no) WHERE {group} IS NOT NULL GROUP BY 1, 2, 3)"""


def message_stream(spark, sf_dir, view="messages"):
    """The events table replayed as a stream, turned into messages."""
    schema = V.table(spark, sf_dir, "events").schema
    stream = replay_files(spark, f"{sf_dir}/events*.parquet", schema)
    return spark.sql(V.SQL[view].replace("FROM events", "FROM {events}"), events=stream)


@check("count_window_stats", live_sql(WINDOW_SQL.format(group="violation_county") + f"SELECT batch_no, year_month, violation_county, {rounded_sql(STATS)} FROM stats"))
def count_window_stats(spark, sf_dir):
    return rounded(windows.window_stats(V.view(spark, sf_dir, "messages"), "violation_county", OFFSET, WINDOW, V.MIN_YEAR), STATS)


def half_mean_sql(group: str) -> str:
    """Closed form per statistic: the last value weighs 1/2, the one before 1/4, ..., the first counts twice."""
    parts = [
        f"""{s}_state AS (SELECT year_month, {group}, sum({s} * CASE WHEN k = 1 THEN pow(0.5, n - 1) ELSE pow(0.5, n - k + 1) END) AS {s}
             FROM (SELECT *, row_number() OVER (PARTITION BY year_month, {group} ORDER BY batch_no) AS k,
                     count(*) OVER (PARTITION BY year_month, {group}) AS n FROM stats WHERE {s} IS NOT NULL) GROUP BY 1, 2)"""
        for s in STATS
    ]
    joins = " ".join(f"LEFT JOIN {s}_state USING (year_month, {group})" for s in STATS)
    return (
        WINDOW_SQL.format(group=group)
        + ", "
        + ", ".join(parts)
        + f", state AS (SELECT year_month, {group}, {', '.join(STATS)} FROM (SELECT DISTINCT year_month, {group} FROM stats) {joins})"
    )


def state_sql(group: str) -> str:
    return live_sql(half_mean_sql(group) + f" SELECT year_month, {group}, {rounded_sql(STATS)} FROM state")


@check("running_half_mean", state_sql("violation_county"))
def running_half_mean(spark, sf_dir):
    stats = windows.window_stats(V.view(spark, sf_dir, "messages"), "violation_county", OFFSET, WINDOW, V.MIN_YEAR)
    return rounded(windows.running_half_mean(stats, ["year_month", "violation_county"]), STATS)


@check("stream_month_stats", month_stats_sql("violation_county"))
def stream_month_stats(spark, sf_dir):
    folder = work_folder(spark, "month_stats")
    messages = message_stream(spark, sf_dir)
    live.start_month_stats(messages, "violation_county", f"{folder}/sink", f"{folder}/checkpoint", V.MIN_YEAR, KEEP).awaitTermination()
    return rounded(live.read_epoch(spark, f"{folder}/sink"), STATS)


def stream_state(spark, sf_dir, group):
    folder = work_folder(spark, "half_mean")
    messages = message_stream(spark, sf_dir)
    live.start_half_mean(
        messages, group, f"{folder}/sink", f"{folder}/checkpoint", OFFSET, WINDOW, V.MIN_YEAR, keep=KEEP
    ).awaitTermination()
    return live.read_epoch(spark, f"{folder}/sink/state")


@check("view_borough", state_sql("violation_county"))
def view_borough(spark, sf_dir):
    return rounded(live.view_groups(stream_state(spark, sf_dir, "violation_county"), "violation_county"), STATS)


@check("view_street", state_sql("street"))
def view_street(spark, sf_dir):
    return rounded(live.view_groups(stream_state(spark, sf_dir, "street"), "street"), STATS)


@check(
    "view_overall",
    live_sql(
        half_mean_sql("violation_county")
        + f" SELECT year_month, {rounded_sql(STATS)} FROM (SELECT year_month, {', '.join(f'avg({s}) AS {s}' for s in STATS)} FROM state GROUP BY 1)"
    ),
)
def view_overall(spark, sf_dir):
    return rounded(live.view_overall(stream_state(spark, sf_dir, "violation_county")), STATS)


# --- several broker partitions, with offsets that are missing and messages that come twice -----------

PART_SIZE = 100


def part_sql(select: str) -> str:
    """Windows by rank over the distinct messages of each partition."""
    windows_sql = f""", once AS (SELECT DISTINCT * FROM part_messages),
      placed AS (SELECT *, (row_number() OVER (PARTITION BY partition_no ORDER BY part_offset) - 1) // {PART_SIZE} AS window_no FROM once),
      messages AS (SELECT * EXCLUDE (message_offset, window_no), window_no AS message_offset FROM placed
                   QUALIFY count(*) OVER (PARTITION BY partition_no, window_no) = {PART_SIZE})"""
    body = live_sql("").removeprefix("WITH ")
    live = body[body.index(", live AS") :].replace("message_offset // 1000 AS batch_no", "partition_no, message_offset AS batch_no")
    return with_views(windows_sql + live + select, "part_messages")


def part_stats_sql() -> str:
    return f""", stats AS (SELECT partition_no, batch_no, year_month, violation_county, {STATS_SQL} FROM live
      WHERE violation_county IS NOT NULL GROUP BY 1, 2, 3, 4)"""


def part_state_sql() -> str:
    """``half_mean_sql`` with a state per partition, and the mean of these states."""
    states = half_mean_sql("violation_county")
    states = states[states.index("mean_state AS") :]
    for old, new in [
        ("SELECT year_month, violation_county", "SELECT partition_no, year_month, violation_county"),
        ("SELECT DISTINCT year_month", "SELECT DISTINCT partition_no, year_month"),
        ("PARTITION BY year_month", "PARTITION BY partition_no, year_month"),
        ("GROUP BY 1, 2", "GROUP BY 1, 2, 3"),
        ("USING (year_month", "USING (partition_no, year_month"),
    ]:
        states = states.replace(old, new)
    means = ", ".join(f"avg({s}) AS {s}" for s in STATS)
    return part_sql(
        part_stats_sql()
        + ", "
        + states
        + f" SELECT year_month, violation_county, {rounded_sql(STATS)} FROM (SELECT year_month, violation_county, {means} FROM state GROUP BY 1, 2)"
    )


@check(
    "count_window_partitions",
    part_sql(part_stats_sql() + f" SELECT partition_no, batch_no, year_month, violation_county, {rounded_sql(STATS)} FROM stats"),
)
def count_window_partitions(spark, sf_dir):
    messages = V.view(spark, sf_dir, "part_messages")
    stats = windows.window_stats(messages, "violation_county", "part_offset", PART_SIZE, V.MIN_YEAR, "partition_no")
    return rounded(stats, STATS)


@check("view_borough_partitions", part_state_sql())
def view_borough_partitions(spark, sf_dir):
    folder = work_folder(spark, "half_mean")
    live.start_half_mean(
        message_stream(spark, sf_dir, "part_messages"),
        "violation_county",
        f"{folder}/sink",
        f"{folder}/checkpoint",
        "part_offset",
        PART_SIZE,
        V.MIN_YEAR,
        "partition_no",
        KEEP,
    ).awaitTermination()
    state = live.read_epoch(spark, f"{folder}/sink/state")
    return rounded(live.view_groups(live.merge_partitions(state, "violation_county"), "violation_county"), STATS)


# --- clustering ----------------------------------------------------------------------------------

COMPLETE_SQL = " AND ".join(f"{c} IS NOT NULL" for c in [*cluster.FEATURES, "registration_state"])
INPUT_SQL = f""", inputs AS (SELECT message_offset, message_offset // 1000 AS batch_no, CAST(registration_state = 'NY' AS INTEGER) AS label,
    try_cast(vehicle_year AS DOUBLE) AS vehicle_year, CAST(feet_from_curb AS DOUBLE) AS feet_from_curb, plate_type, violation_code,
    vehicle_body_type, vehicle_make, issuing_agency,
    CASE violation_county WHEN 'BX' THEN 'Bronx' WHEN 'KINGS' THEN 'Brooklyn' WHEN 'NY' THEN 'Manhattan' WHEN 'MN' THEN 'Manhattan' WHEN 'Q' THEN 'Queens'
      WHEN 'ST' THEN 'Staten Island' ELSE violation_county END AS violation_county
    FROM messages WHERE {COMPLETE_SQL} AND {USABLE_SQL})"""


def inputs(spark, sf_dir):
    numbered = windows.add_window_number(V.view(spark, sf_dir, "messages"), OFFSET, WINDOW)
    return cluster.cluster_inputs(numbered, OFFSET, V.MIN_YEAR)


CODE_SQL = ", ".join(
    f"""coalesce((SELECT CAST(code AS INTEGER) FROM (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM
         (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM inputs WHERE batch_no = 0)) d WHERE d.v = CAST(i.{c} AS VARCHAR)), -1) AS {c}"""
    for c in cluster.CATEGORICAL
)


@check("encode_unseen", with_views(INPUT_SQL + f"SELECT message_offset, {CODE_SQL} FROM inputs i", "messages"))
def encode_unseen(spark, sf_dir):
    rows = inputs(spark, sf_dir)
    dictionary = materialize(encode.label_dictionary(rows.filter("batch_no = 0"), cluster.CATEGORICAL), "dictionary")
    return encode.encode_labels(rows, dictionary, cluster.CATEGORICAL).select(OFFSET, *cluster.CATEGORICAL)


SCALED_SQL = ", ".join(
    f"""round(({c} - avg({c}) OVER w) / CASE WHEN coalesce(stddev_pop({c}) OVER w, 0) = 0 THEN 1 ELSE stddev_pop({c}) OVER w END, 6) AS {c}"""
    for c in cluster.NUMERIC
)


@check(
    "scale_per_window",
    with_views(INPUT_SQL + f"SELECT message_offset, {SCALED_SQL} FROM inputs WINDOW w AS (PARTITION BY batch_no)", "messages"),
)
def scale_per_window(spark, sf_dir):
    scaled = encode.scale_per_group(inputs(spark, sf_dir), "batch_no", cluster.NUMERIC)
    return rounded(scaled.select(OFFSET, *cluster.NUMERIC), cluster.NUMERIC)


@check(
    "running_accuracy",
    with_views(
        INPUT_SQL
        + """, numbered AS (SELECT *, (row_number() OVER (ORDER BY message_offset) - 1) // 100 AS chunk_no FROM inputs),
             chunks AS (SELECT chunk_no, avg(CAST(label = violation_code % 2 AS DOUBLE)) AS accuracy FROM numbered GROUP BY 1 HAVING count(*) = 100)
           SELECT chunk_no, accuracy, greatest(accuracy, 1 - accuracy) AS best_accuracy FROM chunks ORDER BY chunk_no DESC LIMIT 100""",
        "messages",
    ),
)
def running_accuracy(spark, sf_dir):
    """Chunks of 100 usable rows; the prediction here is a rule, so that the result is exact."""
    predictions = inputs(spark, sf_dir).withColumn("cluster", F.col("violation_code") % 2)
    return cluster.running_accuracy(predictions, OFFSET, "label", "cluster", size=100)


def cluster_predictions(spark, sf_dir):
    folder = work_folder(spark, "clusters")
    cluster.start_clustering(
        message_stream(spark, sf_dir), f"{folder}/sink", f"{folder}/checkpoint", OFFSET, WINDOW, min_year=V.MIN_YEAR
    ).awaitTermination()
    return spark.read.parquet(f"{folder}/sink/predictions").drop("epoch")


@check("stream_kmeans")
def stream_kmeans(spark, sf_dir):
    return cluster_predictions(spark, sf_dir).groupBy("batch_no", "cluster", "label").agg(F.count("*").alias("n"))


@check(
    "stream_kmeans_windows",
    with_views(
        INPUT_SQL
        + """, whole AS (SELECT message_offset // 1000 AS batch_no FROM messages GROUP BY 1 HAVING count(*) = 1000)
           SELECT batch_no, label, count(*) AS n, true AS known_cluster FROM inputs JOIN whole USING (batch_no) GROUP BY 1, 2""",
        "messages",
    ),
)
def stream_kmeans_windows(spark, sf_dir):
    """What SQL can state of the clustering: every usable message of a whole window has one of the two clusters."""
    return cluster_predictions(spark, sf_dir).groupBy("batch_no", "label").agg(
        F.count("*").alias("n"), F.every(F.col("cluster").isin(0, 1)).alias("known_cluster")
    )
