"""Feature encoding, model inputs, models and scores."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import contexts as C
from checks import views as V
from checks.aggregates import rounded
from checks.columns import BODY_SQL, CLOCK_SQL, COUNTY_SQL, DATE_SQL, ISSUE_SQL, MAKE_SQL, PLATE_SQL
from checks.registry import check
from checks.views import with_views
from urbanspark.functions import clean, rules
from urbanspark.functions.hours import wall_clock
from urbanspark.operators import encode, metrics
from urbanspark.operators.design import Design, Moments, code_fixed, fit_design, score_column
from urbanspark.operators.tables import inline_table, materialize
from urbanspark.plans import block_models, boosting, models, tickets


@check(
    "onehot_county",
    with_views(
        "SELECT issuing_agency, "
        + ", ".join(f"count(*) FILTER (borough = '{b}') AS \"borough_{b}\"" for b in [*rules.BOROUGHS, "-"])
        + f" FROM (SELECT issuing_agency, {COUNTY_SQL} AS borough FROM tickets) GROUP BY 1",
        "tickets",
    ),
)
def onehot_county(spark, sf_dir):
    source = V.tickets(spark, sf_dir, "issuing_agency", "violation_county")
    wide = encode.one_hot(
        source.select("issuing_agency", clean.county_clean("violation_county").alias("borough")), "borough"
    )
    return wide.groupBy("issuing_agency").agg(*[F.sum(f"`{c}`").alias(c) for c in wide.columns[1:]])


# Cleaned columns as SQL, for the category lists.
CLEAN_SQL = {
    "plate_type": PLATE_SQL,
    "violation_code": "CAST(violation_code AS VARCHAR)",
    "vehicle_body_type": BODY_SQL,
    "vehicle_make": MAKE_SQL,
    "issuing_agency": "issuing_agency",
    "violation_county": COUNTY_SQL,
}
LEVELS = [(c, level) for c, values in rules.CATEGORY_LEVELS.items() for level in values[1:]]


def flag_name(column: str, level: str) -> str:
    return f"{column}_{level}"


@check(
    "onehot_fixed",
    with_views(
        "SELECT registration_state, count(*) AS n, "
        + ", ".join(f"CAST(count(*) FILTER (c_{c} = '{level}') AS BIGINT) AS \"{flag_name(c, level)}\"" for c, level in LEVELS)
        + " FROM (SELECT registration_state, "
        + ", ".join(f"{e} AS c_{c}" for c, e in CLEAN_SQL.items())
        + " FROM tickets) GROUP BY 1",
        "tickets",
    ),
)
def onehot_fixed(spark, sf_dir):
    source = V.tickets(spark, sf_dir, "registration_state", *CLEAN_SQL).withColumns(
        {
            "plate_type": clean.plate_type("plate_type"),
            "vehicle_body_type": clean.body_type("vehicle_body_type"),
            "vehicle_make": clean.make_initial("vehicle_make"),
            "violation_county": clean.county_clean("violation_county"),
        }
    )
    # Equal rows first: the wide columns are then made and added up once per combination.
    combinations = source.groupBy(*source.columns).agg(F.count("*").alias("n"))
    wide = encode.one_hot_fixed(combinations, rules.CATEGORY_LEVELS)
    sums = [F.sum(F.col(f"`{flag_name(*x)}`") * F.col("n")).alias(flag_name(*x)) for x in LEVELS]
    return wide.groupBy("registration_state").agg(F.sum("n").alias("n"), *sums)


SCALE_COLUMNS = ["violation_code", "feet_from_curb"]


@check(
    "scale_train_test",
    with_views(
        f""", dated AS (SELECT violation_code, feet_from_curb, {DATE_SQL} < TIMESTAMP '{V.TEST}' AS is_train FROM tickets WHERE {DATE_SQL} IS NOT NULL),
             fitted AS (SELECT {", ".join(f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in SCALE_COLUMNS)} FROM dated WHERE is_train)
           SELECT CASE WHEN is_train THEN 'train' ELSE 'test' END AS part, {", ".join(f"round(({c} - {c}_m) / {c}_s, 6) AS {c}" for c in SCALE_COLUMNS)}, count(*) AS n
           FROM dated, fitted GROUP BY ALL""",
        "tickets",
    ),
)
def scale_train_test(spark, sf_dir):
    source = V.tickets(spark, sf_dir, *SCALE_COLUMNS, "issue_date")
    dated = source.withColumn("issue_date", clean.to_timestamp_or_null("issue_date"))
    train, test = encode.split_by_time(dated, "issue_date", V.TEST)
    scaler = encode.fit_scaler(train, SCALE_COLUMNS)
    train, test = encode.apply_scaler(train, scaler), encode.apply_scaler(test, scaler)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return rounded(both, SCALE_COLUMNS).groupBy("part", *SCALE_COLUMNS).agg(F.count("*").alias("n"))


@check(
    "chunk_rows",
    with_views(
        f"""SELECT block_no, count(*) AS n, min(issue_time) AS first_time, max(issue_time) AS last_time FROM (
              SELECT issue_time, (row_number() OVER (ORDER BY issue_time) - 1) // 1000 AS block_no FROM (SELECT {ISSUE_SQL} AS issue_time FROM tickets)
              WHERE issue_time IS NOT NULL) GROUP BY 1""",
        "tickets",
    ),
)
def chunk_rows(spark, sf_dir):
    source = V.tickets(spark, sf_dir, "summons_number", "issue_date", "violation_time", "violation_county", "violation_code", "house_number")
    time = clean.issue_time(clean.to_timestamp_or_null("issue_date"), clean.clock_hour("violation_time"))
    timed = materialize(source.withColumn("issue_time", time).filter("issue_time IS NOT NULL"), "timed")
    blocks = models.chunk_rows(timed, "issue_time", ["summons_number", "house_number"], size=1000)
    return blocks.groupBy("block_no").agg(
        F.count("*").alias("n"), F.min("issue_time").alias("first_time"), F.max("issue_time").alias("last_time")
    )


# --- the out-of-state set ------------------------------------------------------------------------

TICKET_INPUTS = [
    "registration_state",
    "plate_type",
    "issue_date",
    "violation_time",
    "violation_county",
    "violation_code",
    "vehicle_body_type",
    "vehicle_make",
    "issuing_agency",
    "from_hours_in_effect",
    "to_hours_in_effect",
    "vehicle_year",
    "feet_from_curb",
]
NUMERIC_SQL = {
    "from_hours_in_effect": f"coalesce({CLOCK_SQL.format(c='from_hours_in_effect')}, 0)",
    "to_hours_in_effect": f"coalesce({CLOCK_SQL.format(c='to_hours_in_effect')}, 24)",
    "vehicle_year": "vehicle_year",
    "feet_from_curb": "feet_from_curb",
}
CYCLE_SQL = {
    f"{name}_{label}": f"{f}(2 * pi() * {name}(issue_time) / {period})"
    for name, period in {"month": 12, "day": 31, "hour": 24}.items()
    for f, label in (("sin", "sine"), ("cos", "cosine"))
}
SET_SQL = (
    C.HOURLY_SQL
    + ", cleaned AS (SELECT registration_state, "
    + f"{ISSUE_SQL} AS issue_time, "
    + ", ".join(f"{e} AS {c}" for c, e in {**CLEAN_SQL, **NUMERIC_SQL}.items())
    + f""" FROM tickets WHERE {ISSUE_SQL} >= TIMESTAMP '{V.START}' AND {ISSUE_SQL} < TIMESTAMP '{V.END}' AND {COUNTY_SQL} <> '-'),
    joined AS (SELECT c.*, {", ".join(f"h.{c}" for c in C.FEATURE_COLUMNS)} FROM cleaned c
      LEFT JOIN hourly h ON h.borough = c.violation_county AND h.datetime = c.issue_time),
    numbers AS (SELECT issue_time, CAST(registration_state = 'NY' AS INTEGER) AS label, """
    + ", ".join(
        f"CAST(coalesce({e}, 0) AS FLOAT) AS \"{name}\""
        for name, e in {
            **{c: c for c in [*NUMERIC_SQL, *C.FEATURE_COLUMNS]},
            **CYCLE_SQL,
            **{flag_name(c, level): f"CAST({c} = '{level}' AS INTEGER)" for c, level in LEVELS},
        }.items()
    )
    + " FROM joined)"
)
SET_COLUMNS = [*NUMERIC_SQL, *C.FEATURE_COLUMNS, *CYCLE_SQL, *[flag_name(c, level) for c, level in LEVELS]]
# Columns that vary in the training part at every scale, compared row by row.
ROW_COLUMNS = [
    *NUMERIC_SQL,
    "open_businesses",
    "num_events",
    "landmark_density",
    "open_schools",
    "national_holiday",
    "special_day",
    "school_holiday",
    *CYCLE_SQL,
    "plate_type_COM",
    "violation_code_40",
    "vehicle_body_type_SU",
    "vehicle_make_other",
    "issuing_agency_P",
    "violation_county_Queens",
]


def state_set(spark, sf_dir):
    source = V.tickets(spark, sf_dir, *TICKET_INPUTS, spread=True)
    return tickets.state_features(source, C.stored_hourly(spark, sf_dir), V.START, V.END, V.TEST)


def rounded_floats_sql(columns):
    return ", ".join(f'round(CAST("{c}" AS DOUBLE), 4) AS "{c}"' for c in columns)


@check(
    "state_ticket_features",
    with_views(SET_SQL + f"SELECT issue_time, label, {rounded_floats_sql(ROW_COLUMNS)} FROM numbers", *C.FEATURE_VIEWS, "tickets"),
)
def state_ticket_features(spark, sf_dir):
    return rounded(state_set(spark, sf_dir).wide(ROW_COLUMNS), ROW_COLUMNS, 4)


@check(
    "state_feature_sums",
    with_views(
        SET_SQL
        + f""", long AS (UNPIVOT numbers ON {", ".join(f'"{c}"' for c in SET_COLUMNS)} INTO NAME "column" VALUE v)
           SELECT "column", label, round(sum(CAST(v AS DOUBLE)) FILTER (issue_time < TIMESTAMP '{V.TEST}'), 3) AS train_sum,
                  round(sum(CAST(v AS DOUBLE)) FILTER (issue_time >= TIMESTAMP '{V.TEST}'), 3) AS test_sum
           FROM long WHERE "column" IN (SELECT "column" FROM long WHERE issue_time < TIMESTAMP '{V.TEST}' GROUP BY 1 HAVING min(v) <> max(v)) GROUP BY 1, 2""",
        *C.FEATURE_VIEWS,
        "tickets",
    ),
)
def state_feature_sums(spark, sf_dir):
    """All columns that the set keeps, added up per label in the training and the test part: numbers as they are, levels by counting codes."""
    coded = state_set(spark, sf_dir)
    table, design = coded.table, coded.design
    parts = {"train_sum": F.col("issue_time") < wall_clock(V.TEST), "test_sum": F.col("issue_time") >= wall_clock(V.TEST)}
    numeric = [c for c in design.numeric if c in design.inputs]
    cells = [
        F.struct(F.lit(c).alias("column"), *[F.sum(F.when(part, F.col(f"`{c}`").cast("double"))).alias(n) for n, part in parts.items()])
        for c in numeric
    ]
    rows_of = {n.replace("sum", "rows"): F.sum(F.when(part, 1)) for n, part in parts.items()}
    numbers = table.groupBy("label").agg(F.array(*cells).alias("rows"), *[e.alias(n) for n, e in rows_of.items()])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("code")) for c in design.levels])
    counted = table.select("label", *[part.cast("int").alias(n) for n, part in parts.items()], F.explode(pairs).alias("p"))
    counted = counted.groupBy("label", "p.column", "p.code").agg(*[F.sum(n).cast("double").alias(n) for n in parts])
    levels = [(c, i, design.name(c, v)) for c, values in design.levels.items() for i, v in enumerate(values, 1)]
    kept = inline_table(spark, ["of", "code", "name"], [row for row in levels if row[2] in design.inputs])
    # Every kept level for every label; a level that a label lacks sums to 0, in a part without rows to null.
    every = numbers.select("label", "train_rows", "test_rows").join(F.broadcast(kept))
    found = counted.withColumnRenamed("column", "of")
    flags = every.join(found, ["label", "of", "code"], "left").select(
        "label",
        F.col("name").alias("column"),
        *[F.when(F.col(n.replace("sum", "rows")).isNotNull(), F.coalesce(n, F.lit(0.0))).alias(n) for n in parts],
    )
    both = numbers.select("label", F.inline("rows")).unionByName(flags)
    return rounded(both, list(parts), 3)


# --- scores --------------------------------------------------------------------------------------

SCORED_SQL = """, scored AS (SELECT CAST(registration_state = 'NY' AS INTEGER) AS label, CAST(violation_code > 25 AS INTEGER) AS prediction,
    CAST(feet_from_curb AS DOUBLE) AS y, violation_code / 5.0e0 AS p FROM tickets)"""


def scored(spark, sf_dir):
    return V.tickets(spark, sf_dir, "registration_state", "violation_code", "feet_from_curb").select(
        (F.col("registration_state") == "NY").cast("int").alias("label"),
        (F.col("violation_code") > 25).cast("int").alias("prediction"),
        F.col("feet_from_curb").cast("double").alias("y"),
        (F.col("violation_code") / 5.0).alias("p"),
    )


@check(
    "metric_accuracy",
    with_views(SCORED_SQL + "SELECT round(avg(CAST(label = prediction AS DOUBLE)), 9) AS accuracy, count(*) AS n FROM scored", "tickets"),
)
def metric_accuracy(spark, sf_dir):
    return rounded(metrics.accuracy(scored(spark, sf_dir), "label", "prediction"), ["accuracy"], 9)


@check("metric_rmse", with_views(SCORED_SQL + "SELECT round(sqrt(avg(pow(y - p, 2))), 6) AS rmse, count(*) AS n FROM scored", "tickets"))
def metric_rmse(spark, sf_dir):
    return rounded(metrics.rmse(scored(spark, sf_dir), "y", "p"), ["rmse"])


@check(
    "metric_confusion",
    with_views(
        SCORED_SQL + "SELECT label, prediction, count(*) AS n, round(count(*) / (SELECT count(*) FROM scored), 9) AS share FROM scored GROUP BY 1, 2",
        "tickets",
    ),
)
def metric_confusion(spark, sf_dir):
    return rounded(metrics.confusion_matrix(scored(spark, sf_dir), "label", "prediction"), ["share"], 9)


# --- models --------------------------------------------------------------------------------------


@check(
    "linreg",
    "SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept FROM lineitem",
)
def linreg(spark, sf_dir):
    lines = V.table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice")
    model = models.linear_model(models.vectors(lines, ["l_quantity"], "l_extendedprice"))
    return lines.limit(1).select(
        F.round(F.lit(float(model.coefficients[0])), 4).alias("slope"), F.round(F.lit(float(model.intercept)), 4).alias("intercept")
    )


REGRESSION_SQL = with_views(
    f"SELECT count(*) AS n, TRUE AS better_than_mean FROM ({C.PER_DAY_SQL}) WHERE issue_date >= TIMESTAMP '{V.TEST}'", "tickets"
)
CLASSIFICATION_SQL = with_views(
    f"""SELECT CAST(registration_state = 'NY' AS INTEGER) AS label, count(*) AS n, TRUE AS no_worse_than_majority FROM tickets
        WHERE {ISSUE_SQL} >= TIMESTAMP '{V.TEST}' AND {ISSUE_SQL} < TIMESTAMP '{V.END}' AND {COUNTY_SQL} <> '-' GROUP BY 1""",
    "tickets",
)


class DailySet:
    """The tickets-per-day set with its inputs, split by time; missing numbers become 0 unless ``missing`` keeps them."""

    def __init__(self, spark, sf_dir, missing=False):
        source = V.tickets(spark, sf_dir, "issue_date", "violation_county")
        table = tickets.daily_ticket_features(source, C.daily_features(spark, sf_dir), V.START, V.END)
        inputs = [c for c in table.columns if c not in ("issue_date", "tickets")]
        filled = [F.col(c).cast("float") if missing else F.coalesce(F.col(c).cast("float"), F.lit(0.0).cast("float")) for c in inputs]
        timed = table.select(
            F.col("issue_date").cast("timestamp_ntz").alias("issue_time"),
            F.col("tickets").alias("label"),
            *[f.alias(c) for f, c in zip(filled, inputs)],
        )
        # Written: many renamed columns in one plan cost the optimizer more than the table itself.
        timed = materialize(timed, "daily_set")
        self.train, self.test = encode.split_by_time(timed, "issue_time", V.TEST)
        self.design, self.moments = fit_design(self.train, Design(inputs, {}))
        self.blocks = models.time_blocks(self.train, self.design, "issue_time")
        self.mean = self.train.agg(F.avg("label")).first()[0]

    def scores(self, prediction):
        """Rows of the test part, and whether the squared error on the training part is below that of its mean."""
        error = lambda p: F.avg((F.col("label") - p) * (F.col("label") - p))
        better = self.train.agg((error(prediction) < error(F.lit(self.mean))).alias("better_than_mean"))
        return self.test.agg(F.count("*").alias("n")).join(F.broadcast(better))


class BlockedSet(NamedTuple):
    blocks: DataFrame
    design: Design
    moments: Moments


def class_scores(train, test, prediction):
    """Rows per label of the test part that the model put into one of the two classes, and whether it is right on as many
    training rows as the larger label alone, but for one in a hundred."""
    hits = train.groupBy("label").agg(F.count("*").alias("n"), F.sum((F.col("label") == prediction).cast("int")).alias("right"))
    better = hits.agg((F.sum("right") >= F.lit(0.99) * F.max("n")).alias("no_worse_than_majority"))
    return test.groupBy("label").agg(F.count_if(prediction.isin(0, 1)).alias("n")).join(F.broadcast(better))


def column_of(weights, of):
    return score_column(weights, of.design, of.moments)


@check("gbt_regress", REGRESSION_SQL)
def gbt_regress(spark, sf_dir):
    """Boosted trees on inputs with missing values."""
    daily = DailySet(spark, sf_dir, missing=True)
    booster, _ = boosting.boost(daily.blocks, daily.train, daily.design, "squared", trees=30)
    both = {part: boosting.predict(rows, booster) for part, rows in (("train", daily.train), ("test", daily.test))}
    better = both["train"].agg(
        (F.avg(F.pow(F.col("label") - F.col("prediction"), 2)) < F.avg(F.pow(F.col("label") - daily.mean, 2))).alias("better_than_mean")
    )
    return both["test"].agg(F.count("*").alias("n")).join(F.broadcast(better))


@check("gbt_classify", CLASSIFICATION_SQL)
def gbt_classify(spark, sf_dir):
    state = state_set(spark, sf_dir)
    train, test = state.parts()
    blocks = models.time_blocks(train, state.design, "issue_time")
    booster, _ = boosting.boost(blocks, train, state.design, "logistic")
    predicted = [boosting.predict(part, booster).withColumn("label", F.col("label").cast("int")) for part in (train, test)]
    return class_scores(*predicted, F.col("prediction"))


# One tree of depth 1 on two numbers and a code, one number often missing: all splits in one query.
SPLIT_SQL = """WITH t AS (SELECT CASE WHEN l_quantity < 8 THEN NULL ELSE l_quantity END AS quantity, round(l_discount * 100) AS discount,
             CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 2 ELSE 0 END AS flag, round(l_tax * 100) AS y FROM lineitem),
g AS (SELECT *, round((avg(y) OVER () - y) * 1048576) / 1048576 AS g FROM t),
all_rows AS (SELECT sum(g) AS g, count(*) AS h FROM g),
bounds AS (SELECT DISTINCT 'quantity' AS feature, quantity AS b FROM g WHERE quantity < (SELECT max(quantity) FROM g)
     UNION SELECT DISTINCT 'discount', discount FROM g WHERE discount < (SELECT max(discount) FROM g)
     UNION SELECT DISTINCT 'flag', flag FROM g WHERE flag > 0),
cells AS (SELECT 'quantity' AS feature, quantity AS v, sum(g) AS g, count(*) AS h FROM g GROUP BY ALL
    UNION ALL SELECT 'discount', discount, sum(g), count(*) FROM g GROUP BY ALL
    UNION ALL SELECT 'flag', flag, sum(g), count(*) FROM g GROUP BY ALL),
sides AS (SELECT b.feature, b.b, m.missing_low,
     sum(c.g) FILTER (CASE WHEN c.v IS NULL THEN m.missing_low WHEN b.feature = 'flag' THEN c.v = b.b ELSE c.v <= b.b END) AS lg,
     sum(c.h) FILTER (CASE WHEN c.v IS NULL THEN m.missing_low WHEN b.feature = 'flag' THEN c.v = b.b ELSE c.v <= b.b END) AS lh
   FROM bounds b JOIN cells c USING (feature) CROSS JOIN (SELECT TRUE AS missing_low UNION ALL SELECT FALSE) m GROUP BY ALL),
gains AS (SELECT s.*, lg * lg / (lh + 1) + (a.g - lg) * (a.g - lg) / (a.h - lh + 1) - a.g * a.g / (a.h + 1) AS gain FROM sides s, all_rows a WHERE lh >= 1 AND a.h - lh >= 1)
SELECT feature, CAST(b AS DOUBLE) AS bound, missing_low AND feature = 'quantity' AS missing_low, round(gain, 4) AS gain
FROM gains ORDER BY gains.gain DESC, feature LIMIT 1"""


@check("gbt_split", SPLIT_SQL)
def gbt_split(spark, sf_dir):
    """The best split of the first tree, its gain and the side of missing values."""
    lines = V.table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("timestamp_ntz").alias("t"),
        F.round(F.col("l_tax") * 100).alias("label"),
        F.when(F.col("l_quantity") >= 8, F.col("l_quantity")).cast("float").alias("quantity"),
        F.round(F.col("l_discount") * 100).cast("float").alias("discount"),
        code_fixed(F.col("l_returnflag"), ["A", "R"]).alias("flag"),
    )
    lines = materialize(lines, "split_rows")
    design = Design(["quantity", "discount"], {"flag": ["A", "R"]})
    blocks = models.time_blocks(lines, design, "t")
    booster, splits = boosting.boost(blocks, lines, design, "squared", trees=1, depth=1, bins=256)
    split = splits[0][0]
    bins, names = booster.bins, [*design.numeric, *design.levels]
    place = split.bound - int(bins.starts[split.feature])
    bound = float(bins.bounds[split.feature][place]) if split.feature < len(bins.bounds) else float(place)
    row = (names[split.feature], bound, split.missing_low, round(split.gain, 4))
    return inline_table(spark, ["feature", "bound", "missing_low", "gain"], [row])


@check("linreg_daily", REGRESSION_SQL.replace("AS better_than_mean", "AS better_than_mean, TRUE AS converged"))
def linreg_daily(spark, sf_dir):
    daily = DailySet(spark, sf_dir)
    weights, report = block_models.consensus_weights(daily.blocks, daily.design, daily.moments, "squared")
    return daily.scores(column_of(weights, daily)).withColumn("converged", F.lit(report["primal"] <= report["limit"]))


def weights_of_any_layout(of, loss, **settings):
    """Weights by stochastic gradient, and whether blocks dealt to 3 and to 11 partitions give the same ones."""
    found = [block_models.sgd_weights(of.blocks.repartition(n), of.design, of.moments, loss, **settings) for n in (3, 11)]
    return found[0], F.lit(bool(abs(found[0] - found[1]).max() < 1e-9))


@check("sgd_regress", REGRESSION_SQL.replace("AS better_than_mean", "AS better_than_mean, TRUE AS same_weights"))
def sgd_regress(spark, sf_dir):
    daily = DailySet(spark, sf_dir)
    weights, same = weights_of_any_layout(daily, "squared", rounds=20)
    return daily.scores(column_of(weights, daily)).withColumn("same_weights", same)


@check("logreg", CLASSIFICATION_SQL.replace("AS no_worse_than_majority", "AS no_worse_than_majority, TRUE AS small_gradient"))
def logreg(spark, sf_dir):
    """``small_gradient``: no slope of the penalised mean loss exceeds 1e-4 at the end."""
    state = state_set(spark, sf_dir)
    train, test = state.parts()
    blocks = models.time_blocks(train, state.design, "issue_time")
    weights, _ = block_models.consensus_weights(blocks, state.design, state.moments, "logistic")
    slope = block_models.logistic_gradient(blocks, state.design, state.moments, weights, 1.0)
    scores = class_scores(train, test, (column_of(weights, state) > 0).cast("int"))
    return scores.withColumn("small_gradient", F.lit(bool(abs(slope).max() < 1e-4)))


@check("sgd_classify", CLASSIFICATION_SQL.replace("AS no_worse_than_majority", "AS no_worse_than_majority, TRUE AS same_weights"))
def sgd_classify(spark, sf_dir):
    state = state_set(spark, sf_dir)
    train, test = state.parts()
    blocked = BlockedSet(models.time_blocks(train, state.design, "issue_time"), state.design, state.moments)
    weights, same = weights_of_any_layout(blocked, "hinge", rounds=5, rate=0.2)
    return class_scores(train, test, (column_of(weights, state) > 0).cast("int")).withColumn("same_weights", same)


# Normal equations of two inputs, written out.
CONSENSUS_SQL = """WITH t AS (SELECT l_quantity AS x1, round(l_discount * 100) AS x2, l_extendedprice AS y FROM lineitem),
m AS (SELECT covar_pop(x1, x1) AS s11, covar_pop(x2, x2) AS s22, covar_pop(x1, x2) AS s12, covar_pop(y, x1) AS s1y, covar_pop(y, x2) AS s2y,
             avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my FROM t),
b AS (SELECT *, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1, (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM m)
SELECT round(b1, 3) AS quantity, round(b2, 3) AS discount, round(my - b1 * m1 - b2 * m2, 3) AS intercept FROM b"""


@check("linreg_consensus", CONSENSUS_SQL)
def linreg_consensus(spark, sf_dir):
    """Least squares by consensus over blocks of 1000 rows."""
    lines = V.table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("timestamp_ntz").alias("t"),
        F.col("l_extendedprice").cast("double").alias("label"),
        F.col("l_quantity").cast("float").alias("quantity"),
        F.round(F.col("l_discount") * 100).cast("float").alias("discount"),
    )
    design, moments = fit_design(lines, Design(["quantity", "discount"], {}))
    blocks = models.time_blocks(lines, design, "t", size=1000)
    weights, _ = block_models.consensus_weights(blocks, design, moments, "squared", penalty=0.0, tolerance=1e-10)
    slopes = weights[1:] / moments.scale
    intercept = weights[0] - (slopes * moments.mean).sum()
    found = {"quantity": slopes[0], "discount": slopes[1], "intercept": intercept}
    return lines.limit(1).select(*[F.round(F.lit(float(v)), 3).alias(c) for c, v in found.items()])
