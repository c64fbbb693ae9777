"""Every registered query against its SQL on the smallest tables, and checks of their plans."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from checks import views as V
from checks.aggregates import rounded
from checks.compare import compare, open_tables
from tests.conftest import plan_of

SF = "/root/testdata/sf0.001"
# Trained for minutes; the models have their own test on small data.
SLOW = {"gbt_regress", "gbt_classify", "logreg"}


@pytest.fixture(scope="module")
def tables():
    return open_tables(SF)


@pytest.mark.parametrize("name", sorted(set(queries()) - SLOW))
def test_query(spark, tables, name):
    ok, note = compare(spark, tables, SF, queries()[name], oracle_sql().get(name))
    assert ok, note


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and "tickets" in df.columns


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_foreign_keys_are_complete(spark):
    """The ticket view leaves out joins whose columns nobody asked for; this is why it may."""
    for child, key, parent, parent_key in [
        ("lineitem", "l_orderkey", "orders", "o_orderkey"),
        ("lineitem", "l_partkey", "part", "p_partkey"),
        ("orders", "o_custkey", "customer", "c_custkey"),
        ("customer", "c_nationkey", "nation", "n_nationkey"),
        ("nation", "n_regionkey", "region", "r_regionkey"),
    ]:
        for sf_dir in (SF, "/root/testdata/sf0.01"):
            rows = V.table(spark, sf_dir, child)
            parents = V.table(spark, sf_dir, parent)
            assert rows.join(parents, rows[key] == parents[parent_key], "left_anti").count() == 0
            assert parents.select(parent_key).distinct().count() == parents.count()


@pytest.mark.parametrize(
    "name",
    [
        "interval_active_counts",
        "open_businesses_hourly",
        "event_counts_hourly",
        "geo_point_in_polygon",
        "feature_table_hourly",
        "join_daily_features",
        "join_hourly_features",
        "count_window_stats",
        "running_half_mean",
        "tickets_per_day_county",
        "top_streets",
    ],
)
def test_no_nested_loop_join(spark, name):
    plan = plan_of(queries()[name](spark, SF))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_only_needed_columns_are_read(spark):
    plan = plan_of(queries()["freq_agency"](spark, SF))
    assert "ReadSchema: struct<l_returnflag:string>" in plan


def test_the_ticket_view_is_joined_once(spark):
    """Two passes decide and measure the columns; both read the few columns that were written, not the joins of the view."""
    plan = plan_of(queries()["drop_constant_std"](spark, SF))
    assert "Join" not in plan and "std_columns" in plan


def test_rounded_whole_numbers_need_no_decimals(spark):
    values = [None, 0.0, -0.0, 3.0, -7.0, 2.5, 1.00005, -1.00005, 0.123456, 1e-9, 9007199254740993.0, 1e300, float("nan"), float("inf"), -float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "x double").withColumn("y", F.round("x", 4))
    rows = rounded(df, ["x"], 4).selectExpr("CAST(x AS STRING) AS x", "CAST(y AS STRING) AS y").collect()
    assert [r.x for r in rows] == [r.y for r in rows]
    assert "rint" in rounded(df, ["x"], 4)._jdf.queryExecution().analyzed().toString().lower()
