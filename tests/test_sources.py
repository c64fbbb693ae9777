from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from urbanspark.session import child_names, work_folder
from urbanspark.sources import convert, readers, writers
from urbanspark.sources.schema import TICKET_COLUMNS, TICKET_SCHEMA


def test_unknown_format(spark):
    with pytest.raises(ValueError, match="Invalid file format"):
        readers.read_dataset(spark, "/nowhere", "xlsx")
    with pytest.raises(ValueError, match="Unsupported format"):
        writers.write_dataset(spark.range(1), "/nowhere", "xlsx")


def test_loose_files_by_year(spark):
    base = work_folder(spark, "years")
    for year in (2014, 2015, 2016):
        spark.range(year, year + 1).write.parquet(f"{base}/{year}.parquet")
    spark.range(9, 10).write.parquet(f"{base}/2014_2015.parquet")
    read = lambda years: sorted(r[0] for r in readers.read_dataset(spark, base + "/*", "parquet").collect()) if years is None else sorted(
        r[0] for r in readers.read_dataset(spark, base, "parquet", years=years).collect()
    )
    assert read(None) == [9, 2014, 2015, 2016]
    assert read([2014, 2015]) == [9, 2014, 2015]  # the file that names both years is read once
    with pytest.raises(ValueError, match="No files found for the specified years."):
        read([1999])


def test_partition_pruning(spark):
    base = work_folder(spark, "partitions")
    spark.range(10).withColumn("year", (F.col("id") % 3 + 2014).cast("int")).write.partitionBy("year").parquet(base)
    df = readers.read_dataset(spark, base, "parquet", years=[2015])
    assert sorted(r["id"] for r in df.collect()) == [1, 4, 7]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan or "year#" in plan.split("PartitionFilters")[1][:80]


def test_column_pruning_reaches_the_scan(spark):
    base = work_folder(spark, "columns")
    spark.range(10).selectExpr("id", "id AS `a b`", "id AS c").write.parquet(base)
    df = readers.read_dataset(spark, base, "parquet", columns=["a b"], schema=spark.read.parquet(base).schema)
    assert "ReadSchema: struct<a b:bigint>" in df._jdf.queryExecution().executedPlan().toString()


def test_ticket_conversion(spark):
    base = work_folder(spark, "tickets")
    row = {name: None for name, _ in TICKET_COLUMNS} | {"Summons Number": "7", "Violation Code": "x", "Vehicle Year": "2001"}
    names = [f"old {i}" for i in range(43)]
    raw = spark.createDataFrame([tuple(row.values())], ", ".join(f"`{n}` string" for n in names))
    raw.write.option("header", True).csv(f"{base}/csv/2014.csv")
    assert convert.convert_ticket_files(spark, f"{base}/csv", f"{base}/parquet") == ["2014.parquet"]
    assert convert.convert_ticket_files(spark, f"{base}/csv", f"{base}/parquet") == []
    df = spark.read.parquet(f"{base}/parquet/2014.parquet")
    assert df.schema == TICKET_SCHEMA and len(df.columns) == 43
    found = df.first()
    # Columns go by position, and a value of the wrong type is null, not a lost row.
    assert (found["Summons Number"], found["Violation Code"], found["Vehicle Year"]) == (7, None, 2001)


def test_interrupted_conversion_is_done_again(spark):
    base = work_folder(spark, "interrupted")
    spark.createDataFrame([tuple(str(i) for i in range(43))]).write.option("header", True).csv(f"{base}/csv/2015.csv")
    spark.range(1).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", False).parquet(f"{base}/parquet/2015.parquet")
    assert convert.convert_ticket_files(spark, f"{base}/csv", f"{base}/parquet") == ["2015.parquet"]


def test_fixed_width(spark):
    df = spark.createDataFrame([(1, "É" * 30, "x" * 60, date(2020, 1, 2), 1.5, None)], "i int, t string, Location string, d date, f double, n string")
    assert values(writers.fixed_width(df, {"t": 3})) == [(1, "EEE", "x" * 42, "2020-01-02", 1.5, None)]


def test_exports(spark):
    base = work_folder(spark, "exports")
    df = spark.range(100).withColumn("borough", F.lit("Staten Island")).withColumn("datetime", F.col("id"))
    writers.export_top(df, f"{base}/top", [F.desc("id")], rows=3)
    files = [n for n in child_names(spark, f"{base}/top") if n.endswith(".csv")]
    assert len(files) == 1
    assert sorted(r["id"] for r in spark.read.option("header", True).csv(f"{base}/top").collect()) == ["97", "98", "99"]
    writers.write_features(df, f"{base}/features")
    assert "borough=Staten Island" in child_names(spark, f"{base}/features")
    writers.write_sorted_by_time(df, f"{base}/sorted", "datetime", partitions=4)
    assert spark.read.parquet(f"{base}/sorted").count() == 100


def test_samples(spark):
    df = spark.range(10_000)
    exact = readers.reservoir_sample(df, 0.1, seed=3)
    assert exact.count() == 1000 and exact.distinct().count() == 1000
    assert readers.reservoir_sample(df, 1.0).count() == 10_000 and readers.reservoir_sample(df, 0.0).count() == 0
    assert readers.reservoir_sample(df, 0.25, slots=3).count() == 2500
    by_key = readers.hash_sample(df, ["id"], 0.2)
    again = readers.hash_sample(df.repartition(7), ["id"], 0.2)
    assert sorted(values(by_key)) == sorted(values(again)) and 1800 < by_key.count() < 2200
    base = work_folder(spark, "sample")
    df.write.parquet(base)
    assert 700 < readers.read_dataset(spark, base, "parquet", fraction=0.1).count() < 1300


def test_merged_table(spark):
    base = work_folder(spark, "merged")
    spark.range(2).selectExpr("id", "id AS a").write.parquet(f"{base}/one")
    spark.range(2).selectExpr("id", "'x' AS b").write.parquet(f"{base}/two")
    table = convert.create_merged_table(spark, "merged_table_test", [f"{base}/one", f"{base}/two"], f"{base}/table")
    assert sorted(table.columns) == ["a", "b", "id"] and table.count() == 4
    assert readers.read_dataset(spark, "merged_table_test", "table", columns=["b"]).columns == ["b"]


def test_cluster_sessions_need_a_shared_folder(spark, monkeypatch):
    import urbanspark.session as session

    monkeypatch.setattr(session, "_setting", lambda *_: None)
    assert work_folder(spark, "x").startswith(session._local_base())
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(spark, "x")
