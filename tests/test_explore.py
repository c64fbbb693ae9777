import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of, values
from urbanspark.operators import encode, explore, metrics
from urbanspark.operators.ranks import global_row_number
from urbanspark.plans import models


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema).repartition(5)


def test_group_stats(spark):
    rng = random.Random(1)
    rows = [("a", rng.randint(1990, 2020)) for _ in range(101)] + [("b", 2000), ("c", None), (None, 5)]
    found = {r["k"]: r for r in explore.group_stats(frame(spark, rows, "k string, v int"), ["k"], "v", 2000.0).collect()}
    numbers = [v for k, v in rows if k == "a"]
    assert found["a"]["mean"] == pytest.approx(statistics.mean(numbers))
    assert found["a"]["std"] == pytest.approx(statistics.stdev(numbers))
    assert found["a"]["median"] == statistics.median(numbers)
    assert (found["b"]["mean"], found["b"]["std"], found["b"]["median"]) == (2000.0, None, 2000.0)
    assert found["c"]["mean"] is None and set(found) == {"a", "b", "c"}


@pytest.mark.parametrize("n", [1, 2, 7, 1000])
def test_exact_quantiles(spark, n, monkeypatch):
    monkeypatch.setattr(explore, "VALUES_PER_RANGE", 50)
    rng = random.Random(n)
    numbers = [rng.choice([1.5, rng.random() * 100, 7.0]) for _ in range(n)]
    counted = frame(spark, [(v,) for v in numbers], "v double").groupBy("v").agg(F.count("*").alias("c"))
    probabilities = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]
    assert explore.exact_quantiles(counted, probabilities) == pytest.approx(list(np.quantile(numbers, probabilities)))


def test_histogram_like_numpy(spark):
    numbers = [v for v in range(1972, 2021) for _ in range(v % 7)]
    found = explore.histogram(frame(spark, [(v,) for v in numbers], "v int"), "v", 30).orderBy("bin").collect()
    counts, edges = np.histogram(numbers, bins=30)
    assert [r["n"] for r in found] == list(counts)
    assert [r["low"] for r in found] == pytest.approx(list(edges[:-1]))
    same = explore.histogram(frame(spark, [(3,), (3,)], "v int"), "v", 4)
    assert [r["n"] for r in same.orderBy("bin").collect()] == [2, 0, 0, 0]


def test_top_k_is_a_heap(spark):
    df = explore.top_k(frame(spark, [("a",), ("b",), ("b",), (None,)], "v string"), "v", k=2)
    assert values(df) == [("b", 2), ("a", 1)]
    assert "TakeOrdered" in plan_of(df)


def test_first_per_key_prunes_before_the_shuffle(spark):
    rows = [(1, i, f"n{i}") for i in range(50)] + [(2, 7, "only")]
    df = explore.first_per_key(frame(spark, rows, "k int, t int, v string"), ["k"], ["t"])
    assert sorted(values(df)) == [(1, 0, "n0"), (2, 7, "only")]
    assert plan_of(df).count("WindowGroupLimit") >= 1


def test_crosstab_and_correlation(spark):
    df = frame(spark, [(1, "a", 1.0, 2.0), (1, "b", 2.0, 4.0), (2, "a", 3.0, None), (None, "a", 4.0, 9.0)], "r int, c string, x double, y double")
    assert sorted(values(explore.crosstab(df, "r", "c"))) == [(1, 1, 1), (2, 1, 0)]
    matrix = {(r["a"], r["b"]): r["r"] for r in explore.correlation_matrix(df, ["x", "y"]).collect()}
    assert matrix["x", "y"] == matrix["y", "x"] == pytest.approx(np.corrcoef([1, 2, 4], [2, 4, 9])[0, 1])


def test_distinct_counts_and_constants(spark):
    df = frame(spark, [(1, 1, None), (1, 2, None), (1, None, None)], "same int, two int, nothing int")
    assert dict(values(explore.distinct_counts(df, df.columns))) == {"same": 1, "two": 2, "nothing": 0}
    assert dict(values(explore.distinct_counts(df, df.columns, approximate=True)))["two"] == 2
    assert encode.constant_columns_by_distinct(df, df.columns) == ["same"]
    assert encode.constant_columns_by_deviation(df, df.columns) == ["same", "nothing"]


def test_one_hot(spark):
    df = frame(spark, [(1, "a"), (2, "b"), (3, None), (4, "z")], "i int, c string")
    wide = encode.one_hot_fixed(df, {"c": ["a", "b"]}).orderBy("i")
    assert values(wide) == [(1, 0), (2, 1), (3, 0), (4, 0)]
    assert encode.one_hot(df, "c").columns == ["i", "c_a", "c_b", "c_z"]


def test_labels(spark):
    first = frame(spark, [("b",), ("a",), ("b",)], "c string")
    dictionary = encode.label_dictionary(first, ["c"])
    coded = encode.encode_labels(frame(spark, [("a",), ("b",), ("z",)], "c string"), dictionary, ["c"])
    assert sorted(values(coded)) == [(-1,), (0,), (1,)]


def test_scaling(spark):
    df = frame(spark, [(0, 1.0, 5.0), (0, 3.0, 5.0), (1, 10.0, 1.0)], "g int, x double, y double")
    scaled = {tuple(r) for r in values(encode.scale_per_group(df, "g", ["x", "y"]))}
    assert scaled == {(0, -1.0, 0.0), (0, 1.0, 0.0), (1, 0.0, 0.0)}
    scaler = encode.fit_scaler(df, ["y", "x"])
    assert scaler["x"] == pytest.approx((14 / 3, float(np.std([1, 3, 10]))))


def test_row_numbers(spark):
    rows = [(i // 7, i) for i in range(100)]
    numbered = global_row_number(frame(spark, rows, "slot bigint, t int"), "slot", F.floor(F.col("slot") / 4), ["t"])
    assert sorted((r["t"], r["row_no"]) for r in numbered.collect()) == [(i, i) for i in range(100)]


def test_chunks_of_a_hot_hour(spark, monkeypatch):
    """Most rows share one hour; blocks still have exactly their size and follow time."""
    rows = [(i, "2020-01-01 05:00:00" if i < 70 else f"2020-01-0{2 + i % 3} 01:00:00") for i in range(100)]
    df = frame(spark, rows, "i int, t string").select("i", F.col("t").cast("timestamp_ntz").alias("t"))
    import urbanspark.operators.ranks as ranks

    original = ranks.time_slots
    monkeypatch.setattr(models, "time_slots", lambda d, h, t, s: original(d, h, t, s, rows_per_slot=10))
    blocks = models.chunk_rows(df, "t", ["i"], size=30).groupBy("block_no").agg(F.count("*"), F.min("t"), F.max("t"))
    found = sorted(values(blocks))
    assert [r[1] for r in found] == [30, 30, 30, 10]
    assert all(a[3] <= b[2] for a, b in zip(found, found[1:]))


def test_blocks_do_not_depend_on_the_slot_limit(spark, monkeypatch):
    rows = [(i, f"2020-01-01 05:{i % 60:02d}:00") for i in range(600)]
    df = frame(spark, rows, "i int, t string").select("i", F.col("t").cast("timestamp_ntz").alias("t"))
    import urbanspark.operators.ranks as ranks

    original, found = ranks.time_slots, []
    for limit in (3, 100, 1_000_000):
        monkeypatch.setattr(models, "time_slots", lambda d, h, t, s, limit=limit: original(d, h, t, s, rows_per_slot=limit))
        blocks = models.chunk_rows(df, "t", ["i"], size=50)
        found.append(sorted(values(blocks.select("i", "block_no"))))
        spans = sorted(values(blocks.groupBy("block_no").agg(F.min("t"), F.max("t"))))
        assert all(a[2] <= b[1] for a, b in zip(spans, spans[1:]))
    assert found[0] == found[1] == found[2]


def test_metrics(spark):
    df = frame(spark, [(1, 1), (1, 0), (0, 0), (0, 0)], "y int, p int")
    assert metrics.accuracy(df, "y", "p").first()["accuracy"] == 0.75
    assert metrics.rmse(df, "y", "p").first()["rmse"] == 0.5
    assert {(r["y"], r["p"]): r["share"] for r in metrics.confusion_matrix(df, "y", "p").collect()} == {
        (1, 1): 0.25,
        (1, 0): 0.25,
        (0, 0): 0.5,
    }
