import random

import numpy as np
import pytest

from tests.conftest import plan_of
from urbanspark.operators import quantiles

SHARES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, part int, v double").repartition(5)


def grouped(rows):
    groups = {}
    for k, part, v in rows:
        groups.setdefault((k, part), []).append(v)
    return groups


def assert_like_numpy(spark, rows):
    counted = quantiles.value_counts_per_key(frame(spark, rows), ["k", "part"], "v")
    found = {(r["k"], r["part"]): r["quantiles"] for r in quantiles.quantiles_of_counts(counted, ["k", "part"], SHARES).collect()}
    expected = grouped(rows)
    assert set(found) == set(expected)
    for key, numbers in expected.items():
        numbers = [v for v in numbers if v is not None]
        assert found[key] == (pytest.approx(list(np.quantile(numbers, SHARES))) if numbers else [None] * len(SHARES))


@pytest.mark.parametrize("limit", [20, 1_000_000])
def test_groups_of_all_sizes(spark, monkeypatch, limit):
    """A hot group, ties over most of a group, single values, null keys and a group of nulls, narrowed in several rounds or none."""
    monkeypatch.setattr(quantiles, "SORTED_VALUES", limit)
    rng = random.Random(3)
    rows = [("hot", 1, rng.gauss(0, 1) * 10 ** rng.randrange(6)) for _ in range(3000)]
    rows += [("tied", 1, rng.choice([7.0, 7.0, 7.0, rng.random()])) for _ in range(500)]
    rows += [("one", 2, 4.5), ("hot", 2, 1.0), ("hot", 2, 2.0), (None, None, 3.0), (None, None, 9.0), ("none", 1, None), ("one", 2, None)]
    assert_like_numpy(spark, rows)


def test_without_keys_and_empty(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "SORTED_VALUES", 10)
    numbers = [float(i * i % 211) for i in range(300)]
    df = spark.createDataFrame([(v,) for v in numbers], "v double")
    counted = quantiles.value_counts_per_key(df, [], "v")
    assert quantiles.quantiles_of_counts(counted, [], SHARES).first()["quantiles"] == pytest.approx(list(np.quantile(numbers, SHARES)))
    nothing = quantiles.value_counts_per_key(frame(spark, []), ["k"], "v")
    assert quantiles.quantiles_of_counts(nothing, ["k"], SHARES).count() == 0
    assert quantiles.box_per_key(frame(spark, []), ["k"], "v").count() == 0


def test_box_per_key(spark):
    rows = [("a", 1, float(v)) for v in [1, 2, 2, 3, 4, 100]] + [("b", 1, None)]
    found = {r["k"]: tuple(r)[1:] for r in quantiles.box_per_key(frame(spark, rows), ["k"], "v").collect()}
    assert found == {"a": (6, 2.0, 2.5, 3.75, 1.0, 4.0, 1), "b": (0, None, None, None, None, None, 0)}


def test_no_buffer_of_all_values(spark):
    rows = [("a", 1, float(v)) for v in range(20)]
    counted = quantiles.value_counts_per_key(frame(spark, rows), ["k"], "v")
    plan = plan_of(quantiles.quantiles_of_counts(counted, ["k"], [0.5]))
    assert "percentile" not in plan and "NestedLoop" not in plan
