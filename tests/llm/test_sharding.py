"""Feistel shards: the permutation, the numbers, and the shards against a brute-force version."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from urbanspark.llm import sharding

ROWS = [
    *[(i, f"text {i}", "en", i) for i in range(300)],
    (None, None, None, 1),
    (None, "", "de", 2),
    (7, "text 7", "en", 7),
    (7, "text 7", "en", 7),
    (8, "ü" * 9000, "en", 3),
    *[(500, "copy", "fr", i % 3) for i in range(50)],
]
SCHEMA = "doc_id bigint, text string, lang string, digest bigint"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def python_permutation(x, n, seed):
    a, b = sharding.grid(n)
    while True:
        high, low = divmod(x, b)
        for i, key in enumerate(sharding.round_keys(seed)):
            mixed = lambda half: ((half * sharding.FACTOR + key) % sharding.MODULUS) ** 2 % sharding.MODULUS  # noqa: E731, B023
            if i % 2 == 0:
                high = (high + mixed(low) % a) % a
            else:
                low = (low + mixed(high) % b) % b
        x = high * b + low
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 3, 5, 24, 97, 1000, 4321])
def test_permutation_and_its_inverse(spark, n):
    walk = sharding.longest_walk(spark.range(1), n)
    rows = spark.range(n).select("id", sharding.permuted(F.col("id"), n, walk).alias("place"))
    rows = rows.select("*", sharding.permuted(F.col("place"), n, walk, backwards=True).alias("back")).collect()
    assert sorted(r["place"] for r in rows) == list(range(n))
    assert all(r["back"] == r["id"] for r in rows)
    assert all(r["place"] == python_permutation(r["id"], n, sharding.SEED) for r in rows)


def test_places_look_random(spark):
    """Neighbours do not stay neighbours, and each shard draws from the whole range of numbers."""
    n = 10_000
    walk = sharding.longest_walk(spark.range(1), n)
    shard, _ = sharding.shard_and_slot(F.col("id"), n, walk)
    rows = [tuple(r) for r in spark.range(n).select("id", sharding.permuted(F.col("id"), n, walk), shard).orderBy("id").collect()]
    apart = [abs(x[1] - y[1]) for x, y in zip(rows, rows[1:])]
    assert 0.8 * n / 3 < sum(apart) / len(apart) < 1.2 * n / 3
    for k in range(sharding.SHARDS):
        ids = [i for i, _, s in rows if s == k]
        assert 0.4 * n < sum(ids) / len(ids) < 0.6 * n


def expected(rows, seed=sharding.SEED):
    def digest(r):
        return int(hashlib.md5(f"{'' if r[0] is None else r[0]}:{r[1] or ''}".encode()).hexdigest()[:15], 16)

    keyed = sorted((digest(r), r[0] is not None, r[0] or 0, len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows)
    out = []
    for number, (_, known, doc_id, size, crc) in enumerate(keyed):
        place = python_permutation(number, len(keyed), seed)
        out.append((doc_id if known else None, size, crc, "rows", place % 24, place // 24, None))
    return sorted(out, key=repr)


def test_against_brute_force_in_any_layout(docs):
    wanted = expected(ROWS)
    for layout in (docs.coalesce(1), docs.repartition(7, "lang")):
        got = sharding.assign_shards(layout)
        assert sorted(map(tuple, got.collect()), key=repr) == wanted


def test_heavy_digests_are_split(docs, monkeypatch):
    """Many equal rows fall on one digest; with small slots they go through sub-slots, with the same result."""
    monkeypatch.setattr(sharding, "SLOT_ROWS", 8)
    monkeypatch.setattr(sharding, "SLOTS_PER_BLOCK", 4)
    got = [tuple(r) for r in sharding.assign_shards(docs.repartition(5)).collect()]
    assert sorted((r[4], r[5]) for r in got) == sorted((p % 24, p // 24) for p in range(len(ROWS)))
    again = [tuple(r) for r in sharding.assign_shards(docs.coalesce(2)).collect()]
    assert sorted(got, key=repr) == sorted(again, key=repr)


def test_no_python_on_the_path(docs):
    plan = sharding.assign_shards(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan and "NestedLoop" not in plan


def test_empty_table(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert sharding.assign_shards(nothing).collect() == []


def test_whole_rows_are_written(docs, tmp_path):
    """Extra columns with names used inside come through; every row lies where arithmetic says."""
    clash = docs.withColumnRenamed("lang", "number").withColumn("at", F.lit("x"))
    written = sharding.shard_documents(clash, str(tmp_path / "shards"))
    assert set(clash.columns) <= set(written.columns)
    got = written.select(*clash.columns).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, map(tuple, clash.collect())))
    places = sorted((r["shard"], r["slot"]) for r in written.collect())
    assert places == sorted((p % 24, p // 24) for p in range(len(ROWS)))
    n = len(ROWS)
    walk = sharding.longest_walk(docs, n)
    numbers = [r[0] for r in written.select(sharding.row_number_at(F.col("shard"), F.col("slot"), n, walk)).collect()]
    assert sorted(numbers) == list(range(n))


def test_own_names_are_refused(docs, tmp_path):
    with pytest.raises(ValueError):
        sharding.shard_documents(docs.withColumn("slot", F.lit(1)), str(tmp_path / "no"))
