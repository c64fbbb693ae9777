import json
import random

import pytest
from pyspark.sql import functions as F

from checks import views as V
from tests.conftest import values
from urbanspark.operators.explore import STATISTICS
from urbanspark.session import work_folder
from urbanspark.streaming import cluster, live, messages, windows

KEYS = ["year_month", "violation_county"]
SF = "/root/testdata/sf0.001"


def half_mean(numbers):
    state = None
    for n in numbers:
        if n is not None:
            state = n if state is None else (state + n) / 2
    return state


def fold(spark, numbers, **settings):
    rows = [("k", i, None if n is None else float(n)) for i, n in enumerate(numbers)]
    df = spark.createDataFrame(rows, "k string, batch_no bigint, mean double").repartition(4)
    folded = windows.fold_windows(df, ["k"], values=["mean"], **settings)
    return folded.select(F.col("mean")["g"]).first()[0]


def test_half_mean_unit_rows(spark):
    assert fold(spark, [10, 20, 40]) == 27.5
    assert fold(spark, [10, None, 20]) == 15.0
    assert fold(spark, [None, None]) is None


@pytest.mark.parametrize("span,levels", [(2, 3), (3, 1), (1000, 2)])
def test_half_mean_in_segments(spark, span, levels):
    rng = random.Random(span)
    numbers = [rng.choice([None, rng.random() * 100]) for _ in range(60)]
    assert fold(spark, numbers, span=span, levels=levels) == pytest.approx(half_mean(numbers))


def message_files(spark, parts):
    """The messages in several Parquet files, in offset order."""
    base = work_folder(spark, "messages")
    rows = V.view(spark, SF, "messages")
    for i in range(parts):
        part = rows.filter((F.col("message_offset") >= i * 1000 // parts) & (F.col("message_offset") < (i + 1) * 1000 // parts))
        part.coalesce(1).write.parquet(f"{base}/{i}")
    return base, rows


def rows_by_key(df):
    return {(r[KEYS[0]], r[KEYS[1]]): [r[s] for s in STATISTICS] for r in df.collect()}


def assert_same(found, expected):
    assert found.keys() == expected.keys()
    for key, numbers in expected.items():
        assert found[key] == [None if n is None else pytest.approx(n) for n in numbers], key


@pytest.mark.parametrize("parts", [1, 4])
def test_stream_equals_batch(spark, parts):
    """Windows of 130 messages do not end where files end, so rows are carried between micro-batches."""
    base, rows = message_files(spark, parts)
    out = work_folder(spark, "out")
    stream = messages.replay_files(spark, f"{base}/*", rows.schema, files_per_batch=1)
    live.start_half_mean(stream, KEYS[1], f"{out}/sink", f"{out}/checkpoint", "message_offset", 130, 1995).awaitTermination()
    assert len(live.epochs(spark, f"{out}/sink/state")) == parts
    stats = windows.window_stats(rows, KEYS[1], "message_offset", 130, 1995)
    assert_same(rows_by_key(live.read_epoch(spark, f"{out}/sink/state")), rows_by_key(windows.running_half_mean(stats, KEYS)))
    # 1000 messages are seven whole windows and 90 messages.
    assert live.read_epoch(spark, f"{out}/sink/carry").count() == 1000 % 130


def test_old_epochs_are_forgotten(spark):
    """Two epochs per folder remain, the result is that of a stream which keeps all, and the last batch can be run again."""
    base, rows = message_files(spark, 6)
    sink = work_folder(spark, "sink")
    step = live.half_mean_batch(KEYS[1], sink, "message_offset", 130, 1995, keep=2)
    parts = [spark.read.parquet(f"{base}/{i}") for i in range(6)]
    for epoch, part in enumerate(parts):
        step(part, epoch)
    step(parts[5], 5)
    assert {name: live.epochs(spark, f"{sink}/{name}") for name in ("state", "carry", "positions")} == dict.fromkeys(
        ("state", "carry", "positions"), [4, 5]
    )
    stats = windows.window_stats(rows, KEYS[1], "message_offset", 130, 1995)
    assert_same(rows_by_key(live.read_epoch(spark, f"{sink}/state")), rows_by_key(windows.running_half_mean(stats, KEYS)))
    with pytest.raises(ValueError):
        live.forget_epochs(spark, f"{sink}/state", 1)


def test_month_stats_keep_counts_of_values_only(spark):
    base, rows = message_files(spark, 3)
    out = work_folder(spark, "out")
    stream = messages.replay_files(spark, f"{base}/*", rows.schema, files_per_batch=1)
    query = live.start_month_stats(stream, KEYS[1], f"{out}/sink", f"{out}/checkpoint", 1995, keep=2)
    query.awaitTermination()
    live_rows = windows.live_columns(rows.filter(windows.usable_year(1995))).dropna(subset=[KEYS[1]])
    distinct = live_rows.select(*KEYS, "vehicle_year_number").distinct().count()
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == distinct
    assert live.epochs(spark, f"{out}/sink") == [1, 2]
    assert_same(rows_by_key(live.read_epoch(spark, f"{out}/sink")), rows_by_key(windows.month_stats(rows, KEYS[1], 1995)))


def test_restart_continues_from_the_checkpoint(spark):
    base, rows = message_files(spark, 2)
    out, second = work_folder(spark, "out"), work_folder(spark, "later")

    def run():
        stream = messages.replay_files(spark, f"{second}/*", rows.schema)
        live.start_month_stats(stream, KEYS[1], f"{out}/sink", f"{out}/checkpoint", 1995).awaitTermination()

    spark.read.parquet(f"{base}/0").write.parquet(f"{second}/0")
    run()
    spark.read.parquet(f"{base}/1").write.parquet(f"{second}/1")
    run()
    assert_same(rows_by_key(live.read_epoch(spark, f"{out}/sink")), rows_by_key(windows.month_stats(rows, KEYS[1], 1995)))


def test_replayed_micro_batch_changes_nothing(spark):
    base, rows = message_files(spark, 2)
    sink = work_folder(spark, "sink")
    step = live.half_mean_batch(KEYS[1], sink, "message_offset", 130, 1995)
    first, second = spark.read.parquet(f"{base}/0"), spark.read.parquet(f"{base}/1")
    step(first, 0)
    step(second, 1)
    before = rows_by_key(live.read_epoch(spark, f"{sink}/state"))
    step(second, 1)  # as after a failure between the sink's write and the checkpoint's commit
    assert_same(rows_by_key(live.read_epoch(spark, f"{sink}/state")), before)


def test_incomplete_window_gives_nothing(spark):
    rows = V.view(spark, SF, "messages")
    numbers = {r["batch_no"] for r in windows.window_stats(rows, KEYS[1], "message_offset", 300, 1995).collect()}
    assert numbers == {0, 1, 2}


def test_views(spark):
    state = spark.createDataFrame(
        [("2014-01", "BX", 1.0, None, 1.0, 1.0, 1.0), ("2014-01", "QS", 3.0, 2.0, 3.0, 3.0, 3.0)],
        "year_month string, violation_county string, mean double, std double, median double, max double, min double",
    )
    assert values(live.view_overall(state)) == [("2014-01", 2.0, 2.0, 2.0, 2.0, 2.0)]
    assert [r["violation_county"] for r in live.view_groups(state, "violation_county").collect()] == ["BX", "QS"]


def test_json_round_trip(spark):
    df = spark.createDataFrame([(7, "a\"b", None)], "`Summons Number` bigint, t string, n int")
    encoded = messages.encode_rows(df, "Summons Number")
    key, value = encoded.first()
    assert key == "7" and json.loads(value) == {"Summons Number": 7, "t": 'a"b', "n": None}
    assert values(messages.decode_rows(encoded, df.schema, ["key"])) == [("7", 7, 'a"b', None)]


def test_broker_options():
    options = messages.broker_options("host:9092", group="g")
    assert options["startingOffsets"] == "earliest" and options["subscribe"] == messages.TOPIC


def part_rows(spark, repeat=True):
    """600 messages over three partitions of unequal size; every fifth offset is missing, some messages come twice."""
    rows = V.view(spark, SF, "messages").filter("message_offset < 600")
    part = F.when(F.col("message_offset") % 6 < 3, 0).when(F.col("message_offset") % 6 < 5, 1).otherwise(2)
    place = F.expr("message_offset div 6 * 3 + CASE WHEN message_offset % 6 < 3 THEN message_offset % 6 ELSE message_offset % 6 - 3 END")
    rows = rows.withColumn("part", part).withColumn("offset", 50 + place + (place / 4).cast("bigint"))
    return rows.unionByName(rows.filter("message_offset % 10 = 0")) if repeat else rows


def test_windows_of_partitions_lose_nothing(spark):
    rows = part_rows(spark)
    numbered = windows.add_window_number(rows, "offset", 40, "part")
    counts = {(r["part"], r["batch_no"]): r["count"] for r in numbered.groupBy("part", "batch_no").count().collect()}
    expected = {}
    for part, total in ((0, 300), (1, 200), (2, 100)):
        for start in range(0, total, 40):
            expected[part, start // 40] = min(40, total - start)
    assert counts == expected


def test_emitted_and_carried_is_received(spark):
    rows = part_rows(spark, repeat=False).persist()
    sink = work_folder(spark, "sink")
    step = live.half_mean_batch(KEYS[1], sink, "offset", 40, 1995, "part")
    # The third micro-batch brings the second one again beside its own messages.
    cuts = [(0, 150), (150, 400), (150, 600)]
    for epoch, (low, high) in enumerate(cuts):
        step(rows.filter((F.col("message_offset") >= low) & (F.col("message_offset") < high)), epoch)
    positions = {r["part"]: r["__done"] for r in live.read_epoch(spark, f"{sink}/positions").collect()}
    assert positions == {0: 7, 1: 5, 2: 2}
    carried = {r["part"]: r["count"] for r in live.read_epoch(spark, f"{sink}/carry").groupBy("part").count().collect()}
    assert carried == {0: 20, 2: 20}
    assert sum(positions.values()) * 40 + sum(carried.values()) == 600
    stats = windows.window_stats(rows, KEYS[1], "offset", 40, 1995, "part")
    whole = windows.running_half_mean(stats, ["part", *KEYS])
    assert_same(
        rows_by_key(live.merge_partitions(live.read_epoch(spark, f"{sink}/state"), KEYS[1])),
        rows_by_key(live.merge_partitions(whole, KEYS[1])),
    )
    rows.unpersist()


def test_empty_stream_has_no_windows(spark):
    rows = part_rows(spark).limit(0)
    assert windows.add_window_number(rows, "offset", 40, "part").count() == 0


def clusters(spark, files, per_batch):
    _, schema = files
    out = work_folder(spark, "clusters")
    stream = messages.replay_files(spark, f"{files[0]}/*", schema, files_per_batch=per_batch)
    cluster.start_clustering(stream, f"{out}/sink", f"{out}/checkpoint", "message_offset", 200, min_year=1995).awaitTermination()
    centers = [list(r["center"]) for r in live.read_epoch(spark, f"{out}/sink/centers").orderBy("cluster").collect()]
    rows = spark.read.parquet(f"{out}/sink/predictions").select("message_offset", "cluster").orderBy("message_offset")
    return centers, values(rows)


def test_clusters_do_not_depend_on_the_trigger(spark):
    base, rows = message_files(spark, 5)
    one, many = clusters(spark, (base, rows.schema), None), clusters(spark, (base, rows.schema), 1)
    assert one[1] == many[1]
    for a, b in zip(one[0], many[0]):
        assert a == pytest.approx(b)


def test_clustering_over_micro_batches(spark):
    base, rows = message_files(spark, 4)
    out = work_folder(spark, "clusters")
    stream = messages.replay_files(spark, f"{base}/*", rows.schema, files_per_batch=1)
    cluster.start_clustering(stream, f"{out}/sink", f"{out}/checkpoint", "message_offset", 200, min_year=1995).awaitTermination()
    predictions = spark.read.parquet(f"{out}/sink/predictions")
    numbered = windows.add_window_number(rows, "message_offset", 200)
    usable = cluster.cluster_inputs(numbered, "message_offset", 1995)
    assert predictions.count() == usable.count() and predictions.select("message_offset").distinct().count() == usable.count()
    centers = live.read_epoch(spark, f"{out}/sink/centers").orderBy("cluster").collect()
    assert len(centers) == 2 and sum(c["weight"] for c in centers) == usable.count()
    accuracy = cluster.running_accuracy(predictions, "message_offset", "label", "cluster", size=100)
    for row in accuracy.collect():
        assert row["best_accuracy"] == max(row["accuracy"], 1 - row["accuracy"])


def test_center_update_is_a_weighted_mean(spark):
    rows = [tuple([x] + [0.0] * 7) for x in (0.0, 2.0, 10.0)]
    df = spark.createDataFrame(rows, ", ".join(f"{f} double" for f in cluster.FEATURES))
    start = [[0.0] * 8, [9.0] + [0.0] * 7]
    centers, weights = cluster.update_centers(df, start, [2.0, 0.0])
    assert centers[0][0] == pytest.approx(0.5) and centers[1][0] == 10.0 and weights == [4.0, 1.0]


def test_windows_of_a_run_take_turns(spark):
    """One walk over a run gives what steps one by one give, whatever order and files the rows come in."""
    rng = random.Random(3)
    rows = [(f, w, 10 * w + i, *[rng.gauss(0, 1) for _ in cluster.FEATURES]) for f in (1, 2) for w in range(6) for i in range(10)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "part int, batch_no bigint, offset bigint, " + ", ".join(f"{f} double" for f in cluster.FEATURES))
    centers, weights = [[-0.1] * 8, [0.1] * 8], [0.0, 0.0]
    found = cluster.update_windows(df.repartition(5), ["batch_no", "part"], ["offset"], centers, weights)
    assert [(r["batch_no"], r["part"]) for r in found] == [(w, f) for w in range(6) for f in (1, 2)]
    for step in found:
        centers, weights = [list(c) for c in centers], list(weights)
        points = [r[3:] for r in rows if (r[1], r[0]) == (step["batch_no"], step["part"])]
        near = [min((0, 1), key=lambda k: sum((x - c) ** 2 for x, c in zip(p, centers[k]))) for p in points]
        for k in (0, 1):
            own = [p for p, n in zip(points, near) if n == k]
            if own:
                total = weights[k] + len(own)
                centers[k] = [(c * weights[k] + sum(x)) / total for c, x in zip(centers[k], zip(*own))]
                weights[k] = total
        assert step["weights"] == weights
        for k in (0, 1):
            assert step["centers"][k] == pytest.approx(centers[k])


def test_jobs_of_the_clustering_do_not_grow_with_the_windows(spark):
    base, rows = message_files(spark, 1)
    jobs = []
    for size in (200, 10):
        out = work_folder(spark, "clusters")
        stream = messages.replay_files(spark, f"{base}/*", rows.schema)
        query = cluster.start_clustering(stream, f"{out}/sink", f"{out}/checkpoint", "message_offset", size, min_year=1995)
        query.awaitTermination()
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(str(query.runId))))
    assert 0 < jobs[1] < jobs[0] + 20, jobs
