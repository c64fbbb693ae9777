"""Online two-means clustering of a ticket stream, and its running accuracy."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from urbanspark.functions import clean
from urbanspark.operators.encode import encode_labels, label_dictionary, scale_per_group
from urbanspark.operators.ranks import global_row_number
from urbanspark.operators.tables import broadcast_within
from urbanspark.streaming.live import ONE_PARTITION, read_epoch, read_windows, write_epoch
from urbanspark.streaming.windows import usable_year

NUMERIC = ["vehicle_year", "feet_from_curb"]
CATEGORICAL = ["plate_type", "violation_code", "vehicle_body_type", "vehicle_make", "issuing_agency", "violation_county"]
FEATURES = NUMERIC + CATEGORICAL
# Messages whose windows are walked in one job: enough that starting the job costs little beside it.
RUN_ROWS = 200_000


def cluster_inputs(messages: DataFrame, offset: str, min_year: int = 2012, partition: str | None = None) -> DataFrame:
    """Complete, usable messages: partition, offset, batch_no, features and the label (1 = home state)."""
    complete = messages.dropna(subset=[*FEATURES, "registration_state"]).filter(usable_year(min_year))
    return complete.select(
        *([partition] if partition else []),
        offset,
        "batch_no",
        *[clean.to_number(c).alias(c) for c in NUMERIC],
        *[F.col(c) for c in CATEGORICAL if c != "violation_county"],
        clean.county_pass_through("violation_county").alias("violation_county"),
        (F.col("registration_state") == "NY").cast("int").alias("label"),
    )


def initial_centers(window: DataFrame, order: list[str], k: int, seed: int) -> list[list[float]]:
    """Centers to start from: one pass of k-means over one window, in ``order``, so that reruns agree."""
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(window.dropna(subset=FEATURES))
    one_task = vectors.coalesce(1).sortWithinPartitions(*order)
    return [list(map(float, c)) for c in KMeans(k=k, seed=seed, maxIter=1).fit(one_task).clusterCenters()]


def move_centers(points: np.ndarray, centers: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One mini-batch step: each center moves to the weighted mean of itself and its new points.

    A point belongs to the nearest center by squared distance; ties go to the lower number.
    """
    distances = np.zeros((len(centers), len(points)))
    for k, center in enumerate(centers):
        for j, c in enumerate(center):
            distances[k] += (points[:, j] - c) * (points[:, j] - c)
    least = np.fmin.reduce(distances)
    cluster = ((distances == least) | (np.isnan(distances) & np.isnan(least))).argmax(axis=0)
    centers, weights = centers.copy(), weights.copy()
    for k in range(len(centers)):
        own = points[cluster == k]
        if len(own):
            total = weights[k] + len(own)
            centers[k] = (centers[k] * weights[k] + own.sum(axis=0)) / total
            weights[k] = total
    return centers, weights


def update_windows(
    run: DataFrame, window: list[str], order: list[str], centers: list[list[float]], weights: list[float]
) -> list[Row]:
    """Mini-batch steps over the windows of a run, in turn: per window its keys, and centers and weights after its step.

    Each step needs the centers of the one before, so one task walks the run; it holds one window at a time.
    Only k centers per window return to the driver.
    """
    start = np.array(centers, np.float64), np.array(weights, np.float64)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[pa.Array], np.ndarray]]:
        for batch in batches:
            points = np.column_stack([batch[f].to_numpy(zero_copy_only=False) for f in FEATURES])
            names = list(zip(*[batch[c].to_pylist() for c in window]))
            cuts = [0, *[i for i in range(1, len(names)) if names[i] != names[i - 1]], len(names)]
            for low, high in zip(cuts, cuts[1:]):
                if high > low:
                    yield names[low], [batch[c].slice(low, 1) for c in window], points[low:high]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = start
        for _, parts in groupby(pieces(batches), key=itemgetter(0)):
            _, names, points = zip(*parts)
            at = move_centers(np.concatenate(points), *at)
            yield pa.RecordBatch.from_arrays([*names[0], pa.array([at[0].tolist()]), pa.array([at[1].tolist()])], [*window, "centers", "weights"])

    one_task = run.select(*window, *order, *FEATURES).coalesce(1).sortWithinPartitions(*window, *order)
    types = ", ".join(f"`{c}` {one_task.schema[c].dataType.simpleString()}" for c in window)
    return one_task.mapInArrow(walk, f"{types}, centers array<array<double>>, weights array<double>").collect()


def update_centers(
    scaled: DataFrame, centers: list[list[float]], weights: list[float]
) -> tuple[list[list[float]], list[float]]:
    """One mini-batch step with the rows of one window."""
    steps = update_windows(scaled.withColumn("batch_no", F.lit(0).cast("bigint")), ["batch_no"], [], centers, weights)
    return (steps[-1]["centers"], steps[-1]["weights"]) if steps else (centers, weights)


def nearest_known(k: int) -> Column:
    """Number of the nearest center by squared distance, of those in the array column ``centers``; ties go to the lower number."""
    distances = [
        sum(((F.col(f) - F.col("centers")[i][j]) * (F.col(f) - F.col("centers")[i][j]) for j, f in enumerate(FEATURES)), F.lit(0.0))
        for i in range(k)
    ]
    least = F.least(*distances) if k > 1 else distances[0]
    choice = F
    for number, distance in enumerate(distances):
        choice = choice.when(distance == least, F.lit(number))
    return choice


def cluster_batch(
    sink: str, offset: str, size: int, k: int = 2, seed: int = 0, min_year: int = 2012, partition: str | None = None
) -> Callable[[DataFrame, int], None]:
    """Micro-batch step: encode and scale per window; each complete window updates the centers in turn.

    The label dictionary comes from the first window of the stream and never changes. A window is predicted
    with the centers as they are after its own update, so later windows do not reach back, and the
    stream's trigger does not matter. The windows of several partitions take turns by number. Updating
    is one job per run of consecutive windows, over files of their own; scaling and prediction are one job for all.
    """
    key = partition or ONE_PARTITION
    window = [key, "batch_no"]

    def step(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        numbered = read_windows(batch, epoch, sink, offset, size, partition)
        inputs = cluster_inputs(numbered.filter("whole"), offset, min_year, key)
        dictionary = read_epoch(spark, f"{sink}/dictionary", epoch)
        if dictionary is None:
            first = inputs.agg(F.min(F.struct("batch_no", key))).first()[0]
            if first is None:
                numbered.unpersist()
                return
            opening = inputs.filter((F.col("batch_no") == first["batch_no"]) & (F.col(key) == first[key]))
            write_epoch(label_dictionary(opening, CATEGORICAL), f"{sink}/dictionary", epoch)
            dictionary = read_epoch(spark, f"{sink}/dictionary")
        # Runs of whole windows, about ``RUN_ROWS`` messages each, so that each update job reads its own files only.
        sources = max(1, numbered.select(key).distinct().count())
        run = F.expr(f"batch_no div {max(1, RUN_ROWS // (size * sources))}")
        coded = encode_labels(inputs, dictionary, CATEGORICAL).withColumn("__run", run).repartition("__run")
        scaled = scale_per_group(coded, ["__run", *window], FEATURES).na.fill(0.0, FEATURES)
        scaled.write.mode("overwrite").partitionBy("__run").parquet(f"{sink}/windows/epoch={epoch}")
        numbered.unpersist()
        schema = scaled.schema
        scaled = spark.read.schema(schema).parquet(f"{sink}/windows/epoch={epoch}")

        model = read_epoch(spark, f"{sink}/centers", epoch)
        centers, weights = None, [0.0] * k
        if model is not None:
            known = sorted(model.collect(), key=lambda r: r["cluster"])  # k rows
            centers, weights = [list(r["center"]) for r in known], [r["weight"] for r in known]
        steps = []
        for at in scaled.select("__run").distinct().orderBy("__run").toLocalIterator():
            one = scaled.filter((F.col("__run") == at["__run"]) & F.col(key).isNotNull())
            if centers is None:
                first = one.agg(F.min(F.struct("batch_no", key))).first()[0]
                if first is None:
                    continue
                opening = one.filter((F.col("batch_no") == first["batch_no"]) & (F.col(key) == first[key]))
                centers = initial_centers(opening, [offset], k, seed)
            found = update_windows(one, ["batch_no", key], [offset], centers, weights)
            if found:
                centers, weights = found[-1]["centers"], found[-1]["weights"]
            steps += [(r[key], r["batch_no"], r["centers"]) for r in found]
        if centers is None:
            return
        centers_of = spark.createDataFrame(steps, f"`{key}` {schema[key].dataType.simpleString()}, batch_no bigint, centers array<array<double>>")
        write_epoch(
            spark.createDataFrame(
                [(i, centers[i], float(weights[i])) for i in range(k)], "cluster int, center array<double>, weight double"
            ),
            f"{sink}/centers",
            epoch,
        )
        known = [partition] if partition else []
        predicted = scaled.join(broadcast_within(centers_of, len(steps)), window).select(
            *known, offset, "batch_no", "label", nearest_known(k).alias("cluster")
        )
        write_epoch(predicted, f"{sink}/predictions", epoch)

    return step


def start_clustering(messages: DataFrame, sink: str, checkpoint: str, offset: str, size: int = 10_000, **settings) -> StreamingQuery:
    return (
        messages.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(cluster_batch(sink, offset, size, **settings))
        .start()
    )


def running_accuracy(
    predictions: DataFrame, offset: str, label: str, prediction: str, size: int = 10_000, keep: int = 100
) -> DataFrame:
    """Accuracy of every ``size`` usable rows in message order; the latest ``keep`` values.

    A cluster number is compared with the label as it is; ``best_accuracy`` is the value after the
    better of the two matchings. Chunks run across windows, so rows are numbered globally from counts
    per window (``batch_no``). An incomplete last chunk gives no value.
    """
    block = F.expr("batch_no div 1000")
    numbered = global_row_number(predictions, "batch_no", block, [offset])
    hit = F.when(F.col(label) == F.col(prediction), 1.0).otherwise(0.0)
    chunks = (
        numbered.groupBy(F.expr(f"row_no div {size}").alias("chunk_no"))
        .agg(F.avg(hit).alias("accuracy"), F.count("*").alias("n"))
        .filter(F.col("n") == size)
    )
    return (
        chunks.select("chunk_no", "accuracy", F.greatest("accuracy", 1 - F.col("accuracy")).alias("best_accuracy"))
        .orderBy(F.desc("chunk_no"))
        .limit(keep)
    )
