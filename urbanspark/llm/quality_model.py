"""Quality classifier by positive-unlabelled learning.

Trusted positives are documents labelled 1; all documents outside the held-out fold are the
unlabelled text; the share of good documents (the class prior) is estimated from the labelled rows
and taken a little lower. A linear model with logistic loss minimises the unbiased risk

    prior * E_positive[loss(-g)] + E_unlabelled[loss(g)] - prior * E_positive[loss(g)],

whose first and last term join into a linear one, so Newton steps find the optimum. The part that
estimates the risk on bad documents must not become negative: a step that would make it so is halved
until it is not, and training ends where no step is left. Labels outside the positives enter nothing but the prior.

Every step is one aggregation over all training rows of a thin feature table; nothing is sampled.
Features are counts of the whole text (``text_stats``); label, language, source and id are not among them.

Defined results: null and empty texts are scored like any text; a document without id is never held
out and has no label; contradictory labels of a document count as not trusted; without a trusted
positive all scores are 0.5; an empty table gives no rows; repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanspark.llm.text_stats import CLASSES, class_counts, common_word_counts, text_counts
from urbanspark.llm.words import Slice, slices
from urbanspark.operators.tables import materialize

FOLDS = 5
ACCEPT = 0.3
PRIOR_MARGIN = 0.03
RIDGE = 0.01
STEPS = 8
CLIP = 8.0


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def features(part: Slice) -> np.ndarray:
    """Texts x features."""
    counts, classes, common = text_counts(part), class_counts(part), common_word_counts(part)
    share = classes / np.maximum(classes.sum(1, keepdims=True), 1)
    words = np.maximum(counts["n_words"], 1)
    lines = np.maximum(counts["n_lines"], 1)
    size = np.log1p(counts["n_words"])
    again, repeated = counts["n_same_as_last"] / words, counts["n_repeat_words"] / words

    def of(name: str) -> np.ndarray:
        return share[:, CLASSES.index(name)]

    columns = [share[:, i] for i in range(1, len(CLASSES))]
    columns += [
        counts["n_symbols"] / np.maximum(counts["word_chars"], 1),
        counts["n_dup_lines"] / lines,
        repeated,
        counts["n_distinct_words"] / words,
        again,
        np.minimum(counts["word_chars"] / words, 20) / 10,
        size,
        size**2 / 10,
        1 - common[:, -1] / np.maximum(common.sum(1), 1),
        np.log1p(counts["n_words"] / lines),
        np.minimum(of("upper") / 0.05, 1),
        np.minimum(of("symbol") / 0.02, 1),
        np.minimum(of("stop") / 0.06, 1),
        np.minimum(of("other") / 0.01, 1),
        np.minimum(again / 0.1, 1),
        np.minimum(repeated / 0.3, 1),
    ]
    return np.stack(columns, axis=1)


N_FEATURES = len(CLASSES) - 1 + 16


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def inputs(self, rows: np.ndarray) -> np.ndarray:
        return _standard(rows, self.mean, self.scale)

    def score(self, rows: np.ndarray) -> np.ndarray:
        return np.round(1 / (1 + np.exp(-(self.inputs(rows) @ self.weights))), 6)


def _standard(rows: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.concatenate([np.clip((rows - mean) / scale, -CLIP, CLIP), np.ones((len(rows), 1))], axis=1)


def feature_table(docs: DataFrame) -> DataFrame:
    """doc_id, held_out and features of every row, written once: the only pass over the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text")):
                found = features(part)
                lists = pa.ListArray.from_arrays(np.arange(0, found.size + 1, N_FEATURES, dtype=np.int32), found.ravel())
                own = batch.slice(part.low, part.high - part.low)
                yield pa.RecordBatch.from_arrays(
                    [own.column("doc_id"), own.column("held_out"), lists], names=["doc_id", "held_out", "features"]
                )

    asked = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return materialize(asked.mapInArrow(run, "doc_id bigint, held_out boolean, features array<double>"), "quality-features")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES)


def _sums(rows: DataFrame, part_sums, size: int) -> np.ndarray:
    """Sum over all rows of a vector of ``size`` numbers: one vector per task, then one sum per place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += part_sums(_matrix(batch), batch.column("positive").to_numpy(zero_copy_only=False).astype(bool))
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["sums"])

    parts = rows.select("features", "positive").mapInArrow(run, "sums array<double>")
    places = parts.select(F.posexplode("sums").alias("place", "value")).groupBy("place").agg(F.sum("value").alias("value"))
    out = np.zeros(size)
    for place, value in places.collect():  # as many rows as the vector has places
        out[place] = value
    return out


def train(table: DataFrame, labels: DataFrame) -> QualityModel:
    """Fit on the rows of ``table`` outside the held-out fold; ``labels`` has doc_id and quality."""
    trusted = labels.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
    share, n_labels = trusted.agg(F.avg(F.col("low").cast("double")), F.count("low")).first()
    positives = trusted.filter("low = 1 AND high = 1").select(F.col("doc_id").alias("__doc_id"))
    used = table.filter("NOT held_out")
    rows = used.join(positives, F.col("doc_id") == F.col("__doc_id"), "left").select("features", F.col("__doc_id").isNotNull().alias("positive"))
    rows = materialize(rows, "quality-training")

    moments = _sums(rows, lambda x, p: np.concatenate([[len(x), p.sum()], x.sum(0), (x * x).sum(0)]), 2 + 2 * N_FEATURES)
    n, n_positive = moments[:2]
    if not n_positive:
        return QualityModel(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES + 1))
    mean = moments[2 : 2 + N_FEATURES] / n
    scale = np.sqrt(np.maximum(moments[2 + N_FEATURES :] / n - mean**2, 0)) + 1e-9
    prior, k = share * (1 - PRIOR_MARGIN), N_FEATURES + 1

    def risk_sums(weights: np.ndarray):
        def part(x: np.ndarray, positive: np.ndarray) -> np.ndarray:
            z = _standard(x, mean, scale)
            g = z @ weights
            s = 1 / (1 + np.exp(-g))
            loss = np.logaddexp(0, g)
            curve = (z * (s * (1 - s))[:, None]).T @ z
            return np.concatenate([[loss.sum(), loss[positive].sum()], s @ z, z[positive].sum(0), curve.ravel()])

        return part

    def measure(weights: np.ndarray):
        sums = _sums(rows, risk_sums(weights), 2 + 2 * k + k * k)
        negative_risk = sums[0] / n - prior * sums[1] / n_positive
        gradient = sums[2 : 2 + k] / n - prior * sums[2 + k : 2 + 2 * k] / n_positive + RIDGE * weights
        return negative_risk, gradient, sums[2 + 2 * k :].reshape(k, k) / n + RIDGE * np.eye(k)

    weights = np.zeros(k)
    _, gradient, curve = measure(weights)
    for _ in range(STEPS):
        step = np.linalg.solve(curve, gradient)
        step *= min(1, 3 / max(np.abs(step).max(), 1e-12))
        for _ in range(4):
            negative_risk, new_gradient, new_curve = measure(weights - step)
            if negative_risk >= 0:
                break
            step /= 2
        else:
            break
        weights, gradient, curve = weights - step, new_gradient, new_curve
        if np.abs(gradient).max() < 1e-4:
            break
    return QualityModel(mean, scale, weights)


def score_table(table: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of a feature table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(_matrix(batch)) if batch.num_rows else np.empty(0)
            predicted = (score >= ACCEPT).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array(predicted)],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return table.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on ``docs`` and ``labels``, then score every row of ``docs``."""
    table = feature_table(docs)
    return score_table(table, train(table, labels))


def accepted_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, all columns, judged where they are read."""
    model = train(feature_table(docs), labels)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(at)):
                keep = model.score(features(part)) >= ACCEPT
                yield batch.slice(part.low, part.high - part.low).filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
