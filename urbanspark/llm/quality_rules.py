"""Quality rules: fixed counts, then the distance of a text's distributions from language references.

Base rules: a document fails with fewer than ``MIN_WORDS`` words, or if more than half of its words lie in
three-word windows found twice or more in it.

Method. Two histograms describe a text: characters by class, and frequent function words against all
other words. Distances are Jensen-Shannon distances (base 2) and have limits, wider for short texts, whose histograms
vary by chance.

First every document is compared with the mean of all documents that pass the base rules, letters of all kinds as one
class: this holds for any language and script and drops what is no prose at all. Then come the references of the
languages, the mean histograms of the documents that passed so far, computed twice: the second time without documents
far from the first references, so junk leaves no mark on them. A document is compared with its own language and with the
``MAX_LANGUAGES`` largest and takes the nearest. The fewer documents a reference comes from, the wider are the limits,
without a step: verdicts do not turn at some number of documents of a language.

Defined results: a null text has no words and fails; a null language gives no reference but the document
is compared with the largest; a language with one document, in all or near the first references, has no reference, as
that would be the document itself, and its documents are compared with the mean of all documents only; repeated rows are
judged each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanspark.llm.text_stats import CLASSES, WORD_LIST, class_counts, common_word_counts, text_counts
from urbanspark.llm.words import slices
from urbanspark.operators.tables import broadcast_within, materialize

MIN_WORDS = 50
REPEAT_PERCENT = 50
# Limits of the distances: constant part, and what a text of n words gets on top divided by n.
CLASS_LIMIT = (0.16, 6.0)
WORD_LIMIT = (0.45, 6.0)
# Second references come from documents nearer than this to the first ones.
TRIM = 0.15
# Limit of the distance from all documents: beyond the 0.56 between the mean of two unlike halves and each of them, so what
# most documents are like is never dropped. And what a reference of n documents adds to the limits above, divided by n.
GENERAL_LIMIT = (0.6, 6.0)
FEW_DOCUMENTS = 0.9
# References that go to every task, about 1 kB each, for documents whose language is missing or wrong. Each document
# gets the reference of its own language by a join, whatever its size.
MAX_LANGUAGES = 1000

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
N_CLASSES, N_WORDS = len(CLASSES), len(WORD_LIST) + 1
LETTERS = [CLASSES.index(name) for name in ("lower", "upper", "letter")]


def _lists(values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.arange(0, values.size + 1, values.shape[1], dtype=np.int32), values.ravel().astype(np.int32))


def histogram_table(docs: DataFrame) -> DataFrame:
    """Base counts and both histograms of every row, written once: the only pass over the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text")):
                counts, own = text_counts(part), batch.slice(part.low, part.high - part.low)
                yield pa.RecordBatch.from_arrays(
                    [own.column("doc_id"), own.column("lang"), *(pa.array(counts[name].astype(np.int64)) for name in BASE)]
                    + [_lists(class_counts(part)), _lists(common_word_counts(part))],
                    names=["doc_id", "lang", *BASE, "classes", "words"],
                )

    schema = "doc_id bigint, lang string, " + ", ".join(f"{name} bigint" for name in BASE) + ", classes array<int>, words array<int>"
    table = materialize(docs.select("doc_id", "lang", "text").mapInArrow(run, schema), "histograms")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return table.withColumn("base_failed", failed)


def _shares(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for name, width in (("classes", N_CLASSES), ("words", N_WORDS)):
        counts = batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        out.append(counts / np.maximum(counts.sum(1, keepdims=True), 1))
    return out[0], out[1]


def jensen_shannon(rows: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Distance of each row from the reference, between 0 and 1."""
    middle = (rows + reference) / 2

    def divergence(p: np.ndarray) -> np.ndarray:
        return np.where(p > 0, p * np.log2(np.where(p > 0, p, 1) / np.where(middle > 0, middle, 1)), 0).sum(1)

    return np.sqrt(np.maximum(divergence(rows) + divergence(np.broadcast_to(reference, rows.shape)), 0) / 2)


def _any_script(classes: np.ndarray) -> np.ndarray:
    """Shares of the classes with all letters as one class."""
    return np.column_stack([classes[:, LETTERS].sum(1), np.delete(classes, LETTERS, axis=1)])


def general_reference(table: DataFrame) -> np.ndarray:
    """Mean shares of the classes, letters as one, over all documents that pass the base rules."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = np.rint(_any_script(_shares(batch)[0]) * 1e6).astype(np.int64).sum(0)
            yield pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32()), pa.array(sums)], names=["place", "value"])

    parts = table.filter("NOT base_failed").select("classes", "words").mapInArrow(run, "place int, value bigint")
    found = parts.groupBy("place").agg(F.sum("value").alias("value")).orderBy("place").collect()  # a row per class
    sums = np.array([row["value"] for row in found] or [0] * (N_CLASSES - len(LETTERS) + 1), dtype=float)
    return sums / max(sums.sum(), 1.0)


def ordinary(classes: np.ndarray, n_words: np.ndarray, general: np.ndarray) -> np.ndarray:
    """Which rows lie within the limit around the mean of all documents."""
    return jensen_shannon(_any_script(classes), general) <= GENERAL_LIMIT[0] + GENERAL_LIMIT[1] / np.maximum(n_words, 1)


References = list[tuple[np.ndarray, np.ndarray]]


def _own_references(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have a reference of their own language, and these references."""
    column = batch.column("reference")
    known = column.is_valid().to_numpy(zero_copy_only=False)
    return known, column.flatten().to_numpy(zero_copy_only=False).reshape(-1, N_CLASSES + N_WORDS)


def nearest(classes: np.ndarray, words: np.ndarray, known: np.ndarray, own: np.ndarray, largest: References) -> tuple[np.ndarray, np.ndarray]:
    """Distances of both histograms from the language with the smallest sum of both."""
    best = np.full((2, len(classes)), np.inf)
    if known.any():
        best[:, known] = [jensen_shannon(classes[known], own[:, :N_CLASSES]), jensen_shannon(words[known], own[:, N_CLASSES:])]
    for class_reference, word_reference in largest:
        found = np.stack([jensen_shannon(classes, class_reference), jensen_shannon(words, word_reference)])
        best = np.where(found.sum(0) < best.sum(0), found, best)
    return best[0], best[1]


def largest_references(references: DataFrame) -> References:
    chosen = references.orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES).select("reference").collect()
    rows = [np.array(row["reference"]) for row in chosen]
    return [(row[:N_CLASSES], row[N_CLASSES:]) for row in rows]


def with_references(table: DataFrame, references: DataFrame) -> DataFrame:
    """Every row of ``table`` with the reference of its language, or null."""
    width = 8 * (N_CLASSES + N_WORDS)
    named = references.select("lang", F.col("n").alias("n_reference"), "reference")
    small = broadcast_within(named, references.count() * width // 64)
    return table.join(small, "lang", "left")


def language_references(table: DataFrame, general: np.ndarray, first: DataFrame | None = None) -> DataFrame:
    """lang, n and reference (mean histograms) of the languages; with ``first``, over documents near one of those references.

    Documents far from the ``general`` reference are left out.

    Tasks add up whole millionths, so the sums are the same in any order.
    """
    usable = table.filter("NOT base_failed AND lang IS NOT NULL").select("lang", "n_words", "classes", "words")
    largest = largest_references(first) if first else []
    if first:
        usable = with_references(usable, first)
    trim = first is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes, words = _shares(batch)
            rows = np.rint(np.concatenate([classes, words], axis=1) * 1e6).astype(np.int64)
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            near = ordinary(classes, batch.column("n_words").to_numpy(), general)
            if trim:
                known, own = _own_references(batch)
                near &= known & (nearest(classes, words, known, own, largest)[0] < TRIM)
            rows, langs = rows[near], langs[near]
            names = sorted(set(langs))
            sums = [[int((langs == name).sum()), *rows[langs == name].sum(0).tolist()] for name in names]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sums, pa.list_(pa.int64()))], names=["lang", "sums"])

    parts = usable.mapInArrow(run, "lang string, sums array<bigint>")
    places = parts.select("lang", F.posexplode("sums").alias("place", "value")).groupBy("lang", "place").agg(F.sum("value").alias("value"))
    by_lang = places.groupBy("lang").agg(
        F.max(F.when(F.col("place") == 0, F.col("value"))).alias("n"),
        F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda pair: pair["value"]).alias("sums"),
    )

    def mean(start: int, size: int):
        own = F.slice("sums", start, size)
        total = F.greatest(F.aggregate(own, F.lit(0).cast("bigint"), lambda a, b: a + b), F.lit(1))
        return F.transform(own, lambda value: value / total)

    reference = F.concat(mean(2, N_CLASSES), mean(2 + N_CLASSES, N_WORDS)).alias("reference")
    return materialize(by_lang.filter("n > 1").select("lang", "n", reference), "references")


def judge_documents(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, and both distances (null without a reference) of every row."""
    table = histogram_table(docs)
    general = general_reference(table)
    references = language_references(table, general, language_references(table, general))
    largest = largest_references(references)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            failed = batch.column("base_failed").to_numpy(zero_copy_only=False).astype(bool)
            n_words = np.maximum(batch.column("n_words").to_numpy(), 1)
            own_known, own = _own_references(batch)
            shares = _shares(batch)
            class_distance, word_distance = nearest(*shares, own_known, own, largest)
            no_lang = batch.column("lang").is_null().to_numpy(zero_copy_only=False)
            known = np.isfinite(class_distance) & (own_known | no_lang)
            n_reference = batch.column("n_reference").cast(pa.float64()).fill_null(np.inf).to_numpy(zero_copy_only=False)
            few = FEW_DOCUMENTS / n_reference
            far = class_distance > CLASS_LIMIT[0] + CLASS_LIMIT[1] / n_words + few
            far |= word_distance > WORD_LIMIT[0] + WORD_LIMIT[1] / n_words + few
            kept = ~failed & ~(far & known) & ordinary(shares[0], n_words, general)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(batch.column(name) for name in BASE), batch.column("base_failed"), pa.array(kept)]
                + [pa.array(d, mask=~known) for d in (class_distance, word_distance)],
                names=["doc_id", *BASE, "base_failed", "kept", "class_distance", "word_distance"],
            )

    schema = (
        "doc_id bigint, "
        + ", ".join(f"{name} bigint" for name in BASE)
        + ", base_failed boolean, kept boolean, class_distance double, word_distance double"
    )
    return with_references(table, references).mapInArrow(run, schema)
