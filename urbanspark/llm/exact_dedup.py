"""Exact copies of texts: frequent digests are removed on the map side, the rest by one shuffle.

Texts are equal when they are identical after every run of ASCII white space became one space; a
null text is an empty text. Of equal texts the row with the smallest ``doc_id`` stays; a row
without an id comes after all others, and of repeated rows (same id, same text) one stays. An empty
table gives an empty result. Columns other than ``doc_id`` and ``text`` are never looked at.

Method. Frequent digests are searched by a Misra-Gries sketch (Spark's ``approx_top_k``, a
mergeable form of it), merged in a tree of bounded fan-in. What the sketch names is only a
candidate: one exact aggregation over all rows verifies it. The verified winners, at most
``MAX_WINNERS`` rows whatever the data, are broadcast, and every row with such a digest is decided
in its map task. All other digests are shuffled. A digest the sketch misses goes the second way,
so the result never depends on the sketch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanspark.llm.names import free_prefix
from urbanspark.operators.tables import materialize

SPACES = r"[\x20\x09-\x0D]+"
# Digests the sketch names at most: about 100 bytes each, so the broadcast stays below 1 MB.
MAX_WINNERS = 2048
# Counters of a sketch. A digest on more than about 0.1 % of all rows cannot be missed.
COUNTERS = 4096
# Sketches are merged in groups: task -> 4096 -> 64 -> 1.
FAN_IN = (4096, 64, 1)


def text_digest(text: Column) -> Column:
    """SHA-256 of the normalised text in UTF-8, lower-case hex."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " "), 256)


def _order(row: Column) -> Column:
    return F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("doc_id"), row.alias("row"))


def frequent_digests(digests: DataFrame) -> DataFrame:
    """Candidates for frequent values of ``text_sha256``: at most MAX_WINNERS rows."""
    sketches = digests.groupBy((F.spark_partition_id() % FAN_IN[0]).alias("part")).agg(
        F.expr(f"approx_top_k_accumulate(text_sha256, {COUNTERS})").alias("sketch")
    )
    for groups in FAN_IN[1:]:
        sketches = sketches.groupBy((F.col("part") % groups).alias("part")).agg(
            F.expr(f"approx_top_k_combine(sketch, {COUNTERS})").alias("sketch")
        )
    # The last level is grouped too: tasks without rows then add no empty sketch, which Spark cannot merge.
    top = sketches.select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {MAX_WINNERS})")).alias("top"))
    return top.filter("top.count > 1").select(F.col("top.item").alias("text_sha256"))


def heavy_groups(digests: DataFrame) -> DataFrame:
    """Verified winners: text_sha256, the first row ``best`` and the exact ``n`` of groups of two or more."""
    candidates = F.broadcast(frequent_digests(digests))
    counted = digests.join(candidates, "text_sha256").groupBy("text_sha256")
    return counted.agg(F.min("place").alias("best"), F.count("*").alias("n")).filter("n > 1")


def digest_table(docs: DataFrame) -> DataFrame:
    """text_sha256 and ``place`` (id, then row number) of every row, written once."""
    thin = docs.select("doc_id", text_digest(F.col("text")).alias("text_sha256"), F.monotonically_increasing_id().alias("row"))
    return materialize(thin.select("text_sha256", _order(F.col("row")).alias("place")), "digests")


def exact_copies(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    digests = digest_table(docs)
    marked = digests.join(F.broadcast(heavy_groups(digests)), "text_sha256", "left")
    group = Window.partitionBy("text_sha256")
    light = marked.filter("n IS NULL").withColumns({"best": F.min("place").over(group), "n": F.count("*").over(group)})
    return (
        marked.filter("n IS NOT NULL")
        .unionByName(light)
        .select(
            F.col("place.doc_id").alias("doc_id"),
            F.col("best.doc_id").alias("keep_id"),
            F.col("n").alias("group_size"),
            (F.col("place") == F.col("best")).alias("kept"),
            "text_sha256",
        )
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Copies of frequent texts go in the map task; what is left is shuffled once by digest, and the
    group limit below the shuffle sends one row per digest and task.
    """
    own = free_prefix(docs)
    digest, last, keep, rank = (own + name for name in ("digest", "last", "keep", "rank"))
    heavy = heavy_groups(digest_table(docs)).select(
        F.col("text_sha256").alias(digest), F.col("best.last").alias(last), F.col("best.doc_id").alias(keep)
    )
    tagged = docs.withColumn(digest, text_digest(F.col("text")))
    known = tagged.join(F.broadcast(heavy), digest, "left")
    left = known.filter(F.col(last).isNull() | F.col(last) | (F.col("doc_id") == F.col(keep)))
    first = Window.partitionBy(digest).orderBy(F.col("doc_id").asc_nulls_last())
    return left.withColumn(rank, F.row_number().over(first)).filter(F.col(rank) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])
