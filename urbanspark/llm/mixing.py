"""Mixing sources to target weights by pivotal dependent rounding.

The mix takes ``share`` times all words. Sources share it by weight; a source gives at most
``max_copies`` times its own words, and what it cannot give is shared again among the others. Every
document of a source then has the same fractional number of copies.

Method. The whole copies are certain; the fraction is a probability. Documents are paired in falling
order of size: words move at random from one of the pair to the other until one of the two fractions is 0
or 1, with odds that keep every document's expectation. The sum of words is kept exactly, so each
source ends within one document of its target; small documents come last and take up what large ones
left over, so that document is rarely a large one. A reduction tree makes this parallel: bounded
buckets of a source leave one undecided document each, those meet in the next level, and so on;
the last one of a source is drawn.

Draws and buckets hash the document's id, its size, the seed and a number among the rows with this source,
id and size, so reruns agree on any cluster and a row repeated many times, or rows without ids, spread over
all buckets. Documents stream through a bucket one at a time.

Defined results: a null text has size 0 and takes 0; null sources are one source, the last; a
repeated row is a document of its own, as is each row without an id; an empty table gives no rows. Only
doc_id, text and source are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from urbanspark.llm.names import free_prefix
from urbanspark.operators.tables import broadcast_within, materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_COPIES = 2.0
# Documents per bucket on average, and undecided documents per bucket of the next level.
BUCKET_ROWS = 1024
FAN_IN = 64
DECIDED = 1e-9
# Equal rows that one task numbers at once.
NUMBERED_ROWS = 4096


def document_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source and the number of words of every row, written once."""
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("bigint")
    return materialize(docs.select("doc_id", "source", size.alias("size")), "mix-sizes")


def numbered_rows(sizes: DataFrame) -> DataFrame:
    """source, doc_id, size and a ``number`` from 0 among the rows that share them.

    Equal rows are counted, with partial counts in each task, and numbered from the count. Counts above
    NUMBERED_ROWS are dealt out in pieces, so no task writes all rows of one of them.
    """
    key = ["source", "doc_id", "size"]
    counted = materialize(sizes.groupBy(*key).agg(F.count("*").alias("rows")), "mix-counts")
    few = counted.filter(F.col("rows") <= NUMBERED_ROWS).withColumn("number", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("rows") - 1)))
    many = counted.filter(F.col("rows") > NUMBERED_ROWS)
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("rows") - 1, F.lit(NUMBERED_ROWS).cast("bigint"))
    pieces = many.withColumn("start", F.explode(starts)).repartition(*key, "start")
    last = F.least(F.col("start") + NUMBERED_ROWS, F.col("rows")) - 1
    pieces = pieces.withColumn("number", F.explode(F.sequence("start", last)))
    return few.select(*key, "number").unionByName(pieces.select(*key, "number"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_copies: float = MAX_COPIES) -> DataFrame:
    """One row per source: source, source_no, source_size, n_docs, target.

    Resharing the excess by weight until no source is above its limit is the same as filling all sources to one
    level times weight, each up to its limit. With sources in the order in which they reach their limits, each
    prefix taken as full gives a lower bound of that level, and the right prefix attains it. The windows
    without a key sort one row per source, not documents.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    listed = by_source.withColumn("source_no", number).withColumn("weight", F.get(cycle, F.col("source_no") % len(weights)))
    limit = F.col("source_size") * F.lit(max_copies)
    full_order = Window.orderBy(limit / F.col("weight"), "source_no")
    everything = Window.partitionBy()
    budget = F.sum("source_size").over(everything) * F.lit(share)
    before = F.coalesce(F.sum(limit).over(full_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    weight_left = F.sum("weight").over(full_order.rowsBetween(0, Window.unboundedFollowing))
    levels = listed.withColumn("level", (budget - before) / weight_left)
    target = F.least(limit, F.max("level").over(everything) * F.col("weight"))
    return materialize(levels.select("source", "source_no", "source_size", "n_docs", target.alias("target")), "mix-targets")


def _pivot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream of documents ordered by (source_no, bucket): at most one per bucket stays undecided."""
    key, pending = None, None
    for batch in batches:
        rows = []
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            doc_id, source_no, size, base, fraction, draw, bucket = row
            if key != (source_no, bucket):
                if pending is not None:
                    rows.append(tuple(pending))
                key, pending = (source_no, bucket), None
            if size == 0:
                fraction = 0.0
            if fraction < DECIDED or fraction > 1 - DECIDED:
                rows.append((doc_id, source_no, size, base, float(round(fraction)), draw, bucket))
                continue
            if pending is None:
                pending = [doc_id, source_no, size, base, fraction, draw, bucket]
                continue
            other, p = pending[2], pending[4]
            give = min((1 - p) * other, fraction * size)
            take = min(p * other, (1 - fraction) * size)
            if draw * (give + take) < take:
                p, fraction = p + give / other, fraction - give / size
            else:
                p, fraction = p - take / other, fraction + take / size
            if p < DECIDED or p > 1 - DECIDED:
                pending[4] = float(round(p))
                rows.append(tuple(pending))
                pending = [doc_id, source_no, size, base, fraction, draw, bucket]
                if fraction < DECIDED or fraction > 1 - DECIDED:
                    pending[4] = float(round(fraction))
                    rows.append(tuple(pending))
                    pending = None
            else:
                pending[4] = p
                rows.append((doc_id, source_no, size, base, float(round(fraction)), draw, bucket))
        if rows:
            yield _batch(rows)
    if pending is not None:
        yield _batch([tuple(pending)])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in zip(zip(*rows), TYPES)], names=COLUMNS)


COLUMNS = ["doc_id", "source_no", "size", "base", "fraction", "draw", "bucket"]
TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64()]
SCHEMA = "doc_id bigint, source_no int, size bigint, base bigint, fraction double, draw double, bucket bigint"


def _level(rows: DataFrame, name: str) -> DataFrame:
    dealt = rows.select(*COLUMNS).repartition("source_no", "bucket")
    ordered = dealt.sortWithinPartitions("source_no", "bucket", F.desc("size"), "draw", "doc_id")
    return materialize(ordered.mapInArrow(_pivot, SCHEMA), name)


def mix_documents(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, max_copies: float = MAX_COPIES, seed: int = 7) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken."""
    sizes = document_sizes(docs)
    targets = source_targets(sizes, weights, share, max_copies)
    n_sources, most = targets.agg(F.count("*"), F.max("n_docs")).first()
    sides = broadcast_within(targets.withColumnRenamed("source", "own_source"), n_sources)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    buckets = F.ceil(F.col("n_docs") / BUCKET_ROWS)
    draw = (F.xxhash64(F.lit(seed), "doc_id", "size", "number").bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))).alias("draw")
    known = numbered_rows(sizes).join(sides, F.col("source").eqNullSafe(F.col("own_source")))
    rows = known.withColumn("rate", rate).select(
        "doc_id",
        "source_no",
        "size",
        F.floor("rate").alias("base"),
        (F.col("rate") - F.floor("rate")).alias("fraction"),
        draw,
        F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "size", "number"), buckets).alias("bucket"),
    )
    open_ = (F.col("fraction") > 0) & (F.col("fraction") < 1)
    width, decided = math.ceil((most or 0) / BUCKET_ROWS), []
    rows = _level(rows, "mix-level")
    while width > 1:
        decided.append(rows.filter(~open_))
        width = math.ceil(width / FAN_IN)
        rows = _level(rows.filter(open_).withColumn("bucket", F.floor(F.col("bucket") / FAN_IN)), "mix-level")
    result = rows.withColumn("fraction", F.when(open_, (F.col("draw") < F.col("fraction")).cast("double")).otherwise(F.col("fraction")))
    for part in decided:
        result = result.unionByName(part)
    result = result.join(broadcast_within(targets, n_sources), "source_no")
    copies = (F.col("base") + F.col("fraction")).cast("bigint")
    return result.withColumn("copies", copies).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def repeat_documents(docs: DataFrame, mix: DataFrame) -> DataFrame:
    """``docs`` with each row as often as ``mix_documents`` takes it; rows taken 0 times are left out.

    Rows that share doc_id, source and size share their copies in the order of their texts.
    """
    prefix = free_prefix(docs)
    own, copies, rows, times, copy = (prefix + name for name in ("own", "copies", "rows", "times", "copy"))
    key = ["doc_id", "source", "size"]
    wanted = mix.groupBy(*key).agg(F.sum("copies").alias(copies), F.count("*").alias(rows))
    wanted = wanted.filter(F.col(copies) > 0).withColumnsRenamed({c: prefix + c for c in key})
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("bigint")
    sized = docs.withColumn(own, size)
    same = F.col("doc_id").eqNullSafe(F.col(f"{prefix}doc_id")) & F.col("source").eqNullSafe(F.col(f"{prefix}source"))
    joined = sized.join(wanted, same & (F.col(own) == F.col(f"{prefix}size")))
    rank = F.row_number().over(Window.partitionBy("doc_id", "source", own).orderBy("text"))
    share = F.floor(F.col(copies) / F.col(rows)) + F.when(rank <= F.col(copies) % F.col(rows), 1).otherwise(0)
    numbered = joined.withColumn(times, share.cast("int"))
    repeated = numbered.withColumn(copy, F.explode(F.array_repeat(F.lit(0), F.col(times))))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])
