"""Shards by a Feistel permutation of global row numbers.

Every row gets a number from 0 in an order that only the rows' content decides. A permutation of these numbers, a keyed
Feistel network with cycle walking, gives each row a place; place p lies in shard p mod k at slot p div k. So the shuffle is
the same in every run and in every file layout, shards differ by one row at most, and both directions are arithmetic: ``shard_and_slot``
of a row number and ``row_number_at`` of a shard and a slot need no table. Rows move only by their number; texts never do.

Numbers without one sorted task: rows are dealt to slots of about ``SLOT_ROWS`` by a 60-bit digest, ranked inside their slot, and
counts of the slots give the offsets. Rows that are equal in id and text fall on one digest; where more than
``SLOT_ROWS`` do, they are dealt on to sub-slots, so no task gets them all.

The permutation: a number x below n is the pair (x div b, x mod b) of a grid of a x b >= n cells, a and b near the root of n.
Rounds change the halves in turn by a function of the other half, so every round can be undone. A number that leaves 0 .. n - 1 is
permuted again until it is back. At most a - 1 cells lie outside, so the longest such walk is found from them alone.

Defined results: a null text has size 8 and counts as empty for order and checksum; a null id orders as an empty one; an empty table gives no
rows. Repeated rows get places of their own; which of several rows that are equal in every column gets which place makes no
difference. Other columns are not used, except to order rows equal in id and text; in ``shard_documents`` they come through, and its own
column names are refused if the table has them. Groups of equal texts are not kept together: the law is ``rows``.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanspark.operators.tables import broadcast_within, materialize

SHARDS = 24
SEED = 20240229
ROUNDS = 8
SLOT_ROWS = 100_000
SLOTS_PER_BLOCK = 1024
# Prime modulus and multiplier of the round function: products stay below 2**62.
MODULUS, FACTOR = (1 << 31) - 1, 1_103_515_245
DIGEST_BITS = 60


# --- the permutation -----------------------------------------------------------------------------


def grid(n: int) -> tuple[int, int]:
    """Sides a x b of the smallest near-square grid that holds n numbers."""
    b = max(isqrt(n), 1)
    return max(-(-n // b), 1), b


def round_keys(seed: int, rounds: int = ROUNDS) -> list[int]:
    return [(seed * (i + 1) * 2_654_435_761 + 97 * i) % MODULUS for i in range(rounds)]


def _round(half: Column, key: Column) -> Column:
    """Not linear in the half, so that rounds do not add up to one sum."""
    mixed = F.pmod(half * F.lit(FACTOR) + key, F.lit(MODULUS))
    return F.pmod(mixed * mixed, F.lit(MODULUS))


def _steps(seed: int, backwards: bool) -> Column:
    keys = list(enumerate(round_keys(seed)))
    order = reversed(keys) if backwards else keys
    return F.array(*[F.struct(F.lit(i % 2 == 0).alias("high"), F.lit(key).cast("bigint").alias("key")) for i, key in order])


def _once(x: Column, n: int, seed: int, backwards: bool) -> Column:
    a, b = (F.lit(side).cast("bigint") for side in grid(n))
    sign = F.lit(-1 if backwards else 1).cast("bigint")

    def step(halves: Column, turn: Column) -> Column:
        high, low = halves["high"], halves["low"]
        new_high = F.when(turn["high"], F.pmod(high + sign * F.pmod(_round(low, turn["key"]), a), a)).otherwise(high)
        new_low = F.when(turn["high"], low).otherwise(F.pmod(low + sign * F.pmod(_round(high, turn["key"]), b), b))
        return F.struct(new_high.alias("high"), new_low.alias("low"))

    x = x.cast("bigint")
    whole = F.floor(x / b.cast("decimal(20,0)")).cast("bigint")
    start = F.struct(whole.alias("high"), F.pmod(x, b).alias("low"))
    return F.aggregate(_steps(seed, backwards), start, step, lambda halves: halves["high"] * b + halves["low"])


def longest_walk(df: DataFrame, n: int, seed: int = SEED) -> int:
    """How often a number is permuted at most until it is below n.

    Only cells from n to a x b can prolong a walk; a range of fewer than ``a`` numbers is walked until all are back.
    """
    a, b = grid(n)
    outside, walk = df.sparkSession.range(n, a * b, 1, 1 + a // 1_000_000), 1
    while a * b > n and outside.limit(1).count():
        walk += 1
        outside = outside.select(_once(F.col("id"), n, seed, False).alias("id")).filter(F.col("id") >= n)
        outside = materialize(outside, "walk")
    return walk


def permuted(x: Column, n: int, walk: int, seed: int = SEED, backwards: bool = False) -> Column:
    """The place of number x among n; ``backwards`` gives the number at a place. ``walk`` comes from ``longest_walk``."""
    once = _once(x, n, seed, backwards)
    if walk <= 1:
        return once
    again = F.array_repeat(F.lit(0), walk - 1)
    return F.aggregate(again, once, lambda p, _: F.when(p >= F.lit(n), _once(p, n, seed, backwards)).otherwise(p))


def shard_and_slot(number: Column, n: int, walk: int, shards: int = SHARDS, seed: int = SEED) -> tuple[Column, Column]:
    place = permuted(number, n, walk, seed)
    return F.pmod(place, F.lit(shards)).cast("int"), F.floor(place / F.lit(shards).cast("decimal(20,0)")).cast("bigint")


def row_number_at(shard: Column, slot: Column, n: int, walk: int, shards: int = SHARDS, seed: int = SEED) -> Column:
    """The number of the row at a slot: a reader finds its rows without a look-up table."""
    return permuted(slot.cast("bigint") * shards + shard, n, walk, seed, backwards=True)


# --- global row numbers --------------------------------------------------------------------------


def content_digest(doc_id: Column, text: Column) -> Column:
    """60 even bits from id and text."""
    named = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(named.cast("binary")), 1, DIGEST_BITS // 4), 16, 10).cast("bigint")


def row_digest(df: DataFrame) -> Column:
    """A hash of every column; maps, which Spark does not hash, go by their sorted entries."""

    def hashable(name: str, kind: str) -> Column:
        column = F.col(f"`{name}`")
        return F.to_json(F.struct(column.alias("v"))) if "map<" in kind or "variant" in kind else column

    return F.xxhash64(*[hashable(name, kind) for name, kind in df.dtypes])


def number_rows(keyed: DataFrame, n: int, digest: str = "digest", order: list[str] | None = None, name: str = "number") -> DataFrame:
    """Add the row number by (``digest``, ``order``). ``keyed`` is read several times, so it must be a written table.

    Its column ``at`` holds a number per row, such as ``monotonically_increasing_id``. ``digest`` holds ``DIGEST_BITS`` even bits. Rows of one digest beyond a slot's size are split by where they lie, after ``order`` has
    no more say: they must be equal in all that matters.
    """
    slots = max(1, -(-n // SLOT_ROWS))
    width = -(-(1 << DIGEST_BITS) // slots)
    heavy = keyed.groupBy(digest).agg(F.count("*").alias("__n")).filter(F.col("__n") > SLOT_ROWS)
    heavy = heavy.select(digest, (F.floor(F.col("__n") / SLOT_ROWS) + 1).alias("__parts"))
    slot = F.floor(F.col(digest) / F.lit(width).cast("decimal(20,0)")).cast("bigint")
    placed = keyed.join(broadcast_within(heavy, n // SLOT_ROWS), digest, "left").withColumn("__slot", slot)
    # In a slot, heavy digests come after all others, each with its parts in order.
    is_heavy = F.col("__parts").isNotNull()
    placed = placed.withColumn("__heavy", F.when(is_heavy, F.col(digest)).otherwise(F.lit(-1).cast("bigint")))
    placed = placed.withColumn("__part", F.when(is_heavy, F.pmod("at", "__parts")).otherwise(F.lit(0)).cast("bigint"))
    cell = ["__slot", "__heavy", "__part"]
    cells = placed.groupBy(*cell).agg(F.count("*").alias("__n"))
    cells = cells.withColumn("__block", F.floor(F.col("__slot") / SLOTS_PER_BLOCK).cast("bigint"))
    before = (Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    blocks = cells.groupBy("__block").agg(F.sum("__n").alias("__n"))
    blocks = blocks.select("__block", F.coalesce(F.sum("__n").over(Window.orderBy("__block").rowsBetween(*before)), zero).alias("__ahead"))
    inside = Window.partitionBy("__block").orderBy(*cell).rowsBetween(*before)
    offsets = cells.withColumn("__inside", F.coalesce(F.sum("__n").over(inside), zero))
    offsets = offsets.join(blocks, "__block").select(*cell, (F.col("__inside") + F.col("__ahead")).alias("__before"))
    rank = F.row_number().over(Window.partitionBy(*cell).orderBy(digest, *(order or [])))
    numbered = placed.withColumn("__rank", rank).join(broadcast_within(offsets, 3 * (slots + 1)), cell)
    return numbered.withColumn(name, F.col("__before") + F.col("__rank") - 1).select(*keyed.columns, name)


# --- shards --------------------------------------------------------------------------------------


def text_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 8


def assign_shards(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard (null: a new shard moves rows everywhere)."""
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select(
        "doc_id",
        text_size(F.col("text")).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        content_digest(F.col("doc_id"), F.col("text")).alias("digest"),
        F.monotonically_increasing_id().alias("at"),
    )
    keyed = materialize(keyed, "shard_keys")
    n = keyed.count()
    numbered = number_rows(keyed, n, order=["doc_id", "size", "text_crc32"])
    shard, slot = shard_and_slot(F.col("number"), max(n, 1), longest_walk(docs, n, seed) if n else 1, shards, seed)
    return numbered.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        shard.alias("shard"),
        slot.alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def shard_documents(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Write whole rows to ``path``, one folder per shard, sorted by slot within each file; returns what was written.

    A shard is split over several files by slot, so a task holds a range of slots of one shard and never a whole shard.
    """
    own = ["shard", "slot"]
    taken = sorted(set(own) & set(docs.columns))
    if taken:
        raise ValueError(f"columns {taken} would be overwritten; rename them first")
    columns = docs.columns
    # Positional names inside, so that no name of the table can clash with one used on the way.
    inner = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    place_of = {name: f"c{i}" for i, name in enumerate(columns)}
    added = {
        "digest": content_digest(F.col(place_of["doc_id"]), F.col(place_of["text"])),
        "tie": row_digest(inner),
        "at": F.monotonically_increasing_id(),
    }
    stored = materialize(inner.withColumns(added), "shard_rows")
    n = stored.count()
    # Digests alone are ranked. Whole rows move twice: to their place, and to the file they end in.
    numbered = number_rows(stored.select("digest", "tie", "at"), n, order=["tie"])
    shard, slot = shard_and_slot(F.col("number"), max(n, 1), longest_walk(docs, n, seed) if n else 1, shards, seed)
    whole = stored.join(numbered.select("at", shard.alias("shard"), slot.alias("slot")), "at")
    result = whole.select(*[F.col(place_of[c]).alias(c) for c in columns], "shard", "slot")
    files = max(1, -(-n // (shards * SLOT_ROWS)))
    dealt = result.repartitionByRange(shards * files, "shard", "slot").sortWithinPartitions("shard", "slot")
    dealt.write.partitionBy("shard").parquet(path)
    schema = result.select(*columns, "slot", "shard").schema
    return docs.sparkSession.read.schema(schema).parquet(path)


# --- the same in SQL, for comparison -------------------------------------------------------------


def crc32_sql(binary: str) -> str:
    """CRC-32 of a blob in DuckDB: one table look-up per byte. The table follows from its rule."""
    table = []
    for value in range(256):
        for _ in range(8):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    octets = f"list_transform(regexp_extract_all(hex({binary}), '..'), lambda x: ('0x' || x)::BIGINT)"
    step = f"lambda c, b: xor(c >> 8, ({table}::BIGINT[])[xor(c & 255, b) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), {step}), 4294967295)"


def assign_sql(shards: int = SHARDS, seed: int = SEED) -> str:
    """The numbers by one sorted window, the rounds spelled out, the walk as a recursion."""
    halves = "x // b AS h0, x % b AS l0"
    rounds = []
    for i, key in enumerate(round_keys(seed)):
        changed, other, side = ("h", "l", "a") if i % 2 == 0 else ("l", "h", "b")
        mixed = f"(({other}{i} * {FACTOR} + {key}) % {MODULUS})"
        value = f"({changed}{i} + (({mixed} * {mixed}) % {MODULUS}) % {side}) % {side} AS {changed}{i + 1}"
        rounds.append(f"SELECT *, {value}, {other}{i} AS {other}{i + 1} FROM")
    once = f"(SELECT number, x, a, b, n, {halves} FROM {{source}})"
    for line in rounds:
        once = f"({line} {once})"
    step = f"SELECT number, h{ROUNDS} * b + l{ROUNDS} AS x, a, b, n FROM {once}"
    return f"""WITH RECURSIVE keyed AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 8 AS size, {crc32_sql("encode(coalesce(text, ''))")} AS text_crc32,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, {DIGEST_BITS // 4}))::BIGINT AS digest
  FROM documents),
numbered AS (SELECT *, row_number() OVER (ORDER BY digest, doc_id NULLS FIRST, size, text_crc32) - 1 AS number FROM keyed),
sides AS (SELECT n, b, greatest((n + b - 1) // b, 1) AS a FROM (SELECT count(*) AS n, greatest(CAST(floor(sqrt(count(*))) AS BIGINT), 1) AS b FROM keyed)),
start AS (SELECT number, number AS x, a, b, n FROM numbered, sides),
walk AS ({step.format(source="start")} UNION ALL {step.format(source="walk WHERE x >= n")})
SELECT k.doc_id, k.size, k.text_crc32, 'rows' AS law, CAST(w.x % {shards} AS INTEGER) AS shard, w.x // {shards} AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM numbered k JOIN walk w USING (number) WHERE w.x < w.n"""
