"""Near copies: documents whose sets of five-word shingles have a Jaccard similarity of 0.75 or more.

Two documents link when 100 * common >= 75 * all shingles of both. The result is exact up to 64-bit shingle
hashes: one row per document with the smallest doc_id it can reach by links. Documents with equal sets
are one set from the start; links are sought between sets and never expanded into pairs of copies.

Method, a token-group matrix: blocks of similar sets, and for every shingle the blocks whose union holds it.

1. A set with more shingles that no other set has than the similarity lets it miss
   has no partner. Shingles with hashes below ``LOW_SHARE`` of the range suffice for that and are counted
   over all documents; whoever could still have a partner goes on with its whole set.
2. Sets known to be linked form groups: in buckets of equal min-hash each set joins the first leader that it is
   verified to link with. Hot buckets are split. Sets whose shingles of other groups do not suffice for a link leave.
3. The sets left are dealt into blocks by min-hash. Shingles held by the fewest blocks are looked up in the matrix.
   Hits plus the shingles not looked up bound the overlap of a set with any set of a block, and only blocks whose
   bound reaches the needed overlap are opened: the set goes there once, its overlaps with all sets of the
   block are counted exactly, and a spanning forest of the links between groups comes out.

A large group of sets that are all just below the similarity fills several blocks, and each of its sets opens all of
these: one row per set and block, not per pair. The comparing itself, inside a block, is still as many as there are pairs.

Groups, min-hashes and the order of look-ups decide how much work is done, never which links are found.

Defined results: null, empty and blank texts have no shingle and stay alone; fewer than five words are one
shingle; a repeated row links with its copy; a component whose documents all lack an id has the id null;
an empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanspark.llm.components import components
from urbanspark.llm.names import free_prefix
from urbanspark.llm.words import Slice, mix, slices, windows
from urbanspark.operators.tables import broadcast_within, materialize

WIDTH = 5
# Share of the hash range counted in the first step, and shingles per task of that count.
LOW_SHARE = 0.4
PART_SHINGLES = 500_000
# Shingles that a task packs at a time.
CHUNK_SHINGLES = 500_000
# Sets per task that adds up the counts of the parts.
BUCKET_IDS = 50_000
# Min-hash rounds, sets per bucket before it is split, and leaders of a bucket a set is compared with.
ROUNDS = 2
BUCKET_SETS = 256
LEADERS = 32
# Shingles looked up beyond the least number: each makes the bound on a block's overlap sharper by one.
EXTRA = 24
# Shingles of the sets of a block.
BLOCK_SHINGLES = 100_000

_SEEDS = [np.uint64(0x9FB21C651E98DF25 * (2 * i + 1) % (1 << 64)) for i in range(ROUNDS)]
_OTHER = np.uint64(0xA0761D6478BD642F)


def text_sets(part: Slice) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a slice."""
    hashes = part.hashes(True)
    shingles, edges = windows(hashes, part.edges, WIDTH)
    found = []
    for i, words in enumerate(np.diff(part.edges).tolist()):
        if words >= WIDTH:
            found.append(np.unique(shingles[edges[i] : edges[i + 1]]))
        else:
            whole = np.uint64(0)
            for value in hashes[part.edges[i] : part.edges[i + 1]].tolist():
                whole = mix(np.array([(int(whole) * 31 + value + words) % (1 << 64)], np.uint64))[0]
            found.append(np.array([whole] if words else [], np.uint64))
    return found


def set_name(shingles: np.ndarray) -> bytes:
    """128 bits that name a set."""
    return np.array([mix(shingles).sum(dtype=np.uint64), mix(shingles ^ _OTHER).sum(dtype=np.uint64)], "<u8").tobytes()


def set_ids(names: list[bytes]) -> np.ndarray:
    """The 64-bit ids of names, never 0. Documents meet by name, sets that may have partners by id."""
    ids = np.frombuffer(b"".join(name[:8] for name in names), "<i8").copy()
    ids[ids == 0] = 1
    return ids


def needed(n: Column) -> Column:
    """Least overlap of a set of n shingles with a partner: 75 % of n, rounded up."""
    return F.floor((n * 3 + 3) / 4)


def text_key() -> Column:
    """Names the text of a row; null for a null text."""
    return F.unhex(F.md5("text"))


def set_table(docs: DataFrame, with_key: bool = False) -> DataFrame:
    """doc_id, n, name and id of the set of every row, written once; ``with_key`` adds the key of its text."""
    more = ["key"] if with_key else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text")):
                found = text_sets(part)
                own = batch.column("doc_id").slice(part.low, len(found))
                names = [set_name(s) for s in found]
                columns = [own, pa.array([len(s) for s in found], pa.int64()), pa.array(names, pa.binary()), pa.array(set_ids(names))]
                columns += [batch.column(c).slice(part.low, len(found)) for c in more]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "name", "id", *more])

    schema = "doc_id bigint, n bigint, name binary, id bigint" + ", key binary" * with_key
    read = docs.select("doc_id", "text", *[text_key().alias(c) for c in more])
    return materialize(read.mapInArrow(run, schema), "shingle-sets")


# ---- shingles held by one owner only


PACKED = "part int, shingles binary, sets binary, owners binary, places binary"


def _packed(sets: list[np.ndarray], ids: np.ndarray, owners: np.ndarray, parts: int, low: float) -> Iterator[tuple]:
    """Rows (part, ...) with all shingles of a batch of sets; ids and owners are 64-bit numbers other than 0.

    A shingle that several owners of the batch have is sent once, as shared.
    """
    keys, first = np.unique(ids, return_index=True)
    own, sets = owners[first], [sets[i] for i in first.tolist()]
    limit = np.uint64(min(int(low * 2.0**64), (1 << 64) - 1))
    sets = [s[: np.searchsorted(s, limit)] for s in sets]
    shingles = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    if not len(shingles):
        return
    place = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(shingles, kind="stable")
    shingles, place = shingles[order], place[order]
    starts = np.flatnonzero(np.concatenate([[True], shingles[1:] != shingles[:-1]]))
    owner = own[place]
    shared = np.minimum.reduceat(owner, starts) != np.maximum.reduceat(owner, starts)
    sizes = np.diff(np.append(starts, len(shingles)))
    place[np.repeat(shared, sizes)] = -1
    keep = ~np.repeat(shared, sizes)
    keep[starts[shared]] = True
    shingles, place = shingles[keep], place[keep]
    part = ((shingles >> np.uint64(32)) * np.uint64(parts)) // ((limit >> np.uint64(32)) + np.uint64(1))
    cuts = np.searchsorted(part, np.arange(parts + 1))
    for number, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
        if a < b:
            used, index = np.unique(place[a:b], return_inverse=True)
            known = used >= 0
            name = np.where(known, keys[used], 0).astype("<i8")
            owned = np.where(known, own[used], 0).astype("<i8")
            low_bits = (shingles[a:b] & np.uint64(0xFFFFFFFF)).astype("<u4")
            yield number, low_bits.tobytes(), name.tobytes(), owned.tobytes(), index.astype("<u4").tobytes()


def _chunks(sets: list[np.ndarray]) -> Iterator[slice]:
    """Ranges of sets with about ``CHUNK_SHINGLES`` shingles; one larger set is a range of its own."""
    ends = np.cumsum([len(s) for s in sets], dtype=np.int64)
    low = 0
    while low < len(sets):
        done = int(ends[low - 1]) if low else 0
        high = max(low + 1, int(np.searchsorted(ends, done + CHUNK_SHINGLES, "right")))
        yield slice(low, high)
        low = high


def _packed_batch(rows) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 5
    kinds = [pa.int32()] + [pa.binary()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["part", "shingles", "sets", "owners", "places"])


def _lonely(table: pa.Table) -> pa.Table:
    """Of one part of the hash range: how many shingles each set has that its owner alone holds.

    Shingles are told apart by 32 bits inside a part; a collision can only make a shingle look shared.
    """
    shingles, sets, owners = [], [], []
    for row in table.to_pylist():
        place = np.frombuffer(row["places"], "<u4")
        shingles.append(np.frombuffer(row["shingles"], "<u4"))
        sets.append(np.frombuffer(row["sets"], "<i8")[place])
        owners.append(np.frombuffer(row["owners"], "<i8")[place])
    shingles, sets, owners = np.concatenate(shingles), np.concatenate(sets), np.concatenate(owners)
    order = np.lexsort((sets, shingles))
    shingles, sets, owners = shingles[order], sets[order], owners[order]
    starts = np.flatnonzero(np.concatenate([[True], shingles[1:] != shingles[:-1]]))
    low, high = np.minimum.reduceat(owners, starts), np.maximum.reduceat(owners, starts)
    single = np.repeat((low == high) & (low != 0), np.diff(np.append(starts, len(shingles))))
    single[1:] &= (shingles[1:] != shingles[:-1]) | (sets[1:] != sets[:-1])
    ids, counts = np.unique(sets[single], return_counts=True)
    buckets = int(table["buckets"][0].as_py())
    bucket = (mix(ids.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    rows = [(i, ids[bucket == i].tobytes(), counts[bucket == i].astype("<i8").tobytes()) for i in np.unique(bucket).tolist()]
    columns = list(zip(*rows)) or [[], [], []]
    return pa.table({"bucket": pa.array(columns[0], pa.int64()), "ids": pa.array(columns[1], pa.binary()), "counts": pa.array(columns[2], pa.binary())})


def _sum_lonely(table: pa.Table) -> pa.Table:
    ids = np.concatenate([np.frombuffer(v, "<i8") for v in table["ids"].to_pylist()])
    counts = np.concatenate([np.frombuffer(v, "<i8") for v in table["counts"].to_pylist()])
    ids, place = np.unique(ids, return_inverse=True)
    return pa.table({"id": pa.array(ids), "lonely": pa.array(np.bincount(place, counts).astype(np.int64))})


def _count_lonely(packed: DataFrame, sets: int) -> DataFrame:
    """id and its number of lonely shingles; parts of the range hand over their counts by buckets of ids, not by row."""
    asked = packed.withColumn("buckets", F.lit(max(1, math.ceil(sets / BUCKET_IDS))))
    counts = asked.groupBy("part").applyInArrow(_lonely, "bucket bigint, ids binary, counts binary")
    return counts.groupBy("bucket").applyInArrow(_sum_lonely, "id bigint, lonely bigint")


def with_partners(sets: DataFrame, lonely: DataFrame) -> DataFrame:
    """Rows of ``sets`` (id, n, ...) whose shingles that are not lonely, ``held`` in number, may suffice for a partner."""
    joined = sets.join(lonely, "id", "left").withColumn("held", F.col("n") - F.coalesce("lonely", F.lit(0)))
    return joined.filter(F.col("held") >= needed(F.col("n"))).drop("lonely")


def candidate_sets(docs: DataFrame, table: DataFrame) -> DataFrame:
    """id, n, shingles and min-hash keys of every set that may have a partner other than itself; each set once."""
    total, rows = table.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    parts = max(1, math.ceil(total * LOW_SHARE / PART_SHINGLES))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text")):
                sets = [s for s in text_sets(part) if len(s)]
                ids = set_ids([set_name(s) for s in sets])
                yield _packed_batch(_packed(sets, ids, ids, parts, LOW_SHARE))

    lonely = _count_lonely(docs.select("text").mapInArrow(pack, PACKED), rows)
    distinct = table.filter("n > 0").groupBy("id", "n").agg(F.min("doc_id").alias("doc_id"))
    left = materialize(with_partners(distinct, lonely).drop("held"), "sets-left")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text")):
                sets = [s for s in text_sets(part) if len(s)]
                yield _set_batch(sets)

    # Within the size limit of broadcasts the texts stay where they are; beyond it they are shuffled.
    most = left.count()
    wanted = broadcast_within(left.select(F.col("doc_id").alias("__doc_id")), most)
    texts = docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("__doc_id")), "left_semi")
    # Documents that share an id may bring sets that were not asked for.
    sets = texts.select("text").mapInArrow(read, SETS).join(broadcast_within(left.select("id"), most), "id", "left_semi")
    return materialize(sets.dropDuplicates(["id"]), "sets")


SETS = "id bigint, n bigint, shingles array<bigint>, " + ", ".join(f"bucket{i} bigint" for i in range(ROUNDS))


def _set_batch(sets: list[np.ndarray]) -> pa.RecordBatch:
    buckets = [[int(mix(s ^ seed).min().view(np.int64)) for s in sets] for seed in _SEEDS]
    lengths = [len(s) for s in sets]
    edges = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    values = np.concatenate(sets).view(np.int64) if sets else np.empty(0, np.int64)
    columns = [pa.array(set_ids([set_name(s) for s in sets])), pa.array(lengths, pa.int64())]
    columns += [pa.ListArray.from_arrays(pa.array(edges), pa.array(values)), *(pa.array(b, pa.int64()) for b in buckets)]
    return pa.RecordBatch.from_arrays(columns, names=["id", "n", "shingles", *(f"bucket{i}" for i in range(ROUNDS))])


def _read_sets(column: pa.ListArray) -> list[np.ndarray]:
    values, edges = column.values.to_numpy(), column.offsets.to_numpy()
    return [values[a:b].view(np.uint64) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]


# ---- groups


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common elements of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def links(a: np.ndarray, b: np.ndarray) -> bool:
    if 4 * min(len(a), len(b)) < 3 * max(len(a), len(b)):
        return False
    common = _overlap(a, b)
    return 100 * common >= 75 * (len(a) + len(b) - common)


def _lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets ordered by bucket: each gets the first of the bucket's last leaders that it links with, or leads itself."""
    bucket, leaders = None, []
    for batch in batches:
        found = []
        for own_id, own, shingles in zip(batch.column("id").to_pylist(), batch.column("own").to_pylist(), _read_sets(batch.column("shingles"))):
            if own != bucket:
                bucket, leaders = own, []
            leader = next((other for other, held in leaders if links(shingles, held)), own_id)
            if leader == own_id:
                leaders = [*leaders[-LEADERS + 1 :], (own_id, shingles.copy())]
            found.append(leader)
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.int64())], names=["id", "leader"])


def _round(sets: DataFrame, bucket: str, total: int) -> DataFrame:
    """id and leader of every set, of at most ``total``; hot buckets are split by id."""
    hot = sets.groupBy(bucket).count().filter(F.col("count") > BUCKET_SETS)
    hot = hot.select(bucket, F.ceil(F.col("count") / BUCKET_SETS).alias("splits"))
    hot = broadcast_within(hot, total // BUCKET_SETS)
    dealt = sets.select("id", "shingles", bucket).join(hot, bucket, "left")
    salt = F.pmod(F.xxhash64("id"), F.coalesce("splits", F.lit(1)))
    dealt = dealt.select("id", "shingles", F.concat_ws("/", F.col(bucket).cast("string"), salt.cast("string")).alias("own"))
    ordered = dealt.repartition("own").sortWithinPartitions("own", "id")
    return materialize(ordered.mapInArrow(_lead, "id bigint, leader bigint"), "leaders")


def similar_groups(sets: DataFrame) -> DataFrame:
    """id and owner (the leader of its group) of every set."""
    owned, left, total = None, sets, sets.count()
    for i in range(ROUNDS):
        found = _round(left, f"bucket{i}", total)
        if owned is None:
            owned = found.select("id", F.col("leader").alias("owner"))
        else:
            moved = found.select(F.col("id").alias("owner"), "leader")
            owned = owned.join(moved, "owner", "left").select("id", F.coalesce("leader", "owner").alias("owner"))
        if i + 1 < ROUNDS:
            left = sets.join(owned.filter("id = owner").select("id"), "id", "left_semi")
    return materialize(owned, "owners")


# ---- links between groups


def possible_links(sets: DataFrame) -> DataFrame:
    """The sets (id, owner, n, shingles, bucket0, held) that may link with a set of another owner, as far as bounds tell.

    ``most`` is the greatest size of a set, not above n, whose link with this one ``held`` would allow.
    """
    total, rows = sets.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    parts = max(1, math.ceil(total / PART_SHINGLES))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, owners = batch.column("id").to_numpy(), batch.column("owner").to_numpy()
            sets = _read_sets(batch.column("shingles"))
            for some in _chunks(sets):
                yield _packed_batch(_packed(sets[some], ids[some], owners[some], parts, 1.0))

    # Both uses read the same columns, so the sets are shuffled once for them.
    used = sets.select("id", "owner", "n", "shingles", "bucket0")
    lonely = _count_lonely(used.mapInArrow(pack, PACKED), rows)
    left = with_partners(used, lonely)
    most = F.least("n", F.floor((7 * F.col("held") - 3 * F.col("n")) / 3))
    return materialize(left.withColumn("most", most), "sets-left")


def placed_in_blocks(left: DataFrame, total: int) -> DataFrame:
    """``left`` with the block of each set: sets of equal min-hash share one, and no block is much above ``BLOCK_SHINGLES``."""
    count = max(1, math.ceil(total / BLOCK_SHINGLES))
    based = left.withColumn("base", F.pmod(F.xxhash64("bucket0"), F.lit(count)))
    splits = F.ceil(F.sum("n") / BLOCK_SHINGLES).alias("splits")
    heavy = broadcast_within(based.groupBy("base").agg(splits).filter("splits > 1"), count)
    salt = F.pmod(F.xxhash64("id"), F.coalesce("splits", F.lit(1)))
    return based.join(heavy, "base", "left").withColumn("block", F.xxhash64("base", salt)).drop("base", "splits")


def opened_blocks(placed: DataFrame) -> DataFrame:
    """Pairs (id, block) of a set and a block that may hold a partner of another group which is not smaller.

    A link of sizes n <= m needs three sevenths of n + m in common, so six sevenths of the smaller set at least, and the
    smaller set asks. Look-ups in the matrix begin with the shingles of the fewest blocks and end ``EXTRA`` after the
    point where a link could no longer hide. The overlap with any set of a block is at most the hits in its union and
    the shingles not looked up. A set always asks its own block.
    """
    matrix = placed.select("block", F.explode("shingles").alias("shingle")).distinct()
    spread = matrix.groupBy("shingle").agg(F.count("*").alias("spread")).filter("spread > 1")
    least = F.ceil(6 * F.col("n") / 7)
    extra = F.least(F.lit(EXTRA), least - 1)
    asking = placed.filter(F.col("held") >= least).select("id", "n", F.col("block").alias("own"), least.alias("least"), extra.alias("extra"), "shingles")
    of_set = Window.partitionBy("id")
    shared = asking.select("id", F.explode("shingles").alias("shingle")).join(spread, "shingle")
    ranked = shared.join(asking.drop("shingles"), "id").withColumns(
        {"rank": F.row_number().over(of_set.orderBy("spread", "shingle")), "some": F.count("*").over(of_set)}
    )
    asked = ranked.filter("some >= least AND rank <= some - least + 1 + extra").select("id", "shingle")
    hits = asked.join(matrix, "shingle").groupBy("id", "block").agg(F.count("*").alias("hits"))
    sizes = placed.groupBy("block").agg(F.min("n").alias("least_n"), F.max("most").alias("most"))
    bounded = hits.join(asking.drop("shingles"), "id").filter("block != own").join(sizes, "block")
    reach = F.col("hits") + F.col("least") - 1 - F.col("extra")
    enough = (reach >= F.col("least")) & (7 * reach >= 3 * (F.col("n") + F.greatest("n", "least_n"))) & (F.col("most") >= F.col("n"))
    return bounded.filter(enough).select("id", "block").unionByName(asking.select("id", F.col("own").alias("block")))


def _open(asked: pa.Table, members: pa.Table) -> pa.Table:
    """Edges (a, b) between groups: a spanning forest of the links of the asking sets with the sets of one block."""
    edges: list[tuple[int, int]] = []
    if asked.num_rows and members.num_rows:
        sets = _read_sets(members["their_shingles"].combine_chunks())
        sizes = members["their_n"].to_numpy()
        owners = members["their_owner"].to_numpy()
        order = np.argsort(np.concatenate(sets), kind="stable")
        place = np.repeat(np.arange(len(sets)), [len(s) for s in sets])[order]
        tokens, starts = np.unique(np.concatenate(sets)[order], return_index=True)
        counts = np.diff(np.append(starts, len(place)))
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while x in parent:
                x = parent[x]
            return x

        rows = zip(_read_sets(asked["shingles"].combine_chunks()), asked["n"].to_pylist(), asked["owner"].to_pylist())
        for shingles, n, owner in rows:
            at = np.searchsorted(tokens, shingles)
            at[at == len(tokens)] = 0
            at = at[tokens[at] == shingles]
            some = counts[at]
            ends = np.cumsum(some)
            inner = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts[at] - ends + some, some)
            common = np.bincount(place[inner], minlength=len(sets))
            linked = (sizes >= n) & (owners != owner) & (100 * common >= 75 * (n + sizes - common))
            for other in np.unique(owners[linked]).tolist():
                a, b = root(owner), root(other)
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    edges.append((owner, other))
    return pa.table({"a": pa.array([a for a, _ in edges], pa.int64()), "b": pa.array([b for _, b in edges], pa.int64())})


def links_between_groups(sets: DataFrame, owned: DataFrame) -> DataFrame:
    """Edges (a, b) between owners, such that groups connected by any link of their sets are connected.

    A block is opened by the sets that ask for it, in shares of bounded size; one row goes out per set and opened
    block, and no pair of sets becomes a row.
    """
    left = possible_links(sets.join(owned, "id"))
    total = left.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    placed = materialize(placed_in_blocks(left, total), "blocks")
    opened = materialize(opened_blocks(placed), "opened")
    asked = opened.join(placed.select("id", "owner", "n", "shingles"), "id")
    weights = opened.join(placed.select("id", "n"), "id").groupBy("block").agg(F.ceil(F.sum("n") / PART_SHINGLES).alias("shares"))
    asked = asked.join(weights, "block").withColumn("share", F.pmod(F.xxhash64("id"), "shares"))
    # Columns of both sides come from one table, so one side has them under names of its own.
    renamed = {c: f"their_{c}" for c in ("block", "owner", "n", "shingles")}
    members = placed.select(*renamed).join(weights, "block").withColumnsRenamed(renamed)
    members = members.withColumn("their_share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).drop("shares")
    asking = asked.select("block", "share", "owner", "n", "shingles").groupBy("block", "share")
    edges = asking.cogroup(members.groupBy("their_block", "their_share")).applyInArrow(_open, "a bigint, b bigint")
    return materialize(edges, "links")


def _merge(owned: DataFrame, edges: DataFrame) -> DataFrame:
    """``owned`` with the groups joined that ``edges`` connect."""
    joined = components(edges).select(F.col("node").alias("owner"), "component")
    return materialize(owned.join(joined, "owner", "left").select("id", F.coalesce("component", "owner").alias("owner")), "owners")


def set_classes(docs: DataFrame, table: DataFrame) -> DataFrame:
    """name of every set with shingles, least doc_id of its rows, and the owner its whole component shares."""
    sets = candidate_sets(docs, table)
    owned = similar_groups(sets)
    owned = _merge(owned, links_between_groups(sets, owned))
    least = table.filter("n > 0").groupBy("name", "id").agg(F.min("doc_id").alias("least"))
    return materialize(least.join(owned, "id", "left").withColumn("owner", F.coalesce("owner", "id")), "classes")


def near_copies(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles and component_id."""
    table = set_table(docs)
    classes = set_classes(docs, table)
    alone = table.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    ids = classes.groupBy("owner").agg(F.min("least").alias("component_id"))
    by_set = classes.join(ids, "owner").select("name", "component_id")
    rows = table.filter("n > 0").join(by_set, "name").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return rows.unionByName(alone)


def one_per_component(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the smallest doc_id, ties by a hash of the text.

    Components are known by their sets, so rows of different components that share an id all stay. Rows without
    shingles and rows of a component without any id all stay.
    """
    table = set_table(docs, with_key=True)
    classes = set_classes(docs, table)
    rows = table.filter("n > 0").join(classes.select("name", "owner"), "name")
    least = rows.filter("doc_id IS NOT NULL").groupBy("owner").agg(F.min(F.struct("doc_id", "key")).alias("row"))
    prefix = free_prefix(docs)
    id_, no_id, key_, single_, rank_ = (prefix + name for name in ("id", "no_id", "key", "single", "rank"))
    single = least.select("row.doc_id", "row.key", F.lit(True).alias(single_))
    without = rows.join(least.select("owner"), "owner", "left_anti").unionByName(table.filter("n = 0"), allowMissingColumns=True)
    kept = single.unionByName(without.select("doc_id", "key").distinct().withColumn(single_, F.lit(False)))
    # A null text has a null key. All key columns are not null, so the rank needs no second shuffle of the texts.
    none = F.unhex(F.lit(""))
    place = {id_: F.coalesce("doc_id", F.lit(0)), no_id: F.isnull("doc_id"), key_: F.coalesce("key", none)}
    kept = kept.withColumns(place).select(*place, single_)
    own = docs.withColumns({**place, key_: F.coalesce(text_key(), none)}).join(kept, list(place))
    rank = F.row_number().over(Window.partitionBy(*place).orderBy(F.lit(0)))
    stay = own.withColumn(rank_, rank).filter(~F.col(single_) | (F.col(rank_) == 1))
    return stay.select(*[F.col(f"`{c}`") for c in docs.columns])
