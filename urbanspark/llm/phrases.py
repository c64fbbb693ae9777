"""Phrases of words that stand together more often than apart, mined as Toivonen proposed.

A phrase that comes often holds only phrases that come at least as often. So a sample of the documents, mined with a lowered
threshold, proposes a set that is closed under parts. One pass over all documents then counts, exactly, every phrase of this set and its
negative border: phrases outside the set whose first part and last part, one word shorter each, lie inside. A
border phrase that turns out frequent means that the sample missed it. Then the set grows by what was found, and a further pass counts what
now has both parts inside and had not before; parts that nobody has counted yet count as inside, so one such pass reaches through all
lengths. When a pass finds nothing that the last set and its unknown extensions do not cover, all frequent phrases are counted.

The set is held as a Bloom filter of bounded size, built by Spark's bitmap aggregates. It answers "inside" for all phrases of the set and
for a few others; those are counted for nothing and fall below the threshold, so results do not depend on it. With more
phrases than the filter holds more is counted, and nothing is lost.

A task counts phrases in slices of about ``SLICE_BYTES`` of whole texts by hash, and hands (lang, phrase, count) on with the phrase spelled
out, so global counts are by text. Counts are combined before the shuffle; a phrase that is everywhere costs a row per slice.

Defined results: a null text counts as empty, a null lang as ``und``; an empty table gives no rows. Repeated rows count as often as they
come. Other columns are not used; ids decide at most which rows the sample takes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from urbanspark.llm.words import Slice, mix, slices
from urbanspark.operators.tables import materialize

LEAST = 30
LONGEST = 4
CONTAINED = 80
TOP = 2000
SCALE = 2_000_000
NO_LANG = "und"
# The sample takes one in SAMPLE_EVERY documents; its threshold is LEAST / SAMPLE_EVERY times SLACK, rounded down.
SAMPLE_EVERY, SLACK = 8, 0.8
SLICE_BYTES = 1 << 20
# A language's phrases are ranked in this many shares first; only the first of each meet.
RANK_SHARES = 64
MAX_FILTER_BITS, BITS_PER_PHRASE, PROBES = 1 << 28, 16, 3
BITMAP_BITS = 32_768  # of Spark's bitmap aggregates

STOPS = b".,;:!?\n\x0b\x0c\r"
_STOP = np.zeros(256, bool)
_STOP[list(STOPS)] = True
_SEPARATOR = _STOP.copy()
_SEPARATOR[list(b" \t")] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] = np.arange(97, 123)
_NEXT = np.uint64(0xD6E8FEB86659FD93)
_PROBE = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]

COUNTS = "lang string, words int, phrase string, f bigint"


# --- the set that is known to be frequent, or proposed -------------------------------------------


class Known:
    """A Bloom filter over phrase hashes; without bits it holds nothing."""

    def __init__(self, bits: np.ndarray | None = None, size: int = 0):
        self.bits, self.size = bits, size

    def has(self, hashes: np.ndarray) -> np.ndarray:
        inside = np.full(len(hashes), self.bits is not None)
        if self.bits is not None:
            for at in probes(hashes, self.size):
                inside &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return inside


def probes(hashes: np.ndarray, size: int) -> list[np.ndarray]:
    """Bit positions of each hash; ``size`` is a power of two."""
    return [(mix(hashes * constant) & np.uint64(size - 1)).astype(np.int64) for constant in _PROBE[:PROBES]]


def filter_of(phrases: DataFrame) -> Known:
    """The filter of a table (lang, words, phrase). Bits are set in Spark; the driver gets at most ``MAX_FILTER_BITS`` bits."""
    n = phrases.count()
    if not n:
        return Known()
    size = max(BITMAP_BITS, min(MAX_FILTER_BITS, 1 << (n * BITS_PER_PHRASE - 1).bit_length()))

    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = phrase_hashes(batch["lang"], batch["phrase"])
            yield pa.RecordBatch.from_pydict({"at": np.concatenate(probes(hashes, size)) + 1})

    at = phrases.select("lang", "phrase").mapInArrow(positions, "at bigint")
    # Spark's bitmaps start at 1, with bucket 1.
    maps = at.groupBy((F.bitmap_bucket_number("at") - 1).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")
    )
    bits = np.zeros(size // 8, np.uint8)
    for row in maps.toLocalIterator():
        start = row["bucket"] * BITMAP_BITS // 8
        bits[start : start + BITMAP_BITS // 8] = np.frombuffer(row["bits"], np.uint8)
    return Known(bits, size)


# --- counting ------------------------------------------------------------------------------------


def lang_hashes(lang: pa.Array) -> np.ndarray:
    whole = pc.fill_null(lang, NO_LANG)
    return np.concatenate([p.run_hashes(p.bounds[:-1], p.bounds[1:], False) for p in slices(whole)] or [np.empty(0, np.uint64)])


def word_hashes(part: Slice, langs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Starts, ends, owner text and hash of each word of a slice; ``langs`` is a hash per text."""
    starts, ends, edges = part.runs(_SEPARATOR)
    owner = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    # Not a plain sum: a word may be spelled like a language.
    return starts, ends, owner, longer(langs[owner], part.run_hashes(starts, ends, True))


def longer(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of phrases with one more word."""
    return mix(hashes * _NEXT + words)


def phrase_hashes(lang: pa.Array, phrase: pa.Array) -> np.ndarray:
    """The hash of each whole phrase, as counting sees it."""
    langs, found = lang_hashes(lang), []
    for part in slices(phrase):
        *_, owner, words = word_hashes(part, langs[part.low : part.high])
        first = np.searchsorted(owner, np.arange(part.high - part.low))
        size = np.bincount(owner, minlength=part.high - part.low)
        total = words[first]
        for i in range(1, int(size.max(initial=1))):
            more = size > i
            total[more] = longer(total[more], words[first[more] + i])
        found.append(total)
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def spelled(part: Slice, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Words of a slice in lower case, as strings."""
    sizes = ends - starts
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    at = np.repeat(starts - bounds[:-1], sizes) + np.arange(bounds[-1])
    data = _FOLD[part.data[at]]
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data))


def counted_slice(
    part: Slice, langs: np.ndarray, old: Known | None, new: Known, longest: int = LONGEST, ahead: bool = False
) -> Iterator[tuple[int, np.ndarray, pa.Array, np.ndarray]]:
    """(words, text of the first one, phrase, count) of what ``new`` lets through and ``old`` did not; ``old`` None: nothing was counted yet.

    ``ahead``: phrases that were not counted before may be part of a longer one, as nothing is known against them.
    """
    starts, ends, owner, words = word_hashes(part, langs)
    if not len(words):
        return
    stops = np.concatenate([[0], np.cumsum(_STOP[part.data], dtype=np.int64)])
    # Word i + 1 goes on in the piece of word i.
    goes_on = (owner[1:] == owner[:-1]) & (stops[starts[1:]] == stops[ends[:-1]])
    _, first, word = np.unique(words, return_index=True, return_inverse=True)
    text = spelled(part, starts[first], ends[first])
    distinct = words[first]
    if old is None:
        yield 1, owner[first], text, np.bincount(word, minlength=len(first))
    # ``may``: can be part of a longer phrase; ``was``: was inside the old set, so what it is part of may have been counted.
    may, was = new.has(distinct)[word], np.zeros(len(word), bool) if old is None else old.has(distinct)[word]
    hashes, whole = words, np.ones(len(words), bool)
    for size in range(2, longest + 1):
        n = len(words) - size + 1
        if n <= 0:
            return
        whole = whole[:n] & goes_on[size - 2 : size - 2 + n]
        hashes = longer(hashes[:n], words[size - 1 :])
        wanted = whole & may[:n] & may[1 : n + 1]
        if not wanted.any():
            return
        before = whole & was[:n] & was[1 : n + 1]
        at = np.flatnonzero(wanted & ~before)
        if len(at):
            _, pick, count = np.unique(hashes[at], return_index=True, return_counts=True)
            at = at[pick]
            phrase = pc.binary_join_element_wise(*[text.take(pa.array(word[at + i])) for i in range(size)], pa.scalar(" ", pa.large_string()))
            yield size, owner[at], phrase, count
        if size == longest:
            return
        # A phrase is inside only if its parts are: a filter alone would sometimes say so of others.
        may, was = np.zeros(n, bool), np.zeros(n, bool)
        at = np.flatnonzero(wanted)
        may[at] = new.has(hashes[at])
        if ahead:
            may |= wanted & ~before
        if old is not None:
            at = np.flatnonzero(before)
            was[at] = old.has(hashes[at])


def counts(docs: DataFrame, old: Known | None, new: Known, least: int, longest: int = LONGEST, ahead: bool = False) -> DataFrame:
    """One pass: counts of phrases that come at least ``least`` times, in one written table.

    The first pass adds a row of 0 words for each language, with the number of all its words.
    """
    shared = docs.sparkSession.sparkContext.broadcast((old, new))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        old, new = shared.value
        for batch in batches:
            lang = pc.fill_null(batch["lang"], NO_LANG)
            hashes = lang_hashes(lang)
            for part in slices(batch["text"], SLICE_BYTES):
                own = lang.slice(part.low, part.high - part.low)
                for size, text_of, phrase, n in counted_slice(part, hashes[part.low : part.high], old, new, longest, ahead):
                    if size == 1:
                        everything = pa.table({"lang": own.take(pa.array(text_of)), "f": n}).group_by("lang").aggregate([("f", "sum")])
                        zero = [everything["lang"].combine_chunks(), np.zeros(len(everything), np.int32), [""] * len(everything)]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(zero[0]), pa.array(zero[1]), pa.array(zero[2], pa.string()), everything["f_sum"].combine_chunks().cast(pa.int64())],
                            ["lang", "words", "phrase", "f"],
                        )
                    yield pa.RecordBatch.from_arrays(
                        [
                            own.take(pa.array(text_of)),
                            pa.array(np.full(len(n), size, np.int32)),
                            phrase.cast(pa.string()),
                            pa.array(n.astype(np.int64)),
                        ],
                        ["lang", "words", "phrase", "f"],
                    )

    found = docs.select(F.col("lang").cast("string").alias("lang"), "text").mapInArrow(count, COUNTS)
    summed = found.groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f"))
    return materialize(summed.filter((F.col("f") >= least) | (F.col("words") == 0)), "phrase_counts")


def missed(found: DataFrame, known: Known, longest: int) -> DataFrame:
    """Frequent phrases outside the set that can be part of a longer one."""
    shared = found.sparkSession.sparkContext.broadcast(known)

    def outside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = ~shared.value.has(phrase_hashes(batch["lang"], batch["phrase"]))
            yield batch.filter(pa.array(keep))

    parts = proper_parts(found, longest)
    return parts.mapInArrow(outside, parts.schema)


def union(tables: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), tables)


def proper_parts(found: DataFrame, longest: int) -> DataFrame:
    return found.filter((F.col("words") > 0) & (F.col("words") < longest)).select("lang", "words", "phrase")


def frequent(
    docs: DataFrame, least: int, proposed: DataFrame | None = None, longest: int = LONGEST, ahead: bool = True
) -> tuple[DataFrame, int]:
    """All phrases that come at least ``least`` times, with their counts, and how many passes it took.

    ``ahead``: the second pass counts all extensions of what the proposal missed at once, and is the last. Without it, and
    without a proposal, phrases are mined length by length.
    """
    inside = [] if proposed is None else [proposed]
    old, new = None, Known() if proposed is None else filter_of(proposed)
    found = []
    while True:
        found.append(counts(docs, old, new, least, longest, ahead and old is not None))
        if (ahead and old is not None) or not missed(found[-1], new, longest).limit(1).count():
            return union(found), len(found)
        # All that was found, not only what was missed: the next filter must not lose what this one let through by chance.
        inside.append(proper_parts(found[-1], longest))
        old, new = new, filter_of(union(inside))


def sampled(docs: DataFrame, every: int) -> DataFrame:
    if every <= 1:
        return docs
    return docs.filter(F.pmod(F.xxhash64(*[c for c in ("doc_id", "lang", "text") if c in docs.columns]), F.lit(every)) == 0)


def frequent_phrases(docs: DataFrame, least: int = LEAST, sample_every: int = SAMPLE_EVERY) -> tuple[DataFrame, int]:
    """All frequent phrases and the number of passes over all documents."""
    lowered = max(1, int(least / sample_every * SLACK))
    sample = materialize(sampled(docs, sample_every).select("lang", "text"), "phrase_sample")
    proposed, _ = frequent(sample, lowered, longest=LONGEST - 1, ahead=False)
    return frequent(docs, least, proper_parts(proposed, LONGEST))


# --- scores --------------------------------------------------------------------------------------


def cut_scores(counted: DataFrame) -> DataFrame:
    """Candidates with the counts of both parts at their worst cut, and the score there."""
    phrases = counted.filter(F.col("words") > 1)
    cuts = phrases.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).withColumns(
        {
            "head": F.expr("substring_index(phrase, ' ', k)"),
            "tail": F.expr("substring_index(phrase, ' ', k - words)"),
        }
    )
    part = counted.filter(F.col("words") > 0).select("lang", "phrase", "f")
    heads, tails = part.toDF("lang", "head", "l"), part.toDF("lang", "tail", "r")
    scored = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    # The product passes 64 bits; decimals are exact.
    product = F.col("f").cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(8,0)")
    score = F.call_function("div", product, F.col("l").cast("decimal(20,0)") + F.col("r").cast("decimal(20,0)"))
    scored = scored.withColumn("score", score.cast("bigint"))
    worst = F.min(F.struct("score", "k", "l", "r")).alias("worst")
    return scored.groupBy("lang", "words", "phrase", F.col("f").alias("a")).agg(worst).select(
        "lang", "words", "phrase", "a", "worst.l", "worst.r", "worst.score"
    )


def contained(candidates: DataFrame) -> DataFrame:
    """(lang, phrase, inside): the greatest count of a longer candidate that holds the phrase."""
    longer_ones = candidates.filter(F.col("words") > 2).select("lang", "words", F.col("f"), F.split("phrase", " ").alias("w"))
    spans = F.expr(
        "explode(flatten(transform(sequence(2, words - 1), n -> transform(sequence(1, words - n + 1), i -> array_join(slice(w, i, n), ' ')))))"
    )
    return longer_ones.select("lang", "f", spans.alias("phrase")).groupBy("lang", "phrase").agg(F.max("f").alias("inside"))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, sample_every: int = SAMPLE_EVERY) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    found, _ = frequent_phrases(docs, least, sample_every)
    totals = found.filter(F.col("words") == 0).select("lang", F.col("f").alias("n"))
    candidates = found.filter(F.col("words") > 1)
    kept = cut_scores(found).join(contained(candidates), ["lang", "phrase"], "left")
    kept = kept.filter(F.col("inside").isNull() | (F.lit(100) * F.col("inside") < F.lit(CONTAINED) * F.col("a")))
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    share = F.pmod(F.xxhash64("phrase"), F.lit(RANK_SHARES))
    in_share = F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))
    first = kept.withColumn("share", share).withColumn("rank", in_share).filter(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


# --- the same in SQL, for comparison -------------------------------------------------------------

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def collocation_sql(least: int = LEAST, top: int = TOP) -> str:
    """All phrases of one to four words counted at once."""
    lines = "regexp_split_to_array(translate(coalesce(text, ''), '{}', '{}'), '[.,;:!?\\x0A-\\x0D]')".format(UPPER, LOWER)
    sizes = " UNION ALL ".join(
        f"SELECT lang, {k} AS words, unnest([array_to_string(w[i : i + {k - 1}], ' ') for i in range(1, len(w) - {k - 2})]) AS phrase FROM pieces"
        for k in range(1, LONGEST + 1)
    )
    return f"""WITH lines AS (SELECT coalesce(lang, '{NO_LANG}') AS lang, unnest({lines}) AS line FROM documents),
pieces AS (SELECT lang, regexp_extract_all(line, '[^\\x20\\x09]+') AS w FROM lines),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY 1),
counted AS MATERIALIZED (SELECT lang, words, phrase, count(*) AS f FROM ({sizes}) GROUP BY ALL HAVING count(*) >= {least}),
split AS (SELECT lang, phrase, words, f, string_split(phrase, ' ') AS w FROM counted WHERE words > 1),
cuts AS (SELECT *, unnest(range(1, words)) AS k FROM split),
scored AS (
  SELECT c.lang, c.phrase, c.words, c.f AS a, c.k, x.f AS l, y.f AS r,
         CAST(CAST({SCALE} AS HUGEINT) * c.f // (x.f + y.f) AS BIGINT) AS score
  FROM cuts c JOIN counted x ON x.lang = c.lang AND x.phrase = array_to_string(w[1 : k], ' ')
              JOIN counted y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1 :], ' ')),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
spans AS (SELECT lang, f, w, words, unnest(range(2, words)) AS size FROM split),
inner_spans AS (SELECT lang, f, w, size, unnest(range(1, words - size + 2)) AS i FROM spans),
held AS (SELECT lang, array_to_string(w[i : i + size - 1], ' ') AS phrase, max(f) AS inside FROM inner_spans GROUP BY 1, 2),
kept AS (SELECT w.* FROM worst w LEFT JOIN held h USING (lang, phrase) WHERE h.inside IS NULL OR 100 * h.inside < {CONTAINED} * w.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= {top}"""
