"""Groups of spelling variants: words one edit apart, by k-d trees over letter counts.

A word becomes the vector of its letter counts. One replaced letter moves the vector by at most 2 in L1, one inserted or deleted letter by
exactly 1, so near words lie in small boxes around each other. Words of one length form a tree:

1. ``fit_cells`` splits each length's vectors at medians, on a bounded sample, into cells; only the evenness of cells depends on the sample.
2. Every word is stored in the one cell that holds its vector, and asks the other cells that a ball around it reaches: for its own length
   those with a greater number (radius 2), for the next length all of them (radius 1). So every near pair meets exactly once.
3. Per cell, a k-d tree over the stored words is walked by all asking words together. A box is left out when the offsets to the planes crossed on
   the way add up to more than the radius. At the leaves counts are compared as bit sets, then whole words: letter order decides.

A word's near words are then reduced to their number and the most frequent one. Forms are followed to their root by pointer jumping; as a
form has at least twice the count of its word, chains are short and have no cycles.

Costs: a word crosses at most 2 planes of the tree, so it asks a number of cells that grows with the square of a logarithm. Words
of equal letter counts in another order are never near each other and are not paired. Cells hold ``CELL_WORDS`` words at even
splits; only pairs that pass the count test are compared, in bounded steps, and only sums leave a cell.

Defined results: a null text has no words; a null id counts as an empty text in ``<id>:<run>``; an empty table gives no rows. Repeated
rows count as often as they come. Other columns are not used.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanspark.operators.tables import materialize

MIN_LETTERS, MIN_COUNT, TIMES = 5, 3, 2
TYPO_EVERY = 97
RUN = "([A-Za-z\\u00C0-\\u00FF]+)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Letters as Latin-1 bytes: a-z, then 0xC0 to 0xFF.
DIMENSIONS = 26 + 64
_DIMENSION = np.full(256, -1, np.int64)
_DIMENSION[97:123] = np.arange(26)
_DIMENSION[0xC0:] = np.arange(26, DIMENSIONS)

CELL_WORDS = 8_192
CELL_LETTERS = 1 << 20
SAMPLE_WORDS = 100_000
SAMPLE_LETTERS = 256
LEAF_WORDS = 24
PAIR_LETTERS = 1 << 22
SEED = 13

Node = tuple  # (dimension, bound, low side, high side) or a cell number


# --- words ---------------------------------------------------------------------------------------


def word_counts(docs: DataFrame, typo_every: int = TYPO_EVERY, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """Words of whole texts and how often they come: runs of letters in lower case, one in ``typo_every`` short of a letter by a hash."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN))).alias("run"))
    runs = runs.select("doc_id", F.translate("run", UPPER, LOWER).alias("run")).filter(F.char_length("run") >= min_letters)
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    hashed = runs.select("run", F.crc32(named.cast("binary")).alias("h"))
    at = F.pmod("h", F.char_length("run")).cast("int")
    shorter = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
    words = hashed.select(F.when(F.pmod("h", F.lit(typo_every)) == 0, shorter).otherwise(F.col("run")).alias("word"))
    counted = words.filter(F.char_length("word") >= min_letters).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= min_count)


def letters_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All letters as bytes, and the bounds of each word."""
    bounds = np.concatenate([[0], np.cumsum([len(w) for w in words], dtype=np.int64)])
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8), bounds


def count_vectors(words: list[str]) -> np.ndarray:
    """Words x letters."""
    letters, bounds = letters_of(words)
    row = np.repeat(np.arange(len(words)), np.diff(bounds))
    counts = np.bincount(row * DIMENSIONS + _DIMENSION[letters], minlength=len(words) * DIMENSIONS)
    return counts.reshape(len(words), DIMENSIONS).astype(np.int32)


# --- trees ---------------------------------------------------------------------------------------


def best_split(vectors: np.ndarray) -> tuple[int, int] | None:
    """Dimension and bound that halve the vectors best; the low side has at most ``bound`` of the letter. None if all are equal."""
    n = len(vectors)
    best, off = None, n
    for bound in range(3):
        below = (vectors <= bound).sum(axis=0)
        uneven = np.where((below > 0) & (below < n), np.abs(2 * below - n), n)
        d = int(uneven.argmin())
        if uneven[d] < off:
            best, off = (d, bound), int(uneven[d])
    if best is None or off > n * 3 // 4:
        # Long words have many of each letter: take the middle of the widest dimension as well.
        d = int((vectors.max(axis=0) - vectors.min(axis=0)).argmax())
        bound = int(np.sort(vectors[:, d])[(n - 1) // 2])
        bound = min(bound, int(vectors[:, d].max()) - 1)
        if bound >= vectors[:, d].min():
            below = int((vectors[:, d] <= bound).sum())
            if abs(2 * below - n) < off:
                best = (d, bound)
    return best


def grow(vectors: np.ndarray, cells: int, numbers: Iterator[int]) -> Node | int:
    """A tree of about ``cells`` cells, numbered from left to right."""
    split = best_split(vectors) if cells > 1 and len(vectors) > 1 else None
    if split is None:
        return next(numbers)
    low = vectors[:, split[0]] <= split[1]
    share = max(1, min(cells - 1, round(cells * low.mean())))
    return (*split, grow(vectors[low], share, numbers), grow(vectors[~low], cells - share, numbers))


def n_cells(tree: Node | int) -> int:
    return n_cells(tree[2]) + n_cells(tree[3]) if isinstance(tree, tuple) else 1


def reached(tree: Node | int, vectors: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each cell the rows whose ball reaches its box. The way down keeps, per row, the offset in each dimension crossed."""

    def walk(node, rows: np.ndarray, spent: np.ndarray, crossed: dict[int, np.ndarray]):
        if not len(rows):
            return
        if not isinstance(node, tuple):
            yield node, rows
            return
        d, bound, low, high = node
        value = vectors[rows, d]
        before = crossed.get(d, np.zeros(len(rows), np.int64))
        for side, offset in ((low, np.maximum(value - bound, 0)), (high, np.maximum(bound + 1 - value, 0))):
            # Offsets in one dimension do not add up: the greater one holds.
            offset = np.maximum(offset, before)
            total = spent - before + offset
            near = total <= radius
            kept = {k: v[near] for k, v in crossed.items()}
            kept[d] = offset[near]
            yield from walk(side, rows[near], total[near], kept)

    yield from walk(tree, np.arange(len(vectors)), np.zeros(len(vectors), np.int64), {})


def fit_cells(words: DataFrame, cell_words: int = CELL_WORDS, sample_words: int = SAMPLE_WORDS) -> dict[int, Node]:
    """A tree of cells for every length with more than one cell, from at most ``sample_words`` words."""
    lengths = words.filter(F.char_length("word") <= SAMPLE_LETTERS).groupBy(F.char_length("word").alias("length")).agg(F.count("*").alias("n"))
    size = lambda length: min(cell_words, CELL_LETTERS // length + 1)
    # At most SAMPLE_LETTERS rows; longer words are few and go by their length alone.
    wanted = {r["length"]: r["n"] for r in lengths.collect() if r["n"] > size(r["length"])}
    if not wanted:
        return {}
    share = min(1.0, sample_words / sum(wanted.values()))
    drawn = words.filter(F.char_length("word").isin(*wanted)).filter(
        F.pmod(F.xxhash64("word", F.lit(SEED)), F.lit(1 << 30)) < int(share * (1 << 30))
    )
    by_length: dict[int, list[str]] = defaultdict(list)
    for row in drawn.select("word").limit(2 * sample_words).toLocalIterator():
        by_length[len(row["word"])].append(row["word"])
    trees = {}
    for length, sample in by_length.items():
        cells = min(-(-wanted[length] // size(length)), len(sample) // 4)
        if cells > 1:
            numbers = iter(range(1 << 62))
            trees[length] = grow(count_vectors(sorted(sample)), cells, numbers)
    return trees


# --- pairs ---------------------------------------------------------------------------------------

STORED, SAME_LENGTH, SHORTER = 0, 1, 2
ROUTED = "length int, cell bigint, kind int, word string, n bigint"
PARTIAL = "word string, n_near bigint, near_n bigint, near_word string"


def route(batch: pa.RecordBatch, trees: dict[int, Node]) -> Iterator[dict]:
    """A batch's words to the cells where they are stored or ask."""
    words, counts = batch["word"].to_pylist(), batch["n"].to_numpy(zero_copy_only=False)
    by_length: dict[int, list[int]] = defaultdict(list)
    for i, word in enumerate(words):
        by_length[len(word)].append(i)
    for length, rows in by_length.items():
        index = np.array(rows)
        own, longer = trees.get(length, 0), trees.get(length + 1, 0)
        vectors = count_vectors([words[i] for i in rows]) if own or longer else np.zeros((len(rows), 1), np.int32)
        home = np.zeros(len(rows), np.int64)
        for cell, inside in reached(own, vectors, 0):
            home[inside] = cell
        asks = [(length, cell, SAME_LENGTH, at[home[at] < cell]) for cell, at in reached(own, vectors, 2)]
        asks += [(length + 1, cell, SHORTER, at) for cell, at in reached(longer, vectors, 1)]
        for cell in np.unique(home):
            asks.append((length, int(cell), STORED, np.flatnonzero(home == cell)))
        for its_length, cell, kind, at in asks:
            if len(at):
                yield {
                    "length": np.full(len(at), its_length, np.int32),
                    "cell": np.full(len(at), cell, np.int64),
                    "kind": np.full(len(at), kind, np.int32),
                    "word": [words[i] for i in index[at]],
                    "n": counts[index[at]],
                }


def _bits(vectors: np.ndarray) -> np.ndarray:
    """Counts as bit sets, one bit each for at least one and at least two of a letter: the number of different bits bounds the distance from below."""
    flags = np.concatenate([vectors >= 1, vectors >= 2], axis=1)
    padded = np.zeros((len(vectors), 192), bool)
    padded[:, : flags.shape[1]] = flags
    return np.packbits(padded, axis=1).view(np.uint64)


class Cell:
    """The stored words of a cell, of one length, with their tree."""

    def __init__(self, length: int, words: list[str], counts: np.ndarray):
        self.length, self.words, self.counts = length, words, counts
        self.letters = letters_of(words)[0].reshape(len(words), length)
        self.rank = _ranks(words)
        vectors = count_vectors(words)
        self.bits, self.leaves = _bits(vectors), []
        self.tree = self._grow(vectors, np.arange(len(words)))
        self.vectors = vectors

    def _grow(self, vectors: np.ndarray, rows: np.ndarray) -> Node | int:
        split = best_split(vectors[rows]) if len(rows) > LEAF_WORDS else None
        if split is None:
            self.leaves.append(rows)
            return len(self.leaves) - 1
        low = vectors[rows, split[0]] <= split[1]
        return (*split, self._grow(vectors, rows[low]), self._grow(vectors, rows[~low]))

    def pairs(self, asking: list[str], radius: int, inside: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(asking, stored) rows one edit apart; ``inside`` asks for the pairs among the stored words, each once."""
        vectors = self.vectors if inside else count_vectors(asking)
        bits = self.bits if inside else _bits(vectors)
        letters = self.letters if inside else letters_of(asking)[0].reshape(len(asking), -1)
        found = []
        for leaf, rows in reached(self.tree, vectors, radius):
            stored = self.leaves[leaf]
            step = max(1, PAIR_LETTERS // (8 * len(stored)))
            for start in range(0, len(rows), step):
                part = rows[start : start + step]
                apart = np.bitwise_count(bits[part][:, None, :] ^ self.bits[stored][None, :, :]).sum(axis=2, dtype=np.uint8)
                i, j = np.nonzero(apart <= radius)
                i, j = part[i], stored[j]
                if inside:
                    i, j = i[i < j], j[i < j]
                found.extend(self._one_edit(i, j, letters))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return tuple(np.concatenate(side) for side in zip(*found))

    def _one_edit(self, i: np.ndarray, j: np.ndarray, letters: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Those pairs whose letters, in order, differ by one edit."""
        step = max(1, PAIR_LETTERS // self.length)
        for start in range(0, len(i), step):
            a, b = i[start : start + step], j[start : start + step]
            short, whole = letters[a], self.letters[b]
            if short.shape[1] == self.length:
                near = (short != whole).sum(axis=1) == 1
            else:
                ahead = np.logical_and.accumulate(short == whole[:, :-1], axis=1).sum(axis=1)
                behind = np.logical_and.accumulate((short == whole[:, 1:])[:, ::-1], axis=1).sum(axis=1)
                near = ahead + behind >= self.length - 1
            yield a[near], b[near]


def _ranks(words: list[str]) -> np.ndarray:
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    return rank


def _summary(at: np.ndarray, other: np.ndarray, words: list[str], others: list[str], counts: np.ndarray, rank: np.ndarray) -> dict:
    """Per word: how many near words this step found, and the most frequent of them, the first in code-point order."""
    order = np.lexsort((rank[other], -counts[other], at))
    at, other = at[order], other[order]
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    sizes = np.diff(np.concatenate([first, [len(at)]]))
    return {
        "word": [words[i] for i in at[first]],
        "n_near": sizes.astype(np.int64),
        "near_n": counts[other[first]].astype(np.int64),
        "near_word": [others[i] for i in other[first]],
    }


def search(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Near words of rows that come sorted by (length, cell, kind): stored words of a cell first, then those that ask."""
    key, stored, counts, cell = None, [], [], None

    def build() -> Iterator[dict]:
        nonlocal cell
        cell = Cell(key[0], stored, np.concatenate(counts))
        i, j = cell.pairs([], 2, inside=True)
        if len(i):
            both = np.concatenate([i, j]), np.concatenate([j, i])
            yield _summary(*both, stored, stored, cell.counts, cell.rank)

    for batch in batches:
        lengths, cells, kinds = (batch[c].to_numpy(zero_copy_only=False) for c in ("length", "cell", "kind"))
        words, n = batch["word"].to_pylist(), batch["n"].to_numpy(zero_copy_only=False)
        changes = np.flatnonzero((np.diff(lengths) != 0) | (np.diff(cells) != 0) | (np.diff(kinds) != 0)) + 1
        for low, high in zip([0, *changes], [*changes, len(words)]):
            if low == high:
                continue
            its_key, kind = (int(lengths[low]), int(cells[low])), kinds[low]
            if its_key != key:
                if stored and cell is None:
                    yield from build()
                key, stored, counts, cell = its_key, [], [], None
            if kind == STORED:
                stored.extend(words[low:high])
                counts.append(n[low:high])
                continue
            if not stored:
                continue  # nobody lives in this cell
            if cell is None:
                yield from build()
            asking, its_n = words[low:high], n[low:high]
            i, j = cell.pairs(asking, 2 if kind == SAME_LENGTH else 1)
            if len(i):
                yield _summary(i, j, asking, stored, cell.counts, cell.rank)
                yield _summary(j, i, stored, asking, its_n, _ranks(asking))
    if stored and cell is None:
        yield from build()


def near_words(words: DataFrame, cell_words: int = CELL_WORDS) -> DataFrame:
    """Per word with near words: their number, the count of the most frequent and that word."""
    fitted = fit_cells(words, cell_words)  # at most SAMPLE_WORDS / 4 cells
    trees = words.sparkSession.sparkContext.broadcast(fitted)
    tasks = max(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2 * sum(map(n_cells, fitted.values())))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in route(batch, trees.value):
                yield pa.RecordBatch.from_pydict(rows)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in search(batches):
            yield pa.RecordBatch.from_pydict(rows)

    routed = words.mapInArrow(spread, ROUTED)
    partial = routed.repartition(tasks, "length", "cell").sortWithinPartitions("length", "cell", "kind").mapInArrow(found, PARTIAL)
    best = F.min(F.struct((-F.col("near_n")).alias("order"), F.col("near_word").alias("near_word")))
    summed = partial.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return summed.select("word", "n_near", (-F.col("best.order")).alias("near_n"), F.col("best.near_word").alias("near_word"))


# --- forms ---------------------------------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words that have a form: each step doubles the length of the way behind."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "spelling_roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = materialize(now.join(further, "root", "left").select("word", "root", "next"), "spelling_roots")
        if not joined.filter("next IS NOT NULL").limit(1).count():
            return now
        now = joined.select("word", F.coalesce("next", "root").alias("root"))


def spelling_groups(docs: DataFrame, cell_words: int = CELL_WORDS) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = materialize(word_counts(docs), "spelling_words")
    near = near_words(words, cell_words)
    has_form = F.col("near_n") >= TIMES * F.col("n")
    table = words.join(near, "word", "left").select(
        "word",
        F.when(has_form, F.col("near_word")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(has_form, F.col("near_n")).alias("form_n"),
    )
    table = materialize(table, "spelling_forms")
    followed = table.join(roots(table.filter("form IS NOT NULL")), "word", "left")
    return followed.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


# --- the same in SQL, for comparison -------------------------------------------------------------


def spelling_sql(crc32_sql) -> str:
    """Near words by deleting each letter in turn; roots by recursion."""
    return f"""WITH RECURSIVE runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{UPPER}', '{LOWER}') AS run FROM documents),
hashed AS (SELECT run, {crc32_sql("encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)")} AS h FROM runs),
typed AS (SELECT CASE WHEN h % {TYPO_EVERY} = 0 THEN run[1 : h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word FROM hashed),
words AS (SELECT word, count(*) AS n FROM typed WHERE length(word) >= {MIN_LETTERS} GROUP BY 1 HAVING count(*) >= {MIN_COUNT}),
holes AS (SELECT word, n, i, word[1 : i - 1] || word[i + 1 :] AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
links AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT h.word, w.word, w.n FROM holes h JOIN words w ON h.rest = w.word
  UNION SELECT w.word, h.word, h.n FROM holes h JOIN words w ON h.rest = w.word),
near AS (SELECT word, count(*) AS n_near, max(other_n) AS near_n FROM links GROUP BY 1),
best AS (SELECT word, n_near, near_n, min(other) AS near_word FROM near JOIN links USING (word) WHERE other_n = near_n GROUP BY ALL),
formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= {TIMES} * n THEN near_word END AS form,
         CASE WHEN near_n >= {TIMES} * n THEN near_n END AS form_n FROM words LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS root, form AS next FROM formed
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN formed f ON f.word = c.next)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM formed f JOIN chain c ON c.word = f.word AND c.next IS NULL"""
