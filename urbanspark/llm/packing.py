"""Packing documents into sequences of a fixed number of tokens.

Only documents longer than a sequence are cut, into full pieces and a rest. Pieces are packed best-fit
decreasing: the longest first, each into the open sequence with the least room that still takes it,
found by a segment tree over remaining capacities in logarithmic time. Pieces are dealt into groups of bounded
size by a hash of their row number; sequences that a group leaves with room are opened again and their
pieces packed anew in the next level, with those of other groups, so the loss of many groups is that
of a few.

Tokens come from the given tokenizer file. Every run between ASCII white space is encoded on its own, which gives
the ids of the whole text because this tokenizer splits there and drops white space. Words of printable ASCII and
Latin-1 letters are split further into letters, digits and marks, as its pattern does, and merged in bulk;
all other words, and those that could hold a contraction or a special token, go through the full tokenizer.
A worker keeps the ids of the parts it has met.

Defined results: a null or empty text is the end token alone; repeated rows are packed each; a null id
stays null; an empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanspark.llm.words import SPACE, Slice, slices
from urbanspark.operators.tables import materialize, rows_a_batch

CAPACITY = 4096
END_ID = 1
GROUP_PIECES = 4096
LEVELS = 4
# A sequence with no more room than this share of its capacity is closed.
CLOSED_ROOM = 0.01
# Texts are encoded in slices of this many bytes (a slice takes about 50 times as much while it is encoded); known parts
# are kept up to this number (32 bytes each).
ENCODE_BYTES = 1 << 20
KNOWN_PARTS = 2_000_000
# Rows that a task hands to Python at a time; by default 10,000 texts, or lists of ids, make one batch.
ROWS_A_BATCH = 1000

# Bytes by kind: what the tokenizer's own pattern keeps together. OTHER marks words for the full tokenizer.
BLANK, LETTER, DIGIT, MARK, OTHER = range(5)


def _kinds() -> np.ndarray:
    kinds = np.full(256, OTHER, np.uint8)
    kinds[SPACE] = BLANK
    kinds[0x21:0x7F] = MARK
    kinds[0x30:0x3A] = DIGIT
    kinds[0x41:0x5B] = kinds[0x61:0x7B] = LETTER
    kinds[0xC3] = kinds[0x80:0xC0] = LETTER  # Latin-1 letters; other first bytes stay OTHER
    kinds[ord("'")] = OTHER  # may begin a contraction
    return kinds


def _lower() -> np.ndarray:
    lower = np.arange(256, dtype=np.uint8)
    lower[0x41:0x5B] += 32
    lower[0x80:0x9F] += 32  # second bytes of capital Latin-1 letters
    return lower


KINDS, LOWER = _kinds(), _lower()
WHOLE_WORD = np.uint64(0x5851F42D4C957F2D)


class WordEncoder:
    """Ids of texts, with a memory of bounded size for the parts that were met before."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.full = Tokenizer.from_file(path)
        # The same merges for parts that are already lower-case and split.
        self.parts = Tokenizer.from_file(path)
        self.parts.normalizer = None
        self.parts.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary = self.full.get_vocab()
        self.ends_part = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_part[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.keys = np.empty(0, np.uint64)
        self.starts, self.counts = np.empty(0, np.int64), np.empty(0, np.int32)
        self.ids = np.empty(0, np.int32)

    def _by_itself(self, text: str) -> np.ndarray:
        return np.array(self.full.encode(text, add_special_tokens=False).ids, np.int32)

    def _new_ids(self, texts: list[str], whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of ids per text. ``whole`` marks words for the full tokenizer."""
        found = {i: self._by_itself(texts[i]) for i in np.flatnonzero(whole).tolist()}
        parts = [texts[i] for i in np.flatnonzero(~whole).tolist()]
        ids = np.array(self.parts.encode(" ".join(parts).lower(), add_special_tokens=False).ids, np.int32) if parts else self.ids[:0]
        ends = np.flatnonzero(self.ends_part[ids]) + 1
        if len(ends) != len(parts):  # a part without an end of its own: take them one by one
            split = [self._by_itself(part) for part in parts]
            ids, ends = np.concatenate(split), np.cumsum([len(own) for own in split])
        counts = np.zeros(len(texts), np.int32)
        counts[~whole] = np.diff(ends, prepend=0)
        if not found:
            return ids, counts
        counts[list(found)] = [len(own) for own in found.values()]
        split = iter(np.split(ids, ends[:-1]))
        return np.concatenate([found[i] if i in found else next(split) for i in range(len(texts))]), counts

    @staticmethod
    def units(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends, hashes and kind of what is encoded by itself.

        That is a run of letters, a digit or a run of marks; or a whole word with other characters, or with
        a mark that could belong to a special token.
        """
        data, kind = part.data, KINDS[part.data]
        other = kind == OTHER
        second = (data == 0x97) | (data == 0xB7)  # the two Latin-1 signs among the letters
        other[1:] |= (second[1:] & (data[:-1] == 0xC3)) | ((data[1:] == ord("|")) & (data[:-1] == ord("<")))
        seen = np.concatenate([[0], np.cumsum(other)])
        whole_word = seen[part.ends] > seen[part.starts]
        begins = np.zeros(len(data), bool)
        begins[part.starts] = True
        inside = np.zeros(len(data), bool)
        inside[kind != BLANK] = np.repeat(~whole_word, part.ends - part.starts)
        begins[1:] |= inside[1:] & ((kind[1:] != kind[:-1]) | (kind[1:] == DIGIT))
        starts = np.flatnonzero(begins)
        word = np.searchsorted(part.starts, starts, "right") - 1
        ends = np.minimum(np.append(starts[1:], len(data)), part.ends[word])
        whole = whole_word[word]
        lower = Slice(part.low, LOWER[data], part.bounds, part)
        hashes = lower.run_hashes(starts, ends, False)
        if whole.any():
            hashes[whole] = part.run_hashes(starts[whole], ends[whole], False) ^ WHOLE_WORD
        return starts, ends, hashes, whole

    def encode(self, part: Slice) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a slice, and the edges of each text's ids."""
        if not len(part.starts):
            return np.empty(0, np.int32), np.zeros(len(part.edges), np.int64)
        starts, ends, hashes, whole = self.units(part)
        unique, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) + len(unique) > KNOWN_PARTS:
            self.forget()
        at = np.searchsorted(self.keys, unique)
        known = np.zeros(len(unique), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == unique[inside]
        if not known.all():
            new = first[~known]
            raw = part.data.tobytes()
            texts = [raw[a:b].decode() for a, b in zip(starts[new].tolist(), ends[new].tolist())]
            ids, counts = self._new_ids(texts, whole[new])
            begin = len(self.ids) + np.cumsum(counts, dtype=np.int64) - counts
            where = at[~known]
            self.keys = np.insert(self.keys, where, unique[~known])
            self.starts, self.counts = np.insert(self.starts, where, begin), np.insert(self.counts, where, counts)
            self.ids = np.concatenate([self.ids, ids])
            at = np.searchsorted(self.keys, unique)
        unit = at[inverse]
        counts = self.counts[unit]
        edges = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        ids = self.ids[np.repeat(self.starts[unit] - edges[:-1], counts) + np.arange(edges[-1])]
        return ids, edges[np.searchsorted(starts, part.bounds)]


@cache
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def document_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked for, the ids themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for part in slices(batch.column("text"), ENCODE_BYTES):
                ids, edges = encoder.encode(part)
                rows, kept = [], []
                for i, (low, high) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
                    whole = np.append(ids[low:high], END_ID).astype("<u4")
                    for piece, start in enumerate(range(0, len(whole), capacity)):
                        own = whole[start : start + capacity]
                        rows.append((doc_ids[part.low + i], piece, start, len(own), zlib.crc32(own)))
                        kept.append(own.tolist() if keep_ids else None)
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    columns, names = [*columns, pa.array(kept, pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select("doc_id", "text").mapInArrow(run, PIECE + (", ids array<int>" if keep_ids else ""))


class OpenSequences:
    """Sequences by remaining room, in a segment tree that knows which amounts of room occur."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.occurs = bytearray(2 * self.leaves)
        self.by_room: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, sequence: int) -> None:
        self.by_room[room].append(sequence)
        node = self.leaves + room
        while node and not self.occurs[node]:
            self.occurs[node] = 1
            node >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """Remove the sequence with the least room of at least ``length``."""
        occurs, node = self.occurs, self.leaves + length
        if not occurs[node]:
            while node > 1 and not (node & 1 == 0 and occurs[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if occurs[2 * node] else 2 * node + 1
        room = node - self.leaves
        sequence = self.by_room[room].pop()
        if not self.by_room[room]:
            occurs[node] = 0
            node >>= 1
            while node and not (occurs[2 * node] or occurs[2 * node + 1]):
                occurs[node] = 0
                node >>= 1
        return room, sequence


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence and offset of each piece, and the room left in each sequence. Ties keep their order."""
    sequence_of, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_, rooms = OpenSequences(capacity), []
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        found = open_.take(length)
        if found is None:
            found = (capacity, len(rooms))
            rooms.append(capacity)
        room, sequence = found
        sequence_of[i], offset[i] = sequence, capacity - room
        rooms[sequence] = room - length
        if room > length:
            open_.add(room - length, sequence)
    return sequence_of, offset, np.array(rooms, np.int64)


def _pack_level(pieces: DataFrame, level: int, groups: int, capacity: int, last: bool) -> DataFrame:
    columns = pieces.columns

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("row")
        sequence, offset, rooms = best_fit_decreasing(table["length"].to_numpy(), capacity)
        group = table["pack_group"][0].as_py()
        closed = np.full(len(rooms), True) if last else rooms <= capacity * CLOSED_ROOM
        table = table.drop_columns(["pack_group"])
        table = table.append_column("sequence_id", pa.array((level * (1 << 40) + group) * (1 << 20) + sequence))
        return table.append_column("offset", pa.array(offset)).append_column("closed", pa.array(closed[sequence]))

    kinds = dict(pieces.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in columns) + ", sequence_id bigint, offset bigint, closed boolean"
    dealt = pieces.withColumn("pack_group", F.pmod(F.xxhash64(F.lit(level), "row"), F.lit(groups)))
    return materialize(dealt.groupBy("pack_group").applyInArrow(run, schema), "packed")


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset; any columns beside ``length`` are carried along."""
    columns = pieces.columns
    rest = materialize(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    left, done = rest.count(), []
    for level in range(LEVELS):
        groups = max(1, math.ceil(left / GROUP_PIECES))
        last = groups == 1 or level == LEVELS - 1
        packed = _pack_level(rest, level, groups, capacity, last)
        before, left = left, 0 if last else packed.filter("NOT closed").count()
        if last or left > before / 2:  # opening most sequences again would not fill them better
            done.append(packed)
            break
        done.append(packed.filter("closed"))
        rest = packed.filter("NOT closed").drop("sequence_id", "offset", "closed")
        if not left:
            break
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result.select(*[F.col(f"`{c}`") for c in columns], "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids) of every piece."""
    with rows_a_batch(docs.sparkSession, ROWS_A_BATCH):
        return pack_pieces(document_pieces(docs, tokenizer, capacity, keep_ids), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The token sequences themselves: sequence_id and its ids, from pieces packed with their ids."""
    in_order = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(in_order, lambda p: p["ids"])).alias("ids"))
