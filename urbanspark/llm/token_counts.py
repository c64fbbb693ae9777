"""Token counts of fields and sections from one encoding of the whole document.

A document is its fields, joined by line feeds; a section is a line of a field, with the line feed that
ends it. The document is encoded once. Tokens of a byte-level vocabulary cover the text without gaps, so the
running sum of their byte lengths is their span, and a search in the sorted section bounds joins spans
and sections. A token that crosses a boundary goes to the section of its first byte (rule ``first``) or
to the one with most of its bytes, the earlier of equals (rule ``most``); every token is counted once.

Defined results: a null field is an empty one; a document without text has one empty section per field and no
tokens; repeated rows are counted each; an empty table gives no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COLUMNS = ["doc_id", "field", "section", "start", "end", "n_tokens", "n_crossing"]
SCHEMA = "doc_id bigint, field int, section int, start bigint, end bigint, n_tokens bigint, n_crossing bigint"


@cache
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        sizes[rank] = len(token)
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), sizes


def section_counts(fields: list[str], encoding, sizes: np.ndarray, rule: str) -> np.ndarray:
    """Rows (field, section, start, end, tokens, crossing tokens); spans in code points of the joined document."""
    whole = "\n".join(fields)
    data = np.frombuffer(whole.encode(), np.uint8)
    ends = np.flatnonzero(data == 0x0A) + 1
    bounds = np.concatenate([[0], ends, [len(data)]])
    lines = np.array([field.count("\n") + 1 for field in fields])
    field = np.repeat(np.arange(len(fields)), lines)
    section = np.arange(len(field)) - np.repeat(np.cumsum(lines) - lines, lines)

    length = sizes[np.array(encoding.encode_ordinary(whole), np.int64)]
    stop = np.cumsum(length)
    start = stop - length
    first = np.searchsorted(bounds[1:-1], start, "right")
    last = np.searchsorted(bounds[1:-1], stop - 1, "right")
    owner = first
    crossing = np.flatnonzero(first != last)
    if rule == "most" and len(crossing):
        owner = first.copy()
        for i in crossing.tolist():
            sections = np.arange(first[i], last[i] + 1)
            covered = np.minimum(bounds[sections + 1], stop[i]) - np.maximum(bounds[sections], start[i])
            owner[i] = sections[np.argmax(covered)]
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[bounds]
    n = len(field)
    return np.stack(
        [field, section, points[:-1], points[1:], np.bincount(owner, minlength=n), np.bincount(owner[crossing], minlength=n)], axis=1
    )


def token_counts(docs: DataFrame, ranks: str, pattern: str, fields: tuple[str, ...] = ("text",), rule: str = "first") -> DataFrame:
    """One row per section; ``field`` is the place in ``fields``. ``ranks`` is a file of byte-level BPE ranks."""
    if rule not in ("first", "most"):
        raise ValueError(f"unknown rule {rule}")
    asked = docs.select("doc_id", *[F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f"field{i}") for i, f in enumerate(fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, sizes = _encoding(ranks, pattern)
        for batch in batches:
            doc_ids, found, rows = batch.column("doc_id"), [], []
            texts = [batch.column(i) for i in range(1, batch.num_columns)]
            for row in range(batch.num_rows):
                counts = section_counts([column[row].as_py() for column in texts], encoding, sizes, rule)
                found.append(counts)
                rows.append(np.full(len(counts), row))
            if found:
                counts = np.concatenate(found)
                kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
                columns = [doc_ids.take(pa.array(np.concatenate(rows)))]
                columns += [pa.array(counts[:, i]).cast(kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=COLUMNS)

    return asked.mapInArrow(run, SCHEMA)
