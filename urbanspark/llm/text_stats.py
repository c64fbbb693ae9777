"""Counts of whole texts that the quality rules and the quality classifier share.

Everything is computed per slice of texts in numpy; equality of lines and of word windows is equality
of 64-bit hashes. A null text counts as an empty one, whose counts are all 0.
"""

from __future__ import annotations

import numpy as np

from urbanspark.llm.words import Slice, mix, windows

SYMBOLS = b"#*$%&|<>"
CLASSES = ["lower", "upper", "digit", "space", "line_end", "symbol", "stop", "other", "letter"]

# Frequent function words of the four languages, plain.
COMMON_WORDS = {
    "en": "the of and a to in is it that was for on are with as at be by from or an this have not".split(),
    "fr": "le la les de des du et un une en que qui dans est par pour pas au aux sur avec il ne se".split(),
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an er".split(),
    "es": "el la los de que y en un las se del por con no una su para es al lo como más o pero".split(),
}
WORD_LIST = sorted({word for words in COMMON_WORDS.values() for word in words})


def _class_table() -> np.ndarray:
    table = np.full(256, CLASSES.index("other"), np.uint8)
    table[97:123] = CLASSES.index("lower")
    table[65:91] = CLASSES.index("upper")
    table[48:58] = CLASSES.index("digit")
    table[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = CLASSES.index("space")
    table[0x0A] = CLASSES.index("line_end")
    table[list(SYMBOLS)] = CLASSES.index("symbol")
    table[list(b".,;:!?'\"-()")] = CLASSES.index("stop")
    table[0xC0:] = CLASSES.index("letter")
    return table


CLASS_OF = _class_table()
NOT_WORD = np.ones(256, bool)
NOT_WORD[48:58] = NOT_WORD[65:91] = NOT_WORD[97:123] = NOT_WORD[0x80:] = False
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_FIRST_BYTE = np.ones(256, bool)
_FIRST_BYTE[0x80:0xC0] = False
_WORD_POINT = _FIRST_BYTE.copy()
_WORD_POINT[[0x20, *range(0x09, 0x0E)]] = False


def _word_table() -> tuple[np.ndarray, np.ndarray]:
    data = " ".join(WORD_LIST).encode()
    whole = Slice(0, np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    hashes = whole.hashes(True)
    order = np.argsort(hashes)
    return hashes[order], order


_WORD_HASHES, _WORD_INDEX = _word_table()


def _own(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Hashes that differ between texts."""
    return mix(hashes + mix(text.astype(np.uint64) + np.uint64(1)))


def text_counts(part: Slice) -> dict[str, np.ndarray]:
    """One value per text for each count."""
    n = len(part.edges) - 1
    rows = np.arange(n)
    words = np.diff(part.edges)
    hashes, text = part.hashes(False), np.repeat(rows, words)

    # Lines end before each line feed and at the end of the text.
    feeds = np.flatnonzero(part.data == 0x0A)
    line_ends = np.sort(np.concatenate([feeds, part.bounds[1:]]))
    of_text = np.searchsorted(part.bounds[1:], np.sort(feeds), "right")
    line_text = np.sort(np.concatenate([of_text, rows]))
    line_starts = np.concatenate([[0], line_ends[:-1]])
    first_line = np.concatenate([[True], line_text[1:] != line_text[:-1]])
    line_starts = np.where(first_line, part.bounds[line_text], line_starts + 1)
    has_word = np.searchsorted(part.starts, line_starts) < np.searchsorted(part.starts, line_ends)
    line_text, line_starts, line_ends = line_text[has_word], line_starts[has_word], line_ends[has_word]
    lines = _own(part.run_hashes(line_starts, line_ends, False), line_text)
    _, once = np.unique(lines, return_index=True)
    n_lines = np.bincount(line_text, minlength=n)
    dup_lines = n_lines - np.bincount(line_text[once], minlength=n)

    triples, edges = windows(hashes, part.edges, 3)
    triple_text = np.repeat(rows, np.diff(edges))
    _, inverse, counts = np.unique(_own(triples, triple_text), return_inverse=True, return_counts=True)
    again = np.flatnonzero(counts[inverse] > 1)
    # The first word of window i of a text is as far from the text's first word as i from its first window.
    at = again + (part.edges[:-1] - edges[:-1])[triple_text[again]]
    covered = np.zeros(len(hashes) + 1, bool)
    for i in range(3):
        covered[at + i] = True
    repeat_words = np.bincount(text[covered[:-1]], minlength=n)

    _, distinct = np.unique(_own(hashes, text), return_index=True)
    same_as_last = np.concatenate([[False], (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])])[: len(hashes)]
    return {
        "n_words": words,
        "word_chars": part.sums(_WORD_POINT[part.data]),
        "n_symbols": part.sums(_SYMBOL[part.data]),
        "n_lines": n_lines,
        "n_dup_lines": dup_lines,
        "n_repeat_words": repeat_words,
        "n_distinct_words": np.bincount(text[distinct], minlength=n),
        "n_same_as_last": np.bincount(text[same_as_last], minlength=n),
    }


def class_counts(part: Slice) -> np.ndarray:
    """Texts x character classes; a character outside ASCII counts once, as a letter."""
    n, size = len(part.edges) - 1, len(CLASSES)
    text = np.repeat(np.arange(n), np.diff(part.bounds))
    point = _FIRST_BYTE[part.data]
    return np.bincount(text[point] * size + CLASS_OF[part.data[point]], minlength=n * size).reshape(n, size)


def common_word_counts(part: Slice) -> np.ndarray:
    """Texts x common words, and all other words in the last column. Words here are letters and digits only."""
    n, size = len(part.edges) - 1, len(WORD_LIST) + 1
    starts, ends, edges = part.runs(NOT_WORD)
    hashes = part.run_hashes(starts, ends, True)
    at = np.minimum(np.searchsorted(_WORD_HASHES, hashes), size - 2)
    word = np.where(_WORD_HASHES[at] == hashes, _WORD_INDEX[at], size - 1)
    text = np.repeat(np.arange(n), np.diff(edges))
    return np.bincount(text * size + word, minlength=n * size).reshape(n, size)
