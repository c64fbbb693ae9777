"""Spelling variants against a brute-force version that compares all words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from urbanspark.llm import spelling

SCHEMA = "doc_id bigint, text string, word string, n bigint"


def fixture_rows():
    rng = random.Random(5)
    letters = "abcdeé"
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(5, 9))) for _ in range(60)]
    pool = list(base)
    for word in base:
        for _ in range(4):
            at = rng.randrange(len(word))
            pool.append(rng.choice([word[:at] + word[at + 1 :], word[:at] + rng.choice(letters) + word[at:], word[:at] + rng.choice(letters) + word[at + 1 :]]))
    weights = [rng.choice([1, 2, 5, 20]) for _ in pool]
    rows = []
    for i in range(60):
        drawn = rng.choices(pool, weights, k=120)
        rows.append((i, " ".join(w.upper() if rng.random() < 0.2 and w.isascii() else w for w in drawn), "x", 1))
    # Anagrams, words of one letter, very long words, other letters, and rows without words.
    rows += [(200, "listen silent enlist tinsel " * 5 + "aaaaaa aaaaaaa aaaaaaaa " * 4, "x", 1)]
    rows += [(201, ("z" * 3000 + " ") * 4 + ("z" * 3001 + " ") * 9, None, None), (202, "ÀÉÈàéè×÷øy Straße straße " * 6, "x", 1)]
    rows += [(None, "nulls nulls nulls nullz nullz nullz", "x", 1), (203, None, "x", 1), (204, "", "x", 1), (205, "12 34", "x", 1)]
    rows += [rows[0], rows[0], (None, "nulls nulls nulls", "x", 1)]
    return rows


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def brute_force(rows):
    upper = str.maketrans(spelling.UPPER, spelling.LOWER)
    n = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(upper)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                n[run] += 1
    words = {w: c for w, c in n.items() if c >= 3}
    links = {w: [v for v in words if near(w, v)] for w in words}
    form = {}
    for w, others in links.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w], root(w), c, len(links[w]), form[w] and words[form[w]]) for w, c in words.items())


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(fixture_rows(), SCHEMA)


@pytest.mark.parametrize("cell_words", [spelling.CELL_WORDS, 8])
def test_against_brute_force(docs, cell_words):
    wanted = brute_force(fixture_rows())
    assert sum(row[1] is not None for row in wanted) > 20 and any(row[2] != row[1] for row in wanted if row[1])
    got = spelling.spelling_groups(docs.repartition(5), cell_words)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect())) == wanted


def test_cells_are_even_and_each_word_has_one(spark):
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abcdefghijkl") for _ in range(8)) for _ in range(4000)})
    trees = spelling.fit_cells(spark.createDataFrame([(w, 3) for w in words], "word string, n bigint"), 200)
    vectors = spelling.count_vectors(words)
    home = np.full(len(words), -1)
    for cell, rows in spelling.reached(trees[8], vectors, 0):
        assert (home[rows] == -1).all()
        home[rows] = cell
    sizes = np.bincount(home)
    assert (home >= 0).all() and sizes.max() < 1000 and len(sizes) >= 12


def test_boxes_lose_nobody(spark):
    """Every vector within the radius lies in a cell that the search reaches."""
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abcdef"), 7)) for _ in range(400)]
    vectors = spelling.count_vectors(words)
    tree = spelling.grow(vectors, 40, iter(range(1000)))
    home = np.empty(400, int)
    for cell, rows in spelling.reached(tree, vectors, 0):
        home[rows] = cell
    asked = {(cell, row) for cell, rows in spelling.reached(tree, vectors, 2) for row in rows}
    apart = np.abs(vectors[:, None] - vectors[None]).sum(axis=2)
    assert all((home[j], i) in asked for i, j in zip(*np.nonzero(apart <= 2)))
    assert len(asked) < 0.7 * 400 * len(set(home))


def test_empty_table(spark):
    assert spelling.spelling_groups(spark.createDataFrame([], SCHEMA)).collect() == []
    assert spelling.spelling_groups(spark.createDataFrame([(1, None, None, None)], SCHEMA)).collect() == []


def test_long_chains_of_forms(spark):
    chain = [(f"w{i:02}", f"w{i + 1:02}") for i in range(20)]
    got = dict(map(tuple, spelling.roots(spark.createDataFrame(chain, "word string, form string").withColumn("x", F.lit(1))).collect()))
    assert got == {w: "w20" for w, _ in chain}
