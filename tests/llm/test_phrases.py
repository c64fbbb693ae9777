"""Phrase mining against a brute-force version that counts every phrase."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from urbanspark.llm import phrases

SCHEMA = "doc_id bigint, text string, lang string, phrase string, words int, f bigint"


def fixture_rows():
    rng = random.Random(8)
    common = "the of New york is a en es big red dog ran".split()
    rows = []
    for i in range(120):
        words = []
        for _ in range(40):
            words += rng.choice([["New", "YORK", "city", "hall"], ["red", "dog"], [rng.choice(common)], [f"rare{rng.randrange(300)}"]])
            if rng.random() < 0.2:
                words.append(rng.choice([",", ".", "\n", "\t", "a,b", "été\r", "\x1c", " "]))
        rows.append((i, " ".join(words), ["en", "es", None, "en"][i % 4]))
    # Copies, a phrase of one document only, texts without words, a very long text, languages spelled like words.
    rows += [(200 + i, "once upon a time there", "und") for i in range(40)]
    rows += [(None, "aa aa aa aa aa aa " * 20, "fr"), (301, None, "en"), (302, "", None), (303, " .,; \n", "en"), (304, "word", "en")]
    rows += [(305, "very long text here. " * 4000, "de"), (306, "x" * 50_000, "de"), rows[0], rows[0]]
    return [(*row, "clash", 1, 2) for row in rows]


def brute_force(rows, least, top):
    upper = {c: c + 32 for c in range(65, 91)}
    f, n = Counter(), Counter()
    for _, text, lang, *_ in rows:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(upper)):
            words = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang or "und", tuple(words[i : i + k])] += 1
    f = {key: a for key, a in f.items() if a >= least}
    held = defaultdict(int)
    for (lang, w), a in f.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                held[lang, w[i : i + k]] = max(held[lang, w[i : i + k]], a)
    by_lang = defaultdict(list)
    for (lang, w), a in f.items():
        if len(w) > 1 and 100 * held[lang, w] < 80 * a:
            cuts = [(2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w))]
            score, _, left, right = min(cuts)
            by_lang[lang].append((-score, -a, " ".join(w).encode(), left, right))
    out = []
    for lang, found in by_lang.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(fixture_rows(), SCHEMA)


@pytest.mark.parametrize("least,top,every", [(30, 2000, 8), (5, 7, 3), (30, 2000, 1)])
def test_against_brute_force(docs, least, top, every):
    wanted = brute_force(fixture_rows(), least, top)
    assert len(wanted) > 10
    got = phrases.collocations(docs.repartition(4), least, top, every)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == wanted


def all_counts(table):
    return {(r["lang"], r["phrase"]): r["f"] for r in table.collect()}


def test_misses_of_the_sample_are_found(docs):
    """Whatever was proposed, the result is the same: no further pass after a full proposal, one after any other."""
    by_length, passes = phrases.frequent(docs, 30, ahead=False)
    assert passes == 4
    everything = phrases.proper_parts(by_length, 4)
    again, once = phrases.frequent(docs, 30, everything)
    assert once == 1 and all_counts(again) == all_counts(by_length)
    for some in (everything.filter("words = 1 AND hash(phrase) % 2 = 0"), everything.filter("words = 1 OR lang = 'es'"), None):
        repaired, more = phrases.frequent(docs, 30, some)
        assert more == 2 and all_counts(repaired) == all_counts(by_length)


def test_a_full_filter_loses_nothing(docs, monkeypatch):
    wanted = all_counts(phrases.frequent(docs, 30)[0])
    monkeypatch.setattr(phrases, "MAX_FILTER_BITS", 1)
    monkeypatch.setattr(phrases, "BITMAP_BITS", 32_768)
    monkeypatch.setattr(phrases, "PROBES", 0)
    assert all_counts(phrases.frequent(docs, 30)[0]) == wanted


def test_slices_do_not_matter(docs, monkeypatch):
    wanted = all_counts(phrases.frequent(docs, 30)[0])
    monkeypatch.setattr(phrases, "SLICE_BYTES", 100)
    assert all_counts(phrases.frequent(docs, 30)[0]) == wanted


def test_filter_has_all_and_few_others(spark):
    rows = [("en", 2, f"w{i} v{i % 7}") for i in range(3000)]
    known = phrases.filter_of(spark.createDataFrame(rows, "lang string, words int, phrase string"))
    lang = pa.array(["en"] * 3000)
    assert known.has(phrases.phrase_hashes(lang, pa.array([r[2] for r in rows]))).all()
    others = known.has(phrases.phrase_hashes(lang, pa.array([f"x{i} y" for i in range(3000)])))
    assert np.count_nonzero(others) < 60


def test_large_counts_are_exact(spark):
    """Products pass 64 bits."""
    big = 6_000_000_000_000_000_007
    rows = [("en", 1, "a", big), ("en", 1, "b", big - 2), ("en", 2, "a b", big - 5)]
    got = phrases.cut_scores(spark.createDataFrame(rows, "lang string, words int, phrase string, f bigint")).collect()
    assert [r["score"] for r in got] == [2_000_000 * (big - 5) // (2 * big - 2)]


def test_empty_tables(spark):
    assert phrases.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    assert phrases.collocations(spark.createDataFrame([(1, None, None, None, None, None)], SCHEMA)).collect() == []
