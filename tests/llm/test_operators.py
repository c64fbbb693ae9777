"""Each operator against a brute-force version on a small fixture with nulls, empty and long texts, ties and repeated rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from checks.compare import compare, open_tables
from urbanspark.llm import (
    chat,
    exact_dedup,
    mixing,
    ngram_join,
    packing,
    pii,
    quality_model,
    quality_rules,
    queries,
    token_counts,
    url_rules,
)

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, digest string, row bigint, size bigint"


def fixture_rows():
    rng = random.Random(11)
    words = [f"w{i}" for i in range(200)]
    base = [" ".join(rng.choice(words) for _ in range(80)) for _ in range(6)]
    rows = []
    for i, text in enumerate(base * 3):
        edited = text.split()
        for _ in range(i % 4):
            edited[rng.randrange(80)] = rng.choice(words)
        rows.append((i, " ".join(edited), ["en", None, "fr"][i % 3], ["a", "b", None][i % 3]))
    rows += [(100, None, None, None), (101, "", "en", "a"), (102, " \n\t ", "en", "a"), (103, "One two", "en", "b")]
    rows += [(104, "one  TWO", "en", "b"), (0, base[0], "en", "a"), (0, base[0], "en", "a"), (None, base[1], "en", "a")]
    rows += [(105, "mail bob.1@mail1.example.com or +1 (988) 555-2485, 10.0.0.7 and 4111 1111 1111 1111", "en", "a")]
    rows += [(106, " ".join(rng.choice(words) for _ in range(6000)), "de", "c")]
    return [(*row, 1, "x", 5, 6) for row in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(fixture_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, 1 if i % 3 else 0, 0) for i in range(18)], "doc_id bigint, quality int, toxic int")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_match_their_sql(spark, name):
    ok, note = compare(spark, open_tables(SF), SF, queries.QUERIES[name], queries.SQL[name])
    assert ok, note


def test_exact_copies(docs):
    got = exact_dedup.exact_copies(docs).collect()
    groups = defaultdict(list)
    for row in fixture_rows():
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", row[1] or "")].append(row[0])
    assert len(got) == len(fixture_rows())
    by_digest = defaultdict(list)
    for row in got:
        by_digest[row.text_sha256].append(row)
    for text, ids in groups.items():
        rows = by_digest[hashlib.sha256(text.encode()).hexdigest()]
        least = min((i for i in ids if i is not None), default=None)
        assert {r.keep_id for r in rows} == {least} and {r.group_size for r in rows} == {len(ids)}
        assert [r.doc_id for r in rows if r.kept] == [least]
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)


def brute_components(rows):
    sets = []
    for _, text in rows:
        words = [w.decode() for w in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())]
        sets.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common and 100 * common >= 75 * (len(a) + len(sets[j]) - common):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return Counter((doc_id, len(sets[i]), least.get(find(i))) for i, (doc_id, _) in enumerate(rows))


def test_near_copies(docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "BUCKET_SETS", 4)
    monkeypatch.setattr(ngram_join, "PART_SHINGLES", 200)
    rows = [(r[0], r[1]) for r in fixture_rows()]
    assert Counter(tuple(r) for r in ngram_join.near_copies(docs).collect()) == brute_components(rows)


def test_near_copies_of_a_group_around_the_limit(spark, monkeypatch):
    """300 copies of one text, each pair a little above or below the similarity, in blocks that are split."""
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 2000)
    monkeypatch.setattr(ngram_join, "PART_SHINGLES", 4000)
    draw = random.Random(5)
    base = [f"w{i}" for i in range(90)]
    rows = []
    for i in range(300):
        words = list(base)
        for place in draw.sample(range(90), draw.choice([1, 2, 3, 3])):
            words[place] = f"x{draw.randrange(6)}"
        rows.append((i, " ".join(words[: draw.choice([90, 90, 80])])))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    wanted = brute_components(rows)
    assert 5 < len({c for _, _, c in wanted}) < 300
    assert Counter(tuple(r) for r in ngram_join.near_copies(docs).collect()) == wanted


def test_mix_reaches_targets(docs):
    mix = mixing.mix_documents(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.taken) for r in mix) == sorted(
        (r.doc_id is None, r.doc_id, r.taken) for r in mixing.mix_documents(docs.repartition(7)).collect()
    )
    size = Counter(len(WORD.findall(row[1] or "")) for row in fixture_rows())
    assert Counter(r["size"] for r in mix) == size
    total = sum(r["size"] for r in mix)
    targets = {r.source: (r.target, r.source_size) for r in mix}
    assert math.isclose(sum(t for t, _ in targets.values()), 1.5 * total)
    for source, (target, source_size) in targets.items():
        own = [r for r in mix if r.source == source]
        assert target <= 2 * source_size + 1e-6 and all(r.taken <= 2 * r["size"] for r in own)
        assert abs(sum(r.taken for r in own) - target) <= max(r["size"] for r in own)
    repeated = mixing.repeat_documents(docs, mixing.mix_documents(docs))
    assert repeated.columns == docs.columns
    assert repeated.count() == sum(r.copies for r in mix)


def test_pack_round_trip(docs):
    packed = packing.pack_documents(docs, TOKENIZER, capacity=512, keep_ids=True)
    rows = packed.collect()
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(TOKENIZER)
    wanted = Counter()
    for row in fixture_rows():
        ids = [*full.encode(row[1] or "", add_special_tokens=False).ids, packing.END_ID]
        for piece, start in enumerate(range(0, len(ids), 512)):
            own = ids[start : start + 512]
            crc = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in own))
            wanted[(row[0], piece, start, len(own), crc, tuple(own))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in rows) == wanted
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 512
    # No two pieces of more than half a sequence share one.
    least = max(math.ceil(sum(r.length for r in rows) / 512), sum(r.length > 256 for r in rows))
    assert len(places) <= 1.1 * least + 1
    assert packing.sequences(packed).agg(F.max(F.size("ids"))).first()[0] <= 512


def test_best_fit_is_the_tightest():
    import numpy as np

    rng = random.Random(2)
    lengths = [rng.randint(1, 100) for _ in range(300)]
    sequence, _, _ = packing.best_fit_decreasing(np.array(lengths), 100)
    room, expected = [], {}
    for i in sorted(range(300), key=lambda i: -lengths[i]):
        fits = [r for r in room if r >= lengths[i]]
        expected[i] = min(fits) if fits else None
        if fits:
            room[room.index(min(fits))] -= lengths[i]
        else:
            room.append(100 - lengths[i])
    assert len(set(sequence.tolist())) == len(room)


@pytest.mark.parametrize("layout", ["messages", "shared", "prompt", "instruction"])
def test_chat_layouts_agree(spark, layout):
    shapes = {
        "messages": "array(named_struct('role','user','content','a <b> ~1 [x]'), named_struct('role','assistant','content','</s>[INST]')) AS messages",
        "shared": "array(named_struct('from','user','value','a <b> ~1 [x]'), named_struct('from','assistant','value','</s>[INST]')) AS conversations",
        "prompt": "'a <b> ~1 [x]' AS prompt, '</s>[INST]' AS response",
        "instruction": "'a <b> ~1 [x]' AS instruction, CAST(NULL AS STRING) AS input, '</s>[INST]' AS output",
    }
    df = spark.sql(f"SELECT 5L AS conv_id, 'noise' AS extra, {shapes[layout]}")
    formatted = chat.format_turns(chat.canonical_turns(df))
    as_json = chat.canonical_turns_of_json(df.drop("extra").select(F.to_json(F.struct("*")).alias("payload")), "payload")
    if layout != "instruction":  # a null field is left out of JSON, which makes it another layout with equal turns
        assert as_json.count() == 2
    row = chat.read_back(formatted).first()
    said = "user\na <b> ~1 [x]\nassistant\n</s>[INST]\n"
    assert row.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert row.loss_sha256 == hashlib.sha256(b"</s>[INST]").hexdigest() and row.loss_chars == 10


def test_chat_nulls(spark):
    turns = spark.createDataFrame([(None, None, None, None), (1, 0, "user", None), (1, 0, "user", None)], "conv_id long, turn long, role string, text string")
    rows = {r.conv_id: r for r in chat.read_back(chat.format_turns(turns)).collect()}
    assert rows[1].n_turns == 2 and rows[None].n_turns == 1


def test_quality_scores(docs, labels, spark):
    rows = quality_model.score_documents(docs, labels).collect()
    assert len(rows) == len(fixture_rows())
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    none = quality_model.score_documents(docs, labels.limit(0)).select("score").distinct().collect()
    assert [r.score for r in none] == [0.5]


def test_quality_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    scores = queries.QUERIES["op6_quality_classifier"](spark, sf)
    truth = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    right = scores.filter("held_out").join(truth, "doc_id").agg(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0]
    assert right > 0.98


def test_quality_rule_counts(docs):
    wanted = Counter()
    for row in fixture_rows():
        text = row[1] or ""
        words = WORD.findall(text)
        lines = [line for line in text.split("\n") if WORD.search(line)]
        triples = list(zip(words, words[1:], words[2:]))
        often = Counter(triples)
        again = {j for i, t in enumerate(triples) if often[t] > 1 for j in (i, i + 1, i + 2)}
        symbols = len(re.findall(r"[#*$%&|<>]", text))
        wanted[(row[0], len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(again))] += 1
    rows = quality_rules.judge_documents(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows) == wanted
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in rows)
    assert not any(r.kept and r.base_failed for r in rows)


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def test_base_spans_are_the_patterns():
    rng = random.Random(4)
    for _ in range(5000):
        text = "".join(rng.choice("aZ0129.-+@_% ()") for _ in range(rng.randint(0, 40)))
        wanted = []
        for kind, pattern in PATTERNS.items():
            for match in re.finditer(pattern, text):
                digits = re.sub("[^0-9]", "", match[0])
                if kind == "ip" and not all(int(part) <= 255 for part in match[0].split(".")):
                    continue
                if kind == "card" and not (12 <= len(digits) <= 19 and pii.luhn(digits)):
                    continue
                if kind == "phone" and not 9 <= len(digits) <= 15:
                    continue
                wanted.append((match.start(), match.end(), kind))
        assert pii.base_spans(text) == sorted(wanted, key=lambda s: (s[0], pii.KINDS.index(s[2])))


def test_personal_data(docs):
    rows = {r.doc_id: r for r in pii.span_digests(pii.find_spans(docs)).collect()}
    assert (rows[105].n_email, rows[105].n_ip, rows[105].n_card, rows[105].n_phone) == (1, 1, 1, 1)
    assert rows[100].spans == "" and rows[100].base_sha256 == hashlib.sha256(b"").hexdigest()
    weights = pii.train([])
    text = "call (988) 555-2485 today"
    assert pii.added_spans(text, pii.base_spans(text), weights) == [(5, 19, "phone")]


@pytest.mark.parametrize("rule", ["first", "most"])
def test_section_counts_byte_by_byte(spark, rule):
    """Every token's bytes dealt one by one to the sections (lines, each with its line end) of both fields."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    texts = ["one\n\n\n two\r\n\r\n  three", "\n\n", "", None, "über 日本\n\n\n\n語 \t\n x = 1;\n    y\n", "a" * 400 + "\n" + " b" * 300, "\n \n \n\n", "end\n"]
    rows = [(i, texts[-1 - i], text) for i, text in enumerate(texts)] * 2
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string").repartition(3)
    encoding, _ = token_counts._encoding(path, public_tokenizers.PATTERN)
    wanted, crossed = Counter(), 0
    for doc_id, source, text in rows:
        fields = [source or "", text or ""]
        whole = "\n".join(fields)
        names = [(f, k) for f, field in enumerate(fields) for k in range(field.count("\n") + 1)]
        place, own = 0, []
        for byte in whole.encode():
            own.append(place)
            place += byte == 0x0A
        tokens, crossing, at = Counter(), Counter(), 0
        for token in encoding.encode_ordinary(whole):
            held = own[at : at + len(encoding.decode_single_token_bytes(token))]
            at += len(held)
            share = Counter(held)
            owner = held[0] if rule == "first" else min(share, key=lambda k: (-share[k], k))
            tokens[owner] += 1
            crossing[owner] += len(share) > 1
        assert at == len(own)
        lines = whole.split("\n")
        start = 0
        for k, (name, line) in enumerate(zip(names, lines)):
            end = start + len(line) + (k + 1 < len(lines))
            wanted[(doc_id, *name, start, end, tokens[k], crossing[k])] += 1
            start = end
        crossed += crossing.total()
    got = token_counts.token_counts(docs, path, public_tokenizers.PATTERN, ("source", "text"), rule).collect()
    assert crossed > 0 and Counter(tuple(r) for r in got) == wanted


@pytest.mark.parametrize("rule", ["first", "most"])
def test_token_counts(docs, rule):
    rows = token_counts.token_counts(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, ("source", "text"), rule).collect()
    encoding, _ = token_counts._encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    total = sum(len(encoding.encode_ordinary("\n".join([row[3] or "", row[1] or ""]))) for row in fixture_rows())
    assert sum(r.n_tokens for r in rows) == total
    assert sum(r.end - r.start for r in rows) == sum(len("\n".join([row[3] or "", row[1] or ""])) for row in fixture_rows())


def test_url_rules(spark):
    urls = [None, "", "no scheme", "http://A.Example.COM/en/1?x#y", "https://www.example.com/en/", "http://x.net/es/a", "http://net", "http://a..com//"]
    pages = spark.createDataFrame([(i % 6, u, "h") for i, u in enumerate(urls * 2)], "page_id long, url string, rule string")
    rules = spark.createDataFrame(queries.RULES, "verdict string, rule string")
    rows = Counter((r.host, r.path, r.rule, r.verdict) for r in url_rules.judge_urls(pages, rules).collect())
    assert rows[("a.example.com", "/en/1", "example.com/en/", "block")] == 2
    assert rows[("www.example.com", "/en/", "www.example.com/en/", "allow")] == 2
    assert rows[("", "", None, "allow")] == 6 and rows[("net", "", None, "allow")] == 2
    assert sum(rows.values()) == 16
    assert url_rules.judge_urls(pages, rules.limit(0)).filter("verdict = 'allow'").count() == 16


def test_empty_tables(nothing, labels):
    assert mixing.mix_documents(nothing).count() == 0
    assert packing.pack_documents(nothing, TOKENIZER).count() == 0
    assert exact_dedup.exact_copies(nothing).count() == 0
    assert ngram_join.near_copies(nothing).count() == 0
    assert quality_model.score_documents(nothing, labels).count() == 0
    assert quality_rules.judge_documents(nothing).count() == 0
    assert pii.find_spans(nothing).count() == 0
    assert token_counts.token_counts(nothing, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).count() == 0


def test_one_per_component_with_null_and_repeated_ids(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f"), (None, "x y z"), (None, "x y z"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = sorted(((r["doc_id"], r["text"]) for r in ngram_join.one_per_component(docs).collect()), key=str)
    assert kept == [(1, "a b c d e f"), (3, None), (None, "x y z"), (None, "x y z")]


def test_quality_of_rare_languages(spark, monkeypatch):
    monkeypatch.setattr(quality_rules, "MAX_LANGUAGES", 1)
    rng = random.Random(8)

    def prose(letters, common):
        words = ["".join(rng.choice(letters) for _ in range(6)) for _ in range(40)] + common * 2
        return " ".join(rng.choice(words) for _ in range(400))

    english, cyrillic = ("abcdefghij", "the of and to in is it".split()), ("\u0431\u0432\u0433\u0434\u0436\u0437", ["\u0438"])
    rows = [(i, prose(*english), "en") for i in range(30)] + [(100 + i, prose(*cyrillic), "ru") for i in range(25)]
    rows += [(200, prose(*cyrillic), "bg"), (201, prose("0123456789#", []), "en"), (202, prose("0123456789#", []), "ru")]
    docs = spark.createDataFrame([(i, text.capitalize(), lang) for i, text, lang in rows], "doc_id bigint, text string, lang string")
    judged = {r.doc_id: r for r in quality_rules.judge_documents(docs).collect()}
    # Without a reference of its own the base rules decide; a language beyond the largest has its own reference.
    assert judged[200].kept and judged[200].class_distance is None
    assert all(judged[100 + i].kept for i in range(25)) and all(judged[i].kept for i in range(30))
    assert not judged[201].kept and not judged[202].kept


def added(text, weights):
    return [(text[start:end], kind) for start, end, kind in pii.added_spans(text, pii.base_spans(text), weights)]


@pytest.fixture(scope="module")
def weights():
    return pii.train([])


def test_spelled_out_addresses_without_digits(spark):
    texts = ["write to jane at example dot com please", "ask jane.doe (at) example (dot) com now", "we are at this point in time", "at noon. then the dot"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = {r.doc_id: [(texts[r.doc_id][s.start : s.end], s.kind) for s in r.added] for r in pii.find_spans(docs).collect()}
    assert rows == {0: [("jane at example dot com", "email")], 1: [("jane.doe (at) example (dot) com", "email")], 2: [], 3: []}


def test_long_spans_are_candidates(weights, monkeypatch):
    for span, kind in [
        ("192[.]168[.]1[.]1", "ip"),
        ("bob(dot)smith(at)example(dot)com", "email"),
        ("first [dot] last [at] sub [dot] example [dot] com", "email"),
        ("4/1/1/1/1/1/1/1/1/1/1/1/1/1/1/1", "card"),
    ]:
        assert added(f"see {span} there", weights) == [(span, kind)]
    monkeypatch.setattr(pii, "MAX_TOKENS", 3)
    with pytest.raises(ValueError):
        pii.train([])


def test_rare_kinds_are_learnt(spark):
    rows = [(i, f"mail user{i % 90}.x@host{i}.example.com today") for i in range(150)] + [(1000 + i, "mail one.copy@example.com") for i in range(200)]
    rows += [(2000, "ring +49 (30) 555-2485 now"), (2001, "call (988) 555-2485 today")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    sample = pii.training_spans(docs)
    spans = [(text[start:end], kind) for text, start, end, kind in sample]
    assert len(set(spans)) == len(spans) and ("+49 (30) 555-2485", "phone") in spans
    assert sum(kind == "email" for _, kind in spans) == pii.SAMPLE // len(pii.KINDS)
    assert added(rows[-1][1], pii.train(sample)) == [("(988) 555-2485", "phone")]


def test_dense_numbers_are_cut_nowhere(weights):
    text = ", ".join(f"(988) 555-{i:04d}" for i in range(2000, 2400))
    found = added(text, weights)
    assert found == [(f"(988) 555-{i:04d}", "phone") for i in range(2000, 2400)]


def test_one_per_component_keeps_unique_texts_of_one_id(spark):
    near = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    rows = [(5, "some quite unlike words stand here"), (5, near + " end"), (3, near), (7, "first of two"), (7, "second of two"), (8, ""), (8, "eight")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = sorted((r["doc_id"], r["text"]) for r in ngram_join.one_per_component(docs).collect())
    assert kept == sorted([rows[0], *rows[2:]])


@pytest.mark.parametrize("others", [0, 1, 2, 18, 19, 20, 40])
def test_verdicts_do_not_turn_at_a_number_of_documents(spark, others):
    """One text of digits and signs goes, whatever the number of other documents of its language; those stay."""
    rng = random.Random(others)

    def prose(letters, common):
        words = ["".join(rng.choice(letters) for _ in range(6)) for _ in range(40)] + common * 2
        return " ".join(rng.choice(words) for _ in range(300)).capitalize()

    rows = [(i, prose("abcdefghij", "the of and to in is it".split()), "en") for i in range(60)]
    rows += [(100 + i, prose("klmnoprstu", "nie na do to jest".split()), "pl") for i in range(others)]
    rows += [(200, prose("0123456789#", []), "pl"), (201, prose("бвгджз", ["и"]), "bg")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(2)
    dropped = {r.doc_id for r in quality_rules.judge_documents(docs).collect() if not r.kept}
    assert dropped == {200}


def test_mix_is_near_its_target_over_seeds(spark):
    """The mean distance from the target over seeds is that of small documents, though sizes differ a hundredfold."""
    rng = random.Random(5)
    sizes = [int(2 ** rng.uniform(3, 10)) for _ in range(90)]
    docs = spark.createDataFrame([(i, "w " * n, "ab"[i % 2]) for i, n in enumerate(sizes)], "doc_id bigint, text string, source string")
    docs = docs.persist()
    misses = []
    for seed in range(8):
        for r in mixing.mix_documents(docs, seed=seed).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect():
            misses.append(abs(r.taken - r.target))
    docs.unpersist()
    assert sum(misses) / len(misses) < 0.25 * max(sizes)


def test_equal_rows_are_dealt_out(spark, monkeypatch):
    """Rows without ids and of one size get draws of their own: about their share of copies, not all or none."""
    monkeypatch.setattr(mixing, "NUMBERED_ROWS", 100)
    docs = spark.createDataFrame([(None, "a b c", "s")] * 3000 + [(i, "a b c d", "t") for i in range(3000)], "doc_id bigint, text string, source string")
    numbered = mixing.numbered_rows(mixing.document_sizes(docs))
    assert sorted(r.number for r in numbered.filter("doc_id IS NULL").collect()) == list(range(3000))
    for r in mixing.mix_documents(docs).groupBy("source").agg(F.count("*").alias("n"), F.sum("taken").alias("taken"), F.first("target").alias("target")).collect():
        assert r.n == 3000 and abs(r.taken - r.target) <= 4


@pytest.mark.parametrize("step", ["copies", "near", "mix"])
def test_clashing_columns_come_back_as_they_were(spark, step):
    """Columns named like helpers, with any number of underscores, keep their values."""
    extra = ["__own", "__digest", "__rank", "__id", "__key", "___rank", "copies", "n"]
    rows = [(1, "one two three four five six", "a"), (1, "one two three four five six", "a"), (2, None, None), (None, "x y", "b")]
    docs = spark.createDataFrame(
        [(*row, *[f"{i}{c}" for c in extra]) for i, row in enumerate(rows)],
        "doc_id bigint, text string, source string, " + ", ".join(f"`{c}` string" for c in extra),
    )
    run = {
        "copies": exact_dedup.drop_copies,
        "near": ngram_join.one_per_component,
        "mix": lambda d: mixing.repeat_documents(d, mixing.mix_documents(d)),
    }[step]
    for table in (docs, docs.limit(0)):
        got = run(table)
        assert got.columns == docs.columns
        given = {tuple(r) for r in table.collect()}
        assert {tuple(r) for r in got.collect()} <= given
