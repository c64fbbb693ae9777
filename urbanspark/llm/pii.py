"""Personal data in texts: fixed patterns, and a semi-Markov conditional random field for other spellings.

Base: the leftmost non-overlapping matches of four patterns, with checks that drop a failing match. They always
stay. Method: around digits, ``@`` and spelled-out at signs outside of base spans, a semi-Markov CRF scores whole candidate
segments of up to ``MAX_TOKENS`` tokens by features of the whole span (digits, groups, check digit, separators,
spelled-out signs, the word before). Dynamic programming picks boundaries and types jointly; what it finds beside the base
spans is added if its score clears ``MARGIN``.

Training: base spans with their surroundings, an equal part of ``SAMPLE`` for each kind, those of distinct texts with the
smallest hashes; generated spans of all kinds, whatever the corpus has; and rewritten forms of both (spelled-out signs,
other separators, no plus sign) as positives; look-alikes that fail the checks as negatives. The CRF's likelihood is
maximised by gradient ascent on the driver; the fitted weights are a few kilobytes.

Defined results: a null text is empty and has no spans; spans are in code points, end exclusive; repeated rows are searched
each; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanspark.operators.tables import materialize

KINDS = ["email", "ip", "card", "phone"]
Span = tuple[int, int, str]  # start, end, kind

SAMPLE = 100
# A card number of 19 single digits with a separator after each has 37 tokens. Segments in which two words
# stand side by side are prose beyond LOOSE_TOKENS.
MAX_TOKENS = 40
LOOSE_TOKENS = 12
CONTEXT_TOKENS = 6
CONTEXT_CHARS = 60
MARGIN = 2.0
EPOCHS = 40

# Runs of digits are taken whole where no address follows, so a long run is read once; the result is the same.
IP = re.compile(r"[0-9]+(?:(\.[0-9]+)(\.[0-9]+)(\.[0-9]+))?")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
DIGIT_OR_AT = re.compile(r"[0-9@]")
SPELLED_AT = ("at", "arobase")
SPELLED_DOT = ("dot", "punkt", "point", "punto")
# What opens a region, and what also carries it on: spelled-out dots.
OPENING = re.compile(rf"[0-9@]|(?<![A-Za-z])(?:{'|'.join(SPELLED_AT)})(?![A-Za-z])", re.I | re.A)
MARK = re.compile(rf"[0-9@]|(?<![A-Za-z])(?:{'|'.join(SPELLED_AT + SPELLED_DOT)})(?![A-Za-z])", re.I | re.A)
# A sign in brackets is one token.
BRACKETED = rf"[\[({{<]\s*(?:{'|'.join(SPELLED_AT + SPELLED_DOT)}|[.@])\s*[\])}}>]"
TOKEN = re.compile(rf"{BRACKETED}|[A-Za-z]+|[0-9]+|[^\sA-Za-z0-9]", re.I | re.A)


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Matches of the e-mail pattern, looked for around each at sign."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end, "email"
        at = text.find("@", max(at + 1, end))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """All base spans, by start, then kind."""
    found: list[Span] = list(_emails(text)) if "@" in text else []
    if DIGIT_OR_AT.search(text):
        for match in IP.finditer(text):
            if match[1] and all(_small(part) for part in match[0].split(".")):
                found.append((match.start(), match.end(), "ip"))
        for match in CARD.finditer(text):
            if match.end() - match.start() >= 12:
                digits = match[0].replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found.append((match.start(), match.end(), "card"))
        if "+" in text:
            for match in PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in match[0]) <= 15:
                    found.append((match.start(), match.end(), "phone"))
    return sorted(found, key=lambda span: (span[0], KINDS.index(span[2])))


# ---- features


FEATURES = [
    "bias", "at", "at_and_dot", "spelled_at", "spelled_dot", "four_groups", "small_groups", "plus", "bracket", "luhn",
    "digits_0", "digits_1_6", "digits_7_8", "digits_9_11", "digits_12_15", "digits_16", "digits_17_19", "digits_20",
    "only_numbers", "equal_groups", "spaces", "slash_or_other", "letters_and_digits", "groups_1", "groups_2", "groups_3_4", "groups_5",
    "word_mail", "word_phone", "word_card", "word_ip", "short_last_group", "inner_dot", "loose_words", "goes_on", "at_then_dot", "whole_address", "spaced_address", "whole_ip", "whole_card", "prose_word", "hidden_ip",
]
# Words that are no part of a name.
PROSE_WORDS = "the this that these those which what his her their our my your its all any some".split()
PROSE_WORD = re.compile(rf"(?<![a-z])(?:{'|'.join(PROSE_WORDS)})(?![a-z])")
INDEX = {name: i for i, name in enumerate(FEATURES)}
# Words that announce a kind.
WORDS = {
    "mail": "mail email correo courriel contact".split(),
    "phone": "phone tel call mobile fax telefon telefono".split(),
    "card": "card visa mastercard karte carte tarjeta".split(),
    "ip": "ip host server address adresse".split(),
}


AT_THEN_DOT = re.compile(
    r"(?<![a-z])(?:at(?![a-z]).*?(?<![a-z])(?:dot|punkt)|arobase(?![a-z]).*?(?<![a-z])(?:dot|punkt|point|punto))(?![a-z])"
    r"|(?<![a-z])(?:at|arobase)(?![a-z]).*?[a-z0-9]\.[a-z]",
    re.S,
)


def span_features(span: str, before: str, loose: bool, goes_on: bool) -> list[int]:
    """``loose``: two words stand side by side with no sign between them; ``goes_on``: a sign adjoins the span or is its end."""
    low = span.lower()
    groups = re.findall(r"[0-9]+", span)
    digits = "".join(groups)
    count = len(digits)
    letters = re.search(r"[A-Za-z]", span) is not None
    spelled_at = re.search(r"[\[({<]\s*(at|arobase)\s*[\])}>]|\s(at|arobase)\s", low) is not None
    spelled_dot = re.search(r"[\[({<]\s*(dot|punkt|point|punto)\s*[\])}>]|\s(dot|punkt|point|punto)\s", low) is not None
    # English "at this point in" is prose, so point and punto only go with arobase.
    at_then_dot = AT_THEN_DOT.search(low) is not None
    names = ["bias"] + ["at_then_dot"] * at_then_dot
    names += ["at"] * ("@" in span) + ["at_and_dot"] * bool(re.search(r"@.*\.", span)) + ["spelled_at"] * spelled_at + ["spelled_dot"] * spelled_dot
    if len(groups) == 4 and not letters:
        names += ["four_groups"] + ["small_groups"] * all(_small(g) for g in groups)
    names += ["plus"] * span.startswith("+") + ["bracket"] * ("(" in span) + ["luhn"] * (12 <= count <= 19 and luhn(digits))
    for name, least, most in (
        ("digits_0", 0, 0), ("digits_1_6", 1, 6), ("digits_7_8", 7, 8), ("digits_9_11", 9, 11), ("digits_12_15", 12, 15),
        ("digits_16", 16, 16), ("digits_17_19", 17, 19), ("digits_20", 20, 10**9),
    ):
        names += [name] * (least <= count <= most)
    names += ["only_numbers"] * (not letters) + ["equal_groups"] * (len(groups) > 2 and len({len(g) for g in groups}) == 1)
    names += ["spaces"] * (" " in span) + ["slash_or_other"] * bool(re.search(r"[^\sA-Za-z0-9.()@+-]", span)) + ["letters_and_digits"] * (letters and count > 0)
    names += ["groups_1" if len(groups) < 2 else "groups_2" if len(groups) == 2 else "groups_3_4" if len(groups) < 5 else "groups_5"]
    names += ["short_last_group"] * (bool(groups) and len(groups[-1]) < 3)
    names += ["inner_dot"] * (re.search(r"[A-Za-z]\.[A-Za-z]", span) is not None) + ["loose_words"] * loose + ["goes_on"] * goes_on
    whole_address = at_then_dot and not loose and not goes_on
    names += ["whole_address"] * whole_address + ["spaced_address"] * (whole_address and " " in span)
    names += ["prose_word"] * (PROSE_WORD.search(low) is not None)
    whole_ip = len(groups) == 4 and not letters and not goes_on and all(_small(g) for g in groups)
    names += ["whole_ip"] * whole_ip + ["hidden_ip"] * (whole_ip and re.search(r"[\[({<]\s*\.|\s\.\s", span) is not None)
    names += ["whole_card"] * (12 <= count <= 19 and not letters and not goes_on and luhn(digits))
    names += [f"word_{kind}" for kind, words in WORDS.items() if before.lower() in words]
    return [INDEX[name] for name in names]


# Segments whose features are held at a time.
BLOCK = 4096


def segment_blocks(text: str, tokens: list[tuple[int, int]]) -> Iterator[tuple[list[tuple[int, int]], np.ndarray]]:
    """The candidate segments (first token, token after the last) of a stretch of tokens, in blocks with their features."""
    segments: list[tuple[int, int]] = []
    rows: list[list[int]] = []

    def block() -> tuple[list[tuple[int, int]], np.ndarray]:
        matrix = np.zeros((len(rows), len(FEATURES)))
        for i, row in enumerate(rows):
            matrix[i, row] = 1.0
        return segments, matrix

    words = [text[a:b] for a, b in tokens]
    marked = [OPENING.search(word) is not None for word in words]
    joined = [False, *(tokens[i - 1][1] == tokens[i][0] for i in range(1, len(tokens))), False]
    sign = [MARK.search(word) is not None and not word[0].isdigit() for word in words]
    for i in range(1, len(words) - 1):
        sign[i] = sign[i] or (words[i] in "._-" and joined[i] and joined[i + 1] and words[i - 1][0].isalnum() and words[i + 1][0].isalnum())
    plain = [word[0].isalpha() and not sign[i] for i, word in enumerate(words)]
    beside = [False, *(plain[i - 1] and plain[i] and not joined[i] for i in range(1, len(words)))]
    for first in range(len(tokens)):
        if not (words[first][0].isalnum() or words[first] in "+("):
            continue
        some = loose = False
        for stop in range(first + 1, min(first + MAX_TOKENS, len(tokens)) + 1):
            some = some or marked[stop - 1]
            loose = loose or (stop - 1 > first and beside[stop - 1])
            if loose and stop - first > LOOSE_TOKENS:
                break
            if some and words[stop - 1][0].isalnum():
                segments.append((first, stop))
                before = next((words[i] for i in range(first - 1, max(first - 4, -1), -1) if words[i][0].isalpha()), "")
                goes_on = (first > 0 and sign[first - 1]) or sign[first] or sign[stop - 1] or (stop < len(tokens) and sign[stop])
                rows.append(span_features(text[tokens[first][0] : tokens[stop - 1][1]], before, loose, goes_on))
        if len(rows) >= BLOCK:
            yield block()
            segments, rows = [], []
    yield block()


class Region:
    """A stretch of tokens and its candidate segments, for training."""

    def __init__(self, text: str, tokens: list[tuple[int, int]]):
        self.tokens = tokens
        self.segments: list[tuple[int, int]] = []  # first token, token after the last
        blocks = []
        for segments, matrix in segment_blocks(text, tokens):
            self.segments += segments
            blocks.append(matrix)
        self.matrix = np.concatenate(blocks)
        self.ending: list[list[int]] = [[] for _ in range(len(tokens) + 1)]
        for i, (_, stop) in enumerate(self.segments):
            self.ending[stop].append(i)

    def gradient(self, weights: np.ndarray, gold: dict[tuple[int, int], int]) -> np.ndarray:
        """Of the log likelihood of the gold segments; tokens outside of segments score 0."""
        scores = self.matrix @ weights
        n = len(self.tokens)
        forward, backward = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
        forward[0] = backward[n] = 0.0
        total = np.logaddexp.reduce(scores, axis=1) if len(scores) else np.empty(0)
        for stop in range(1, n + 1):
            ways = [forward[stop - 1], *(forward[self.segments[i][0]] + total[i] for i in self.ending[stop])]
            forward[stop] = np.logaddexp.reduce(ways)
        starting: list[list[int]] = [[] for _ in range(n + 1)]
        for i, (first, _) in enumerate(self.segments):
            starting[first].append(i)
        for first in range(n - 1, -1, -1):
            ways = [backward[first + 1], *(backward[self.segments[i][1]] + total[i] for i in starting[first])]
            backward[first] = np.logaddexp.reduce(ways)
        first = np.array([a for a, _ in self.segments], int)
        stop = np.array([b for _, b in self.segments], int)
        chance = np.exp(scores + (forward[first] + backward[stop] - forward[n])[:, None])
        wanted = np.zeros_like(chance)
        for i, segment in enumerate(self.segments):
            if segment in gold:
                wanted[i, gold[segment]] = 1.0
        return self.matrix.T @ (wanted - chance)


def decode(text: str, tokens: list[tuple[int, int]], weights: np.ndarray) -> list[tuple[int, int, int]]:
    """The best segmentation: first token, token after the last, kind. Only segments that clear the margin are held."""
    ending: dict[int, list[tuple[int, float, int]]] = {}
    for segments, matrix in segment_blocks(text, tokens):
        scores = matrix @ weights
        kind, best = scores.argmax(1), scores.max(1)
        for i in np.flatnonzero(best >= MARGIN).tolist():
            first, stop = segments[i]
            ending.setdefault(stop, []).append((first, float(best[i]), int(kind[i])))
    if not ending:
        return []
    value, back = [0.0], [None]
    for stop in range(1, len(tokens) + 1):
        top, choice = value[stop - 1], None
        for first, score, kind in ending.get(stop, ()):
            if value[first] + score > top:
                top, choice = value[first] + score, (first, stop, kind)
        value.append(top)
        back.append(choice)
    found, at = [], len(tokens)
    while at:
        if back[at] is None:
            at -= 1
        else:
            found.append(back[at])
            at = back[at][0]
    return found[::-1]


def regions(text: str, covered: list[Span]) -> Iterator[list[tuple[int, int]]]:
    """The tokens of each stretch around digits and at signs, written or spelled out, outside of the covered spans.

    Stretches of a text do not overlap and are never cut: one is as long as its marks are close.
    """
    if not OPENING.search(text):
        return
    edges = [0, *(x for start, end, _ in _union(covered) for x in (start, end)), len(text)]
    for low, high in zip(edges[::2], edges[1::2]):
        if not OPENING.search(text, low, high):
            continue
        # Only tokens near a mark are kept: stretches are bounded by distance, not by the text.
        stretches: list[tuple[int, int]] = []
        for mark in MARK.finditer(text, low, high):
            if stretches and mark.start() - stretches[-1][1] < 2 * CONTEXT_CHARS:
                stretches[-1] = (stretches[-1][0], mark.end())
            else:
                stretches.append((mark.start(), mark.end()))
        end = low
        for start, stop in stretches:
            if not OPENING.search(text, start, stop):
                continue
            # Both ends lie on token bounds, and a name with its dots is taken whole.
            a, b = max(end, start - CONTEXT_CHARS), min(high, stop + CONTEXT_CHARS)
            while a > end and text[a - 1] in LOCAL:
                a -= 1
            while b < high and text[b] in LOCAL:
                b += 1
            end = b
            tokens = [m.span() for m in TOKEN.finditer(text, a, b)]
            first = next(i for i, (_, y) in enumerate(tokens) if y > start)
            last = next(i for i in range(len(tokens) - 1, -1, -1) if tokens[i][0] < stop)
            first, last = max(0, first - CONTEXT_TOKENS), min(len(tokens) - 1, last + CONTEXT_TOKENS)
            while first and tokens[first - 1][1] == tokens[first][0]:
                first -= 1
            while last + 1 < len(tokens) and tokens[last + 1][0] == tokens[last][1]:
                last += 1
            yield tokens[first : last + 1]


def _union(spans: list[Span]) -> list[Span]:
    out: list[Span] = []
    for start, end, kind in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]), kind)
        else:
            out.append((start, end, kind))
    return out


# What the features see of a stretch without digits: its signs, its announcing words, and where other words are.
PART = re.compile(r"[A-Za-z]+|[^\x00-\x7F]")
SEEN = frozenset([*SPELLED_AT, *SPELLED_DOT, *PROSE_WORDS, *(word for words in WORDS.values() for word in words)])
SHAPES = 100_000


def shape(text: str) -> str:
    """A text without digits with all words that the features do not tell apart replaced by one."""

    def part(match: re.Match) -> str:
        if match[0].isascii():
            word = match[0].lower()
            return word if word in SEEN else "w"
        return "\u00e9" if match[0].isalnum() else match[0]

    return PART.sub(part, text)


def added_spans(text: str, base: list[Span], weights: np.ndarray, known: dict[str, list] | None = None) -> list[Span]:
    """``known`` holds what was decoded for shapes seen before, so a common shape is decoded once."""
    known = {} if known is None else known
    found = []
    for tokens in regions(text, base):
        low, high = tokens[0][0], tokens[-1][1]
        own = text[low:high]
        if any(c in "0123456789" for c in own):
            spans = decode(text, tokens, weights)
        else:
            own = shape(own)
            spans = known.get(own)
            if spans is None:
                spans = decode(own, [m.span() for m in TOKEN.finditer(own)], weights)
                if len(known) < SHAPES:
                    known[own] = spans
        found += [(tokens[first][0], tokens[stop - 1][1], KINDS[kind]) for first, stop, kind in spans]
    return found


# ---- training


def _generated(rng: random.Random) -> list[tuple[str, str]]:
    def digits(n: int) -> str:
        return "".join(rng.choice("0123456789") for _ in range(n))

    card = "4" + digits(14)
    card += next(d for d in "0123456789" if luhn(card + d))
    name = "".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randint(3, 8)))
    other = "".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randint(3, 8)))
    return [
        (f"{name}.{digits(2)}@{name}{digits(1)}.example.com", "email"),
        (rng.choice([f"{name}@{other}.com", f"{name}.{other}@example.org", f"{name}@mail.{other}.net"]), "email"),
        (".".join(str(rng.randint(1, 255)) for _ in range(4)), "ip"),
        (card, "card"),
        (f"+{rng.randint(1, 99)} ({digits(3)}) {digits(3)}-{digits(4)}", "phone"),
    ]


def _rewritten(span: str, kind: str, rng: random.Random) -> list[str]:
    """Other spellings of a span that the patterns miss."""
    if kind == "email":
        signs = [(" at ", " dot "), ("(at)", "(dot)"), ("[at]", "."), (" [at] ", " [dot] "), (" (at) ", " (dot) "), (" arobase ", " point ")]
        written = [span.replace(".", dot).replace("@", at) for at, dot in signs]
        name, host = span.split("@")
        return [*written, name + rng.choice([" at ", " (at) "]) + host]
    if kind == "phone":
        plain = re.sub(r"^\+[0-9]{1,3}[^0-9(]*", "", span)
        return [plain, "00" + span[1:], plain.replace("(", "").replace(") ", "-").lstrip("\x20).-")]
    if kind == "card":
        number = re.sub(r"[^0-9]", "", span)
        grouped = rng.choice([".", "/", "  "]).join(number[i : i + 4] for i in range(0, len(number), 4))
        return [grouped, rng.choice([".", "/", "  "]).join(number)]
    return [span.replace(".", dot) for dot in ("[.]", " . ", "(.)")]


# How at signs and dots occur in prose.
PROSE = [
    "at noon", "at the station. then", "see me at work (at night) or", "at home, dot", "to the point", "at this point", "the dot at the end",
    "was at work. at night", "at best", "good at it", "at last. the", "at most", "a point at the top", "is at the point where",
    "look at this point in time", "looked at the dot on the map", "aimed at that dot in front", "came at a point of",
]


def _lookalikes(rng: random.Random) -> list[str]:
    """Numbers and codes that are no personal data."""

    def digits(n: int) -> str:
        return rng.choice("123456789") + "".join(rng.choice("0123456789") for _ in range(n - 1))

    wrong = digits(15)
    wrong += next(d for d in "0123456789" if not luhn(wrong + d))
    code = "".join(rng.choice("0123456789abcdef") for _ in range(rng.randint(16, 40)))
    return [
        wrong,
        f"{rng.randint(1, 20)}.{rng.randint(0, 20)}.{rng.randint(0, 20)}",
        f"{rng.randint(256, 999)}.{rng.randint(256, 999)}.{digits(3)}.{digits(3)}",
        f"{rng.randint(1900, 2030)}-{rng.randint(1, 12):02d}-{rng.randint(1, 31):02d}",
        f"{rng.randint(1, 31)}/{rng.randint(1, 12)}/{rng.randint(1900, 2030)}",
        f"{digits(2)}:{digits(2)}:{digits(2)}",
        digits(rng.randint(1, 8)),
        f"{digits(1)},{digits(3)},{digits(3)}.{digits(2)}",
        f'token = "{code}"',
        code.upper(),
        f"@{digits(3)}",
        f"{digits(3)} {digits(3)} {digits(2)}",
        rng.choice(PROSE),
        rng.choice(PROSE),
    ]


def holds(snippet: str, start: int, end: int) -> bool:
    """Whether a segment can hold this span: not so if it starts or ends with a sign such as _ or has too many tokens."""
    tokens = TOKEN.findall(snippet, start, end)
    return 0 < len(tokens) <= MAX_TOKENS and (tokens[0][0].isalnum() or tokens[0] in "+(") and tokens[-1][0].isalnum()


def train(examples: list[tuple[str, int, int, str]], seed: int = 5) -> np.ndarray:
    """Weights (features x kinds) from (snippet, start, end, kind) of base spans."""
    rng = random.Random(seed)
    fill = "the of and to in is it that was for on are with as at be by from dot or an this have point".split()
    beside = [word for word in fill if not MARK.search(word)]

    def around(span: str, kind: str) -> tuple[str, int, int, str]:
        # Next to a span no word is a sign, which could be a part of it.
        left = " ".join([*(rng.choice(fill) for _ in range(rng.randint(0, 3))), rng.choice(beside)])
        if rng.random() < 0.15 and kind:
            left += " " + rng.choice(WORDS["mail" if kind == "email" else kind])
        return f"{left} {span} {' '.join(rng.choice(words) for words in (beside, fill, fill))}", len(left) + 1, len(left) + 1 + len(span), kind

    rows = [(snippet, start, end, kind) for snippet, start, end, kind in examples if holds(snippet, start, end)]
    for _ in range(SAMPLE // len(KINDS)):
        rows += [around(span, kind) for span, kind in _generated(rng)]
    for snippet, start, end, kind in list(rows):
        for other in _rewritten(snippet[start:end], kind, rng):
            rows.append(around(other, kind))
    for _ in range(SAMPLE // 4):
        rows += [around(span, "") for span in _lookalikes(rng)]

    prepared = []
    for snippet, start, end, kind in rows:
        tokens = [m.span() for m in TOKEN.finditer(snippet)]
        region = Region(snippet, tokens)
        inside = [i for i, (a, b) in enumerate(tokens) if a >= start and b <= end]
        gold = {(inside[0], inside[-1] + 1): KINDS.index(kind)} if kind and inside else {}
        if not set(gold) <= set(region.segments):
            raise ValueError(f"no segment holds the {kind} of {end - start} characters in a training example")
        prepared.append((region, gold))
    weights = np.zeros((len(FEATURES), len(KINDS)))
    weights[0] = -2.0
    moment = np.zeros_like(weights)
    for epoch in range(EPOCHS):
        gradient = sum(region.gradient(weights, gold) for region, gold in prepared) / len(prepared) - 1e-4 * weights
        moment += gradient**2
        weights = weights + 1.0 * gradient / (np.sqrt(moment) + 1e-8)
    return weights


def training_spans(docs: DataFrame) -> list[tuple[str, int, int, str]]:
    """Of each kind its part of SAMPLE base spans of distinct texts, with 60 characters around them: the smallest hashes."""
    part = SAMPLE // len(KINDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[str, dict[str, tuple[str, int, int]]] = {kind: {} for kind in KINDS}
        for batch in batches:
            for text in batch.column("text").to_pylist():
                for start, end, kind in base_spans(text or ""):
                    if end - start <= 60 and holds(text, start, end):
                        low = max(0, start - 60)
                        mark = hashlib.sha256(text[start:end].encode()).hexdigest()
                        row = (text[low : end + 60], start - low, end - low)
                        least[kind][mark] = min(row, least[kind].get(mark, row))
            least = {kind: dict(sorted(found.items())[:part]) for kind, found in least.items()}
        rows = [(mark, *row, kind) for kind, found in least.items() for mark, row in found.items()]
        columns = list(zip(*rows)) or [[]] * 5
        kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["mark", "snippet", "start", "end", "kind"])

    found = docs.select("text").mapInArrow(run, "mark string, snippet string, start int, end int, kind string")
    found = materialize(found, "training-spans")
    chosen = []
    for kind in KINDS:
        own = found.filter(F.col("kind") == kind).groupBy("mark").agg(F.min(F.struct("snippet", "start", "end")).alias("row"))
        chosen += [(*row["row"], kind) for row in own.orderBy("mark").limit(part).collect()]
    return chosen


def find_spans(docs: DataFrame) -> DataFrame:
    """doc_id, base (array of spans) and added (array of spans) of every row."""
    weights = train(training_spans(docs))
    span = "array<struct<start:int,end:int,kind:string>>"
    arrow = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list] = {}
        for batch in batches:
            base, added = [], []
            for text in batch.column("text").to_pylist():
                own = base_spans(text or "")
                base.append([{"start": a, "end": b, "kind": k} for a, b, k in own])
                more = sorted(added_spans(text or "", own, weights, known), key=lambda s: (s[0], KINDS.index(s[2])))
                added.append([{"start": a, "end": b, "kind": k} for a, b, k in more])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(base, arrow), pa.array(added, arrow)], names=["doc_id", "base", "added"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id bigint, base {span}, added {span}")


def span_digests(spans: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans as text."""
    place = F.array(*map(F.lit, KINDS))

    def written(column):
        ordered = F.array_sort(F.transform(column, lambda s: F.struct(s["start"], F.array_position(place, s["kind"]), s["end"], s["kind"].alias("kind"))))
        return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    return spans.select("doc_id", *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.concat("base", "added")).alias("spans"))
