"""Personal data by boosted trees over candidate spans.

Generators of high recall propose spans of five kinds, which may overlap. The
spans of the strict rules for four of them are always taken. Every other
candidate gets a probability from boosted trees over features of its format and
its context; those at or above the threshold of their kind, calibrated on
held-out rows to a wanted precision, are taken too, the more probable first,
unless they overlap a span already taken.

No hand-made labels are needed. A strict span of the corpus is a positive row;
so are copies of it in its place in the forms that the strict rules miss: a
phone number without its plus sign, an address spelled out, a card number with
a wrong digit or other separators, and, as there is no strict rule for them,
assigned secrets. Negative rows are parts of such spans and look-alikes in the
same places: decimals, versions, dates, ranges, longer numbers, words. The
sample is bounded: ``sample_texts`` different texts, those with the smallest
hashes, and ``spans_per_text`` spans of each.

Null text is empty text and has no spans. Offsets are code points, the end
exclusive.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegauge.llm.boosting import Booster, boost
from lakegauge.llm.common import per_row

KINDS = ("email", "ip", "card", "phone")
ALL_KINDS = (*KINDS, "secret")
Span = tuple[int, int]

# The strict patterns.
STRICT = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
# Generators of candidates.
_AT, _DOT = r"(?:@| ?[\[(]at[\])] ?)", r"(?:\.| ?[\[(](?:dot|\.)[\])] ?)"
LOOSE = {
    "email": (
        re.compile(rf"[A-Za-z0-9._%+-]+{_AT}[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)+"),
        re.compile(r"[A-Za-z0-9._%+-]+ at [A-Za-z0-9-]+(?: dot [A-Za-z0-9-]+)+"),
    ),
    "ip": (
        re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"),
        re.compile(r"[0-9]{1,3}(?: ?[\[(]\.[\])] ?[0-9]{1,3}){3}"),
    ),
    "card": (
        re.compile(r"[0-9]{4}(?:[ .-]?[0-9]{4}){2,3}[0-9]{0,3}"),
        re.compile(r"[0-9]{13,19}"),
    ),
    "phone": (
        re.compile(r"\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-][0-9]{3,4}"),
        re.compile(r"(?:00|\+ ?)[0-9][ ().0-9-]{6,18}[0-9]"),
    ),
    "secret": (
        re.compile(
            r"""[A-Za-z_][A-Za-z0-9_-]{1,24}["']?[ \t]{0,2}[=:][ \t]{0,2}"""
            r"""["']?[A-Za-z0-9+/_.=-]{8,200}["']?"""
        ),
    ),
}
# Where the generator of secrets is worth its time.
_ASSIGNED = re.compile(r"""[=:][ \t]{0,2}["']?[A-Za-z+/_.=-]{0,80}[0-9]""")
# Names whose values are secrets, and ends of host names; both only features.
_SECRETIVE = re.compile(r"(?i)token|secret|passw|pwd|api|key|auth|credential|access")
_TOP_LEVEL = frozenset("com org net edu gov info io de fr es uk eu biz dev".split())
_DIGIT = re.compile(r"[0-9]")


def _kinds_in(text: str, loose: bool) -> list[str]:
    """Kinds whose patterns can match at all; most texts have neither sign."""
    at = "@" in text or loose and any(s in text for s in ("[at]", "(at)", " dot "))
    kinds = ["email"] * at + [*KINDS[1:]] * bool(_DIGIT.search(text))
    return kinds + ["secret"] * bool(loose and _ASSIGNED.search(text))


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        doubled = digit * 2 if place % 2 else digit
        total += doubled - 9 if doubled > 9 else doubled
    return total % 10 == 0


def passes(kind: str, text: str) -> bool:
    """The strict rule's check of a match, or of a candidate's text."""
    if kind == "email":
        return True
    if kind == "ip":
        parts = re.findall(r"[0-9]+", text)
        return all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in parts)
    digits = _digits(text)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15


def plausible(kind: str, text: str) -> bool:
    """Whether a candidate can be of its kind at all: as the strict rule's
    check, but for a card number's check digit, which may be mistyped."""
    if kind == "secret":
        return True
    return 13 <= len(_digits(text)) <= 19 if kind == "card" else passes(kind, text)


def strict_spans(text: str) -> dict[str, list[Span]]:
    """Leftmost matches of each kind that do not overlap and pass the check."""
    found: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    for kind in _kinds_in(text, loose=False):
        matches = STRICT[kind].finditer(text)
        found[kind] = [m.span() for m in matches if passes(kind, m.group())]
    return found


def candidates(text: str) -> set[tuple[str, int, int]]:
    loose = {
        (kind, *m.span())
        for kind in _kinds_in(text, loose=True)
        for pattern in LOOSE[kind]
        for m in pattern.finditer(text)
        if plausible(kind, m.group())
    }
    strict = strict_spans(text)
    return loose | {(kind, *span) for kind in KINDS for span in strict[kind]}


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format of the span, then its surroundings."""
    span = text[start:end]
    digits = _digits(span)
    before, after = text[max(0, start - 12) : start], text[end : end + 6]
    last, next_ = before[-1:], after[:1]
    numbers = re.findall(r"[0-9]+", span)
    name, _, value = span.replace(":", "=", 1).partition("=")
    end_part = re.split(r"[^A-Za-z0-9]+", span.rstrip(")]"))[-1].lower()
    return [
        *(float(kind == k) for k in ALL_KINDS),
        len(span),
        len(digits),
        len(digits) / len(span),
        len(set(digits)),
        len(numbers),
        max(map(len, numbers), default=0),
        min(map(len, numbers), default=0),
        *(span.count(sign) for sign in ".- ()@"),
        float(span[:1] == "+" or span[:2] == "00"),
        float(digits[:2] in ("19", "20")),
        float(luhn(digits)) if digits else 0.0,
        float(end_part in _TOP_LEVEL),
        float(bool(re.match(r"[A-Za-z]+(?: |$)", span))),
        float(bool(_SECRETIVE.search(name))) if value else 0.0,
        len(value.strip(" \t\"'")),
        _variety(value),
        float(last.isalnum()),
        float(next_.isalnum()),
        float(last in ("", " ", "\n")),
        float(next_ in ("", " ", "\n")),
        float(last in (".", "-", "+", "/", "_", "=", "#")),
        float(next_ in ("-", "/", "_", "%")),
        float(next_ == "." and after[1:2].isdigit()),
        float(bool(re.search(r"[0-9][ .,-]?$", before))),
        float(bool(re.match(r"[ .,-]?[0-9]", after))),
        float(bool(re.search(r"(?i)(?:\bv|version|pp?\.|section|no\.) ?$", before))),
    ]


def _variety(value: str) -> float:
    """Bits per character."""
    n = len(value)
    counts = [value.count(c) for c in set(value)]
    return -sum(k / n * math.log2(k / n) for k in counts) if n else 0.0


def _crosses(span: Span, others: list[Span]) -> bool:
    return any(start < span[1] and span[0] < end for start, end in others)


@dataclass(frozen=True)
class Model:
    booster: Booster | None
    thresholds: dict[str, float]

    @property
    def threshold(self) -> float:
        """The lowest of all kinds."""
        return min(self.thresholds.values(), default=2.0)


# Training rows


def _phone_forms(digits: str) -> list[str]:
    a, b, c = digits[-10:-7], digits[-7:-4], digits[-4:]
    local = [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}"]
    return local + [f"00{digits[:2]} {digits[2:5]} {digits[5:]}"]


def loose_forms(
    kind: str, span: str, words: list[str], rnd: random.Random
) -> list[str]:
    """The same data, or with another name, in ways that the strict rules miss."""
    if kind == "phone":
        return _phone_forms(_digits(span).rjust(10, "5"))
    if kind == "email":
        user, _, host = span.partition("@")
        name = f"{rnd.choice(words)}{rnd.choice('._-')}{rnd.choice(words)}".lower()
        other = f"{rnd.choice(words)}.{rnd.choice(sorted(_TOP_LEVEL))}".lower()
        return [
            form
            for u, h in ((user, host), (name, other), (rnd.choice(words), host))
            for form in (
                f"{u} at {h.replace('.', ' dot ')}",
                f"{u} [at] {h}",
                f"{u}(at){h.replace('.', '(dot)')}",
            )
        ]
    if kind == "ip":
        return [span.replace(".", "[.]"), span.replace(".", "(.)")]
    digits = _digits(span)
    place = rnd.randrange(len(digits))
    wrong = digits[:place] + str((int(digits[place]) + rnd.randint(1, 9)) % 10)
    wrong += digits[place + 1 :]
    groups = [wrong[k : k + 4] for k in range(0, len(wrong), 4)]
    return [wrong, wrong, *(sign.join(groups) for sign in " -.")]


def look_alikes(kind: str, span: str, words: list[str], rnd: random.Random) -> list[str]:
    """What generators of a kind propose, too, and is nobody's data."""
    digits = _digits(span).rjust(4, "7")
    year = rnd.randint(1950, 2049)
    if kind == "phone":
        return [
            f"{year}-{year + 9} {rnd.randint(100, 999)}",
            f"{rnd.randint(10, 31)}.{rnd.randint(100, 999)}-{year}",
            f"pp. {rnd.randint(100, 499)}-{rnd.randint(500, 999)}-{rnd.randint(1000, 1999)}",
            " ".join(str(rnd.randint(100, 9999)) for _ in range(6)),
            f"{rnd.randint(10, 99)}.{digits[:4]}.{digits[-4:]}.{rnd.randint(1, 99)}",
        ]
    if kind == "email":
        one, two, three = (rnd.choice(words) for _ in range(3))
        return [f"{one} at {two} dot {three}", f"{one} at the {two} dot {three}"]
    if kind == "ip":
        return [f"v{span}", f"version {span}", f"{span}.{rnd.randint(0, 9)}", f"1.{span}"]
    return [
        f"0.{digits}",
        f"{digits}{digits}",
        f"{rnd.choice('abcxyz')}{digits}",
        f"{year}{rnd.randint(10**10, 10**11 - 1)}",
        digits[:1] * len(digits),
        f"{digits}.{rnd.randint(10, 99)}",
    ]


_HEX, _TEXT = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
_NAMES = ("token", "api_key", "secret", "password", "access_key", "auth-token", "TOKEN")
_PLAIN_NAMES = ("title", "lang", "date", "page", "width", "file", "note", "time")


def _assigned(name: str, value: str, rnd: random.Random) -> str:
    sign = rnd.choice([" = ", "=", ": "])
    return f'{name}{sign}"{value}"' if rnd.random() < 0.6 else f"{name}{sign}{value}"


def _secret_examples(words: list[str], rnd: random.Random) -> Iterator[tuple[str, bool]]:
    letters = rnd.choice([_HEX, _HEX.upper(), _TEXT])
    value = "".join(rnd.choice(letters) for _ in range(rnd.choice([16, 24, 32, 40, 64])))
    yield _assigned(rnd.choice(_NAMES), value, rnd), True
    year = rnd.randint(1950, 2049)
    for plain in (f"{year}-{rnd.randint(10, 12)}-{rnd.randint(10, 28)}",
                  f"{rnd.choice(words)}-{rnd.choice(words)}.html",
                  f"{rnd.choice(words)}{year}", f"{rnd.randint(10**8, 10**9)}"):
        name = rnd.choice([*_PLAIN_NAMES, rnd.choice(words)])
        yield _assigned(name, plain, rnd), False
    yield _assigned(rnd.choice(_NAMES), rnd.choice(words) + rnd.choice(words), rnd), False


def _rows_of(kind: str, text: str, at: Span, positive: bool):
    """Rows of the candidates that touch a place: the span itself as told,
    parts and surroundings of it as negative."""
    for other, start, end in candidates(text):
        if start < at[1] and at[0] < end:
            right = positive and other == kind and (start, end) == at
            yield [float(ALL_KINDS.index(other)), float(right)] + features(
                text, other, start, end
            )


def training_rows(text: str, spans_per_text: int) -> list[list[float]]:
    """Kind, label and features of a text's spans, of their other forms, and of
    look-alikes in their places."""
    rnd = random.Random(hashlib.md5(text.encode()).digest())
    words = re.findall(r"[A-Za-z]{2,}", text[:20_000]) or ["word"]
    spans = [(kind, span) for kind, own in strict_spans(text).items() for span in own]
    rows = []
    for kind, (start, end) in rnd.sample(spans, min(spans_per_text, len(spans))):
        before, after = text[max(0, start - 30) : start], text[end : end + 30]
        span = text[start:end]
        made = [(kind, span, True)]
        made += [(kind, form, True) for form in loose_forms(kind, span, words, rnd)]
        made += [(kind, form, False) for form in look_alikes(kind, span, words, rnd)]
        made += [("secret", *example) for example in _secret_examples(words, rnd)]
        for own, middle, positive in made:
            place = (len(before), len(before) + len(middle))
            rows += _rows_of(own, before + middle + after, place, positive)
    return rows


def fit(
    docs: DataFrame,
    sample_texts: int = 2000,
    spans_per_text: int = 2,
    precision: float = 0.99,
) -> Model:
    """Trees and thresholds from at most ``sample_texts`` different texts that
    have a digit or an at sign. Texts stay in Spark: the driver gets their
    training rows, about 25 numbers for each of some 50 candidates a span."""
    worth = docs.where("text RLIKE '@|[0-9]{2}'").selectExpr(
        "text", "xxhash64(text) AS hash"
    )
    least = worth.select("hash").distinct().orderBy("hash").limit(sample_texts)
    chosen = worth.join(F.broadcast(least), "hash")
    texts = chosen.groupBy("hash").agg(F.first("text").alias("text"))
    found = per_row(
        texts.withColumnRenamed("hash", "doc_id"),
        "flat array<double>, width bigint",
        lambda: lambda text: _flat(training_rows(text or "", spans_per_text)),
    ).orderBy("doc_id")
    parts = [
        np.array(row["flat"]).reshape(-1, row["width"])
        for row in found.toLocalIterator()
        if row["flat"]
    ]
    if not parts:
        return Model(None, {})  # nothing to learn from: strict rules alone
    rows = np.concatenate(parts)
    kinds, y, x = rows[:, 0].astype(int), rows[:, 1], rows[:, 2:]
    if y.min() == y.max():
        return Model(None, {})
    # Every other text is held out for the thresholds.
    held = np.repeat(np.arange(len(parts)) % 2 == 1, [len(part) for part in parts])
    booster = boost(x[~held], y[~held])
    p = booster.probability(x[held])
    return Model(
        booster,
        {
            kind: _threshold(p[kinds[held] == k], y[held][kinds[held] == k], precision)
            for k, kind in enumerate(ALL_KINDS)
        },
    )


def _flat(rows: list[list[float]]) -> tuple[list[float], int]:
    return [value for row in rows for value in row], len(rows[0]) if rows else 0


def _threshold(p: np.ndarray, truth: np.ndarray, precision: float) -> float:
    """The smallest one, 0.5 at least, at which so many taken rows are right;
    above 1 where none is."""
    down = np.argsort(-p, kind="stable")
    right = np.cumsum(truth[down]) / np.arange(1, len(down) + 1)
    last = np.append(p[down][1:] != p[down][:-1], True)[: len(down)]
    good = np.flatnonzero((right >= precision) & last)
    return max(float(p[down[good[-1]]]), 0.5) if len(good) else 2.0


def find(text: str | None, model: Model) -> dict[str, list[tuple[int, int, bool]]]:
    """Spans by kind in order: start, end and whether a strict rule gave it."""
    text = text or ""
    found: dict[str, list[tuple[int, int, bool]]] = {kind: [] for kind in ALL_KINDS}
    strict = strict_spans(text)
    for kind, spans in strict.items():
        found[kind] = [(start, end, True) for start, end in spans]
    taken = sorted(span for spans in strict.values() for span in spans)
    others = [c for c in sorted(candidates(text)) if not _crosses(c[1:], taken)]
    if others and model.booster is not None:
        rows = np.array([features(text, *candidate) for candidate in others])
        p = model.booster.probability(rows)
        for k in sorted(range(len(others)), key=lambda k: (-p[k], others[k])):
            kind, start, end = others[k]
            if p[k] >= model.thresholds[kind] and not _crosses((start, end), taken):
                found[kind].append((start, end, False))
                taken.append((start, end))
    return {kind: sorted(spans) for kind, spans in found.items()}


def redact(text: str | None, spans: dict[str, list[tuple[int, int, bool]]]) -> str:
    """The text with its spans replaced by their kinds in brackets."""
    text, parts, end = text or "", [], 0
    flat = sorted((s, e, kind) for kind, own in spans.items() for s, e, _ in own)
    for start, stop, kind in flat:
        if stop <= end:
            continue
        parts += [text[end : max(start, end)], f"[{kind}]"]
        end = stop
    return "".join(parts) + text[end:]


def _listed(spans: dict[str, list[tuple[int, int, bool]]], strict: bool) -> str:
    return ",".join(
        f"{kind}:{start}:{end}"
        for kind in ALL_KINDS
        for start, end, given in spans[kind]
        if given or not strict
    )


def find_personal_data(
    docs: DataFrame, model: Model, with_text: bool = True
) -> DataFrame:
    """Per document the number of strict spans by kind, a digest of them, all
    spans, the number added by the trees and (``with_text``) the redacted text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def one(text: str | None) -> tuple:
        spans = find(text, shared.value)
        return (
            *(sum(given for _, _, given in spans[kind]) for kind in KINDS),
            hashlib.sha256(_listed(spans, True).encode()).hexdigest(),
            _listed(spans, False),
            sum(not given for own in spans.values() for _, _, given in own),
            redact(text, spans) if with_text else None,
        )

    counts = ", ".join(f"n_{kind} bigint" for kind in KINDS)
    return per_row(
        docs,
        f"{counts}, base_sha256 string, spans string, n_added bigint, redacted string",
        lambda: one,
    )
