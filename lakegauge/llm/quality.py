"""Quality rules, line first.

Every line with a word is held against three rules; lines that fail are
removed, and a document that loses too large a share of its words is rejected.
A base check on the whole text (length, repetition) comes before.

Null or empty text: no words, base check failed. Repeated rows are judged
one by one; a null ``doc_id`` stays null.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame

from lakegauge.llm.common import SPACES, per_row

# Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
# What a sentence ends with.
SENTENCE_END = ".!?…:"
# Menu separators that stand as words.
SEPARATORS = "|", ">", "»", "·", "•", "/", "::"
# Phrases of notices that are not part of an article.
BOILERPLATE = (
    "all rights reserved",
    "released under the mit license",
    "licensed under the apache license",
    "licensed under cc",
    "this work is licensed under",
    "terms of use",
    "terms of service",
    "privacy policy",
    "accept cookies",
    "enable javascript",
    "subscribe to our newsletter",
    "click here",
)


@dataclass(frozen=True)
class Limits:
    """A document is rejected below ``min_words``, with more than
    ``max_repeat_pct`` per cent of its words in repeated windows, or when its
    failing lines hold more than ``max_lost_pct`` per cent of its words. A
    line fails with more than ``max_marked_pct`` per cent of words that end in
    doubled marks, or ``min_menu_pct`` per cent of menu separators."""

    min_words: int = 50
    max_repeat_pct: int = 50
    max_lost_pct: int = 50
    max_marked_pct: int = 30
    min_menu_pct: int = 15


# A word that ends in a run of marks, as "word***" or "WORD!!".
_MARKED = re.compile(rb"[!?#*$%&]{2,}(?= |$)")
_PHRASES = re.compile(b"|".join(p.encode() for p in BOILERPLATE))
_ENDS = re.compile(b"[.!?:]|" + "…".encode())
_SEPARATORS = frozenset(s.encode() for s in SEPARATORS)


def line_fails(line: bytes, words: list[bytes], limits: Limits) -> bool:
    """Whether a line with words breaks a rule.

    Punctuation: three words or more without any sentence end, or many words
    with doubled marks. Navigation: many separators. Boilerplate: a phrase.
    """
    if len(words) >= 3 and not _ENDS.search(line):
        return True
    marked = len(_MARKED.findall(b" ".join(words)))
    if 100 * marked > limits.max_marked_pct * len(words):
        return True
    menu = sum(word in _SEPARATORS for word in words)
    if 100 * menu >= limits.min_menu_pct * len(words):
        return True
    return _PHRASES.search(line.lower()) is not None


def repeat_words(words: list[bytes]) -> int:
    """Words in three-word windows that occur twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered = end = 0
    for position, window in enumerate(windows):
        if counts[window] > 1:
            covered += position + 3 - max(position, end)
            end = position + 3
    return covered


def judge(text: str | None, limits: Limits, with_text: bool) -> tuple:
    text = text or ""
    n_words = lost = n_dup_lines = 0
    all_words: list[bytes] = []
    seen: set[bytes] = set()
    kept_lines = []
    for line in text.encode().split(b"\n"):
        words = line.split()
        if not words:
            continue
        all_words += words
        n_words += len(words)
        n_dup_lines += line in seen
        seen.add(line)
        if line_fails(line, words, limits):
            lost += len(words)
        elif with_text:
            kept_lines.append(line)
    n_repeat = repeat_words(all_words)
    failed = n_words < limits.min_words
    failed |= 100 * n_repeat > limits.max_repeat_pct * n_words
    return (
        n_words,
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        n_dup_lines,
        n_repeat,
        failed,
        not failed and 100 * lost <= limits.max_lost_pct * n_words,
        lost,
        b"\n".join(kept_lines).decode() if with_text else None,
    )


def clean_lines(
    docs: DataFrame, limits: Limits = Limits(), with_text: bool = True
) -> DataFrame:
    """Per document its figures, the verdict ``kept``, the words in failing
    lines ``n_lost_words`` and the cleaned text ``clean_text``."""
    return per_row(
        docs,
        "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
        "n_repeat_words bigint, base_failed boolean, kept boolean, "
        "n_lost_words bigint, clean_text string",
        lambda: lambda text: judge(text, limits, with_text),
    )
