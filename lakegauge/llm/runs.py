"""Periodic runs of words, found with the dictionary of basic factors.

A run is a stretch of words with smallest period ``q`` (words ``q`` apart are
identical) of at least ``max(min_length, 2 * q)`` words that cannot be made
longer on either side.

The dictionary names, for each power of two, the stretches of that many words
by the pair of names of their halves; a stretch that occurs once in its text
gets no name and takes no part in the next length. A run of period ``q`` with
``2**k <= q < 2**(k + 1)`` begins with a stretch of ``2**k`` words that occurs
again ``q`` words later. Occurrences of one stretch at most half its length
apart are an arithmetic progression, all preceded by the same word, so two of
its later members never begin a run: pairs are only made with a first member,
which keeps their number in proportion to the words. Each pair proposes a
start and a period; it is extended through the dictionary, and of several
periods for one stretch the smallest stays.

Texts are independent rows: one pass, no shuffle. Work grows with
``n log n`` and memory with the words and the repeated stretches of a group of texts or one
longer text, at most about 8 bytes per word and power of two besides the words. Null, empty and blank texts have no words and
no run. Rows with equal or null ``doc_id`` are documents of their own.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import compress, count

import numpy as np
from pyspark.sql import DataFrame

from lakegauge.llm.common import per_batch

MIN_LENGTH = 12


class Dictionary:
    """Names of the repeated stretches of 1, 2, 4, ... words of several texts.

    ``words`` numbers the words of all texts in a row, ``text`` says whose they
    are. Per level the places are sorted; a place without a name begins a
    stretch that its text has once.
    """

    def __init__(self, words: np.ndarray, text: np.ndarray) -> None:
        self.n = len(words)
        self.places: list[np.ndarray] = []
        self.names: list[np.ndarray] = []
        places = np.arange(self.n, dtype=np.int64)
        pairs = text.astype(np.int64) * (int(words.max(initial=0)) + 1) + words
        while len(places):
            _, names, counts = np.unique(
                pairs, return_inverse=True, return_counts=True
            )
            again = counts[names] > 1
            places, names = places[again], names[again]
            self.places.append(places.astype(np.int32))
            self.names.append(names.astype(np.int32))
            # A name belongs to one text, so halves of two texts never meet.
            right = self.name_at(len(self.places) - 1, places + self.length)
            both = right >= 0
            left = names[both].astype(np.int64)
            pairs = left * (int(names.max(initial=0)) + 1) + right[both]
            places = places[both]
            if len(places):
                own = text[places] == text[places + self.length]
                places, pairs = places[own], pairs[own]

    @property
    def length(self) -> int:
        """Words of a stretch of the last level."""
        return 1 << (len(self.places) - 1)

    def name_at(self, level: int, at: np.ndarray) -> np.ndarray:
        """Names of the stretches that begin at places, -1 for none."""
        places, names = self.places[level], self.names[level]
        if not len(places):
            return np.full(len(at), -1, np.int64)
        found = np.minimum(np.searchsorted(places, at), len(places) - 1)
        return np.where(places[found] == at, names[found], -1).astype(np.int64)

    def common(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """How many words the texts at two places have in common."""
        total = np.zeros(len(left), np.int64)
        for level in reversed(range(len(self.places))):
            name = self.name_at(level, left + total)
            same = (name >= 0) & (name == self.name_at(level, right + total))
            total += same.astype(np.int64) << level
        return total


def _windows(
    keys: np.ndarray, low: np.ndarray, high: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(row of low/high, index into sorted keys) of all keys in [low, high)."""
    first = np.searchsorted(keys, low)
    sizes = np.searchsorted(keys, high) - first
    rows = np.repeat(np.arange(len(low)), sizes)
    steps = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return rows, np.repeat(first, sizes) + steps


def _proposals(
    dictionary: Dictionary, words: np.ndarray, begins: np.ndarray, level: int
) -> tuple[np.ndarray, np.ndarray]:
    """Starts and periods from 2**level to 2**(level + 1) that may be runs."""
    length, n = 1 << level, dictionary.n
    names, places = dictionary.names[level], dictionary.places[level].astype(np.int64)
    # A window of twice the length never reaches the places of the next name.
    keys = names.astype(np.int64) * (3 * n + 3) + places
    keys.sort()
    places = keys % (3 * n + 3)
    near = np.zeros(len(keys), bool)
    near[1:] = np.diff(keys) <= length // 2
    heads = np.flatnonzero(~near)
    # First members before anything, and anything before first members.
    low = keys[heads] + length
    rows, at = _windows(keys, low, low + length)
    pairs = [(places[heads[rows]], places[at])]
    late = np.flatnonzero(near)
    low = keys[late] + length
    rows, at = _windows(keys[heads], low, low + length)
    pairs.append((places[late[rows]], places[heads[at]]))
    left, right = (np.concatenate(side) for side in zip(*pairs))
    # Only where the word before differs can a run begin.
    opens = begins[left] | (words[left - 1] != words[right - 1])
    return left[opens], (right - left)[opens]


def find_runs(
    words: np.ndarray, text: np.ndarray, min_length: int = MIN_LENGTH
) -> np.ndarray:
    """Rows (start, length, period) of the runs of all texts in a row, by start
    and period; starts count through all texts."""
    found = [np.empty((0, 3), np.int64)]
    if len(words):
        begins = np.concatenate(([True], text[1:] != text[:-1]))
        dictionary = Dictionary(words, text)
        for level in range(len(dictionary.places)):
            start, period = _proposals(dictionary, words, begins, level)
            long = period + dictionary.common(start, start + period)
            holds = long >= np.maximum(2 * period, min_length)
            found.append(np.stack([start, long, period], 1)[holds])
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    # One stretch with several periods: the smallest comes first.
    same = np.zeros(len(rows), bool)
    same[1:] = (rows[1:, :2] == rows[:-1, :2]).all(1)
    rows = rows[~same]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which words stay: those no run has after its first period."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(steps[:-1]) == 0


def _of_group(texts: list[str | None], min_length: int) -> list[tuple]:
    split = [(text or "").encode().split() for text in texts]
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    ids = [numbers[word] for words in split for word in words]
    words = np.array(ids, np.int64)
    sizes = np.array([len(words) for words in split], np.int64)
    runs = find_runs(words, np.repeat(np.arange(len(split)), sizes), min_length)
    keep = kept_words(len(words), runs)
    ends = np.cumsum(sizes)
    cuts = np.searchsorted(runs[:, 0], ends)
    rows, at, first = [], 0, 0
    for own, end, cut in zip(split, ends.tolist(), cuts.tolist()):
        mine = runs[first:cut]
        left = own if first == cut else compress(own, keep[at:end].tolist())
        rows.append(
            (
                len(own),
                (mine[:, 0] - at).tolist(),
                mine[:, 1].tolist(),
                mine[:, 2].tolist(),
                b" ".join(left).decode(),
            )
        )
        at, first = end, cut
    return rows


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, the runs as arrays of struct
    ``runs`` (start, length, period) by start, then period, and ``collapsed``,
    the text with each run cut to its first period, words joined by a space."""
    found = per_batch(
        docs,
        "n_words bigint, starts array<bigint>, lengths array<bigint>, "
        "periods array<bigint>, collapsed string",
        lambda: lambda texts: _of_group(texts, min_length),
    )
    struct = "array<struct<start:bigint,length:bigint,period:bigint>>"
    return found.selectExpr(
        "doc_id",
        "n_words",
        f"CAST(arrays_zip(starts, lengths, periods) AS {struct}) AS runs",
        "collapsed",
    )
