"""Periodic runs, collocations and license scans, against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from lakegauge.llm import licenses, phrases, queries, runs
from tests.llm.test_operators import LONG, ODD, docs_of, none, odd  # noqa: F401

SF = "/root/testdata/sf0.001"


# 11 periodic runs


def brute_runs(words, min_length=12):
    """(start, period, length) of the runs, by trying every period."""
    n, smallest = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if length >= max(min_length, 2 * q):
                smallest.setdefault((start, length), q)
    return sorted((start, q, length) for (start, length), q in smallest.items())


def collapsed(words, found):
    gone = {i for s, q, length in found for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.lists(st.sampled_from("ab"), max_size=40), max_size=4),
    st.sampled_from([2, 5, 12]),
)
def test_runs_of_few_letters(texts, min_length):
    flat = np.array([ord(w) for text in texts for w in text], np.int64)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    expected, at = [], 0
    for text in texts:
        expected += [(s + at, n, q) for s, q, n in brute_runs(text, min_length)]
        at += len(text)
    got = runs.find_runs(flat, owner, min_length)
    assert sorted(map(tuple, got.tolist())) == sorted(expected)


def test_runs_with_a_wrong_word():
    rnd = random.Random(3)
    for _ in range(200):
        n = rnd.choice([13, 30, 80, 200])
        words = [rnd.randrange(6) for _ in range(n)]
        start, period = rnd.randrange(n // 2), rnd.randint(1, n // 4)
        for i in range(start, n):
            words[i] = words[start + (i - start) % period]
        if rnd.random() < 0.5:
            words[rnd.randrange(n)] = 9
        got = runs.find_runs(np.array(words, np.int64), np.zeros(n, np.int64))
        assert [(s, q, m) for s, m, q in got.tolist()] == brute_runs(words)


def test_runs_of_long_texts():
    """Many nested runs: numbers that grow with the words, not their square."""
    one = runs._of_group(["a " * 300_000], 12)[0]
    assert (one[1], one[2], one[3], one[4]) == ([0], [300_000], [1], "a")
    words = ["a", "a b"]
    while words[-1].count(" ") < 30_000:
        words.append(f"{words[-1]} {words[-2]}")
    assert len(runs._of_group([words[-1]], 12)[0][1]) < 30_000


def test_runs_on_odd_rows(spark, odd, none):  # noqa: F811
    found = runs.periodic_runs(odd).collect()
    assert len(found) == len(ODD)
    by_id = {r.doc_id: r for r in found}
    for key in (1, 2, 3):
        assert tuple(by_id[key]) == (key, 0, [], "")
    assert by_id[5].collapsed == " ".join(LONG.split()[:8])
    assert [tuple(run) for run in by_id[5].runs] == [(0, 24_000, 8)]
    assert by_id[6].collapsed == "one two three 漢字 é́ <|endoftext|> x"
    assert runs.periodic_runs(none).count() == 0


def test_runs_query(spark):
    got = {r.doc_id: tuple(r) for r in queries.op11_periodic_runs(spark, SF).collect()}
    planted = 0
    for row in spark.read.parquet(f"{SF}/documents.parquet").collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", row.text or "")
        n, code = len(words), zlib.crc32(str(row.doc_id).encode())
        if n > 4000:  # brute force takes the square of it
            assert row.doc_id in got
            continue
        if code % 10 == 0 and n:
            g = code // 10
            a, old = g % n, words
            p = 1 + (n - a) // (3 + g % 8)
            words = [old[i] if i < a else old[a + (i - a) % p] for i in range(n)]
            planted += 1
        found = brute_runs(words)
        best = max(found, key=lambda r: (r[2], -r[0], -r[1]), default=None)
        figures = (None,) * 4
        if best:
            start, q, length = best
            figures = (start, length, q, 1000 * length // q)
        lines = "".join(f"{s},{m},{q}\n" for s, q, m in found)
        assert got.pop(row.doc_id) == (
            row.doc_id,
            len(found),
            *figures,
            hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(collapsed(words, found).encode()).hexdigest(),
        )
    assert planted > 5


# 12 collocations


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute_collocations(rows, min_count, top, subsumed):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i : i + size])] += 1
    found = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= min_count}
    dropped = set()
    for (lang, words), a in found.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                part = words[i : i + size]
                if 100 * a >= subsumed * counts[lang, part]:
                    dropped.add((lang, part))
    ranked = {}
    for (lang, words), a in found.items():
        if (lang, words) in dropped:
            continue
        cuts = []
        for k in range(1, len(words)):
            l, r = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((2_000_000 * a // (l + r), k, l, r))
        score, _, l, r = min(cuts)
        phrase = " ".join(words)
        key = (-score, -a, phrase.encode())
        ranked.setdefault(lang, []).append((key, (phrase, a, l, r, totals[lang], score)))
    return {
        (lang, place, *row)
        for lang, rows in ranked.items()
        for place, (_, row) in enumerate(sorted(rows)[:top], 1)
    }


def random_texts(seed, n):
    rnd = random.Random(seed)
    words = ["the", "The", "of", "a", "New", "york", "times", "é", "\x1c", "x\x00y", "Ä"]
    for _ in range(n):
        text = "".join(
            rnd.choice(words) + rnd.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ","])
            for _ in range(rnd.randrange(60))
        )
        yield rnd.choice(["en", "en", "de", None]), text


@pytest.mark.parametrize("hot_share, bits", [(1000, 1 << 27), (4, 1 << 27), (4, 64)])
def test_collocations(spark, monkeypatch, hot_share, bits):
    """Also with stripes dealt into slices and with a filter that is full."""
    monkeypatch.setattr(phrases, "HOT_SHARE", hot_share)
    monkeypatch.setattr(phrases, "FILTER_BITS", bits)
    rows = [*random_texts(1, 60), ("en", None), ("fr", ""), ("fr", " .,"), (None, "x")]
    docs = spark.createDataFrame(
        [(1, lang, text, "p", 1) for lang, text in rows],
        "doc_id bigint, lang string, text string, phrase string, n int",
    ).repartition(3)
    got = {tuple(r) for r in phrases.collocations(docs, 4, 40, 80).collect()}
    expected = brute_collocations(rows, 4, 40, 80)
    assert len(expected) > 60 and got == expected


def test_no_collocations(spark):
    schema = "lang string, text string"
    for rows in ([], [("en", None)], [(None, "one two")]):
        assert phrases.collocations(spark.createDataFrame(rows, schema)).count() == 0


def test_scores_beyond_64_bits(spark):
    score = spark.sql(
        """SELECT CAST(CAST(a AS DECIMAL(20, 0)) * 2000000
        DIV (CAST(a AS DECIMAL(20, 0)) + CAST(a AS DECIMAL(20, 0))) AS BIGINT) AS s
        FROM VALUES (9000000000000000000L) AS t(a)"""
    )
    assert score.first().s == 1_000_000


def test_segments_keep_pieces_whole(monkeypatch):
    monkeypatch.setattr(phrases, "SEGMENT_BYTES", 10)
    text = "one two. three " + "four " * 10 + "; five\nsix, seven"
    parts = list(phrases._segments(text))
    assert len(parts) > 2
    assert b"\n".join(parts) == text.encode().translate(phrases._PLAIN)


def test_word_hashes_are_those_of_spark(spark):
    words = ["the", "é", "x" * 100, "漢"]
    rows = spark.createDataFrame([("en", w) for w in words], "lang string, word string")
    theirs = [r[0] for r in rows.selectExpr("xxhash64(lang, word)").collect()]
    ours = phrases._word_hashes("en", [w.encode() for w in words])
    assert ours.view(np.int64).tolist() == theirs
    assert xxhash.xxh64_intdigest(b"", seed=42) != 0


# 13 licenses


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def brute_base(text):
    words, found = words_of(text), []
    for phrase, label in licenses.BASE.items():
        own = phrase.split()
        found += [
            (i, label)
            for i in range(len(words))
            if words[i : i + len(own)] == own
        ]
    places = [at for at, _ in found]
    return (
        len(words),
        len(found),
        min(places, default=None),
        max(places, default=None),
        sorted({label for _, label in found}),
    )


def test_base_places(spark):
    rnd = random.Random(5)
    parts = ["MIT", "License", "mit", "licensed", "Apache", "General", "Public", "é", "4"]
    texts = [None, "", " -- ", "MIT", "license"]
    for _ in range(80):
        texts.append(
            "".join(rnd.choice(parts) + rnd.choice(" -,\n\x00") for _ in range(30))
        )
    found = licenses.license_labels(docs_of(spark, texts)).collect()
    got = {r.doc_id: tuple(r)[1:6] for r in found}
    assert got == {k: brute_base(text) for k, text in enumerate(texts)}
    assert any(n > 1 for _, n, *_ in got.values())


def test_license_spans(spark):
    notice = "Redistribution and use in source and binary forms, with or without"
    rest = "modification, are permitted provided that the following conditions are met:"
    other = " ".join(f"word{k}" for k in range(50))
    texts = [
        f"{other}\n{notice} {rest} {other}",
        f"{other} {notice} any {rest}",  # a word more
        f"{notice.replace('binary', 'object')} {rest}",  # a word changed
        f"{notice} {other} {rest}",  # two far parts, neither enough
        "Licensed under CC BY-NC 4.0.",
        "Licensed under CC BY 4.0",
        "Licensed under CC BY-NC-SA 4.0 and the MIT license",
        "licensed under the law of the land",
        other,
    ]
    found = licenses.license_labels(docs_of(spark, texts)).orderBy("doc_id").collect()
    assert [r.labels for r in found] == [
        ["bsd"], ["bsd"], ["bsd"], [], ["cc-by-nc"], ["cc-by"], ["cc-by-nc-sa", "mit"],
        [], [],
    ]
    assert tuple(found[0].spans[0]) == (50, 70, "bsd", 1.0)
    assert tuple(found[1].spans[0])[:3] == (50, 71, "bsd")
    assert 0.9 < found[2].score < 1 and found[3].score == 0 and found[6].score == 1


def test_licenses_on_odd_rows(spark, odd, none):  # noqa: F811
    found = licenses.license_labels(odd).collect()
    assert len(found) == len(ODD)
    assert all(r.labels == [] and r.score == 0 and r.n_base == 0 for r in found)
    assert sorted(r.n_words for r in found if r.doc_id in (1, 2, 3)) == [0, 0, 0]
    assert licenses.license_labels(none).count() == 0
    many = docs_of(spark, ["released under the MIT license. " * 5000])
    row = licenses.license_labels(many).first()
    assert (row.n_base, row.last_word, row.labels) == (5000, 24_998, ["mit"])
