"""License scan: word k-grams of texts vote for diagonals of license templates.

Words are lower-case letters, digits and all other characters beyond ASCII. A
task hashes the rolling k-grams of its texts (``SHINGLE`` words); Spark joins
them to the places of the same k-grams in the templates. A hit votes for the
diagonal ``place in the text - place in the template`` of its template.
Diagonals at most ``DRIFT`` words apart are merged, so inserted and left out
words do not split a span. A span is verified on its template's words: the
share that its hits cover, each word once, is at least ``min_share``, and the
template's telling words (``key``) stand in it without a gap.

The templates are the parameter of the operator, so their k-grams are a table
of known size and broadcast; hits and one row per document are dealt by row.
What a task gathers is one document's: votes of a diagonal are at most as many
as the template's places.

Null, empty and wordless texts have no words and no labels. Rows with equal or
null ``doc_id`` are documents of their own; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegauge.llm.common import per_batch
from lakegauge.llm.shingles import mixed, word_hashes

SHINGLE = 3
DRIFT = 3
MIN_SHARE = 0.6

# Phrases that always give a label.
BASE = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    key: str = ""


# Words of published licenses and of notices that name them.
TEMPLATES = (
    Template("mit", "released under the mit license", "the mit license"),
    Template("mit", "licensed under the mit license", "the mit license"),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy "
        "of this software and associated documentation files the software to deal "
        "in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell "
        "copies of the software",
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any "
        "purpose with or without fee is hereby granted provided that the above "
        "copyright notice and this permission notice appear in all copies",
    ),
    Template("bsd", "licensed under the bsd license", "the bsd license"),
    Template("bsd", "licensed under the bsd 3 clause license", "bsd 3 clause"),
    Template("bsd", "licensed under the bsd 2 clause license", "bsd 2 clause"),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without "
        "modification are permitted provided that the following conditions are met",
    ),
    Template(
        "bsd",
        "neither the name of the copyright holder nor the names of its contributors "
        "may be used to endorse or promote products derived from this software "
        "without specific prior written permission",
    ),
    Template(
        "apache",
        "licensed under the apache license version 2 0",
        "the apache license",
    ),
    Template(
        "apache",
        "you may not use this file except in compliance with the license you may "
        "obtain a copy of the license at",
    ),
    Template(
        "gpl",
        "this work is licensed under the gnu general public license version 3",
        "gnu general public license",
    ),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it "
        "under the terms of the gnu general public license as published by the free "
        "software foundation either version 3 of the license or at your option any "
        "later version",
        "gnu general public license",
    ),
    Template(
        "lgpl",
        "under the terms of the gnu lesser general public license",
        "gnu lesser general public license",
    ),
    Template(
        "agpl",
        "under the terms of the gnu affero general public license",
        "gnu affero general public license",
    ),
    Template(
        "mpl",
        "this source code form is subject to the terms of the mozilla public license "
        "v 2 0 if a copy of the mpl was not distributed with this file you can "
        "obtain one at",
        "mozilla public license",
    ),
    Template("cc-by", "licensed under cc by 4 0", "cc by 4"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "by sa 4"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "by nc 4"),
    Template("cc-by-nd", "licensed under cc by nd 4 0", "by nd 4"),
    Template("cc-by-nc-sa", "licensed under cc by nc sa 4 0", "nc sa 4"),
    Template("cc-by-nc-nd", "licensed under cc by nc nd 4 0", "nc nd 4"),
    Template(
        "cc-by",
        "this work is licensed under a creative commons attribution 4 0 "
        "international license",
        "commons attribution 4 0",
    ),
    Template(
        "cc-by-sa",
        "this work is licensed under a creative commons attribution sharealike 4 0 "
        "international license",
        "attribution sharealike 4 0",
    ),
    Template(
        "cc-by-nc",
        "this work is licensed under a creative commons attribution noncommercial 4 0 "
        "international license",
        "attribution noncommercial 4 0",
    ),
    Template(
        "cc0",
        "to the extent possible under law the author has waived all copyright and "
        "related or neighboring rights to this work",
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain",
    ),
)

# What is no part of a word becomes a blank, A-Z become lower case.
_TO_WORDS = bytes(
    ord(chr(b).lower()) if b >= 128 or chr(b).isalnum() else 32
    for b in range(128)
) + bytes(range(128, 256))
_FACTORS = np.random.default_rng(20240719).integers(
    1, 2**63, SHINGLE, dtype=np.uint64
) | np.uint64(1)


def _rolling(words: np.ndarray) -> np.ndarray:
    """Hashes of the k-grams that begin at each word but the last ones."""
    n = max(0, len(words) - SHINGLE + 1)
    total = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        total += words[k : k + n] * _FACTORS[k]
    return mixed(total)


def _hashes_of(words: Sequence[str]) -> np.ndarray:
    return word_hashes(" ".join(words).encode())[0]


def template_places(templates: Sequence[Template]) -> list[tuple]:
    """(template, place, hash) of every k-gram of the templates."""
    rows = []
    for number, template in enumerate(templates):
        hashes = _rolling(_hashes_of(template.text.split())).view(np.int64)
        rows += [(number, place, int(h)) for place, h in enumerate(hashes)]
    return rows


def _key_places(template: Template) -> list[int]:
    """Places of the k-grams that hold the telling words together."""
    words, key = template.text.split(), template.key.split()
    if not key:
        return []
    if len(key) < SHINGLE:
        raise ValueError(f"a key has at least {SHINGLE} words: {template.key!r}")
    starts = [i for i in range(len(words)) if words[i : i + len(key)] == key]
    if len(starts) != 1:
        raise ValueError(f"a key stands once in its template: {template.key!r}")
    return list(range(starts[0], starts[0] + len(key) - SHINGLE + 1))


def _template_table(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    rows = [
        (number, template.label, len(template.text.split()), _key_places(template))
        for number, template in enumerate(templates)
    ]
    return spark.createDataFrame(
        rows, "template int, label string, size int, key array<int>"
    )


def _phrase_places(words: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Where a phrase's words may stand, by their hashes."""
    n = max(0, len(words) - len(phrase) + 1)
    same = np.ones(n, bool)
    for k, word in enumerate(phrase):
        same &= words[k : k + n] == word
    return np.flatnonzero(same)


def _of_group(texts: list[str | None]) -> list[tuple]:
    """Per text: words, base places with their first, last and labels, and the
    hashes of its k-grams after a zero for the text itself."""
    phrases = [(p.encode().split(), _hashes_of(p.split()), BASE[p]) for p in BASE]
    parts = [(text or "").encode().translate(_TO_WORDS) for text in texts]
    data = b"\n".join(parts)
    words, starts = word_hashes(data)
    grams = _rolling(words).view(np.int64)
    ends = np.cumsum([len(part) + 1 for part in parts])
    bounds = np.concatenate(([0], np.searchsorted(starts, ends))).tolist()
    found: list[list[tuple[int, str]]] = [[] for _ in texts]
    edges = np.array(bounds)
    for spelled, phrase, label in phrases:
        for at in _phrase_places(words, phrase).tolist():
            own = int(np.searchsorted(edges, at, side="right")) - 1
            last = at + len(phrase)
            if last > bounds[own + 1]:
                continue
            end = starts[last] if last < len(starts) else len(data)
            if data[starts[at] : end].split() == spelled:
                found[own].append((at - bounds[own], label))
    rows = []
    for own, (first, last) in enumerate(zip(bounds[:-1], bounds[1:])):
        places = [at for at, _ in found[own]]
        rows.append(
            (
                last - first,
                len(places),
                min(places, default=None),
                max(places, default=None),
                sorted({label for _, label in found[own]}),
                np.concatenate(
                    ([0], grams[first : max(first, last - SHINGLE + 1)])
                ),
            )
        )
    return rows


def license_spans(
    docs: DataFrame,
    templates: Sequence[Template] = TEMPLATES,
    min_share: float = MIN_SHARE,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, the places of the base phrases
    (n_base, first_word, last_word, base_labels) and the verified ``spans``:
    array of struct (label, first_word, last_word, share), by place."""
    spark = docs.sparkSession
    hashed = per_batch(
        docs,
        "n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
        "base_labels array<string>, grams array<bigint>",
        lambda: _of_group,
    )
    head = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    rolled = hashed.withColumn("row", F.monotonically_increasing_id()).selectExpr(
        "row", *head, "posexplode(grams) AS (at, gram)"
    )
    places = spark.createDataFrame(
        template_places(templates), "template int, place int, gram bigint"
    )
    hits = (
        rolled.join(F.broadcast(places), "gram", "left")
        .where("at = 0 OR template IS NOT NULL")
        .selectExpr(
            "row",
            f"CASE WHEN at = 0 THEN struct({', '.join(head)}) END AS head",
            "if(at = 0, NULL, template) AS template",
            "if(at = 0, NULL, at - 1 - place) AS diagonal",
            "at - 1 AS at",
            "place",
        )
        .repartition("row")
    )
    diagonals = hits.groupBy("row", "template", "diagonal").agg(
        F.max("head").alias("head"),
        F.collect_set("place").alias("places"),
        F.min("at").alias("first"),
        F.max("at").alias("last"),
    )
    # A span begins where the diagonal before is far; numbers count the begins.
    in_order = "OVER (PARTITION BY row, template ORDER BY diagonal)"
    spans = (
        diagonals.selectExpr(
            "*", f"diagonal - lag(diagonal) {in_order} <= {DRIFT} AS goes_on"
        )
        .selectExpr("*", f"count_if(NOT coalesce(goes_on, false)) {in_order} AS span")
        .groupBy("row", "template", "span")
        .agg(
            F.max("head").alias("head"),
            F.expr("array_distinct(flatten(collect_list(places)))").alias("places"),
            F.min("first").alias("first"),
            F.max("last").alias("last"),
        )
    )
    covered = f"""size(array_distinct(flatten(transform(places,
        place -> sequence(place, place + {SHINGLE - 1})))))"""
    judged = spans.join(
        F.broadcast(_template_table(spark, templates)), "template", "left"
    ).selectExpr(
        "row",
        "head",
        f"{covered} / size AS share",
        "label",
        "CAST(first AS BIGINT) AS first_word",
        f"CAST(last + {SHINGLE - 1} AS BIGINT) AS last_word",
        "size(array_except(key, places)) = 0 AS telling",
    )
    holds = f"label IS NOT NULL AND telling AND share >= {min_share}D"
    one = "struct(first_word, last_word, label, share)"
    return (
        judged.groupBy("row")
        .agg(
            F.max("head").alias("head"),
            F.expr(f"array_sort(collect_list({one}) FILTER (WHERE {holds}))").alias(
                "spans"
            ),
        )
        .select("head.*", "spans")
    )


def license_labels(docs: DataFrame, **options) -> DataFrame:
    """:func:`license_spans` with ``labels``, those of base phrases and spans,
    and a ``score``: 1 with a base phrase, else the best span's share, or 0."""
    spans = license_spans(docs, **options)
    return spans.selectExpr(
        "*",
        "array_sort(array_union(base_labels, transform(spans, s -> s.label))) AS labels",
        """CASE WHEN n_base > 0 THEN 1D
            ELSE coalesce(array_max(transform(spans, s -> s.share)), 0D) END AS score""",
    )
