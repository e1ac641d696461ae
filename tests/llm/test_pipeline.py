"""The pipeline's stages on odd rows and on an empty table."""

from __future__ import annotations

import pytest

import corpus_pipeline
from lakegauge.llm.components import stored

SF = "/root/testdata/sf0.001"
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "kept string, words int, component_id bigint"
)
GOOD = " ".join(f"word{k} and then the next one" for k in range(30))
ROWS = [
    (1, GOOD, "en"),
    (1, GOOD, "en"),  # repeated
    (2, GOOD + " more", "en"),  # a near copy
    (None, GOOD, "en"),
    (3, None, "en"),
    (4, "", None),
    (5, " \t\n 12 ½", None),
    (6, "eins zwei drei vier " * 20_000, "de"),
    (7, "un deux trois quatre", "fr"),
    (7, "une autre ligne", "fr"),  # another text under the same id
]


@pytest.fixture
def rows(spark):
    full = [(*row, "s", len(row[1] or ""), "k", 1, 9) for row in ROWS]
    return spark.createDataFrame(full, SCHEMA)


def test_odd_rows(spark, rows):
    docs, ids = rows, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF), name)
        assert docs.columns == rows.columns
        ids[name] = sorted((r.doc_id for r in docs.collect()), key=str)
    assert ids["language_id"] == ids["line_dedup"] == [1, 1, 2, 6, 7, 7, None]
    assert ids["ngram_join"] == ids["decontamination"] == [1, 1, 6, 7, 7, None]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert len(last) == 6 and all(r.n_tokens > 0 for r in last)


def test_empty_table(spark, rows):
    docs = rows.where("false")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF), name)
        assert docs.columns == rows.columns and docs.isEmpty()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).isEmpty()
