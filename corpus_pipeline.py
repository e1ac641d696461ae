"""The corpus pipeline: five of the training-data operators in a row.

Each stage takes the rows its predecessor kept. All but the last return the
columns of ``documents``; line dedup cuts the texts (and ``n_chars``) down, the
last stage returns each document's tokens.

Rows with null or empty text, or without a letter, leave at the first stage. Rows
that repeat a ``doc_id`` are judged one by one but for the n-gram join, which
keeps all rows of an id of which one is its group's first, and decontamination,
which drops all rows of an id of which one has a passage. A null ``doc_id`` is no
copy of anything. Columns beside those of ``documents`` go through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegauge.llm import bpe, decontaminate, language, linededup, ngramjoin
from lakegauge.llm.components import stored
from lakegauge.llm.queries import vocabulary_path

# A document whose largest language is a smaller share of it is rejected.
MIN_LANGUAGE_SHARE = 0.4


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a language: not ``und``, and not a mixture in which no
    language has MIN_LANGUAGE_SHARE of the words."""
    found = language.identify_held_out(docs, keep=docs.columns)
    kept = found.where(
        (F.col("__llm_lang") != language.UNKNOWN)
        & (F.col("__llm_score") >= MIN_LANGUAGE_SHARE)
    )
    return kept.select(*docs.columns)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut lines that ten documents or more have. All documents stay; one that
    loses every line has an empty text."""
    bitmaps = linededup.drop_bitmaps(linededup.shared_lines(docs, min_docs=10))
    cut = linededup.apply_bitmaps(docs, bitmaps)
    text = F.when(F.col("__llm_bits").isNull(), F.col("text")).otherwise(F.col("__llm_kept"))
    changed = {"text": text, "n_chars": F.char_length(text).cast("long")}
    return cut.select(*[changed.get(name, F.col(name)).alias(name) for name in docs.columns])


def join_near_duplicates(
    spark: SparkSession, docs: DataFrame, sf_dir: str
) -> DataFrame:
    """Keep the document with the smallest id of each group of near copies."""
    return ngramjoin.one_of_each(docs)


def decontaminate_benchmark(
    spark: SparkSession, docs: DataFrame, sf_dir: str
) -> DataFrame:
    """Drop documents with a benchmark passage."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.remove_contaminated(docs, benchmark)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of the texts that are left: number and digests."""
    path = vocabulary_path("byte_bpe_50k.json")
    return bpe.encode_and_decode(docs, path, with_ids=False).drop("ids", "decoded")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("line_dedup", drop_shared_lines),
    ("ngram_join", join_near_duplicates),
    ("decontamination", decontaminate_benchmark),
    ("bpe", encode),
]

# SQL expresses neither the language mixture nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
