"""The registered queries of this subpackage, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegauge.llm import (
    bpe,
    chat,
    decontaminate,
    html,
    language,
    licenses,
    linededup,
    ngramjoin,
    phrases,
    pii,
    quality,
    rans,
    runs,
)
from lakegauge.llm.common import documents, id_and_text
from lakegauge.workspace import new_folder

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.clean_lines(documents(spark, sf_dir), with_text=False).drop(
        "clean_text"
    )


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.ngram_join(documents(spark, sf_dir)).drop("n_links")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return html.main_text(pages, html.fit(pages))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_dedup(documents(spark, sf_dir)).selectExpr(
        "doc_id", "n_lines", "n_dropped", "sha2(kept, 256) AS kept_sha256"
    )


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    encoded = bpe.encode_and_decode(
        docs, vocabulary_path("byte_bpe_50k.json"), with_ids=False
    )
    return encoded.drop("ids", "decoded")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = pii.fit(id_and_text(docs))
    return pii.find_personal_data(docs, model, with_text=False).drop("redacted")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("doc_id", F.col("doc_id").cast("long"))
    return language.identify_held_out(docs).selectExpr(
        "doc_id", "__llm_held_out AS held_out",
        "__llm_lang AS lang_pred",
        "__llm_score AS score",
    )


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return chat.link_tool_calls(conversations)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.contaminated(documents(spark, sf_dir), benchmark)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_folder(spark, "token-files")
    vocabulary = vocabulary_path("word_bpe_49k.json")
    rans.write_token_files(documents(spark, sf_dir), vocabulary, root)
    return rans.read_token_files(spark, root)


_CRC = "crc32(CAST(CAST(doc_id AS STRING) AS BINARY))"
_SPLIT = r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)"


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """Documents as the contract of op11 asks: one in ten, by its id, repeats
    words from a place on. A null id is none of them."""
    chosen = id_and_text(docs).selectExpr(
        "doc_id", "text", f"{_CRC} % 10 = 0 AS chosen", f"{_CRC} DIV 10 AS g"
    )
    cut = chosen.selectExpr(
        "*", f"CASE WHEN chosen THEN {_SPLIT} ELSE array() END AS words"
    ).selectExpr("*", "size(words) AS n")
    placed = cut.selectExpr("*", "CASE WHEN n > 0 THEN CAST(g % n AS INT) END AS a")
    paced = placed.selectExpr("*", "1 + CAST((n - a) DIV (3 + g % 8) AS INT) AS p")
    repeated = """transform(words, (word, i) ->
        if(i < a, word, element_at(words, 1 + a + (i - a) % p)))"""
    return paced.selectExpr(
        "doc_id",
        f"CASE WHEN n > 0 THEN array_join({repeated}, ' ') ELSE text END AS text",
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(_with_planted_runs(documents(spark, sf_dir)))
    line = "concat(concat_ws(',', run.start, run.length, run.period), '\\n')"
    longest = """array_max(transform(runs, run ->
        struct(run.length AS length, -run.start AS start, -run.period AS period)))"""
    return found.selectExpr("*", f"{longest} AS best").selectExpr(
        "doc_id",
        "CAST(size(runs) AS BIGINT) AS n_runs",
        "-best.start AS start",
        "best.length AS length",
        "-best.period AS period",
        "1000 * best.length DIV -best.period AS exponent_milli",
        f"sha2(array_join(transform(runs, run -> {line}), ''), 256) AS runs_sha256",
        "sha2(collapsed, 256) AS collapsed_sha256",
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_labels(documents(spark, sf_dir)).selectExpr(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        "array_join(base_labels, ',') AS base_labels",
        "array_join(labels, ',') AS labels",
        "score",
        "CAST(size(spans) AS BIGINT) AS n_spans",
    )


QUERIES: dict[str, Query] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_ngram_join": op2_ngram_join,
    "op3_html_text": op3_html_text,
    "op4_line_dedup": op4_line_dedup,
    "op5_bpe": op5_bpe,
    "op6_pii": op6_pii,
    "op7_language_id": op7_language_id,
    "op8_chat": op8_chat,
    "op9_decontamination": op9_decontamination,
    "op10_token_files": op10_token_files,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_collocations": op12_collocations,
    "op13_license_scan": op13_license_scan,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)
