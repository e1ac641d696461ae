"""Removal of lines that many documents share, with keep bitmaps.

Lines become hashes of their keys. The hashes are dealt out by range with their
documents, so a frequent line spreads over several parts, and sorted within the
parts by hash, document and place. Streaming over a sorted part marks the first
occurrence of a line in each document; the parts are written in that order. The
first occurrences of a run of equal hashes are counted per part and the counts
of a run that a border cuts are merged. Occurrences meet the counts by hash and
part, so that no task gets all of a frequent line.

What comes back per document is a bitmap of its lines, as 64-bit words up to the
last word with a dropped line; documents that lose nothing have none. The
bitmaps are written: while their file is small Spark broadcasts them, and no text
moves. Beyond, texts and bitmaps are shuffled by document.

Null or empty text is one empty line. Lines with an empty key always stay. Rows
with equal ``doc_id`` and text are documents of their own where documents are
counted, and get equal bitmaps. Null ``doc_id`` is a value like others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegauge.llm.common import id_and_text
from lakegauge.llm.components import stored

# White space stripped from a line for its key.
_STRIP = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINES = r"split(coalesce(text, ''), '\n', -1)"
_RUN = ["h1", "h2", "doc_id", "body"]


def line_key(line: str) -> str:
    """The key of a line, as SQL: stripped, A-Z in lower case."""
    return f"translate(btrim({line}, {_STRIP}), '{_UPPER}', '{_LOWER}')"


def occurrences(docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """One row per line whose key has ``min_chars`` characters or more.

    h1 and h2 are 128 bits of the key's hash, ``body`` the hash of the text.
    """
    hashed = docs.selectExpr(
        "doc_id",
        "xxhash64(text) AS body",
        f"transform({LINES}, line -> {line_key('line')}) AS keys",
    )
    return hashed.selectExpr(
        "doc_id",
        "body",
        f"""inline(filter(transform(keys, (key, place) -> struct(
              xxhash64(key) AS h1, xxhash64(7, key) AS h2, place,
              char_length(key) >= {min_chars} AS counts)), x -> x.counts))""",
    ).drop("counts")


def first_occurrences(lines: DataFrame) -> DataFrame:
    """Occurrences in sorted range parts, with the number of their ``part`` and
    whether they are the ``first`` of their line in their document; of rows that
    are equal altogether each has its first."""
    dealt = lines.repartitionByRange(*_RUN)
    rank = f"rank() OVER (PARTITION BY {', '.join(_RUN)} ORDER BY place)"
    return dealt.selectExpr("*", f"{rank} = 1 AS first").withColumn(
        "part", F.spark_partition_id()
    )


def shared_lines(docs: DataFrame, min_docs: int, min_chars: int = 1) -> DataFrame:
    """Occurrences of the keys found in ``min_docs`` documents or more."""
    lines = stored(occurrences(docs, min_chars), "lines")
    runs = stored(first_occurrences(lines), "runs")
    cut = runs.groupBy("h1", "h2", "part").agg(F.count_if("first").alias("n"))
    cut = stored(cut, "counts")
    whole = cut.groupBy("h1", "h2").agg(F.sum("n").alias("n"))
    shared = cut.drop("n").join(whole.where(f"n >= {min_docs}"), ["h1", "h2"])
    shared = stored(shared.select("h1", "h2", "part"), "shared")
    return runs.join(shared, ["h1", "h2", "part"]).drop("part", "first")


def drop_bitmaps(dropped: DataFrame) -> DataFrame:
    """(doc_id, body, bits): bit ``place % 64`` of word ``place / 64`` is set
    when the line is dropped."""
    words = (
        dropped.repartition("doc_id", "body")
        .groupBy("doc_id", "body", F.expr("place div 64").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, CAST(place % 64 AS INT)))").alias("bits"))
        .groupBy("doc_id", "body")
        .agg(F.expr("map_from_entries(collect_list(struct(word, bits)))").alias("w"))
    )
    return words.selectExpr(
        "doc_id",
        "body",
        """transform(sequence(0L, array_max(map_keys(w))),
                     k -> coalesce(try_element_at(w, k), 0L)) AS bits""",
    )


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Every row of ``docs`` with its bitmap ``bits``, null if nothing goes,
    and what is left of its text as ``kept``."""
    found = stored(
        bitmaps.selectExpr("doc_id AS __llm_id", "body AS __llm_body", "bits AS __llm_bits"),
        "bitmaps",
    )
    joined = docs.join(
        found,
        F.col("doc_id").eqNullSafe(F.col("__llm_id"))
        & (F.expr("xxhash64(text)") == F.col("__llm_body")),
        "left",
    )
    kept = f"""array_join(filter({LINES}, (line, i) -> coalesce(
        shiftright(get(__llm_bits, i div 64), CAST(i % 64 AS INT)) & 1L = 0, true)), '\n')"""
    return joined.selectExpr(
        *[f"`{name}`" for name in docs.columns],
        "__llm_bits",
        f"if(__llm_bits IS NULL, coalesce(text, ''), {kept}) AS __llm_kept",
    )


def line_dedup(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """Per document ``bits``, ``kept``, ``n_lines`` and ``n_dropped``."""
    docs = id_and_text(docs)
    bitmaps = drop_bitmaps(shared_lines(docs, min_docs, min_chars))
    return apply_bitmaps(docs, bitmaps).selectExpr(
        "doc_id",
        "__llm_bits AS bits",
        "__llm_kept AS kept",
        f"CAST(size({LINES}) AS BIGINT) AS n_lines",
        """coalesce(aggregate(__llm_bits, 0L, (n, word) -> n + bit_count(word)), 0L)
             AS n_dropped""",
    )
