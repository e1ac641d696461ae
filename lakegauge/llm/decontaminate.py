r"""Removal of benchmark passages, found by spaced seeds.

Words are ``[^\x20\x09-\x0D]+`` in lower case, by their hashes. A seed is the
hash of the words at the places that a fixed mask names, so words at the other
places may differ. The seeds of all windows of the benchmark meet those of all
windows of the documents in a hash join. A hit aligns an item with a document;
along that alignment every window of ``WINDOW`` words (or the whole item, if it
is shorter) is compared word by word, and at least ``MIN_EQUAL`` per cent equal
words in one window make the document contaminated.

The masks of a window's length hit every window of that length with enough equal
words, so no alignment that would be accepted is missed. Items of any length take
part, those of one word too; items with null text or without words are left out.
Documents with null or empty text are clean. Rows with equal ``doc_id``
get the same verdict; rows without a ``doc_id`` are judged as one.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegauge.llm.common import id_and_text
from lakegauge.llm.components import stored

# Places that count, by the least length of a window (the item's, if it is shorter
# than WINDOW). Tests enumerate that no accepted window is missed.
WINDOW = 13
SEED_MASKS = {
    1: ((0,),),
    2: ((0, 1),),
    3: ((0, 1, 2), (0, 1, 3), (0, 2, 3)),
    9: ((0, 1, 2, 4), (0, 3, 4, 5)),
    13: ((0, 1, 2, 4, 5), (0, 1, 3, 4, 5), (0, 1, 6, 8, 9)),
}
MIN_EQUAL = 75
# Seeds of a benchmark that may be broadcast: 32 bytes each, 64 MB at most.
MAX_BROADCAST_SEEDS = 2_000_000


def _hashed_words(text: str) -> str:
    words = rf"split(lower({text}), '[ \t-\r]+')"
    return f"transform(filter({words}, w -> w <> ''), w -> xxhash64(w))"


def masks_of(long: int) -> tuple[tuple[int, ...], ...]:
    """The masks for windows of so many words."""
    return SEED_MASKS[max(least for least in SEED_MASKS if least <= long)]


def _seeds(masks: Iterable[tuple[int, ...]], place: str) -> str:
    """The masks' seeds of a place of the array ``words``; null past its end."""
    each = []
    for mask in masks:
        at = ", ".join(f"get(words, {place} + {offset})" for offset in mask)
        seed = f"xxhash64('{mask}', {at})"
        each.append(f"if({place} + {mask[-1]} < size(words), {seed}, NULL)")
    return f"array({', '.join(each)})"


def benchmark_seeds(texts: DataFrame) -> DataFrame:
    """(seed, text_id, item_place), one row per mask and place of the items."""
    places = texts.selectExpr(
        "text_id", "words", "explode(sequence(0, size(words) - 1)) AS item_place"
    )
    starts = sorted(SEED_MASKS, reverse=True)
    by_length = " ".join(
        f"WHEN size(words) >= {least} THEN {_seeds(SEED_MASKS[least], 'item_place')}"
        for least in starts
    )
    seeds = places.selectExpr(
        "text_id", "item_place", f"explode(CASE {by_length} END) AS seed"
    )
    return seeds.where("seed IS NOT NULL").distinct()


def benchmark_words(benchmark: DataFrame) -> DataFrame:
    """(item_id, text_id, words): equal items have one ``text_id``."""
    items = benchmark.where("text IS NOT NULL").selectExpr(
        "CAST(item_id AS BIGINT) AS item_id", f"{_hashed_words('text')} AS words"
    )
    return items.where("size(words) > 0").selectExpr(
        "item_id", "xxhash64(words) AS text_id", "words"
    )


def _needed_masks(items: DataFrame) -> list[tuple[int, ...]]:
    """The masks of the lengths there are; the driver gets WINDOW numbers at most."""
    lengths = items.selectExpr(f"least({WINDOW}, size(words)) AS long").distinct()
    return sorted({mask for row in lengths.collect() for mask in masks_of(row["long"])})


def _document_seeds(words: DataFrame, masks: list[tuple[int, ...]]) -> DataFrame:
    """A row per place and mask of documents (doc_id, row_id, words)."""
    places = words.selectExpr("doc_id", "row_id", "words", "posexplode(words) AS (place, word)")
    return places.selectExpr(
        "doc_id", "row_id", "place", f"explode({_seeds(masks, 'place')}) AS seed"
    ).where("seed IS NOT NULL")


_ALIGNMENT = ["doc_id", "row_id", "text_id", "shift"]


def _verified(aligned: DataFrame) -> DataFrame:
    """(doc_id, text_id, equal_pct) of alignments (.., words, item_words) with a
    window of enough equal words; ``equal_pct`` is the best one's share.

    Equal words are counted over a window that slides along the item, so the
    work grows with its length. The best window may be taken to end with an
    equal word, since one that hangs over the item's start has no more words in
    it than the first whole one.
    """
    equal = "transform(item_words, (w, k) -> get(words, shift + k) = w)"
    places = aligned.selectExpr(
        *_ALIGNMENT,
        f"least({WINDOW}, size(item_words)) AS long",
        f"posexplode({equal}) AS (k, same)",
    ).where("same")
    # Rows with equal id and text give the same places: each counts once.
    places = places.repartition(*_ALIGNMENT).groupBy(*_ALIGNMENT, "long", "k").count()
    window = f"""count(*) OVER (PARTITION BY {", ".join(_ALIGNMENT)} ORDER BY k
        RANGE BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW)"""
    best = places.selectExpr("doc_id", "text_id", f"100.0D * {window} / long AS equal_pct")
    return (
        best.where(f"equal_pct >= {MIN_EQUAL}")
        .groupBy("doc_id", "text_id")
        .agg(F.max("equal_pct").alias("equal_pct"))
    )


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, equal_pct): items found in documents, each once.

    A benchmark of a checked size is broadcast, and the documents are read
    without a shuffle; seeds of a larger one are shuffled. The alignments that
    the seeds name, each once, are written; the documents that have any are read
    again to be verified along them. Spark broadcasts these tables while their
    files are small.
    """
    docs = docs.where("text IS NOT NULL").selectExpr(
        "doc_id", "xxhash64(text) AS row_id", "text"
    )
    items = benchmark_words(benchmark)
    texts = items.select("text_id", "words").distinct()
    seeds, masks = benchmark_seeds(texts), _needed_masks(texts)
    if not masks:
        return docs.selectExpr(
            "doc_id", "CAST(NULL AS BIGINT) AS item_id", "CAST(NULL AS DOUBLE) AS equal_pct"
        ).where("false")
    if seeds.count() <= MAX_BROADCAST_SEEDS:
        seeds = F.broadcast(seeds)
    spoken = docs.selectExpr("doc_id", "row_id", f"{_hashed_words('text')} AS words")
    hits = _document_seeds(spoken, masks).join(seeds, "seed")
    hits = hits.selectExpr("doc_id", "row_id", "text_id", "place - item_place AS shift")
    found = stored(hits.distinct(), "alignments")

    touched = found.selectExpr("doc_id AS __llm_id", "row_id AS __llm_row").distinct()
    same = F.col("doc_id").eqNullSafe(F.col("__llm_id")) & (
        F.col("row_id") == F.col("__llm_row")
    )
    words = docs.join(touched, same, "left_semi").selectExpr(
        "doc_id AS __llm_id", "row_id AS __llm_row", f"{_hashed_words('text')} AS words"
    )
    texts = texts.withColumnRenamed("words", "item_words")
    aligned = found.join(words, same).join(texts, "text_id")
    return _verified(aligned).join(items.select("item_id", "text_id"), "text_id").groupBy(
        "doc_id", "item_id"
    ).agg(F.max("equal_pct").alias("equal_pct"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Every document's ``contaminated``, the number of items found in it and
    the largest share of equal words."""
    docs = id_and_text(docs)
    found = matches(docs, benchmark).groupBy("doc_id").agg(
        F.count("*").alias("n_items"), F.max("equal_pct").alias("best_pct")
    )
    found = found.withColumnRenamed("doc_id", "__llm_id")
    same = F.col("doc_id").eqNullSafe(F.col("__llm_id"))
    return docs.select("doc_id").join(found, same, "left").selectExpr(
        "doc_id",
        "n_items IS NOT NULL AS contaminated",
        "coalesce(n_items, 0L) AS n_items",
        "best_pct",
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of documents without a benchmark passage. The ids found are
    written: while their file is small no document is shuffled."""
    found = matches(id_and_text(docs), benchmark)
    found = stored(found.selectExpr("doc_id AS __llm_id").distinct(), "contaminated")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__llm_id"))
    return docs.join(found, same, "left_anti")
