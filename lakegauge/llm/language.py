"""Language of whole texts by inference in a mixture of languages.

A text's words come from a mixture of languages: a word's likelihood in a
language is the product over its byte trigrams. Expectation maximisation
estimates each text's language proportions. Candidate sets hold the one, two,
... most probable languages; each set's proportions are estimated anew and the
set with the largest penalised likelihood is taken (half the logarithm of the
number of words per language, times a weight). The language with the largest
proportion is predicted, with that proportion as score.

Null text, or text without a letter (Unicode categories L), is ``und`` with score
0. Ties go to the language first in alphabetical order. More than MAX_LANGUAGES
labelled languages are refused: the model has a row per trigram bucket and a
column per language.

Trigram counts come from a sample of labelled texts, bounded per language by
the parameter ``sample_docs``; which texts are taken depends on a hash of the
text alone. Prediction covers every text as a whole.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegauge.llm.common import arrow_schema, groups, lean, texts_of

UNKNOWN = "und"
BUCKETS = 1 << 16
MAX_LANGUAGES = 256
SMOOTHING = 0.3
ROUNDS = 8
PENALTY = 4.0
# What single precision may add to a word's log likelihood.
ROUNDING = 1e-5
# Characters whose words are in one pass of the inference.
GROUP_CHARS = 400_000
# Letters, and some signs that Python takes for letters.
_LETTER = re.compile(r"[^\W\d_]")
# Bytes of letters: ASCII letters and all of the multi-byte characters.
_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    scores: np.ndarray  # log probability by trigram bucket and language


def trigrams(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the trigrams around each letter byte, and their places."""
    raw = np.frombuffer(b" " + data + b" ", np.uint8)
    places = np.flatnonzero(_IS_LETTER[raw[1:-1]]).astype(np.int64)
    wide = raw.astype(np.uint32)
    code = (wide[places] << 16) | (wide[places + 1] << 8) | wide[places + 2]
    return ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int32), places


def fit(labelled: DataFrame, sample_docs: int = 2000) -> Model:
    """Model from rows (text, lang), at most about ``sample_docs`` a language.

    The driver gets a count per language and per language and bucket: at most
    MAX_LANGUAGES x BUCKETS numbers, however large the input.
    """
    labelled = labelled.where("text IS NOT NULL AND lang IS NOT NULL")
    counted = labelled.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(counted) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    spark = labelled.sparkSession
    shares = spark.createDataFrame(
        [(row["lang"], sample_docs / row["count"]) for row in counted],
        "lang string, share double",
    )
    sample = labelled.join(F.broadcast(shares), "lang").where(
        "pmod(xxhash64(text), 1000000) < share * 1000000"
    )
    schema = arrow_schema("lang string, bucket int, n bigint")

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            texts = texts_of(batch.column("text"))
            for lang, text in zip(batch.column("lang").to_pylist(), texts):
                buckets, _ = trigrams(text.lower().encode())
                own = found.setdefault(lang, np.zeros(BUCKETS, np.int64))
                own += np.bincount(buckets, minlength=BUCKETS)
        for lang, counts in found.items():
            seen = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(seen), pa.string()),
                    pa.array(seen, pa.int32()),
                    pa.array(counts[seen], pa.int64()),
                ],
                schema=schema,
            )

    # The sample is small: a few tasks keep the partial counts few.
    gathered = sample.select("lang", "text").repartition(6)
    partial = gathered.mapInArrow(count, "lang string, bucket int, n bigint")
    rows = partial.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect()
    languages = tuple(sorted({row["lang"] for row in rows}))
    counts = np.zeros((BUCKETS, len(languages)))
    for row in rows:
        counts[row["bucket"], languages.index(row["lang"])] = row["n"]
    counts += SMOOTHING
    scores = np.log(counts / counts.sum(axis=0)) if languages else counts
    return Model(languages, scores.astype(np.float32))


def has_letter(text: str | None) -> bool:
    found = _LETTER.finditer(text or "")
    return any(unicodedata.category(m.group()).startswith("L") for m in found)


def _proportions(
    odds: np.ndarray, allowed: np.ndarray, starts: np.ndarray, lengths: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """EM for all texts at once: proportions and log likelihood by text.

    ``odds``: by word and language; ``allowed``: by text and language. Words
    of a text stand together, ``lengths`` of them from ``starts``.
    """
    shares = allowed / allowed.sum(axis=1, keepdims=True)
    ones = np.ones(odds.shape[1], np.float32)
    for _ in range(ROUNDS):
        joint = odds * np.repeat(shares.astype(np.float32), lengths, axis=0)
        total = joint @ ones
        joint /= np.maximum(total, 1e-30)[:, None]
        shares = np.add.reduceat(joint, starts, axis=0) / lengths[:, None]
    joint = odds * np.repeat(shares.astype(np.float32), lengths, axis=0)
    likelihood = np.log(np.maximum(joint @ ones, 1e-30)).astype(np.float64)
    return shares, np.add.reduceat(likelihood, starts)


def infer(model: Model, texts: list[str | None]) -> list[tuple[str, float]]:
    """Language and score of each text of a group."""
    results: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
    chosen = [k for k, text in enumerate(texts) if has_letter(text)]
    if not chosen or not model.languages:
        return results
    joined = [texts[k].lower().encode() for k in chosen]
    # Blanks between them, as at the ends: neighbours do not change a text's words.
    together = b" ".join(joined)
    buckets, places = trigrams(together)
    data = np.frombuffer(together, np.uint8)
    # Words by the spaces before them; texts by the place they start at.
    word_of_place = np.cumsum(_IS_SPACE[data])[places]
    first = np.flatnonzero(np.diff(word_of_place, prepend=-1))
    word_scores = np.add.reduceat(model.scores[buckets], first, axis=0)
    ends = np.cumsum([len(text) + 1 for text in joined])
    text_of_word = np.searchsorted(ends, places[first], side="right")
    present, starts, lengths = np.unique(
        text_of_word, return_index=True, return_counts=True
    )
    word_scores -= word_scores.max(axis=1, keepdims=True)
    odds = np.exp(np.maximum(word_scores, -60.0))
    n = len(model.languages)
    shares, likelihood = _proportions(
        odds, np.ones((len(present), n)), starts, lengths
    )
    order = np.argsort(-shares, axis=1, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(n)[None, :], axis=1)
    price = PENALTY * 0.5 * np.log(lengths + 1.0)
    best, best_shares = likelihood - n * price, shares
    for size in range(1, n):
        # No mixture is likelier than each word's best language (odds 1), so a
        # text whose best value is above the price alone is settled.
        is_open = best <= ROUNDING * lengths - size * price
        if not is_open.any():
            break
        left, some = np.flatnonzero(is_open), lengths[is_open]
        own, likelihood = _proportions(
            odds[np.repeat(is_open, lengths)],
            (rank[left] < size) * 1.0,
            np.cumsum(some) - some,
            some,
        )
        value = likelihood - size * price[left]
        better = value >= best[left]
        best[left[better]] = value[better]
        best_shares[left[better]] = own[better]
    top = np.argmax(best_shares, axis=1)
    for text, language, row in zip(present, top, best_shares):
        score = min(1.0, float(row[language]))
        results[chosen[text]] = (model.languages[language], score)
    return results


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Every row of ``docs`` with ``__llm_lang`` and ``__llm_score``, which come
    from the text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @lean
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[str, float]] = []
            for group in groups(texts_of(batch.column("text")), GROUP_CHARS):
                found += infer(shared.value, group)
            columns = list(zip(*found)) or [(), ()]
            batch = batch.append_column("__llm_lang", pa.array(columns[0], pa.string()))
            yield batch.append_column("__llm_score", pa.array(columns[1], pa.float64()))

    schema = docs.schema.fields + [
        T.StructField("__llm_lang", T.StringType()),
        T.StructField("__llm_score", T.DoubleType()),
    ]
    return docs.mapInArrow(work, T.StructType(schema))


HELD_OUT = "crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0"


def identify_held_out(
    docs: DataFrame, sample_docs: int = 2000, keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """Learn from the documents that are not held out and predict all.

    Returns the columns ``keep``, ``__llm_held_out``, ``__llm_lang`` and ``__llm_score``.
    A null ``doc_id`` counts as held out.
    """
    held_out = f"coalesce({HELD_OUT}, true)"
    model = fit(docs.where(f"NOT {held_out}").select("text", "lang"), sample_docs)
    read = docs.select(*dict.fromkeys([*keep, "doc_id", "text"]))
    return identify(read, model).select(
        *keep, F.expr(held_out).alias("__llm_held_out"), "__llm_lang", "__llm_score"
    )
