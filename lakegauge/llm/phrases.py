"""Collocations of two to four words by the stripes pattern.

A *stripe* is the counter of the words that come next after a prefix. Tasks
count the stripes of a chunk of text and send each as one row; Spark merges
the rows of a prefix by adding up equal next words. The merged stripes say
everything: the occurrences of a phrase are an entry of the stripe of its
words but the last, those of a prefix are known from the stripe one word
before, and the largest entry of a stripe, or of those that end alike, is the
most that any longer phrase around it can have.

Three rounds over the text, each with stripes of longer prefixes: none, one
word, two and three words. A phrase that occurs ``min_count`` times consists
of shorter ones that do, so a round leaves out next words and prefixes that
the round before has not found often enough. Workers ask a bit filter for
that: ``FILTER_BITS`` bits at most, however many phrases there are; what it
lets through in error is counted like the rest and left out by its count.

A prefix with more than one in ``HOT_SHARE`` words has its stripe dealt into
``SLICES`` by the next word; there are less than ``HOT_SHARE`` such words and
as many pairs. The empty prefix is always dealt.

Everything is counted per language; null is ``und``. Null, empty and blank
texts have no words. Rows with equal or null ``doc_id`` all count; other
columns than ``text`` and ``lang`` are not read. A table without words has no
phrases.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Mapping, Sequence
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegauge.llm.common import lean, texts_of
from lakegauge.llm.components import stored

MAX_WORDS = 4
CHUNK_BYTES = 12_000_000
SEGMENT_BYTES = 8_000_000
FILTER_BITS = 1 << 27
BITS_PER_KEY = 16
SLICES = 64
HOT_SHARE = 1000

# What ends a piece, and what separates words in it.
_BREAKS, _BLANKS = b".,;:!?\n\v\f\r", b" \t"
_PLAIN = bytes(
    10 if b in _BREAKS else 32 if b in _BLANKS else b + 32 if 65 <= b <= 90 else b
    for b in range(256)
)
_BREAK = 1


# Chunks of text


def _segments(text: str) -> Iterator[bytes]:
    """A text in plain form, cut between pieces into bounded parts; a longer
    piece stays whole."""
    data = text.encode().translate(_PLAIN)
    at = 0
    while len(data) - at > SEGMENT_BYTES:
        cut = data.rfind(b"\n", at, at + SEGMENT_BYTES)
        if cut < 0:
            cut = data.find(b"\n", at + SEGMENT_BYTES)
        if cut < 0:
            break
        yield data[at:cut]
        at = cut + 1
    yield data[at:]


class _Words:
    """The words of one language's part of a chunk, by number."""

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = defaultdict(count().__next__)
        # In this order: what stands between two blanks, and _BREAK.
        self.numbers[b""], self.numbers[b"\n"]
        self.parts: list[np.ndarray] = []

    def add(self, data: bytes) -> None:
        tokens = data.replace(b"\n", b" \n ").split(b" ")
        tokens.append(b"\n")
        found = np.fromiter(
            map(self.numbers.__getitem__, tokens), np.int32, len(tokens)
        )
        self.parts.append(found[found != 0])

    def sequence(self) -> np.ndarray:
        return np.concatenate(self.parts).astype(np.int64)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, _Words]]:
    """(language, words) of chunks of a task's texts."""
    chunk: dict[str, _Words] = defaultdict(_Words)
    size = 0
    for batch in batches:
        languages = texts_of(batch.column("lang"))
        for lang, text in zip(languages, texts_of(batch.column("text"))):
            for data in _segments(text or ""):
                chunk[lang].add(data)
                size += len(data)
                if size >= CHUNK_BYTES:
                    yield from chunk.items()
                    chunk.clear()
                    size = 0
    yield from chunk.items()


# Filters of what was often enough


def _pair_hash(left, right):
    """Of two 64-bit hashes; as :func:`_pair_hash_sql`."""
    return (left << np.uint64(21)) ^ (left >> np.uint64(43)) ^ right


def _pair_hash_sql(left: str, right: str) -> str:
    return f"shiftleft({left}, 21) ^ shiftrightunsigned({left}, 43) ^ {right}"


def _word_hash_sql(word: str) -> str:
    return f"xxhash64(lang, {word})"


def _word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode(), seed=42)
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(word, seed=seed) for word in words), np.uint64, len(words)
    )


def bit_filter(keys: DataFrame, hashed: str) -> np.ndarray:
    """Bits of the hashes of all rows, as many as the rows ask for within
    FILTER_BITS. Spark sets them; the driver gets the words of the filter."""
    wanted = max(1 << 16, keys.count() * BITS_PER_KEY)
    bits = min(FILTER_BITS, 1 << (wanted - 1).bit_length())
    words = (
        keys.selectExpr(f"({hashed}) & {bits - 1}L AS bit")
        .groupBy(F.expr("shiftright(bit, 6) AS at"))
        .agg(F.expr("bit_or(shiftleft(1L, CAST(bit & 63 AS INT))) AS bits"))
        .toArrow()
    )
    table = np.zeros(bits // 64, np.uint64)
    at = words.column("at").to_numpy()
    table[at] = words.column("bits").to_numpy().view(np.uint64)
    return table


def _has(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = hashes & np.uint64(len(table) * 64 - 1)
    word = table[(bit >> np.uint64(6)).astype(np.int64)]
    return (word >> (bit & np.uint64(63))) & np.uint64(1) == 1


# Stripes

_ROW = "lang string, prefix string, slice int, nexts string, counts array<int>"
_TARGET = pa.schema(
    [
        ("lang", pa.string()),
        ("prefix", pa.string()),
        ("slice", pa.int32()),
        ("nexts", pa.string()),
        ("counts", pa.list_(pa.int32())),
    ]
)
_STRIPES_AT_ONCE = 50_000


def _stripe_rows(
    lang: str,
    spelled: pa.Array,
    prefixes: list[np.ndarray],
    following: np.ndarray,
    counts: np.ndarray,
    dealt: np.ndarray,
) -> Iterator[pa.RecordBatch]:
    """A row per prefix (its words, column by column) and slice, from entries
    in order of prefix; ``dealt`` says which are dealt into slices."""
    slices = np.zeros(len(following), np.int64)
    slices[dealt] = _slice_of(spelled, following[dealt])
    order = np.lexsort((slices, *reversed(prefixes)))
    columns = [column[order] for column in (*prefixes, slices)]
    new = np.ones(len(order), bool)
    new[1:] = np.any([column[1:] != column[:-1] for column in columns], 0)
    starts = np.append(np.flatnonzero(new), len(order))
    for at in range(0, len(starts) - 1, _STRIPES_AT_ONCE):
        own = starts[at : at + _STRIPES_AT_ONCE + 1]
        rows = order[own[0] : own[-1]]
        offsets = pa.array(own - own[0], pa.int32())
        first = order[own[:-1]]
        words = [spelled.take(pa.array(column[first])) for column in prefixes]
        if words:
            prefix = pc.binary_join_element_wise(*words, " ")
        else:
            prefix = pa.array([""] * len(first))
        nexts = spelled.take(pa.array(following[rows]))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(first)),
                prefix,
                pa.array(slices[first], pa.int32()),
                pc.binary_join(pa.ListArray.from_arrays(offsets, nexts), " "),
                pa.ListArray.from_arrays(offsets, pa.array(counts[rows], pa.int32())),
            ],
            schema=_TARGET,
        )


def _slice_of(spelled: pa.Array, following: np.ndarray) -> np.ndarray:
    """Slice of each next word, the same in every task."""
    words, at = np.unique(following, return_inverse=True)
    hashes = [xxhash.xxh32_intdigest(w.as_py()) for w in spelled.take(pa.array(words))]
    return (np.array(hashes, np.int64) % SLICES)[at]


def _counted(sequence: np.ndarray, starts: np.ndarray, size: int):
    """Words, column by column, and counts of the distinct phrases of ``size``
    words at places."""
    base = int(sequence.max(initial=0)) + 1
    names = sequence[starts]
    members = [names]
    for k in range(1, size):
        members.append(sequence[starts + k])
        if k > 1:
            names = np.unique(names, return_inverse=True)[1]
        names = names * base + members[-1]
    _, first, counts = np.unique(names, return_index=True, return_counts=True)
    return [column[first] for column in members], counts


def _begins_with(
    members: list[np.ndarray], numbers: dict[bytes, int], phrase: str
) -> np.ndarray:
    """Which phrases begin with the words of another."""
    own = [numbers.get(word.encode(), 0) for word in phrase.split(" ")]
    return np.all([column == number for column, number in zip(members, own)], 0)


def _count_stripes(
    docs: DataFrame,
    size: int,
    often: np.ndarray | None = None,
    hot: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Merged stripes (lang, prefix, next, f) of phrases of ``size`` words, with
    ``size`` 3 of those of 4 words too. ``often`` is the filter of words (size
    2) or pairs (size 3); ``hot`` has the phrases of a language whose stripes,
    and those of prefixes that begin so, are dealt."""
    spark = docs.sparkSession
    shared = None if often is None else spark.sparkContext.broadcast(often)

    @lean
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words in _chunks(batches):
            sequence, vocabulary = words.sequence(), list(words.numbers)
            spelled = pa.array([word.decode() for word in vocabulary], pa.string())
            plain = sequence != _BREAK
            if size == 1:
                found = [np.flatnonzero(plain)]
            else:
                hashes = _word_hashes(lang, vocabulary)
                if size == 2:
                    good = _has(shared.value, hashes)[sequence] & plain
                    pairs = good[:-1] & good[1:]
                else:
                    pairs = plain[:-1] & plain[1:]
                    at = hashes[sequence]
                    pairs &= _has(shared.value, _pair_hash(at[:-1], at[1:]))
                found = [np.flatnonzero(pairs)]
            if size == 3:
                three = pairs[:-1] & pairs[1:]
                four = three[:-1] & pairs[2:]
                found = [np.flatnonzero(three), np.flatnonzero(four)]
            for more, starts in enumerate(found):
                members, counts = _counted(sequence, starts, size + more)
                dealt = np.full(len(counts), size == 1)
                for phrase in (hot or {}).get(lang, ()):
                    dealt |= _begins_with(members, words.numbers, phrase)
                yield from _stripe_rows(
                    lang, spelled, members[:-1], members[-1], counts, dealt
                )

    read = docs.selectExpr("coalesce(CAST(lang AS STRING), 'und') AS lang", "text")
    stripes = read.mapInArrow(work, _ROW).repartition("lang", "prefix", "slice")
    entries = stripes.selectExpr(
        "lang", "prefix", "slice", "inline(arrays_zip(split(nexts, ' '), counts))"
    ).toDF("lang", "prefix", "slice", "next", "n")
    merged = entries.groupBy("lang", "prefix", "slice", "next")
    return merged.agg(F.sum("n").alias("f")).drop("slice")


def _hot(phrases: DataFrame, total: int) -> dict[str, list[str]]:
    """Phrases by language that make up more than one in HOT_SHARE of all words:
    less than HOT_SHARE rows."""
    hot: dict[str, list[str]] = {}
    for row in phrases.where(f"f * {HOT_SHARE} > {total}").collect():
        hot.setdefault(row.lang, []).append(row.phrase)
    return hot


def phrase_counts(docs: DataFrame, min_count: int) -> tuple[DataFrame, DataFrame]:
    """Written tables of words (lang, prefix, next, f; all of them, the prefix
    empty) and of phrases of 2 to MAX_WORDS words with ``min_count`` or more."""
    words = stored(_count_stripes(docs, 1), "words")
    total = words.agg(F.sum("f")).first()[0] or 0
    often = words.where(f"f >= {min_count}").selectExpr("lang", "next AS phrase", "f")
    pairs = _count_stripes(
        docs, 2, bit_filter(often, _word_hash_sql("phrase")), _hot(often, total)
    )
    pairs = stored(pairs.where(f"f >= {min_count}"), "pairs")
    hashed = _pair_hash_sql(_word_hash_sql("prefix"), _word_hash_sql("next"))
    longer = _count_stripes(
        docs,
        3,
        bit_filter(pairs, hashed),
        _hot(pairs.selectExpr("lang", "concat(prefix, ' ', next) AS phrase", "f"), total),
    )
    longer = stored(longer.where(f"f >= {min_count}"), "longer")
    return words, pairs.unionByName(longer)


def collocations(
    docs: DataFrame, min_count: int = 30, top: int = 2000, subsumed_pct: int = 80
) -> DataFrame:
    """The first ``top`` phrases of each language.

    ``a`` counts a phrase, ``l`` and ``r`` the two parts of the cut with the
    lowest ``score``, floor(2,000,000 a / (l + r)), and ``n`` the language's
    words. A phrase inside a longer one with ``subsumed_pct`` of its
    occurrences or more is left out. Ties: more occurrences first, then by the
    bytes of the phrase.
    """
    words, stripes = phrase_counts(docs, min_count)
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    spelled = "concat_ws(' ', nullif(prefix, ''), next)"
    phrases = stripes.selectExpr("*", f"{spelled} AS phrase")
    known = (
        words.where(f"f >= {min_count}")
        .unionByName(stripes)
        .selectExpr("lang", f"{spelled} AS part", "f")
    )
    # The most of any phrase one word longer, to the right and to the left.
    # Phrases with two words more have no more than one of those.
    around = phrases.where("instr(prefix, ' ') > 0").selectExpr(
        "lang",
        "inline(array(struct(prefix AS phrase, f AS most), "
        "struct(substr(phrase, instr(phrase, ' ') + 1) AS phrase, f AS most)))",
    )
    most = around.groupBy("lang", "phrase").agg(F.max("most").alias("most"))
    kept = (
        phrases.join(most, ["lang", "phrase"], "left")
        .where(
            f"most IS NULL OR CAST(most AS DECIMAL(20, 0)) * 100 "
            f"< CAST(f AS DECIMAL(20, 0)) * {subsumed_pct}"
        )
        .selectExpr("lang", "phrase", "f AS a")
    )
    cuts = kept.selectExpr("*", "split(phrase, ' ') AS words").selectExpr(
        "*", "explode(sequence(1, size(words) - 1)) AS k"
    )
    sides = cuts.selectExpr(
        "lang",
        "phrase",
        "a",
        "k",
        "array_join(slice(words, 1, k), ' ') AS first",
        f"array_join(slice(words, k + 1, {MAX_WORDS}), ' ') AS rest",
    )
    left = known.selectExpr("lang", "part AS first", "f AS l")
    right = known.selectExpr("lang", "part AS rest", "f AS r")
    whole = "CAST({} AS DECIMAL(20, 0))"
    score = (
        f"CAST({whole.format('a')} * 2000000 "
        f"DIV ({whole.format('l')} + {whole.format('r')}) AS BIGINT)"
    )
    scored = (
        sides.join(left, ["lang", "first"])
        .join(right, ["lang", "rest"])
        .groupBy("lang", "phrase", "a")
        .agg(F.expr(f"min(struct({score} AS score, k, l, r)) AS cut"))
        .selectExpr("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )
    # No task ranks a whole language: first a part of it, by a hash, and then
    # the first ones of all parts.
    by = "ORDER BY score DESC, a DESC, phrase"
    in_part = scored.selectExpr("*", f"pmod(xxhash64(phrase), {SLICES}) AS part")
    first = in_part.selectExpr(
        "*", f"row_number() OVER (PARTITION BY lang, part {by}) AS place"
    ).where(f"place <= {top}")
    ranked = first.selectExpr(
        "*", f"CAST(row_number() OVER (PARTITION BY lang {by}) AS BIGINT) AS rank"
    ).where(f"rank <= {top}")
    return ranked.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
