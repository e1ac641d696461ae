"""Token ids in files of static range asymmetric numeral system blocks.

Documents are dealt out by range of ``doc_id``; each part encodes its ids in
order. About ``SEGMENT_IDS`` ids make a segment: one frequency table, shared by
the segment's blocks of ``BLOCK_IDS`` ids. A block is independent: its ids are
dealt in turn to lanes with a state each, whose words interleave in one stream.
At checkpoints a block notes all states and the place in the stream, so parts
of it decode in parallel; a CRC-32 of its ids guards it. Segments are rows of a
Parquet table, whose commit makes a lost task's work repeatable.

Null or empty text gives the end id alone. Rows with equal ``doc_id`` are
documents of their own, in any order; null ``doc_id`` comes first. Ids have 16
bits; a vocabulary with more tokens is refused.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakegauge.llm.common import (
    arrow_schema,
    groups,
    held,
    id_and_text,
    lean,
    near_class,
    release,
    texts_of,
)

END_ID = 2
SCALE_BITS = 16
SEGMENT_IDS = 4_000_000
BLOCK_IDS = 1_000_000
LANES = 2048
ROWS_PER_CHECKPOINT = 128

# The library's rules for words, for texts of Latin-1 characters.
_L, _N = near_class("L"), near_class("N")
_WORDS = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^\t-\r \x85\xa0{_L}{_N}]+"
)
# Texts with others, or with a special token, are encoded by the library whole.
_PLAIN = re.compile(r"[\x00-\xff]*")
# Python's blanks and the library's differ in these alone, below 256.
_ODD_BLANKS = re.compile(r"[\x1c-\x1f]")
# Entries that a worker's table may hold before the rarest half goes.
MAX_ENTRIES = 500_000
NEW_AT_ONCE = 20_000


# Tokens


class WordTokenizer:
    """Ids as little-endian 16-bit bytes, stretch by stretch.

    No word reaches over a blank, so what stands between two blanks has the
    same ids everywhere. The library encodes it once; after that it is a number
    in a table, and the ids of a group of texts are gathered by these numbers.
    """

    def __init__(self, vocabulary: str) -> None:
        self._library = Tokenizer.from_str(vocabulary)
        self._library.no_truncation()
        self._library.no_padding()
        added = self._library.get_added_tokens_decoder().values()
        self._special = [token.content for token in added]
        size = self._library.get_vocab_size()
        if size > 1 << 16:
            raise ValueError(f"ids of {size} tokens do not fit 16 bits")
        tokens = [self._library.id_to_token(k) or "" for k in range(size)]
        self._ends_word = np.array([token.endswith("</w>") for token in tokens])
        self._start_anew([], np.empty(0, np.uint16), np.empty(0, np.int64))

    def _start_anew(self, known: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        """The stretches with their ids in a row, and how often each was met."""
        self._numbers: dict[str, int] = defaultdict(count(len(known)).__next__)
        self._numbers.update(zip(known, range(len(known))))
        self._ids, self._sizes = ids, sizes
        self._starts = np.cumsum(sizes) - sizes
        self._met = np.zeros(len(known), np.int64)

    def _make_room(self) -> None:
        """Keep the half that was met most often."""
        if len(self._numbers) <= MAX_ENTRIES:
            return
        kept = np.argsort(-self._met, kind="stable")[: MAX_ENTRIES // 2]
        kept.sort()
        names = list(self._numbers)
        ids = self._gather(kept)
        self._start_anew([names[k] for k in kept.tolist()], ids, self._sizes[kept])

    def _gather(self, numbers: np.ndarray) -> np.ndarray:
        """The ids of stretches, in a row."""
        sizes = self._sizes[numbers]
        ends = np.cumsum(sizes)
        shift = np.repeat(self._starts[numbers] - (ends - sizes), sizes)
        return self._ids[shift + np.arange(len(shift))]

    def _by_library(self, text: str) -> np.ndarray:
        ids = self._library.encode(text, add_special_tokens=False).ids
        return np.array(ids, np.uint16)

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and how many each has.

        They are one text for the library, with blanks between. Every word's
        last token is a word's end.
        """
        ids = self._by_library(" ".join(words))
        ends = np.flatnonzero(self._ends_word[ids]) + 1
        if len(ends) == len(words) and ends[-1] == len(ids):
            return ids, np.diff(ends, prepend=0)
        each = [self._by_library(word) for word in words]
        return np.concatenate(each), np.array([len(one) for one in each])

    def _learn(self, first: int) -> None:
        """Encode the stretches that got their numbers last: new words by the
        library, stretches of several words from these."""
        new = self._named_from(first)
        parts = [_WORDS.findall(stretch) for stretch in new]
        several = np.array([len(words) > 1 for words in parts])
        number = self._numbers.__getitem__
        # Words that were no stretch so far get the next numbers.
        members = [number(w) for words in parts if len(words) > 1 for w in words]
        more = self._named_from(first + len(new))
        words = [*(s for s, split in zip(new, several.tolist()) if not split), *more]
        ids, sizes = [self._ids], [np.empty(0, np.int64)]
        for at in range(0, len(words), NEW_AT_ONCE):
            encoded = self._encoded(words[at : at + NEW_AT_ONCE])
            ids.append(encoded[0])
            sizes.append(encoded[1])
        own = np.append(np.flatnonzero(~several), np.arange(len(more)) + len(new))
        self._add(first + own, np.concatenate(ids), np.concatenate(sizes))
        if members:
            flat, counts = np.array(members), np.array([len(w) for w in parts])[several]
            sizes_of = np.add.reduceat(self._sizes[flat], np.cumsum(counts) - counts)
            joined = np.concatenate([self._ids, self._gather(flat)])
            self._add(first + np.flatnonzero(several), joined, sizes_of)

    def _named_from(self, first: int) -> list[str]:
        last = islice(reversed(self._numbers), len(self._numbers) - first)
        return list(last)[::-1]

    def _add(self, numbers: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Note stretches whose ids stand at the end of ``ids``."""
        room = len(self._numbers) - len(self._met)
        if room:
            self._starts = np.append(self._starts, np.zeros(room, np.int64))
            self._sizes = np.append(self._sizes, np.zeros(room, np.int64))
            self._met = np.append(self._met, np.zeros(room, np.int64))
        self._starts[numbers] = len(ids) - sizes.sum() + np.cumsum(sizes) - sizes
        self._sizes[numbers] = sizes
        self._ids = ids

    def encode(self, texts: list[str | None]) -> list[bytes]:
        self._make_room()
        first = len(self._numbers)
        number = self._numbers.__getitem__
        plain: list[np.ndarray | None] = []
        for text in texts:
            text = text or ""
            if (
                not _PLAIN.fullmatch(text)
                or _ODD_BLANKS.search(text)
                or any(special in text for special in self._special)
            ):
                plain.append(None)
                continue
            stretches = text.lower().split()
            plain.append(np.fromiter(map(number, stretches), np.int64, len(stretches)))
        if len(self._numbers) > first:
            self._learn(first)
        numbers = [np.empty(0, np.int64), *[n for n in plain if n is not None]]
        together = np.concatenate(numbers)
        self._met += np.bincount(together, minlength=len(self._met))
        long = np.concatenate(([0], np.cumsum(self._sizes[together])))
        ends = 2 * long[np.cumsum([len(n) for n in numbers])]
        data = self._gather(together).astype("<u2").tobytes()
        parts = (data[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()))
        return [
            self._by_library(text or "").astype("<u2").tobytes()
            if own is None
            else next(parts)
            for text, own in zip(texts, plain)
        ]


def _tokenizer(vocabulary: str) -> WordTokenizer:
    return held(("rans", vocabulary), lambda: WordTokenizer(vocabulary))


# The numeral system


class Table:
    """Frequencies of ids, scaled to a sum of 2**SCALE_BITS, at least 1 each."""

    def __init__(self, symbols: np.ndarray, frequencies: np.ndarray) -> None:
        self.symbols, self.frequencies = symbols, frequencies
        starts = np.cumsum(frequencies) - frequencies
        size = int(symbols[-1]) + 1
        self.frequency = np.zeros(size, np.uint64)
        self.start = np.zeros(size, np.uint64)
        self.frequency[symbols], self.start[symbols] = frequencies, starts
        self.symbol_at = np.repeat(symbols, frequencies).astype(np.uint16)

    @classmethod
    def of(cls, ids: np.ndarray) -> Table:
        counts = np.bincount(ids)
        symbols = np.flatnonzero(counts)
        total = 1 << SCALE_BITS
        scaled = np.maximum(1, counts[symbols] * total // len(ids))
        rest = total - int(scaled.sum())
        if rest >= 0:
            scaled[np.argmax(scaled)] += rest
        while rest < 0:  # too many ones: take from the frequent ids
            most = int(np.argmax(scaled))
            taken = min(-rest, int(scaled[most]) // 2)
            scaled[most] -= taken
            rest += taken
        return cls(symbols.astype(np.uint16), scaled.astype(np.uint32))

    def to_bytes(self) -> bytes:
        return self.symbols.astype("<u2").tobytes() + (
            (self.frequencies - 1).astype("<u2").tobytes()
        )

    @classmethod
    def from_bytes(cls, data: bytes) -> Table:
        values = np.frombuffer(data, "<u2")
        half = len(values) // 2
        return cls(values[:half], values[half:].astype(np.uint32) + 1)


_HEAD = struct.Struct("<IIIII")  # ids, lanes, checkpoints, words, CRC-32


def encode_block(ids: np.ndarray, table: Table) -> bytes:
    """One block: head, checkpoints (place and states), words."""
    n = len(ids)
    lanes = max(1, min(LANES, n // 64))
    rows = -(-n // lanes)
    states = np.full(lanes, 1 << SCALE_BITS, np.uint64)
    emitted: list[np.ndarray] = []
    marks = []
    size = 0
    for row in range(rows - 1, -1, -1):
        symbols = ids[row * lanes : (row + 1) * lanes]
        active = states[: len(symbols)]
        frequency = table.frequency[symbols]
        full = active >= frequency << 16
        words = active[full]
        emitted.append((words & 0xFFFF).astype("<u2"))
        size += len(words)
        active[full] = words >> 16
        whole, rest = np.divmod(active, frequency)
        states[: len(symbols)] = (whole << SCALE_BITS) + rest + table.start[symbols]
        if row % ROWS_PER_CHECKPOINT == 0:
            marks.append((size, states.astype("<u4").tobytes()))
    stream = b"".join(words.tobytes() for words in reversed(emitted))
    crc = zlib.crc32(ids.astype("<u4").tobytes())
    head = _HEAD.pack(n, lanes, len(marks), size, crc)
    # Places are counted from the stream's end while encoding.
    places = [struct.pack("<I", size - at) + kept for at, kept in reversed(marks)]
    return head + b"".join(places) + stream


def decode_part(block: bytes, checkpoint: int, table: Table) -> np.ndarray:
    """The ids from one checkpoint to the next."""
    n, lanes, _, size, _ = _HEAD.unpack_from(block)
    each = 4 + 4 * lanes
    at = _HEAD.size + checkpoint * each
    (place,) = struct.unpack_from("<I", block, at)
    states = np.frombuffer(block, "<u4", lanes, at + 4).astype(np.uint64)
    words = np.frombuffer(block, "<u2", size, len(block) - 2 * size).astype(np.uint64)
    first = checkpoint * ROWS_PER_CHECKPOINT * lanes
    last = min(n, first + ROWS_PER_CHECKPOINT * lanes)
    ids = np.empty(last - first, np.uint16)
    for start in range(0, last - first, lanes):
        active = states[: min(lanes, last - first - start)]
        slots = active & 0xFFFF
        symbols = table.symbol_at[slots]
        ids[start : start + len(active)] = symbols
        active = table.frequency[symbols] * (active >> SCALE_BITS)
        active += slots - table.start[symbols]
        low = active < 1 << 16
        read = int(low.sum())
        active[low] = (active[low] << 16) | words[place : place + read]
        place += read
        states[: len(active)] = active
    return ids


def decode_block(block: bytes, table: Table) -> np.ndarray:
    n, _, checkpoints, _, crc = _HEAD.unpack_from(block)
    parts = [decode_part(block, k, table) for k in range(checkpoints)]
    ids = np.concatenate(parts) if parts else np.empty(0, np.uint16)
    if len(ids) != n or zlib.crc32(ids.astype("<u4").tobytes()) != crc:
        raise ValueError("damaged block: its ids do not give its checksum")
    return ids


# Files

_SEGMENT = (
    "part int, start bigint, doc_ids array<bigint>, doc_tokens array<bigint>, "
    "frequencies binary, blocks array<binary>"
)
_TOKENS = "doc_id bigint, part int, start_in_part bigint, n_tokens bigint, ids_crc32 bigint"


def _segment(part: int, start: int, docs: list[tuple[int | None, bytes]]):
    ids = np.frombuffer(b"".join(data for _, data in docs), "<u2")
    table = Table.of(ids)
    blocks = [
        encode_block(ids[at : at + BLOCK_IDS], table)
        for at in range(0, len(ids), BLOCK_IDS)
    ]
    row = {
        "part": part,
        "start": start,
        "doc_ids": [doc_id for doc_id, _ in docs],
        "doc_tokens": [len(data) // 2 for _, data in docs],
        "frequencies": table.to_bytes(),
        "blocks": blocks,
    }
    return pa.RecordBatch.from_pylist([row], arrow_schema(_SEGMENT)), len(ids)


def write_token_files(
    docs: DataFrame, vocabulary_path: str, root: str, end_id: int = END_ID
) -> None:
    """Encode every text, with ``end_id`` after it, into a table at ``root``."""
    with open(vocabulary_path, encoding="utf-8") as file:
        vocabulary = file.read()
    end = struct.pack("<H", end_id)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(vocabulary)
        part, start = TaskContext.get().partitionId(), 0
        waiting: list[tuple[int | None, bytes]] = []
        size = 0
        for batch in batches:
            ids, done = batch.column("doc_id").to_pylist(), 0
            for group in groups(texts_of(batch.column("text"))):
                for data in tokenizer.encode(group):
                    waiting.append((ids[done], data + end))
                    done += 1
                    size += len(data) // 2 + 1
                if size >= SEGMENT_IDS:
                    row, n = _segment(part, start, waiting)
                    yield row
                    start += n
                    waiting, size = [], 0
        if waiting:
            yield _segment(part, start, waiting)[0]
        release()

    ordered = id_and_text(docs).repartitionByRange("doc_id")
    rows = ordered.sortWithinPartitions("doc_id").mapInArrow(work, _SEGMENT)
    rows.write.mode("overwrite").option("compression", "uncompressed").parquet(root)


def read_token_files(spark: SparkSession, root: str) -> DataFrame:
    """Per document its start among all ids, number of ids and their CRC-32.

    Only one number per part, the sum of its ids, passes the driver.
    """

    @lean
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                table = Table.from_bytes(row["frequencies"])
                ids = np.concatenate([decode_block(b, table) for b in row["blocks"]])
                ends = np.cumsum(row["doc_tokens"])
                starts = ends - row["doc_tokens"]
                crcs = [
                    zlib.crc32(ids[a:b].astype("<u4").tobytes())
                    for a, b in zip(starts, ends)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array([row["part"]] * len(crcs), pa.int32()),
                        pa.array(starts + row["start"], pa.int64()),
                        pa.array(row["doc_tokens"], pa.int64()),
                        pa.array(crcs, pa.int64()),
                    ],
                    schema=arrow_schema(_TOKENS),
                )

    table = spark.read.parquet(root)
    sums = table.groupBy("part").agg(
        F.sum(F.expr("aggregate(doc_tokens, 0L, (a, x) -> a + x)")).alias("n")
    )
    offset, offsets = 0, []
    for row in sums.orderBy("part").collect():
        offsets.append((row["part"], offset))
        offset += row["n"]
    first = spark.createDataFrame(offsets, "part int, offset bigint")
    # One block-sized row at a time goes to Python.
    decoded = table.mapInArrow(work, _TOKENS)
    return decoded.join(first, "part").select(
        "doc_id",
        F.expr("offset + start_in_part").alias("start"),
        "n_tokens",
        "ids_crc32",
    )
