r"""Jaccard join on word shingles by prefixes under several global orders.

Under any global order of shingles, two sets with similarity of at least 75 per
cent share a shingle within their prefixes: the first ``n - ceil(0.75 n) + 1``
of n. Three orders are used, all with rare shingles first and each with another
order among equally frequent ones. A pair must share a prefix shingle under all
of them before its texts are compared.

1. Map tasks make the sets in chunks of documents, keep one document of each
   group of equal sets in a chunk, and deal the shingles' hashes out by range,
   packed as one array per chunk and range.
2. A range's task counts its shingles over all documents and sends those found
   in two or more back to their chunks, with their counts. (A shingle of one
   document links nothing.)
3. A chunk's task sorts each document's shingles under the three orders. The
   first order's prefixes become cells (shingle, document); the prefixes under
   the others stay with the document.
4. Each cell proposes the pairs of its first document with the others, not all
   its pairs. Pairs that pass length and the other orders are compared exactly.
5. Cells whose documents are then still in different components join up to
   families. A family is cut into blocks of bounded size, and each pair of
   blocks counts the common shingles of its documents in one matrix product.
   Pairs within a component cannot change the result and are left out; those
   across that are similar are compared exactly. So groups of copies cost one
   pair per document and cell in step 4, and no pairs leave a task in step 5
   but links.

Hashes only propose pairs and collapse equal sets; similarity is decided on the
words. Rows with equal ``doc_id`` are one node. A null ``doc_id`` links with
nothing and has a null component. Documents without words are alone.

``docs`` must be a table that reads the same rows in the same order again.
"""

from __future__ import annotations

import functools
import hashlib
from collections import OrderedDict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegauge.llm.common import (
    arrow_schema,
    groups,
    id_and_text,
    lean,
    release,
    texts_of,
)
from lakegauge.llm.components import components, stored
from lakegauge.llm.shingles import exact_set, hashed_sets, mixed

PERCENT = 75
ORDERS = (1, 2, 3)
# A chunk's bounds: places in it are 16-bit numbers.
CHUNK_DOCS = 60_000
CHUNK_SHINGLES = 1_500_000
# Characters of text that are hashed at once.
GROUP_CHARS = 250_000
# Ids that may be broadcast to fetch texts: about 64 MB as a hash table.
MAX_BROADCAST_IDS = 1_000_000

_PACKED = "chunk bigint, range int, kind int, payload binary"
_MADE = (
    "kind int, id bigint, n bigint, rep bigint, code bigint, "
    "second array<bigint>, third array<bigint>"
)


# Bytes of a group after which its memory is given back.
_LARGE_GROUP = 8_000_000


def _lean_group(work: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    @functools.wraps(work)
    def lean_work(table: pa.Table) -> pa.Table:
        made = work(table)
        if table.nbytes > _LARGE_GROUP:
            release()
        return made

    return lean_work


# 1. Sets and chunks


class _Chunk:
    def __init__(self) -> None:
        self.sets: list[np.ndarray] = []
        self.place: dict[bytes, int] = {}  # of a set, by its digest
        self.members: list[tuple[int, int, int]] = []  # id, size, place
        self.size = 0

    def add(self, doc_id: int, shingles: np.ndarray) -> None:
        digest = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
        if not len(shingles):  # documents without words are not copies
            digest = f"empty {len(self.members)}".encode()
        place = self.place.setdefault(digest, len(self.sets))
        if place == len(self.sets):
            self.sets.append(shingles)
            self.size += len(shingles)
        self.members.append((doc_id, len(shingles), place))

    def full(self) -> bool:
        return len(self.members) >= CHUNK_DOCS or self.size >= CHUNK_SHINGLES

    def packed(self, chunk: int, n_ranges: int) -> pa.RecordBatch:
        """The members, and by range the shingles' codes with their places. The
        numbers are changed in place: a chunk is a worker's largest object."""
        shingles = np.concatenate(self.sets)
        places = np.repeat(
            np.arange(len(self.sets), dtype=np.uint16), [len(s) for s in self.sets]
        )
        self.sets.clear()
        keys = shingles >> np.uint64(32)
        keys *= np.uint64(n_ranges)
        keys &= np.uint64(0xFFFFFFFF << 32)  # the range, in the upper half
        shingles &= np.uint64(0xFFFFFFFF)
        keys |= shingles
        del shingles
        order = np.argsort(keys)
        keys, places = keys[order], places[order]
        del order
        ranges = (keys >> np.uint64(32)).astype(np.uint32)
        first = np.flatnonzero(np.diff(ranges, prepend=np.uint32(2**32 - 1)))
        members = np.array(self.members, np.int64)
        # The members travel with a range that is not counted.
        kinds, numbers = [0], [chunk % n_ranges]
        payloads = [members.tobytes()]
        for start, end in zip(first, [*first[1:], len(keys)]):
            kinds.append(1)
            numbers.append(int(ranges[start]))
            codes = (keys[start:end] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            payloads.append(_pack(codes, places[start:end]))
        columns = [
            pa.array([chunk] * len(kinds), pa.int64()),
            pa.array(numbers, pa.int32()),
            pa.array(kinds, pa.int32()),
            pa.array(payloads, pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, schema=arrow_schema(_PACKED))


def _pack(codes: np.ndarray, *others: np.ndarray) -> bytes:
    """Sorted codes as steps, their bytes by rank so that the small high ones
    compress, then the other arrays."""
    steps = np.diff(codes, prepend=np.uint32(0)).astype("<u4")
    planes = steps.view(np.uint8).reshape(-1, 4).T.tobytes()
    return planes + b"".join(other.tobytes() for other in others)


def _unpack(payload: bytes, *kinds: str) -> list[np.ndarray]:
    sizes = [np.dtype(kind).itemsize for kind in kinds]
    n = len(payload) // (4 + sum(sizes))
    planes = np.frombuffer(payload, np.uint8, 4 * n).reshape(4, n)
    steps = np.ascontiguousarray(planes.T).view("<u4")[:, 0]
    arrays, at = [np.cumsum(steps, dtype=np.uint32)], 4 * n
    for kind, size in zip(kinds, sizes):
        arrays.append(np.frombuffer(payload, kind, n, at))
        at += size * n
    return arrays


def _chunks(docs: DataFrame, n_ranges: int) -> DataFrame:
    @lean
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        chunk = _Chunk()
        for batch in batches:
            ids, done = batch.column("doc_id").to_pylist(), 0
            for group in groups(texts_of(batch.column("text")), GROUP_CHARS):
                for shingles in hashed_sets(group):
                    chunk.add(ids[done], shingles)
                    done += 1
                    if chunk.full():
                        yield chunk.packed(number, n_ranges)
                        number, chunk = number + 1, _Chunk()
        if chunk.members:
            yield chunk.packed(number, n_ranges)

    return docs.mapInArrow(work, _PACKED)


# 2. Counts


@_lean_group
def _count_range(table: pa.Table) -> pa.Table:
    """Members as they are; of a range, each chunk's shared codes."""
    rows = table.to_pylist()
    made = [row for row in rows if row["kind"] == 0]
    rows = [row for row in rows if row["kind"] == 1]
    if rows:
        unpacked = [_unpack(row["payload"], "<u2") for row in rows]
        codes = np.concatenate([codes for codes, _ in unpacked])
        ordered = np.sort(codes)
        starts = np.flatnonzero(np.diff(ordered, prepend=ordered[:1] ^ 1))
        counts = np.diff(np.append(starts, len(ordered)))
        shared = counts > 1
        values, counts = ordered[starts][shared], counts[shared].astype(np.uint32)
        for row, (codes, places) in zip(rows, unpacked):
            at = np.minimum(np.searchsorted(values, codes), max(0, len(values) - 1))
            found = values[at] == codes if len(values) else np.zeros(len(codes), bool)
            if found.any():
                own = _pack(codes[found], places[found], counts[at[found]])
                made.append(row | {"payload": own})
    return pa.Table.from_pylist(made, schema=arrow_schema(_PACKED))


# 3. Prefixes


def _prefix_size(n: np.ndarray) -> np.ndarray:
    return n - -(-PERCENT * n // 100) + (n > 0)


@_lean_group
def _prefixes(table: pa.Table) -> pa.Table:
    """A chunk's members (kind 0), documents with prefixes (1), cells (2)."""
    rows = table.to_pylist()
    members = np.frombuffer(
        next(row["payload"] for row in rows if row["kind"] == 0), np.int64
    ).reshape(-1, 3)
    ids, sizes, places = members.T
    n_sets = int(places.max()) + 1
    reps = np.full(n_sets, np.iinfo(np.int64).max)
    np.minimum.at(reps, places, ids)
    size = np.zeros(n_sets, np.int64)
    size[places] = sizes
    out = [
        {"kind": 0, "id": i, "n": n, "rep": r}
        for i, n, r in zip(ids.tolist(), sizes.tolist(), reps[places].tolist())
    ]
    parts = [
        (row["range"], *_unpack(row["payload"], "<u2", "<u4"))
        for row in rows
        if row["kind"] == 1
    ]
    if parts:
        code = np.concatenate(
            [(np.uint64(r) << np.uint64(32)) | c for r, c, _, _ in parts]
        )
        place = np.concatenate([p for _, _, p, _ in parts]).astype(np.int64)
        count = np.concatenate([k for _, _, _, k in parts])
        shared = np.bincount(place, minlength=n_sets)
        # Shingles of this document alone come first in its prefix.
        wanted = _prefix_size(size) - (size - shared)
        begin = np.cumsum(shared) - shared
        chosen = []
        for order in ORDERS:
            salt = np.uint64(order * 0x632BE59BD9B4E019 % 2**64)
            by = np.lexsort((mixed(code ^ salt), count, place))
            rank = np.arange(len(by)) - begin[place[by]]
            by = by[rank < wanted[place[by]]]
            chosen.append((place[by], code[by].view(np.int64)))
        in_cells = np.unique(chosen[0][0])
        lists = [_lists(*pair, in_cells) for pair in chosen[1:]]
        for at, second, third in zip(in_cells.tolist(), *lists):
            out.append(
                {"kind": 1, "id": int(reps[at]), "n": int(size[at]),
                 "second": second, "third": third}
            )
        for at, cell in zip(*(column.tolist() for column in chosen[0])):
            out.append({"kind": 2, "id": int(reps[at]), "n": int(size[at]), "code": cell})
    return pa.Table.from_pylist(out, schema=arrow_schema(_MADE))


def _lists(place: np.ndarray, code: np.ndarray, wanted: np.ndarray) -> list[list[int]]:
    first, last = np.searchsorted(place, [wanted, wanted + 1])
    return [code[a:b].tolist() for a, b in zip(first, last)]


# 4. and 5. Pairs


def _fetch_texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, text) of some documents: by broadcast of the ids if they are few,
    by a shuffle join otherwise."""
    ids = ids.withColumnRenamed("id", "doc_id")
    if ids.count() <= MAX_BROADCAST_IDS:
        ids = F.broadcast(ids)
    return docs.join(ids, "doc_id", "left_semi").selectExpr("doc_id AS id", "text")


_LENGTHS = f"100 * least(n_a, n_b) >= {PERCENT} * greatest(n_a, n_b)"
_ALL_ORDERS = (
    "arrays_overlap(second_a, second_b) AND arrays_overlap(third_a, third_b)"
)


def _side(reps: DataFrame, side: str) -> DataFrame:
    """Columns of documents with prefixes, named for one side of a pair."""
    names = {"id": side, "n": f"n_{side}", "second": f"second_{side}", "third": f"third_{side}"}
    return reps.selectExpr(*[f"{old} AS {new}" for old, new in names.items()])


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sets are similar, decided on the words."""

    @lean
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: OrderedDict[int, tuple[str, set[bytes]]] = OrderedDict()

        def set_of(doc_id: int, text: str) -> set[bytes]:
            known = recent.get(doc_id)
            if known is not None and known[0] == text:
                return known[1]
            recent[doc_id] = text, exact_set(text)
            if len(recent) > 16:
                recent.popitem(last=False)
            return recent[doc_id][1]

        for batch in batches:
            good = []
            for row in batch.to_pylist():
                a = set_of(row["a"], row["text_a"])
                b = set_of(row["b"], row["text_b"])
                common = len(a & b)
                good.append(100 * common >= PERCENT * (len(a) + len(b) - common))
            kept = batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))
            yield kept.cast(arrow_schema("a bigint, b bigint"))

    joined = pairs.join(texts.selectExpr("id AS a", "text AS text_a"), "a").join(
        texts.selectExpr("id AS b", "text AS text_b"), "b"
    )
    columns = joined.select("a", "b", "text_a", "text_b")
    return columns.mapInArrow(work, "a bigint, b bigint").distinct()


# Bounds of a block of a family.
BLOCK_DOCS = 512
BLOCK_SHINGLES = 400_000
_COLUMNS = 4096


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the common parts of sets: a product of incidence matrices, a
    range of columns at a time."""
    sets = left + right
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(
        np.concatenate(sets), return_inverse=True, return_counts=True
    )
    order = np.argsort(column, kind="stable")
    order = order[count[column[order]] > 1]
    row, column = row[order], column[order]
    _, column = np.unique(column, return_inverse=True)
    n_columns = int(column[-1]) + 1 if len(column) else 0
    total = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, n_columns, _COLUMNS):
        first, last = np.searchsorted(column, [start, start + _COLUMNS])
        matrix = np.zeros((len(sets), _COLUMNS), np.float32)
        matrix[row[first:last], column[first:last] - start] = 1
        total += matrix[: len(left)] @ matrix[len(left) :].T
    return total.astype(np.int64)


@_lean_group
def _compare_blocks(table: pa.Table) -> pa.Table:
    """Similar pairs of a pair of blocks that are in different components."""
    sides = []
    low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
    for block in (low, high):
        rows = [r for r in table.to_pylist() if r["block"] == block]
        ids = np.array([r["id"] for r in rows], np.int64)
        component = np.array([r["component"] for r in rows], np.int64)
        sets = hashed_sets([r["text"] for r in rows])
        sides.append((ids, component, sets))
    found_a: list[int] = []
    found_b: list[int] = []
    if all(len(ids) for ids, _, _ in sides):
        (ids_a, of_a, sets_a), (ids_b, of_b, sets_b) = sides
        common = _common(sets_a, sets_b)
        n_a = np.array([len(s) for s in sets_a])[:, None]
        n_b = np.array([len(s) for s in sets_b])[None, :]
        good = 100 * common >= PERCENT * (n_a + n_b - common)
        good &= of_a[:, None] != of_b[None, :]
        at_a, at_b = np.nonzero(good)
        one, other = ids_a[at_a], ids_b[at_b]
        found_a = np.minimum(one, other).tolist()
        found_b = np.maximum(one, other).tolist()
    return pa.Table.from_pydict(
        {"a": found_a, "b": found_b}, schema=arrow_schema("a bigint, b bigint")
    )


def _crossing(apart: DataFrame, reps: DataFrame, texts: DataFrame) -> DataFrame:
    """Similar pairs (a, b) across components among the documents of cells
    (a: the cell's first document, id, component)."""
    families = components(apart.where("a < id").selectExpr("a", "id AS b"))
    families = families.withColumnRenamed("component", "family")
    members = apart.select("id", "component").distinct().join(families, "id")
    members = stored(members.join(reps.select("id", "n").distinct(), "id"), "families")
    sizes = members.groupBy("family").agg(
        F.expr(
            f"CAST(greatest(ceil(count(*) / {BLOCK_DOCS}), "
            f"ceil(sum(n) / {BLOCK_SHINGLES})) AS INT)"
        ).alias("blocks")
    )
    dealt = members.join(sizes, "family").join(texts, "id")
    dealt = dealt.selectExpr(
        "*", "CAST(pmod(xxhash64(id), blocks) AS INT) AS block"
    ).selectExpr(
        "family", "id", "component", "text", "block",
        "explode(sequence(0, blocks - 1)) AS other",
    ).selectExpr(
        "family", "id", "component", "text", "block",
        "least(block, other) AS low", "greatest(block, other) AS high",
    )
    compared = dealt.groupBy("family", "low", "high").applyInArrow(
        _compare_blocks, "a bigint, b bigint"
    )
    return compared.distinct()


# Bytes of text per range, whose shingles one task counts, and the most ranges
# that leave a chunk some hundreds of shingles in each.
RANGE_BYTES = 4_000_000
MAX_RANGES = 6_000


def _ranges(docs: DataFrame) -> int:
    """Ranges of shingles: they grow with the text, so that a task's do not."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, min(MAX_RANGES, size // RANGE_BYTES))


def ngram_join(docs: DataFrame) -> DataFrame:
    """Per document ``n_shingles``, ``component_id`` and ``n_links``, the
    links that were found to settle its representative's component."""
    spark, docs = docs.sparkSession, id_and_text(docs)
    n_ranges = _ranges(docs)
    named = docs.where("doc_id IS NOT NULL")
    counted = (
        _chunks(named, n_ranges).groupBy("range").applyInArrow(_count_range, _PACKED)
    )
    made = counted.groupBy("chunk").applyInArrow(_prefixes, _MADE)
    made = stored(made, "prefixes")
    members = made.where("kind = 0").selectExpr("id AS doc_id", "n", "rep")
    reps = made.where("kind = 1").select("id", "n", "second", "third")
    cells = made.where("kind = 2").select("code", "id")

    centres = cells.groupBy("code").agg(
        F.min("id").alias("a"), F.max("id").alias("last")
    )
    shared = cells.join(centres.where("a < last"), "code").select("code", "id", "a")
    shared = stored(shared, "cells")
    texts = stored(_fetch_texts(docs, shared.select("id").distinct()), "texts")
    proposed = shared.where("a < id").selectExpr("a", "id AS b").distinct()
    proposed = proposed.join(_side(reps, "a"), "a").join(_side(reps, "b"), "b")
    proposed = proposed.where(f"{_LENGTHS} AND {_ALL_ORDERS}").select("a", "b")
    links = stored(_links(proposed.distinct(), texts), "links")

    known = components(links)
    placed = shared.join(known, "id", "left").selectExpr(
        "code", "id", "a", "coalesce(component, id) AS component"
    )
    split = placed.groupBy("code").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    )
    apart = placed.join(split.where("low < high").select("code"), "code")
    apart = stored(apart.select("a", "id", "component").distinct(), "apart")
    crossing = _crossing(apart, reps, texts)
    links = stored(links.union(_links(crossing, texts)), "links")

    final = components(links)
    degree = links.selectExpr("explode(array(a, b)) AS id").groupBy("id").count()
    found = final.join(degree, "id").selectExpr("id AS rep", "component", "count")
    nameless = _nameless(docs.where("doc_id IS NULL"))
    return (
        members.join(found, "rep", "left")
        .selectExpr(
            "doc_id",
            "n AS n_shingles",
            "coalesce(component, rep) AS component_id",
            "coalesce(count, 0L) AS n_links",
        )
        .unionByName(nameless)
    )


def _nameless(docs: DataFrame) -> DataFrame:
    """Rows without a doc_id: the size of their sets, no component."""

    @lean
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [len(exact_set(text)) for text in texts_of(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64())], ["n"])

    sized = docs.mapInArrow(work, "n bigint")
    return sized.selectExpr(
        "CAST(NULL AS BIGINT) AS doc_id",
        "n AS n_shingles",
        "CAST(NULL AS BIGINT) AS component_id",
        "0L AS n_links",
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of each group's first document; rows without doc_id stay, and all
    rows of an id of which one is a first.

    The ids that go are written: while their file is small Spark broadcasts
    them and no document is shuffled.
    """
    judged = ngram_join(docs).where("doc_id IS NOT NULL").groupBy("doc_id")
    others = judged.agg(F.expr("bool_or(doc_id = component_id) AS first"))
    gone = stored(others.where("NOT first").selectExpr("doc_id AS __llm_id"), "others")
    return docs.join(gone, F.col("doc_id").cast("long") == F.col("__llm_id"), "left_anti")
