"""What several of the training-data operators share."""

from __future__ import annotations

import ctypes
import functools
import unicodedata
from collections.abc import Callable, Hashable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space between words.
SPACES = " \t\n\v\f\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """The two columns that operators on documents read; others may be there."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )


# Texts of characters below this are cut into words here; tokenizer libraries
# cut the others by their own rules.
NEAR = 0x250


def near_class(*categories: str) -> str:
    """Characters below NEAR of the Unicode categories, for a pattern's class."""
    found = [
        c for c in range(NEAR) if unicodedata.category(chr(c)).startswith(categories)
    ]
    return "".join(rf"\u{c:04x}" for c in found)


# Characters of text that a function on batches gets at once, or one longer text.
GROUP_CHARS = 1_000_000


# Rows of an Arrow batch that are Python objects at once.
SLICE_ROWS = 256


def texts_of(column: pa.Array) -> Iterator[str | None]:
    """A column's values in order, a few rows at a time."""
    for start in range(0, len(column), SLICE_ROWS):
        yield from column.slice(start, SLICE_ROWS).to_pylist()


def groups(
    texts: Iterable[str | None], chars: int = GROUP_CHARS
) -> Iterator[list[str | None]]:
    """Texts in order, in groups of about so many characters."""
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text or "")
        if size >= chars:
            yield group
            group, size = [], 0
    if group:
        yield group


# The one large table that a worker keeps for its next tasks.
_held: dict[Hashable, Any] = {}
_trim = getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)


def held(key: Hashable, make: Callable[[], Any]) -> Any:
    """A table that is dear to make. A worker serves many tasks in turn, and
    keeps one such table at most: another operator's goes."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
        release()
    return _held[key]


def drop_held() -> None:
    _held.clear()


def release() -> None:
    """Give memory that is free in this process back to the machine, which the
    idle worker shares with others and with the executor."""
    pa.default_memory_pool().release_unused()
    _trim(0)


Batches = Iterator[pa.RecordBatch]


def lean(work: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """A task's function that begins without other operators' tables and gives
    its memory back when it ends."""

    @functools.wraps(work)
    def lean_work(batches: Batches) -> Batches:
        drop_held()
        try:
            yield from work(batches)
        finally:
            release()

    return lean_work


def per_batch(
    docs: DataFrame,
    schema: str,
    start: Callable[[], Callable[[list[str | None]], list[tuple]]],
    holds: bool = False,
) -> DataFrame:
    """doc_id and what a function makes of each text, as further columns.

    ``start`` is called once per task and returns the function, which gets a
    group of texts and returns a tuple for each. ``holds`` says that it gets a
    table by :func:`held`.
    """
    names = [field.split()[0] for field in schema.split(", ")]
    target = arrow_schema(f"doc_id bigint, {schema}")

    def work(batches: Batches) -> Batches:
        if not holds:
            drop_held()
        make = start()
        try:
            for batch in batches:
                done = 0
                for group in groups(texts_of(batch.column("text"))):
                    columns = list(zip(*make(group)))
                    ids = batch.column("doc_id").slice(done, len(group))
                    done += len(group)
                    arrays = [ids.cast(pa.int64())]
                    arrays += [
                        pa.array(values, target.field(name).type)
                        for name, values in zip(names, columns, strict=True)
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, schema=target)
        finally:
            release()

    return id_and_text(docs).mapInArrow(work, f"doc_id bigint, {schema}")


def per_row(
    docs: DataFrame,
    schema: str,
    start: Callable[[], Callable[[str | None], tuple]],
) -> DataFrame:
    """The same with a function that gets one text."""

    def start_batch():
        make = start()
        return lambda texts: [make(text) for text in texts]

    return per_batch(docs, schema, start_batch)


_ARROW = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<bigint>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()),
    "array<double>": pa.list_(pa.float64()),
    "array<string>": pa.list_(pa.string()),
    "array<binary>": pa.list_(pa.binary()),
}


def arrow_schema(schema: str) -> pa.Schema:
    fields = (field.split() for field in schema.split(", "))
    return pa.schema([(name, _ARROW[kind]) for name, kind in fields])
