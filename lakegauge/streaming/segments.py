"""Tables that micro-batches add to and that are folded as they grow.

A segment is a directory with the rows of the micro-batches ``first`` to
``last``. A micro-batch writes a segment of its own, replaced as a whole when
the batch is retried. After ``fan`` batches their segments are folded into one,
after ``fan`` of those again, up to ``levels`` times: a table of any number of
batches is read from a bounded number of directories per level, and a row is
written once per level. :meth:`Segments.compact` folds what is beyond, as a job
of its own.

Folding only reads batches that are committed: batch ``n`` starts when all
before it are, and folds those. A segment counts once its success marker is
there; inside a larger one it no longer counts. It stays in place until the
next fold, so that a reader who has just listed it finds its files, and a
failed fold is repeated or left alone without anyone noticing.

A root belongs to one checkpoint, whose batch numbers name the segments.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakegauge import storage

FAN = 16
LEVELS = 3

Span = tuple[int, int]
Fold = Callable[[DataFrame], DataFrame]

_NAME = re.compile(r"batch=(\d+)-(\d+)")


def _outermost(spans: Sequence[Span]) -> list[Span]:
    """Those that are inside no other, in order."""
    found: list[Span] = []
    for span in sorted(spans, key=lambda s: (s[0], -s[1])):
        if not found or span[1] > found[-1][1]:
            found.append(span)
    return found


class Segments:
    """One such table. ``fold`` turns the rows of several segments into those
    of one; ``partitions`` are the directory columns inside a segment."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        fold: Fold = lambda rows: rows,
        partitions: Sequence[str] = (),
        fan: int = FAN,
        levels: int = LEVELS,
    ) -> None:
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.fold, self.partitions = fold, list(partitions)
        self.fan, self.levels = fan, levels

    def path(self, span: Span) -> str:
        return f"{self.root}/batch={span[0]:012d}-{span[1]:012d}"

    def _complete(self) -> list[Span]:
        found = []
        for name in storage.children(self.spark, self.root):
            match = _NAME.fullmatch(name)
            if match and storage.exists(self.spark, f"{self.root}/{name}/_SUCCESS"):
                found.append((int(match[1]), int(match[2])))
        return sorted(found)

    def live(self) -> list[Span]:
        """The segments that make up the table, in order."""
        return _outermost(self._complete())

    def read(self, spans: Sequence[Span] | None = None) -> DataFrame:
        """The rows of all live segments, or of some."""
        paths = [self.path(span) for span in (self.live() if spans is None else spans)]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read.schema(self.schema).option("basePath", self.root)
        return reader.parquet(*paths).select(*self.schema.names)

    def _write(self, rows: DataFrame, span: Span) -> None:
        if self.partitions:
            # A few files per directory: adaptive execution merges and splits.
            rows = rows.hint("rebalance", *self.partitions)
        writer = rows.select(*self.schema.names).write.mode("overwrite")
        writer = writer.option("partitionOverwriteMode", "static")
        writer.partitionBy(*self.partitions).parquet(self.path(span))

    def _fold(self, span: Span) -> None:
        """Bring the segments inside a span into one; remove those that an
        earlier fold replaced."""
        spans = self._complete()
        live = _outermost(spans)
        for old in set(spans).difference(live):
            storage.remove(self.spark, self.path(old))
        parts = [s for s in live if span[0] <= s[0] and s[1] <= span[1]]
        if len(parts) > 1:
            self._write(self.fold(self.read(parts)), span)

    def add(self, rows: DataFrame, batch_id: int) -> None:
        """Write a micro-batch, and fold those before it when it is time."""
        size = self.fan
        if batch_id and batch_id % size == 0:
            for _ in range(self.levels - 1):
                if batch_id % (size * self.fan) == 0:
                    size *= self.fan
            self._fold((batch_id - size, batch_id - 1))
        self._write(rows, (batch_id, batch_id))

    def compact(self) -> None:
        """Fold the segments of the last level into one. A stream never folds
        those again, so this may run beside it; once at a time."""
        whole = self.fan**self.levels
        spans = [s for s in self.live() if s[1] - s[0] + 1 >= whole]
        if len(spans) > 1:
            self._fold((spans[0][0], spans[-1][1]))
