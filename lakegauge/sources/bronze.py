"""Raw readings: newline-delimited JSON below ingest-time directories."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegauge import schema as S
from lakegauge import storage
from lakegauge.functions.timeparts import ingest_path
from lakegauge.sinks.bronze import counts_root
from lakegauge.streaming.segments import Segments


def _json_reader(reader):
    return (
        reader.schema(S.BRONZE_SCHEMA)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", S.CORRUPT)
    )


def read_bronze(spark: SparkSession, root: str) -> DataFrame:
    """All raw rows, with the ingest partition columns and the text of any
    line that is not readable JSON.

    Nothing is inferred and nothing is dropped. A filter on the partition
    columns prunes directories.
    """
    # A streamed root has a directory level per batch, which is no column here.
    return _json_reader(spark.read).json(root).select(*S.BRONZE_SCHEMA.names)


def read_bronze_hour(
    spark: SparkSession, root: str, hour: datetime, scope: str = "hour"
) -> DataFrame:
    """Raw rows of one ingest hour or day; no rows when nothing arrived.

    The wanted directory is entered directly, so years of other hours are
    never listed.
    """
    path = ingest_path(root, hour, scope)
    if not storage.exists(spark, path):
        return spark.createDataFrame([], S.BRONZE_SCHEMA)
    rows = _json_reader(spark.read).option("basePath", root).json(path)
    return rows.select(*S.BRONZE_SCHEMA.names)


def stream_bronze(
    spark: SparkSession, root: str, files_per_trigger: int | None = None
) -> DataFrame:
    """The same rows as a stream of newly landed files."""
    reader = _json_reader(spark.readStream)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(root).select(*S.BRONZE_SCHEMA.names)


def hour_available(spark: SparkSession, root: str, hour: datetime) -> bool:
    """Whether any raw data landed for an hour. Looks at file names only."""
    return storage.has_files(spark, ingest_path(root, hour))


_COUNTS = T.StructType([*S.INGEST_FIELDS, T.StructField("raw_count", T.LongType())])


def _added_up(counts: DataFrame) -> DataFrame:
    return counts.groupBy(*S.INGEST_COLUMNS).agg(F.expr("sum(raw_count) AS raw_count"))


def count_segments(spark: SparkSession, root: str) -> Segments:
    """Lines per ingest hour of a landing stream's micro-batches."""
    return Segments(spark, root, _COUNTS, _added_up)


def hour_availability(spark: SparkSession, root: str) -> DataFrame:
    """Raw lines per ingest hour, from the counts that the writers of this
    package leave beside the root; no line is read. A root of other writers
    has none, and its lines are counted."""
    below = counts_root(root)
    if not storage.exists(spark, below):
        return counted_lines(spark, root)
    found = spark.createDataFrame([], _COUNTS)
    for name in storage.children(spark, below):
        counts = f"{below}/{name}"
        if storage.exists(spark, f"{counts}/_SUCCESS"):  # a batch writer's
            found = found.unionByName(spark.read.schema(_COUNTS).parquet(counts))
        else:
            found = found.unionByName(count_segments(spark, counts).read())
    return _added_up(found)


def counted_lines(spark: SparkSession, root: str) -> DataFrame:
    """The same by counting all lines, without parsing them."""
    lines = spark.read.schema(
        "value string, " + ", ".join(f"{name} string" for name in S.INGEST_COLUMNS)
    ).text(root)
    counts = lines.groupBy(*S.INGEST_COLUMNS).count()
    return counts.withColumnRenamed("count", "raw_count")
