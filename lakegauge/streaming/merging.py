"""Streams into tables that lose no reading, however the input is cut.

Every micro-batch adds a segment (:mod:`lakegauge.streaming.segments`), which
is replaced as a whole when it is retried, and segments are folded as they
grow. No watermark is involved: late readings, back-fills and replays in any
later batch are merged, late ones amend their windows, and the tables equal
those of one batch job over the same input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakegauge import schema as S
from lakegauge.operators import cleaning
from lakegauge.operators.dedup import dedup_readings
from lakegauge.operators.windows import (
    merge_states,
    tumbling_states,
    tumbling_statistics_of,
)
from lakegauge.session import use_utc
from lakegauge.sources.topics import BATCH_SECONDS
from lakegauge.streaming.segments import Segments

DAY = "date_format(timestamp, 'yyyy-MM-dd') AS day"

_NAMES = [f.name for f in S.SILVER_FIELDS if f.name in (*S.RAW_COLUMNS, "value_valid")]
_CLEAN = T.StructType(
    [f for f in S.SILVER_FIELDS if f.name in _NAMES]
    + [T.StructField("day", T.StringType())]
)
_REJECTED = T.StructType(
    [
        *S.RAW_FIELDS,
        T.StructField(S.CORRUPT, T.StringType()),
        T.StructField(cleaning.REASON, T.StringType()),
    ]
)
_COUNTED = T.StructType(
    [T.StructField(name, T.LongType()) for name in ("rows_in", "rows_rejected")]
)
_STATES = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("well_id", T.StringType()),
        T.StructField("sensor_type", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("reading_count", T.LongType()),
        T.StructField("anomaly_count", T.LongType()),
        T.StructField("value_count", T.LongType()),
        T.StructField("mean", T.DoubleType()),
        T.StructField("m2", T.DoubleType()),
        T.StructField("min_value", T.DoubleType()),
        T.StructField("max_value", T.DoubleType()),
    ]
)


def start_batches(
    rows: DataFrame,
    add: Callable[[DataFrame, int], None],
    checkpoint: str,
    available_now: bool = False,
    every: str | None = f"{BATCH_SECONDS} seconds",
) -> StreamingQuery:
    """Hand every micro-batch to a function. ``available_now`` drains what is
    there and stops; ``every=None`` leaves it to the source when a batch
    starts."""
    use_utc(rows.sparkSession)
    writer = rows.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every is not None:
        writer = writer.trigger(processingTime=every)
    return writer.start()


# Clean readings


def clean_segments(spark: SparkSession, root: str, **folding) -> Segments:
    """The readings of a stream, by day. Copies are reduced in every fold."""
    return Segments(
        spark, f"{root}/readings", _CLEAN, dedup_readings, ["day"], **folding
    )


def reject_segments(spark: SparkSession, root: str, **folding) -> Segments:
    """The rows that cleaning left out, with their reason and raw text."""
    return Segments(spark, f"{root}/rejects", _REJECTED, **folding)


def count_segments(spark: SparkSession, root: str, **folding) -> Segments:
    """Rows that came and were left out: one row per segment."""

    def fold(rows: DataFrame) -> DataFrame:
        return rows.agg(*[F.sum(name).alias(name) for name in _COUNTED.names])

    return Segments(spark, f"{root}/counts", _COUNTED, fold, **folding)


def merge_clean(
    raw: DataFrame, root: str, checkpoint: str, available_now: bool = False, **folding
) -> StreamingQuery:
    """Clean a raw stream into tables below ``root``: readings, rejects, counts.

    A batch is parsed once. Its copies of a reading are reduced before they are
    written, copies in different segments when these are folded or read.
    """
    spark = raw.sparkSession
    readings = clean_segments(spark, root, **folding)
    rejected = reject_segments(spark, root, **folding)
    counted = count_segments(spark, root, **folding)

    def add(batch: DataFrame, batch_id: int) -> None:
        if S.CORRUPT not in batch.columns:
            batch = batch.withColumn(S.CORRUPT, F.lit(None).cast("string"))
        tagged = cleaning.with_outcome(batch).persist()
        try:
            usable = cleaning.clean_tagged(
                tagged.drop(cleaning.OUTCOME), F.current_timestamp()
            )
            reduced = dedup_readings(usable.select(*_NAMES))
            readings.add(reduced.selectExpr("*", DAY), batch_id)
            rejected.add(cleaning.rejects_of(tagged), batch_id)
            counted.add(
                tagged.selectExpr(
                    "count(*) AS rows_in", f"count({cleaning.REASON}) AS rows_rejected"
                ),
                batch_id,
            )
        finally:
            tagged.unpersist()

    return start_batches(raw, add, checkpoint, available_now)


def read_clean(spark: SparkSession, root: str, where: str = "true") -> DataFrame:
    """Each reading once. ``where`` on ``day`` prunes directories. Copies are
    looked for only where there is more than one segment."""
    segments = clean_segments(spark, root)
    live = segments.live()
    rows = segments.read(live).where(where).select(*_NAMES)
    return dedup_readings(rows) if len(live) > 1 else rows


def stream_counts(spark: SparkSession, root: str) -> DataFrame:
    """As :func:`lakegauge.operators.dedup.drop_counts`, of all batches so far.
    A retried batch replaces its counts, so they are exact."""
    came = count_segments(spark, root).read().selectExpr(
        "coalesce(sum(rows_in), 0) AS rows_in",
        "coalesce(sum(rows_in - rows_rejected), 0) AS rows_clean",
    )
    unique = read_clean(spark, root).selectExpr("count(*) AS rows_unique")
    both = came.unionByName(unique, allowMissingColumns=True)
    return both.selectExpr(
        *[f"max({n}) AS {n}" for n in ("rows_in", "rows_clean", "rows_unique")]
    ).selectExpr(
        "*",
        "rows_in - rows_clean AS rows_dropped",
        "rows_clean - rows_unique AS rows_duplicate",
    )


# Hourly statistics


def state_segments(spark: SparkSession, root: str, **folding) -> Segments:
    """Partial statistics per window and sensor."""
    return Segments(spark, f"{root}/states", _STATES, merge_states, **folding)


def merge_hourly_statistics(
    readings: DataFrame,
    root: str,
    checkpoint: str,
    available_now: bool = False,
    **folding,
) -> StreamingQuery:
    """Keep the sensor statistics of all hours of a stream of clean readings.

    A batch writes its own partial statistics, one row per window and sensor,
    and reads nothing but those of others, when it folds them. Readings are
    counted as they come; a source that repeats some goes through
    :func:`lakegauge.streaming.readings.dedup_stream` first.
    """
    states = state_segments(readings.sparkSession, root, **folding)

    def add(batch: DataFrame, batch_id: int) -> None:
        states.add(tumbling_states(batch), batch_id)

    return start_batches(readings, add, checkpoint, available_now)


def read_hourly_statistics(
    spark: SparkSession, root: str, where: str = "true"
) -> DataFrame:
    """Statistics of all windows; ``where`` on ``window_start`` reaches the files."""
    states = state_segments(spark, root).read().where(where)
    return tumbling_statistics_of(merge_states(states))
