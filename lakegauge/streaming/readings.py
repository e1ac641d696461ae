"""Clean readings and hourly statistics from a stream of raw rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegauge.operators.cleaning import clean
from lakegauge.operators.windows import tumbling_statistics
from lakegauge.schema import READING_KEY


def dedup_stream(
    readings: DataFrame,
    delay: str = "1 hour",
    salts: int = 8,
    clock: str = "timestamp",
) -> DataFrame:
    """Drop replays of a reading that come within ``delay`` of it.

    State is bounded by a watermark on ``clock``. With the event time as the
    clock, readings older than the watermark are dropped too. Where messages
    carry an arrival time use that: readings are then kept however old they
    are, and a wrong event time in the future cannot move the watermark.

    A stream cannot combine map-side
    before its state, so a reading replayed very often would load a single
    task. Copies are therefore first reduced within ``salts`` groups, by the
    task that read them, and what is left, at most one copy per group, is
    reduced by the key alone. ``salts=1`` does the second step only and
    halves the state.
    """
    marked = readings.withWatermark(clock, delay)
    if salts > 1:
        salted = marked.withColumn(
            "__salt", F.pmod(F.spark_partition_id(), F.lit(salts))
        )
        marked = salted.dropDuplicatesWithinWatermark([*READING_KEY, "__salt"]).drop(
            "__salt"
        )
    return marked.dropDuplicatesWithinWatermark(READING_KEY)


def clean_stream(
    raw: DataFrame, delay: str = "1 hour", salts: int = 8, clock: str = "timestamp"
) -> DataFrame:
    """The batch cleaning on a stream, then dedup; stamped per micro-batch."""
    return dedup_stream(clean(raw, F.current_timestamp()), delay, salts, clock)


def hourly_statistics_stream(
    readings: DataFrame, delay: str = "1 hour", every: str = "1 hour"
) -> DataFrame:
    """Sensor statistics per event-time window, emitted once it is closed.

    A window closes when the watermark, the latest event time minus
    ``delay``, has reached its end. Later rows for it are dropped.
    """
    return tumbling_statistics(readings.withWatermark("timestamp", delay), every=every)
