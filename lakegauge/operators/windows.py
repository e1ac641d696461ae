"""Event-time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegauge.functions.numeric import rounded, share
from lakegauge.functions.timeparts import hour_bucket
from lakegauge.operators.kpis import (
    FACT_KEY,
    STATISTICS,
    health_scores,
    sensor_facts,
    statistics_of,
)

_MICROS = 1_000_000


def readings_per_hour(readings: DataFrame, instant: str = "timestamp") -> DataFrame:
    """Number of readings per event hour."""
    hour = F.expr(f"{hour_bucket(instant)} AS hour_start")
    return readings.groupBy(hour).agg(F.expr("count(*) AS reading_count"))


def tumbling_statistics(
    readings: DataFrame, instant: str = "timestamp", every: str = "1 hour"
) -> DataFrame:
    """Sensor statistics per tumbling window of event time.

    Also works on a stream with a watermark on ``instant``; grouping by the
    window struct itself lets Spark close windows by that watermark.
    """
    windowed = readings.withColumn("window", F.window(instant, every))
    statistics = statistics_of(sensor_facts(windowed, ["window"]), ["window"])
    return statistics.selectExpr(
        "window.start AS window_start",
        "window.end AS window_end",
        *statistics.columns[1:],
    )


_WINDOW_KEY = ["window_start", "window_end", *FACT_KEY]


def tumbling_states(
    readings: DataFrame, instant: str = "timestamp", every: str = "1 hour"
) -> DataFrame:
    """Partial statistics per tumbling window and sensor, for merging.

    ``mean`` and ``m2``, the sum of squared differences from it, describe the
    ``value_count`` values that are not NULL; both are 0 without any.
    """
    return (
        readings.withColumn("window", F.window(instant, every))
        .groupBy("window", *FACT_KEY)
        .agg(
            F.expr("count(*) AS reading_count"),
            F.expr("count_if(is_anomaly) AS anomaly_count"),
            F.expr("count(value) AS value_count"),
            F.expr("coalesce(avg(value), 0D) AS mean"),
            F.expr("coalesce(regr_sxx(value, value), 0D) AS m2"),
            F.expr("min(value) AS min_value"),
            F.expr("max(value) AS max_value"),
        )
        .selectExpr(
            "window.start AS window_start",
            "window.end AS window_end",
            *FACT_KEY,
            *["reading_count", "anomaly_count", "value_count"],
            *["mean", "m2", "min_value", "max_value"],
        )
    )


def merge_states(states: DataFrame) -> DataFrame:
    """One state per window and sensor, by the parallel variance rule.

    A key's states are merged one after another, in a fixed order: as many as
    there are partial tables, not readings.
    """
    merged = """aggregate(array_sort(parts),
      struct(0L AS n, 0D AS mean, 0D AS m2),
      (a, b) -> if(b.n = 0, a, struct(
        a.n + b.n AS n,
        a.mean + (b.mean - a.mean) * (b.n / (a.n + b.n)) AS mean,
        a.m2 + b.m2 + (b.mean - a.mean) * (b.mean - a.mean)
          * a.n * (b.n / (a.n + b.n)) AS m2)))"""
    return (
        states.groupBy(*_WINDOW_KEY)
        .agg(
            F.expr("sum(reading_count) AS reading_count"),
            F.expr("sum(anomaly_count) AS anomaly_count"),
            F.expr("collect_list(struct(value_count AS n, mean, m2)) AS parts"),
            F.expr("min(min_value) AS min_value"),
            F.expr("max(max_value) AS max_value"),
        )
        .selectExpr("*", f"{merged} AS merged")
        .selectExpr(
            *_WINDOW_KEY,
            *["reading_count", "anomaly_count", "merged.n AS value_count"],
            *["merged.mean", "merged.m2", "min_value", "max_value"],
        )
    )


def tumbling_statistics_of(states: DataFrame) -> DataFrame:
    """The statistics of :func:`tumbling_statistics` from merged states."""
    measures = {
        "avg_value": rounded("if(value_count > 0, mean, NULL)", 2),
        "min_value": rounded("min_value", 2),
        "max_value": rounded("max_value", 2),
        "stddev_value": rounded(
            "if(value_count > 1, sqrt(m2 / (value_count - 1)), NULL)", 2
        ),
        "anomaly_rate": rounded(share("anomaly_count", "reading_count"), 4),
    }
    return states.selectExpr(
        *_WINDOW_KEY,
        *[f"{measures[n]} AS {n}" if n in measures else n for n in STATISTICS],
    )


def health_history(readings: DataFrame, instant: str = "timestamp") -> DataFrame:
    """Health scores per hour, as the hourly snapshots would hold them."""
    hourly = readings.selectExpr("*", f"{hour_bucket(instant)} AS window_start")
    return health_scores(sensor_facts(hourly, ["window_start"]), ["window_start"])


def anomaly_series(history: DataFrame) -> DataFrame:
    """Anomaly rate per well over time, ordered by time."""
    return history.selectExpr(
        "window_start AS time",
        "well_id AS metric",
        "avg_anomaly_rate AS anomaly_rate",
    ).orderBy("time", "metric")


def with_every_hour(history: DataFrame) -> DataFrame:
    """An hourly history with a row for each hour from a well's first to its
    last: the other columns are NULL where it has none, so that gaps show."""
    hours = (
        history.groupBy("well_id")
        .agg(F.expr("min(window_start) AS first"), F.expr("max(window_start) AS last"))
        .selectExpr(
            "well_id", "explode(sequence(first, last, INTERVAL 1 HOUR)) AS window_start"
        )
    )
    return hours.join(history, ["well_id", "window_start"], "left").select(
        *history.columns
    )


def rolling_average(
    readings: DataFrame,
    instant: str = "timestamp",
    span_seconds: int = 3600,
    slice_seconds: int = 60,
) -> DataFrame:
    """Mean value over the trailing span, per well, sensor and instant.

    The window is closed, ``[t - span, t]``, and its result depends on
    nothing but well, sensor and t, so the output has one row per instant:
    ``rolling_count`` readings with mean ``rolling_avg`` (six decimals).

    A window function over (well, sensor) would put the whole history of a
    hot sensor into one task. Here no task sees more than one slice of it:

    A slice is named by its first microsecond.

    1. Readings are summed up per instant (combined map-side), which bounds a
       slice by its number of distinct microseconds.
    2. Instants are summed up per slice of ``slice_seconds``. A trailing
       window over these totals gives each slice the sum of the full slices
       its instants look back on. That table has one row per slice, so even a
       decade of minutes is small.
    3. What remains per instant are its own slice up to t and the oldest
       slice from ``t - span`` on. Every instant is therefore sent to two
       slices, its own and, shifted by the span, the one a span later, where
       running sums in time order and in reverse order finish the window.

    All parts are added, never subtracted, so nothing cancels out.
    """
    if span_seconds % slice_seconds or span_seconds < 2 * slice_seconds:
        raise ValueError("span_seconds must be two or more whole slices")
    sensor = ["well_id", "sensor_type"]
    span, width = span_seconds * _MICROS, slice_seconds * _MICROS

    instants = (
        readings.groupBy(*sensor, instant)
        .agg(F.expr("sum(value) AS total"), F.expr("count(value) AS n"))
        .selectExpr("*", f"unix_micros(CAST({instant} AS TIMESTAMP)) AS at")
        .selectExpr("*", f"at - pmod(at, {width}) AS slice")
    )

    # The outer form keeps Spark from adding a filter here, which would make
    # this branch differ from the slice totals and shuffle the instants twice.
    parts = instants.selectExpr(
        *sensor,
        f"""inline_outer(array(
          struct(slice, at, 'own' AS part),
          struct(slice + {span} AS slice, at + {span} AS at, 'oldest' AS part)))""",
        instant,
        "total",
        "n",
    )

    full_slices = f"""OVER (PARTITION BY {", ".join(sensor)} ORDER BY slice
      RANGE BETWEEN {span - width} PRECEDING AND {width} PRECEDING)"""
    carried = (
        instants.groupBy(*sensor, "slice")
        .agg(F.expr("sum(total) AS total"), F.expr("sum(n) AS n"))
        .selectExpr(
            *sensor,
            "slice",
            "slice AS at",
            "'carried' AS part",
            f"CAST(NULL AS {dict(instants.dtypes)[instant]}) AS {instant}",
            f"sum(total) {full_slices} AS total",
            f"sum(n) {full_slices} AS n",
        )
    )

    def trailing(column: str) -> str:
        in_slice = f"PARTITION BY {', '.join(sensor)}, slice"
        frame = "RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
        recent = f"""sum(if(part = 'oldest', NULL, {column}))
          OVER ({in_slice} ORDER BY at {frame})"""
        oldest = f"""sum(if(part = 'oldest', {column}, NULL))
          OVER ({in_slice} ORDER BY at DESC {frame})"""
        return f"coalesce({recent}, 0) + coalesce({oldest}, 0)"

    summed = parts.unionByName(carried).selectExpr(
        *sensor,
        instant,
        "part",
        f"{trailing('total')} AS total",
        f"{trailing('n')} AS rolling_count",
    )
    mean = rounded("try_divide(total, rolling_count)", 6)
    return summed.where("part = 'own'").selectExpr(
        *sensor, instant, "rolling_count", f"{mean} AS rolling_avg"
    )
