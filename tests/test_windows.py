from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakegauge import fixtures as X
from lakegauge.operators import windows
from tests.conftest import HOUR, executed_plan, rows_of

SF = "/root/testdata/sf0.001"
SPAN = timedelta(hours=1)


def by_definition(rows):
    """Trailing closed window, straight from its definition."""
    result = set()
    for well, sensor, at, _ in rows:
        inside = [
            v
            for w, s, t, v in rows
            if (w, s) == (well, sensor) and at - SPAN <= t <= at and v is not None
        ]
        mean = round(sum(inside) / len(inside), 6) if inside else None
        result.add((well, sensor, at, len(inside), mean))
    return result


def check(spark, rows, **parameters):
    schema = "well_id string, sensor_type string, timestamp timestamp_ntz, value double"
    table = spark.createDataFrame(rows, schema).repartition(3)
    found = windows.rolling_average(table, **parameters).collect()
    assert len(found) == len({(w, s, t) for w, s, t, _ in rows})
    expected = {(w, s, t): (n, m) for w, s, t, n, m in by_definition(rows)}
    for well, sensor, at, count, mean in found:
        wanted_count, wanted_mean = expected[(well, sensor, at)]
        assert count == wanted_count
        assert mean == pytest.approx(wanted_mean, abs=2e-6)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("slice_seconds", [60, 600, 1800])
def test_rolling_average_random(spark, seed, slice_seconds):
    choice = random.Random(seed)
    start = datetime(2024, 1, 1, 7, 0, 0)
    rows = [
        (
            choice.choice(["a", "b"]),
            choice.choice(["x", "y"]),
            start
            + timedelta(
                seconds=choice.randint(0, 4 * 3600),
                microseconds=choice.choice([0, 0, 1, 999999]),
            ),
            choice.choice([None, round(choice.uniform(-500, 500), 2)]),
        )
        for _ in range(150)
    ]
    check(spark, rows, slice_seconds=slice_seconds)


def test_rolling_average_edges(spark):
    """Exactly one span back counts, one microsecond more does not."""
    at = datetime(2024, 1, 1, 12, 0, 0)
    tick = timedelta(microseconds=1)
    rows = [
        ("w", "s", t, float(i))
        for i, t in enumerate(
            [at - SPAN - tick, at - SPAN, at - SPAN + tick, at - tick, at, at + tick]
        )
    ]
    check(spark, rows)


def test_rolling_average_before_1970(spark):
    at = datetime(1969, 12, 31, 23, 30)
    step = timedelta(minutes=7, seconds=13)
    check(spark, [("w", "s", at + i * step, float(i)) for i in range(20)])


def test_rolling_average_of_one_hot_instant(spark):
    """Many readings of one instant arrive as one partial sum per task."""
    readings = (
        spark.range(50_000)
        .select(
            F.lit("w").alias("well_id"),
            F.lit("s").alias("sensor_type"),
            F.lit(HOUR).cast("timestamp").alias("timestamp"),
            F.col("id").cast("double").alias("value"),
        )
        .repartition(4)
    )
    rows = windows.rolling_average(readings).collect()
    assert [(r.rolling_count, r.rolling_avg) for r in rows] == [(50_000, 24999.5)]


def test_rolling_average_splits_a_hot_sensor(spark):
    """No exchange of the instants is keyed by the sensor alone."""
    plan = executed_plan(windows.rolling_average(X.readings(spark, SF)))
    keys = [
        line.split("hashpartitioning(")[1].split("),")[0]
        for line in plan.splitlines()
        if "hashpartitioning(" in line
    ]
    by_sensor_only = [k for k in keys if "slice" not in k and "timestamp" not in k]
    assert len(by_sensor_only) == 1  # the small table of slice totals


def test_rolling_average_shuffles_instants_once(spark):
    result = windows.rolling_average(X.readings(spark, SF))
    result.collect()
    assert "ReusedExchange" in executed_plan(result)


def test_rolling_average_checks_its_slices(readings_of):
    for span, slice_ in [(3600, 7), (3600, 3600)]:
        with pytest.raises(ValueError):
            windows.rolling_average(
                readings_of({}), span_seconds=span, slice_seconds=slice_
            )


def test_tumbling_windows(readings_of):
    readings = readings_of(
        dict(timestamp=HOUR, value=1.0),
        dict(timestamp=HOUR + timedelta(minutes=59, seconds=59), value=3.0),
        dict(timestamp=HOUR + timedelta(hours=1), value=5.0),
    )
    rows = windows.tumbling_statistics(readings).select(
        "window_start", "window_end", "avg_value", "reading_count"
    )
    assert rows_of(rows) == [
        (datetime(2026, 3, 26, 14), datetime(2026, 3, 26, 15), 2.0, 2),
        (datetime(2026, 3, 26, 15), datetime(2026, 3, 26, 16), 5.0, 1),
    ]


def test_hour_bucket(readings_of):
    readings = readings_of(
        dict(timestamp=HOUR), dict(timestamp=HOUR + timedelta(minutes=59))
    )
    assert rows_of(windows.readings_per_hour(readings)) == [
        (datetime(2026, 3, 26, 14), 2)
    ]


def test_anomaly_series_is_ordered_history(readings_of):
    readings = readings_of(
        dict(timestamp=HOUR + timedelta(hours=2), is_anomaly=True),
        dict(timestamp=HOUR),
    )
    series = windows.anomaly_series(windows.health_history(readings))
    assert [tuple(r) for r in series.collect()] == [
        (datetime(2026, 3, 26, 14), "WELL-001", 0.0),
        (datetime(2026, 3, 26, 16), "WELL-001", 1.0),
    ]
