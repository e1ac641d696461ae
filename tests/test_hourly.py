from __future__ import annotations

import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from lakegauge import __main__ as cli
from lakegauge import schema as S
from lakegauge import storage
from lakegauge.functions.timeparts import ingest_path
from lakegauge.plans import hourly
from lakegauge.plans.rebuild import rebuild
from lakegauge.sinks.runs import read_runs
from lakegauge.sinks.serving import read_sensor_alerts, read_well_health
from lakegauge.sources.tables import read_gold, read_silver
from tests.conftest import HOUR, RUN, rows_of


def reading(well, minute, value=1000.0, anomaly=False, **other):
    row = dict(
        well_id=well,
        location="A",
        depth_m=2400,
        timestamp=f"2026-03-26T14:{minute:02d}:00.000001",
        sensor_type="pressure",
        value=value,
        unit="PSI",
        is_anomaly=anomaly,
    )
    return json.dumps({**row, **other})


def land(roots, hour, *lines):
    from pathlib import Path

    folder = Path(ingest_path(roots.bronze, hour))
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "batch.json").write_text("\n".join(lines) + "\n")


@pytest.fixture
def roots(tmp_path):
    return hourly.Roots.below(str(tmp_path))


FIRST = [
    reading("W1", 0),
    reading("W1", 0),
    reading("W1", 1, value=2500.0, anomaly=True),
    reading("W2", 2, anomaly=True),
    reading("W2", 3, timestamp="never"),
    "not json",
]


def state(spark, roots):
    """Everything the runs have left behind."""
    return {
        "silver": rows_of(read_silver(spark, roots.silver)),
        **{
            table: rows_of(read_gold(spark, roots.gold, table))
            for table in S.GOLD_SCHEMAS
        },
        "health": rows_of(read_well_health(spark, roots.well_health)),
        "alerts": rows_of(read_sensor_alerts(spark, roots.sensor_alerts)),
        "rejects": rows_of(spark.read.parquet(roots.rejects)),
    }


def test_run_hour(spark, roots):
    land(roots, HOUR, *FIRST)
    report = hourly.run_hour(spark, roots, HOUR, processed_at=RUN)
    assert report == dict(
        rows_in=6,
        rows_rejected=2,
        total_records=3,
        anomaly_records=2,
        invalid_records=1,
        missing_location=0,
    )
    health = read_well_health(spark, roots.well_health)
    assert rows_of(health.select("well_id", F.col("health_score").cast("double"))) == [
        ("W1", 80.0),
        ("W2", 60.0),
    ]
    alerts = read_sensor_alerts(spark, roots.sensor_alerts)
    assert rows_of(alerts.select("well_id", "severity", "alert_count")) == [
        ("W1", "CRITICAL", 1),
        ("W2", "WARNING", 1),
    ]
    reasons = spark.read.parquet(roots.rejects).select("reject_reason")
    assert rows_of(reasons) == [("bad_timestamp",), ("malformed",)]
    counts, lowest = hourly.summary(spark, roots)
    assert tuple(counts.first()) == (2, 2)
    assert [r.well_id for r in lowest.collect()] == ["W2", "W1"]


def test_serving_tables_in_sql(spark, roots):
    land(roots, HOUR, *FIRST)
    hourly.run_hour(spark, roots, HOUR, processed_at=RUN)
    hourly.register_views(spark, roots)
    status = spark.sql(
        "SELECT health_score AS `Health Score`, status AS `Status` "
        "FROM well_health WHERE well_id = 'W1'"
    )
    assert rows_of(status.selectExpr("CAST(`Health Score` AS DOUBLE)", "Status")) == [
        (80.0, "HEALTHY")
    ]
    alerts = spark.sql(
        "SELECT well_id AS `Well`, SUM(alert_count) AS `Alert Count` "
        "FROM sensor_alerts GROUP BY well_id ORDER BY SUM(alert_count) DESC, 1 LIMIT 20"
    )
    assert [tuple(r) for r in alerts.collect()] == [("W1", 1), ("W2", 1)]


def test_rerun_changes_nothing(spark, roots):
    land(roots, HOUR, *FIRST)
    hourly.run_hour(spark, roots, HOUR, processed_at=RUN)
    once = state(spark, roots)
    hourly.run_hour(spark, roots, HOUR, processed_at=RUN)
    assert state(spark, roots) == once


def test_rerun_with_repaired_input(spark, roots):
    land(roots, HOUR, *FIRST)
    hourly.run_hour(spark, roots, HOUR, processed_at=RUN)
    land(roots, HOUR, reading("W1", 0))
    hourly.run_hour(spark, roots, HOUR, processed_at=RUN)
    left = state(spark, roots)
    assert len(left["silver"]) == 1
    assert left["alerts"] == [] and left["rejects"] == []
    assert [row[0] for row in left["well_health_scores"]] == ["W1"]


def test_hours_are_independent_and_days_accumulate(spark, roots):
    later = HOUR + timedelta(hours=1)
    land(roots, HOUR, *FIRST)
    land(roots, later, reading("W1", 59))
    hourly.run_hour(spark, roots, HOUR, processed_at=RUN)
    hourly.run_hour(spark, roots, later, processed_at=RUN)
    scores = read_gold(spark, roots.gold, "well_health_scores", later)
    assert rows_of(scores.select("well_id", "total_readings")) == [("W1", 1)]
    assert hourly.clean_to_kpis(spark, roots, later, scope="day")
    scores = read_gold(spark, roots.gold, "well_health_scores", later)
    assert rows_of(scores.select("well_id", "total_readings")) == [("W1", 3), ("W2", 1)]


def test_old_hours_do_not_replace_newer_health(spark, roots):
    later = HOUR + timedelta(hours=1)
    land(roots, HOUR, *FIRST)
    land(roots, later, reading("W1", 59))
    hourly.run_hour(spark, roots, later, processed_at=RUN)
    hourly.run_hour(spark, roots, HOUR, processed_at=RUN)
    health = read_well_health(spark, roots.well_health)
    scores = health.select("well_id", F.col("health_score").cast("double"))
    assert rows_of(scores) == [("W1", 100.0), ("W2", 60.0)]


def test_rebuild_equals_hourly_runs(spark, roots, tmp_path):
    later = HOUR + timedelta(hours=1)
    last = HOUR + timedelta(days=3)
    land(roots, HOUR, *FIRST)
    land(roots, later, FIRST[0], reading("W1", 59, location="B"), "not json")
    land(roots, last, reading("W3", 7, anomaly=True), reading("W3", 7, anomaly=True))
    for hour in (HOUR, later, last):
        hourly.run_hour(spark, roots, hour, processed_at=RUN)
    target = hourly.Roots.below(str(tmp_path / "new"))
    switched = rebuild(spark, roots.bronze, target, processed_at=RUN)
    assert switched.bronze == roots.bronze
    left, right = state(spark, roots), state(spark, switched)
    for table in ("silver", "health", "alerts", *S.GOLD_SCHEMAS):
        assert left[table] == right[table], table
    assert len(left["rejects"]) == len(right["rejects"]) == 3
    with pytest.raises(Exception, match="already exists"):
        rebuild(spark, roots.bronze, target, processed_at=RUN)
    # The hourly runs go on from there.
    land(roots, last + timedelta(hours=1), reading("W3", 8))
    hourly.run_hour(spark, switched, last + timedelta(hours=1), processed_at=RUN)
    assert read_silver(spark, switched.silver).count() == len(left["silver"]) + 1
    assert read_well_health(spark, switched.well_health).count() == 3


def test_rebuild_of_selected_hours(spark, roots, tmp_path):
    land(roots, HOUR, *FIRST)
    land(roots, HOUR + timedelta(days=1), reading("W9", 1))
    target = hourly.Roots.below(str(tmp_path / "new"))
    rebuild(spark, roots.bronze, target, where="day = '27'", partitions=())
    assert rows_of(read_silver(spark, target.silver).select("well_id")) == [("W9",)]


def test_missing_hour_fails_early(spark, roots):
    with pytest.raises(ValueError, match="no raw data"):
        hourly.run_hour(spark, roots, HOUR)


def test_hour_of_rejects_only(spark, roots):
    land(roots, HOUR, "not json")
    report = hourly.run_hour(spark, roots, HOUR, processed_at=RUN)
    assert (report["rows_in"], report["rows_rejected"], report["total_records"]) == (
        1,
        1,
        0,
    )
    assert read_well_health(spark, roots.well_health).isEmpty()


def test_rerun_that_finds_only_rejects(spark, roots):
    land(roots, HOUR, *FIRST)
    hourly.run_hour(spark, roots, HOUR, processed_at=RUN)
    land(roots, HOUR, "not json")
    hourly.run_hour(spark, roots, HOUR, processed_at=RUN)
    left = state(spark, roots)
    for table in ("silver", "alerts", *S.GOLD_SCHEMAS):
        assert left[table] == []
    assert len(left["rejects"]) == 1


def test_scratch_is_removed(spark, roots):
    land(roots, HOUR, *FIRST)
    before = _scratch(spark)
    hourly.run_hour(spark, roots, HOUR, processed_at=RUN)
    assert _scratch(spark) == before


def _scratch(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    own = f"{folder}/lakegauge-{spark.sparkContext.applicationId}"
    return [n for n in storage.children(spark, own) if n.startswith("facts")]


def test_command_line(spark, roots, tmp_path, capsys):
    land(roots, HOUR, *FIRST)
    cli.main(["--base", str(tmp_path), "--hour", "2026-03-26T14"])
    assert json.loads(capsys.readouterr().out.splitlines()[0])["rows_in"] == 6


def test_pending_hours(spark, roots):
    later = HOUR + timedelta(hours=1)
    land(roots, later, reading("W1", 59), "")
    land(roots, HOUR, *FIRST)
    assert hourly.run_pending(spark, roots, RUN) == [HOUR, later]
    once = state(spark, roots)
    assert hourly.run_pending(spark, roots, RUN) == []
    land(roots, HOUR, *FIRST, reading("W9", 9))
    assert hourly.run_pending(spark, roots, RUN) == [HOUR]
    left = state(spark, roots)
    assert len(left["silver"]) == len(once["silver"]) + 1
    runs = read_runs(spark, roots.runs).select("hour", "rows_in", "total_records")
    assert rows_of(runs) == [("14", 7, 4), ("15", 1, 1)]


@pytest.mark.parametrize("layout", [(), ("well_id", "sensor_type")])
def test_layout_stays_with_the_roots(spark, tmp_path, layout):
    """Rebuilt hours and later hourly runs write one layout."""
    later = HOUR + timedelta(hours=1)
    roots = hourly.Roots.below(str(tmp_path / "old"))
    land(roots, HOUR, *FIRST)
    target = hourly.Roots.below(str(tmp_path / "new"))
    rebuilt = rebuild(spark, roots.bronze, target, processed_at=RUN, partitions=layout)
    assert rebuilt.silver_partitions == layout
    land(roots, later, reading("W1", 59))
    hourly.run_hour(spark, rebuilt, later, processed_at=RUN)
    day = read_silver(spark, rebuilt.silver, later, "day")
    assert rows_of(day.select("well_id", "hour")) == [
        ("W1", "14"), ("W1", "14"), ("W1", "15"), ("W2", "14"),
    ]
    assert day.where("well_id = 'W2'").count() == 1
