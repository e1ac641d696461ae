from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest

from lakegauge.functions import labels, numeric, timeparts


def value_of(spark, text, **values):
    """Result of SQL text over one row; values are (type, value) pairs."""
    schema = ", ".join(f"{name} {kind}" for name, (kind, _) in values.items())
    row = [tuple(value for _, value in values.values())]
    table = spark.createDataFrame(row, schema) if values else spark.range(1)
    return table.selectExpr(text).first()[0]


@pytest.mark.parametrize(
    "x, digits, expected",
    [
        (1.005, 2, 1.01),
        (2.675 - 1e-13, 2, 2.68),
        (-1.005, 2, -1.01),
        (1.004999, 2, 1.0),
        (float("inf"), 2, float("inf")),
        (1e25, 2, 1e25),
        (None, 2, None),
    ],
)
def test_rounded(spark, x, digits, expected):
    assert value_of(spark, numeric.rounded("x", digits), x=("double", x)) == expected


def test_share_of_nothing_is_null(spark):
    assert value_of(spark, numeric.share("1", "0")) is None
    assert value_of(spark, numeric.percent("0", "0")) is None
    assert value_of(spark, numeric.percent("1", "8")) == 12.5


@pytest.mark.parametrize(
    "sensor, value, expected",
    [
        ("pressure", 0.0, True),
        ("pressure", 2000.0, True),
        ("pressure", 2000.01, False),
        ("temperature", -10.0, True),
        ("temperature", -10.01, False),
        ("flow_rate", -5.0, True),
        ("flow_rate", 500.01, False),
        ("vibration", 20.0, True),
        ("rpm", 5000.5, False),
        ("humidity", 1e9, True),
        (None, 1.0, True),
        ("pressure", float("nan"), False),
        ("pressure", None, None),
    ],
)
def test_valid_range(spark, sensor, value, expected):
    row = dict(sensor_type=("string", sensor), value=("double", value))
    assert value_of(spark, labels.valid_range(), **row) is expected


@pytest.mark.parametrize(
    "sensor, value, expected",
    [
        ("pressure", 800.0, "normal"),
        ("pressure", 1400.0, "anomaly"),
        ("pressure", 1300.0, "between"),
        ("flow_rate", 0.0, "anomaly"),
        ("flow_rate", 30.0, "between"),
        ("rpm", 700.0, "anomaly"),
        ("humidity", 5.0, None),
        ("rpm", None, None),
    ],
)
def test_value_band(spark, sensor, value, expected):
    row = dict(sensor_type=("string", sensor), value=("double", value))
    assert value_of(spark, labels.value_band(), **row) == expected


@pytest.mark.parametrize(
    "valid, expected", [(False, "CRITICAL"), (True, "WARNING"), (None, "WARNING")]
)
def test_severity(spark, valid, expected):
    row = dict(value_valid=("boolean", valid))
    assert value_of(spark, labels.alert_severity(), **row) == expected


@pytest.mark.parametrize(
    "rate, score, status",
    [
        (0.0, 100.0, "HEALTHY"),
        (0.05, 98.0, "HEALTHY"),
        (0.5, 80.0, "HEALTHY"),
        (0.5012, 80.0, "HEALTHY"),
        (0.5013, 79.9, "WARNING"),
        (1.0, 60.0, "WARNING"),
    ],
)
def test_score_edges(spark, rate, score, status):
    text = numeric.rounded(labels.health_score({"rate": 40.0}), 1)
    assert value_of(spark, text, rate=("double", rate)) == score
    assert value_of(spark, labels.health_status(text), rate=("double", rate)) == status


def test_score_is_clamped(spark):
    worst = labels.health_score({"1.0D": 40.0, "1D": 30.0, "(1D)": 20.0, "(1.0D)": 10.0})
    assert value_of(spark, worst) == 0.0
    assert value_of(spark, labels.health_status(worst)) == "CRITICAL"
    assert value_of(spark, labels.health_score({"9D": 40.0})) == 0.0
    assert value_of(spark, labels.health_score({"-1D": 5.0})) == 100.0


def test_lookup_quotes_its_keys(spark):
    text = labels.lookup("x", {"it's": "1", "a\\b": "2", 3: "3"})
    assert value_of(spark, text, x=("string", "it's")) == 1
    assert value_of(spark, text, x=("string", "a\\b")) == 2


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-03-18T10:23:45.123456", datetime(2024, 3, 18, 10, 23, 45, 123456)),
        ("2024-03-18T10:23:45", datetime(2024, 3, 18, 10, 23, 45)),
        ("2024-03-18 10:23:45.5", datetime(2024, 3, 18, 10, 23, 45, 500000)),
        ("2024-03-18T10:23:45.123456+00:00", datetime(2024, 3, 18, 10, 23, 45, 123456)),
        ("2024-03-18T10:23:45+02:00", datetime(2024, 3, 18, 8, 23, 45)),
        ("2024-03-18T10:23:45Z", datetime(2024, 3, 18, 10, 23, 45)),
        ("not-a-time", None),
        ("10:23:45", None),
        ("2024", None),
        ("2024-02-30T10:00:00", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_instant(spark, text, expected):
    parsed = f"CAST({timeparts.parse_instant('x')} AS TIMESTAMP_NTZ)"
    assert value_of(spark, parsed, x=("string", text)) == expected


def test_ingest_path():
    moment = datetime(2026, 3, 26, 14, 30, tzinfo=timezone.utc)
    assert (
        timeparts.ingest_path("s3a://lake/", moment)
        == "s3a://lake/year=2026/month=03/day=26/hour=14"
    )
    assert timeparts.ingest_path("/lake", moment, "day") == (
        "/lake/year=2026/month=03/day=26"
    )
    shifted = moment.astimezone(timezone(timedelta(hours=5)))
    assert timeparts.ingest_path("x", shifted) == timeparts.ingest_path("x", moment)
    with pytest.raises(ValueError):
        timeparts.ingest_path("x", moment, "week")


def test_ingest_columns_match_the_path(spark):
    instant = "TIMESTAMP'2026-03-26 14:30:00'"
    row = spark.range(1).selectExpr(*timeparts.ingest_columns(instant)).first()
    assert row.asDict() == dict(year="2026", month="03", day="26", hour="14")
    back = spark.createDataFrame([row]).selectExpr(timeparts.ingest_hour())
    assert back.first()[0] == datetime(2026, 3, 26, 14)


def test_previous_hour():
    now = datetime(2026, 3, 26, 0, 5, 59, 7, tzinfo=timezone.utc)
    assert timeparts.previous_hour(now) == datetime(2026, 3, 25, 23, tzinfo=timezone.utc)
    assert timeparts.previous_hour().minute == 0
