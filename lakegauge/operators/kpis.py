"""Per-well and per-sensor indicators.

Everything the KPI tables need comes out of one aggregate over the readings,
:func:`sensor_facts`. It combines map-side, so a hot well or sensor reaches
the reducers as one row per map task. The tables themselves are projections
and small second aggregates of the facts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegauge import schema as S
from lakegauge.functions import labels
from lakegauge.functions.numeric import percent, rounded, share

FACT_KEY = ["well_id", "sensor_type", "location"]
STATISTICS = [
    "avg_value",
    "min_value",
    "max_value",
    "stddev_value",
    "reading_count",
    "anomaly_count",
    "anomaly_rate",
]

# A NULL flag counts as not set in all of these.
_ANOMALOUS = "is_anomaly"
_INVALID = "NOT value_valid"
_VIBRATING = f"sensor_type = 'vibration' AND value > {S.VIBRATION_LIMIT}D"
_STALLING = f"sensor_type = 'rpm' AND value < {S.RPM_LIMIT}D"


def _named(measures: Mapping[str, str]):
    """Columns from a mapping of names to SQL text."""
    return [F.expr(f"{text} AS {name}") for name, text in measures.items()]


def sensor_facts(readings: DataFrame, extra_key: Sequence[str] = ()) -> DataFrame:
    """Statistics and condition counts per well, sensor and location.

    ``extra_key`` adds grouping columns, such as a time window. Counts that a
    caller does not select are pruned from the plan.
    """
    measures = {
        "avg_value": rounded("avg(value)", 2),
        "min_value": rounded("min(value)", 2),
        "max_value": rounded("max(value)", 2),
        "stddev_value": rounded("stddev_samp(value)", 2),
        "reading_count": "count(*)",
        "anomaly_count": f"count_if({_ANOMALOUS})",
        "anomaly_rate": rounded(share(f"count_if({_ANOMALOUS})", "count(*)"), 4),
        "invalid_count": f"count_if({_INVALID})",
        "critical_count": f"count_if({_ANOMALOUS} AND {_INVALID})",
        "high_vibration_count": f"count_if({_VIBRATING})",
        "low_rpm_count": f"count_if({_STALLING})",
    }
    return readings.groupBy(*extra_key, *FACT_KEY).agg(*_named(measures))


def statistics_of(facts: DataFrame, extra_key: Sequence[str] = ()) -> DataFrame:
    """The published statistics columns of a facts table."""
    return facts.select(*extra_key, *FACT_KEY, *STATISTICS)


def sensor_statistics(readings: DataFrame) -> DataFrame:
    """Mean, range, sample deviation, counts and anomaly rate per sensor."""
    return statistics_of(sensor_facts(readings))


def well_rollup(statistics: DataFrame, extra_key: Sequence[str] = ()) -> DataFrame:
    """Well level: plain means over the sensors' rounded rates and averages.

    Every sensor weighs the same however many readings it has.
    ``overall_avg_value`` mixes units and is kept only as published.
    """
    measures = {
        "avg_anomaly_rate": rounded("avg(anomaly_rate)", 4),
        "overall_avg_value": rounded("avg(avg_value)", 2),
        "total_readings": "sum(reading_count)",
        "total_anomalies": "sum(anomaly_count)",
    }
    return statistics.groupBy(*extra_key, "well_id", "location").agg(*_named(measures))


def health_scores(statistics: DataFrame, extra_key: Sequence[str] = ()) -> DataFrame:
    """Score from the anomaly rate alone, with its status, per well."""
    return _with_score(
        well_rollup(statistics, extra_key), {"avg_anomaly_rate": S.ANOMALY_POINTS}
    )


def health_scores_full(facts: DataFrame) -> DataFrame:
    """Score from anomalies, invalid values, vibration and low rotation.

    The last two shares are over that sensor's readings only; a well without
    such a sensor loses nothing for it.
    """

    def share_of(count: str, sensor: str | None = None) -> str:
        of_sensor = f" FILTER (WHERE sensor_type = '{sensor}')" if sensor else ""
        total = f"sum(reading_count){of_sensor}"
        return f"coalesce({share(f'sum({count})', total)}, 0D)"

    measures = {
        "avg_anomaly_rate": rounded("avg(anomaly_rate)", 4),
        "total_readings": "sum(reading_count)",
        "invalid_share": share_of("invalid_count"),
        "high_vibration_share": share_of("high_vibration_count", "vibration"),
        "low_rpm_share": share_of("low_rpm_count", "rpm"),
    }
    points = {
        "avg_anomaly_rate": S.ANOMALY_POINTS,
        "invalid_share": S.INVALID_POINTS,
        "high_vibration_share": S.VIBRATION_POINTS,
        "low_rpm_share": S.RPM_POINTS,
    }
    scored = _with_score(
        facts.groupBy("well_id", "location").agg(*_named(measures)), points
    )
    shares = [name for name in points if name.endswith("_share")]
    return scored.selectExpr(
        *[f"{rounded(n, 4)} AS {n}" if n in shares else n for n in scored.columns]
    )


def _with_score(wells: DataFrame, points: Mapping[str, float]) -> DataFrame:
    score = rounded(labels.health_score(points), 1)
    scored = wells.selectExpr("*", f"{score} AS health_score")
    return scored.selectExpr("*", f"{labels.health_status()} AS status")


def anomaly_rows(readings: DataFrame) -> DataFrame:
    """Readings flagged as anomalous; a NULL flag is not one."""
    return readings.where(_ANOMALOUS)


def invalid_rows(readings: DataFrame) -> DataFrame:
    """Readings known to be out of range."""
    return readings.where(_INVALID)


def with_severity(readings: DataFrame) -> DataFrame:
    """Anomalous readings with their alert severity."""
    return anomaly_rows(readings).selectExpr(
        "*", f"{labels.alert_severity()} AS severity"
    )


def alert_counts(readings: DataFrame, extra_key: Sequence[str] = ()) -> DataFrame:
    """Number of alerts per well, sensor and severity, unordered."""
    return (
        with_severity(readings)
        .groupBy(*extra_key, "well_id", "sensor_type", "severity")
        .agg(F.expr("count(*) AS alert_count"))
    )


def alert_summary(readings: DataFrame) -> DataFrame:
    """Alert counts, most frequent first; the key columns break ties."""
    return alert_counts(readings).orderBy(
        F.desc("alert_count"), "well_id", "sensor_type", "severity"
    )


def alerts_of(facts: DataFrame, extra_key: Sequence[str] = ()) -> DataFrame:
    """Alert counts from the facts, without another look at the readings.

    Equal to :func:`alert_counts`: an alert is critical when its value is
    invalid, and all other anomalies are warnings.
    """
    by_severity = (
        "stack(2, 'CRITICAL', critical_count, "
        "'WARNING', anomaly_count - critical_count) AS (severity, alerts)"
    )
    return (
        facts.selectExpr(*extra_key, "well_id", "sensor_type", by_severity)
        .where("alerts > 0")
        .groupBy(*extra_key, "well_id", "sensor_type", "severity")
        .agg(F.expr("sum(alerts) AS alert_count"))
    )


def anomalies_by_sensor(readings: DataFrame) -> DataFrame:
    """Anomalous readings per sensor type, most frequent first."""
    return (
        anomaly_rows(readings)
        .groupBy("sensor_type")
        .count()
        .orderBy(F.desc("count"), "sensor_type")
    )


# Counts describing a clean table, for one aggregate or an observation.
QUALITY_MEASURES = {
    "total_records": "count(*)",
    "anomaly_records": f"count_if({_ANOMALOUS})",
    "invalid_records": f"count_if({_INVALID})",
    "missing_location": "count_if(location IS NULL)",
}


def quality_columns():
    return _named(QUALITY_MEASURES)


def quality_summary(readings: DataFrame) -> DataFrame:
    """Counts and percentages in one pass; percentages of nothing are NULL."""
    return readings.agg(*quality_columns()).selectExpr(
        "*",
        f"{percent('anomaly_records', 'total_records')} AS anomaly_percent",
        f"{percent('invalid_records', 'total_records')} AS invalid_percent",
    )


def classify_band(readings: DataFrame) -> DataFrame:
    """Add ``band``: normal, anomaly or between, from the built-in rules."""
    return readings.selectExpr("*", f"{labels.value_band()} AS band")


def classify_band_with(readings: DataFrame, rules: DataFrame) -> DataFrame:
    """Like :func:`classify_band` with a rules table of any size.

    ``rules`` has sensor_type, normal_low, normal_high, anomaly_low and
    anomaly_high, one row per sensor type. There is no broadcast hint: Spark
    broadcasts the rules while they are below its size threshold and splits
    skewed sensor types in a shuffled join beyond it.
    """
    bounds = ["normal_low", "normal_high", "anomaly_low", "anomaly_high"]
    known = rules.select("sensor_type", *bounds)
    return readings.join(known, "sensor_type", "left").selectExpr(
        *readings.columns, f"{labels.band_of('value', *bounds)} AS band"
    )
