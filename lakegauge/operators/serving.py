"""Serving tables and the queries dashboards and reports run on them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def serving_health(scores: DataFrame, updated_at: datetime | Column) -> DataFrame:
    """Typed ``well_health`` rows, one per well: the latest.

    A well reported under two locations keeps the one with more readings; on
    a tie the later location name.
    """
    typed = scores.withColumn("updated_at", F.lit(updated_at)).selectExpr(
        "well_id",
        "location",
        "CAST(health_score AS DECIMAL(5,1)) AS health_score",
        "status",
        "CAST(avg_anomaly_rate AS DECIMAL(6,4)) AS avg_anomaly_rate",
        "CAST(total_readings AS BIGINT) AS total_readings",
        "CAST(total_anomalies AS BIGINT) AS total_anomalies",
        "CAST(updated_at AS TIMESTAMP) AS updated_at",
    )
    return _latest_per_well(typed)


def serving_alerts(alerts: DataFrame, window_start: datetime | Column) -> DataFrame:
    """Typed ``sensor_alerts`` rows of one window."""
    return alerts.withColumn("window_start", F.lit(window_start)).selectExpr(
        "well_id",
        "sensor_type",
        "severity",
        "CAST(alert_count AS BIGINT) AS alert_count",
        "CAST(window_start AS TIMESTAMP) AS window_start",
    )


def upsert_health(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Insert or update by well: the latest row of each well wins.

    Order of arrival does not matter, so replaying an old batch changes
    nothing. Both sides hold one row per well.
    """
    return _latest_per_well(current.unionByName(incoming))


def _latest_per_well(rows: DataFrame) -> DataFrame:
    row = f"struct({', '.join(rows.columns)})"
    rank = "struct(updated_at, total_readings, location)"
    latest = F.expr(f"max_by({row}, {rank}) AS latest")
    return rows.groupBy("well_id").agg(latest).select("latest.*")


def health_view(scores: DataFrame) -> DataFrame:
    """The short health listing."""
    return scores.select(
        "well_id", "health_score", "status", "avg_anomaly_rate", "total_readings"
    )


def top_alerts(alerts: DataFrame, limit: int = 10) -> DataFrame:
    """The most frequent alerts."""
    return alerts.orderBy(
        F.desc("alert_count"), "well_id", "sensor_type", "severity"
    ).limit(limit)


def well_status(health: DataFrame, well_id: str) -> DataFrame:
    """Status panel of one well."""
    return health.where(F.col("well_id") == well_id).selectExpr(
        "health_score AS `Health Score`", "status AS Status"
    )


def health_by_well(health: DataFrame) -> DataFrame:
    """Bar chart of all scores."""
    return health.selectExpr(
        "well_id AS Well", "health_score AS `Health Score`"
    ).orderBy("Well")


def active_alerts(
    alerts: DataFrame, limit: int = 20, since: datetime | None = None
) -> DataFrame:
    """Alert totals over all windows, or over the windows from ``since`` on."""
    if since is not None:
        alerts = alerts.where(F.col("window_start") >= F.lit(since))
    return (
        alerts.groupBy(
            F.expr("well_id AS Well"), F.expr("sensor_type AS Sensor"), "severity"
        )
        .agg(F.expr("sum(alert_count) AS `Alert Count`"))
        .orderBy(F.desc("Alert Count"), "Well", "Sensor", "severity")
        .limit(limit)
    )


def serving_counts(health: DataFrame, alerts: DataFrame) -> DataFrame:
    """Row counts of both serving tables, as one row."""
    tables = health.selectExpr("'health' AS name").union(
        alerts.selectExpr("'alerts' AS name")
    )
    return tables.agg(
        F.expr("count_if(name = 'health') AS well_count"),
        F.expr("count_if(name = 'alerts') AS alert_count"),
    )


def lowest_health(health: DataFrame, limit: int = 5) -> DataFrame:
    """The wells in the worst condition."""
    return (
        health.select("well_id", "health_score", "status")
        .orderBy("health_score", "well_id")
        .limit(limit)
    )
