"""Serving tables as Parquet, with an optional database hop."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakegauge import schema as S
from lakegauge import storage
from lakegauge.operators.serving import upsert_health
from lakegauge.session import use_utc

_VERSION = "version="


def _committed(spark: SparkSession, root: str) -> list[int]:
    """Versions whose write finished, oldest first."""
    return [v for v in _versions(spark, root) if _is_committed(spark, root, v)]


def _versions(spark: SparkSession, root: str) -> list[int]:
    names = storage.children(spark, root)
    return sorted(int(n[len(_VERSION) :]) for n in names if n.startswith(_VERSION))


def _version_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/{_VERSION}{version:010d}"


def _is_committed(spark: SparkSession, root: str, version: int) -> bool:
    return storage.exists(spark, f"{_version_path(root, version)}/_SUCCESS")


def read_well_health(spark: SparkSession, root: str) -> DataFrame:
    """The current state of ``well_health``, empty before the first write."""
    committed = _committed(spark, root)
    if not committed:
        return spark.createDataFrame([], S.WELL_HEALTH_SCHEMA)
    return spark.read.schema(S.WELL_HEALTH_SCHEMA).parquet(_version_path(root, committed[-1]))


def upsert_well_health(
    spark: SparkSession, root: str, incoming: DataFrame, keep: int = 3
) -> None:
    """Merge a batch into ``well_health``.

    Plain Parquet has no merge, and a table must not be overwritten while it
    is read. Each upsert writes a new version next to the current one; its
    ``_SUCCESS`` file makes it visible in one step, so readers see the old or
    the new state and a failed attempt is never seen. Runs must not overlap.
    The newest ``keep`` versions stay for readers that have already started;
    older ones and those of failed attempts are removed.
    """
    versions = _versions(spark, root)
    merged = upsert_health(read_well_health(spark, root), incoming)
    merged.write.mode("errorifexists").option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "true"
    ).parquet(_version_path(root, versions[-1] + 1 if versions else 0))
    kept = _committed(spark, root)[-max(keep, 1) :]
    for version in _versions(spark, root):
        if version not in kept:
            storage.remove(spark, _version_path(root, version))


def _alert_window(root: str, window_start: datetime) -> str:
    if window_start.tzinfo is not None:
        window_start = window_start.astimezone(timezone.utc)
    return f"{root.rstrip('/')}/window={window_start:%Y-%m-%dT%H-%M}"


def write_sensor_alerts(alerts: DataFrame, root: str, window_start: datetime) -> None:
    """Append the alerts of one window, replacing an earlier run of it.

    The window's directory is replaced even when there are no alerts, so a
    re-run that finds none leaves none behind.
    """
    alerts.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
        _alert_window(root, window_start)
    )


def write_alert_windows(alerts: DataFrame, root: str) -> None:
    """Backfill: replace all windows that occur in ``alerts`` in one job."""
    use_utc(alerts.sparkSession)
    window = """date_format(window_start, "yyyy-MM-dd'T'HH-mm") AS window"""
    (
        alerts.selectExpr("*", window)
        .hint("rebalance", "window")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("window")
        .parquet(root)
    )


def read_sensor_alerts(spark: SparkSession, root: str) -> DataFrame:
    """All alerts; ``window`` is the directory column, filter on it to prune."""
    window = T.StructField("window", T.StringType())
    schema = T.StructType([*S.SENSOR_ALERTS_SCHEMA.fields, window])
    if not storage.exists(spark, root):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(root)


def export_table(
    table: DataFrame, url: str, name: str, connections: int = 8, **properties: str
) -> None:
    """Copy a serving table to a database over JDBC, replacing its rows.

    ``well_health`` already holds the merged state, so replacing rows has the
    effect of an upsert. The table keeps its definition and is filled by at
    most ``connections`` tasks. Needs the database's JDBC driver.
    """
    (
        table.write.format("jdbc")
        .options(url=url, dbtable=name, truncate="true", **properties)
        .option("numPartitions", connections)
        .mode("overwrite")
        .save()
    )
