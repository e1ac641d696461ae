"""The hourly run: raw to clean, clean to KPIs, KPIs to serving.

Each step takes its window as an argument and replaces that window's output,
so it can be repeated or back-filled in any order.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from lakegauge import schema as S
from lakegauge import storage
from lakegauge.functions.timeparts import ingest_path, previous_hour
from lakegauge.operators import kpis, serving
from lakegauge.operators.cleaning import REJECTED, clean_tagged
from lakegauge.operators.dedup import dedup_readings
from lakegauge.plans.outcomes import Outcomes
from lakegauge.session import use_utc
from lakegauge.sinks.hours import (
    SILVER_PARTITIONS,
    write_gold,
    write_rejects,
    write_silver,
)
from lakegauge.sinks.runs import note_run, pending_hours, raw_count
from lakegauge.sinks.serving import (
    read_sensor_alerts,
    read_well_health,
    upsert_well_health,
    write_sensor_alerts,
)
from lakegauge.sources.bronze import hour_available, read_bronze_hour
from lakegauge.sources.tables import read_gold, read_silver
from lakegauge.workspace import new_folder


@dataclass(frozen=True)
class Roots:
    """Where the layers live; any URI Spark can read and write.

    ``silver_partitions`` is the layout of the clean table: a directory per
    well and sensor, or ``()`` for rows clustered by them inside larger files.
    Every job on these roots writes that one, since a table cannot have both.
    """

    bronze: str
    silver: str
    rejects: str
    gold: str
    well_health: str
    sensor_alerts: str
    runs: str
    silver_partitions: tuple[str, ...] = tuple(SILVER_PARTITIONS)

    @classmethod
    def below(cls, base: str, **layout) -> Roots:
        """All layers as directories of one base URI."""
        names = [n for n in cls.__dataclass_fields__ if n != "silver_partitions"]
        base = base.rstrip("/")
        return cls(*[f"{base}/{name}" for name in names], **layout)


def raw_to_clean(
    spark: SparkSession,
    roots: Roots,
    hour: datetime,
    processed_at: datetime | None = None,
) -> dict[str, int] | None:
    """Clean and deduplicate one ingest hour; None when it has no rows.

    The raw lines are parsed once, into a folder by outcome; the clean table,
    the rejects and the counts come from there.
    """
    use_utc(spark)
    stamp = processed_at or datetime.now(timezone.utc)
    folder = new_folder(spark, "outcomes")
    outcomes = Outcomes(read_bronze_hour(spark, roots.bronze, hour), folder)
    counts = outcomes.counts()
    if not sum(counts.values()):
        storage.remove(spark, folder)
        return None

    usable = clean_tagged(outcomes.usable(), stamp).drop(*S.INGEST_COLUMNS)
    write_silver(
        dedup_readings(usable), roots.silver, hour, roots.silver_partitions
    )
    write_rejects(outcomes.rejects(), roots.rejects, hour)
    storage.remove(spark, folder)
    kept = read_silver(spark, roots.silver, hour).agg(*kpis.quality_columns()).first()
    return {
        "rows_in": sum(counts.values()),
        "rows_rejected": counts[REJECTED],
        **kept.asDict(),
    }


def clean_to_kpis(
    spark: SparkSession, roots: Roots, hour: datetime, scope: str = "hour"
) -> bool:
    """Write the three KPI tables of an hour; False when there is nothing to do.

    That is when the hour has no readings, unless an earlier run wrote KPIs
    for it: those are then replaced by empty tables.
    ``scope="day"`` takes the readings of the whole day so far. The readings
    are aggregated once into a facts table in the shared folder, a few rows
    per well, and all three tables come from that file.
    """
    use_utc(spark)
    readings = read_silver(spark, roots.silver, hour, scope)
    if readings.isEmpty() and not storage.exists(
        spark, ingest_path(f"{roots.gold}/sensor_statistics", hour)
    ):
        return False
    folder = new_folder(spark, "facts")
    kpis.sensor_facts(readings).write.parquet(folder)
    facts = spark.read.parquet(folder)

    statistics = kpis.statistics_of(facts)
    write_gold("sensor_statistics", statistics, roots.gold, hour)
    write_gold("well_health_scores", kpis.health_scores(statistics), roots.gold, hour)
    write_gold("alert_summary", kpis.alerts_of(facts), roots.gold, hour)
    storage.remove(spark, folder)
    return True


def publish(
    spark: SparkSession,
    roots: Roots,
    hour: datetime,
    updated_at: datetime | None = None,
) -> None:
    """Bring an hour's KPI tables into the serving tables.

    The hour is the default ``updated_at``: re-running an old hour then never
    replaces a newer state.
    """
    use_utc(spark)
    health = serving.serving_health(
        read_gold(spark, roots.gold, "well_health_scores", hour), updated_at or hour
    )
    alerts = serving.serving_alerts(
        read_gold(spark, roots.gold, "alert_summary", hour), hour
    )
    upsert_well_health(spark, roots.well_health, health)
    write_sensor_alerts(alerts, roots.sensor_alerts, hour)


def register_views(spark: SparkSession, roots: Roots) -> None:
    """Offer the serving tables to SQL as ``well_health`` and ``sensor_alerts``.

    A view shows the state at the time of the call.
    """
    use_utc(spark)
    read_well_health(spark, roots.well_health).createOrReplaceTempView("well_health")
    alerts = read_sensor_alerts(spark, roots.sensor_alerts)
    alerts.createOrReplaceTempView("sensor_alerts")


def summary(spark: SparkSession, roots: Roots) -> tuple[DataFrame, DataFrame]:
    """Row counts of the serving tables, and the five lowest scores."""
    health = read_well_health(spark, roots.well_health)
    alerts = read_sensor_alerts(spark, roots.sensor_alerts)
    return serving.serving_counts(health, alerts), serving.lowest_health(health)


def run_hour(
    spark: SparkSession,
    roots: Roots,
    hour: datetime | None = None,
    scope: str = "hour",
    processed_at: datetime | None = None,
) -> dict[str, int]:
    """Check, clean, compute and publish one hour, by default the last one.

    Fails when no raw data landed for the hour, so that a scheduler retries.
    The run's counts are noted last, in place of an earlier run's.
    """
    hour = hour or previous_hour()
    if not hour_available(spark, roots.bronze, hour):
        raise ValueError(f"no raw data for the hour {hour:%Y-%m-%d %H}:00")
    lines = raw_count(spark, roots.bronze, hour)
    report = raw_to_clean(spark, roots, hour, processed_at) or {}
    if report and clean_to_kpis(spark, roots, hour, scope):
        publish(spark, roots, hour)
    note_run(spark, roots.runs, hour, {"raw_count": lines, **report})
    return report


def run_pending(
    spark: SparkSession, roots: Roots, processed_at: datetime | None = None
) -> list[datetime]:
    """Run every hour that has no run, or more raw lines than its run read;
    oldest first. Returns these hours; a second call finds none."""
    use_utc(spark)
    hours = pending_hours(spark, roots.bronze, roots.runs)
    for hour in hours:
        run_hour(spark, roots, hour, processed_at=processed_at)
    return hours
