"""All layers from the raw data in a few large jobs.

Running hour after hour over years of raw data would leave a large cluster
idle most of the time. A rebuild computes every hour at once, grouped by the
ingest columns, and gives the same tables as the hourly runs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lakegauge import schema as S
from lakegauge import storage
from lakegauge.functions.timeparts import ingest_hour
from lakegauge.operators import kpis, serving
from lakegauge.operators.cleaning import clean_tagged
from lakegauge.operators.dedup import dedup_readings
from lakegauge.plans.hourly import Roots
from lakegauge.plans.outcomes import Outcomes
from lakegauge.session import use_utc
from lakegauge.sinks.hours import write_gold, write_rejects, write_silver
from lakegauge.sinks.serving import upsert_well_health, write_alert_windows
from lakegauge.sources.bronze import read_bronze
from lakegauge.sources.tables import read_gold, read_silver
from lakegauge.workspace import new_folder


def rebuild(
    spark: SparkSession,
    bronze: str,
    target: Roots,
    where: str = "true",
    processed_at: datetime | None = None,
    partitions: Sequence[str] | None = None,
) -> Roots:
    """Compute all layers below ``target``, which must be new, from ``bronze``.

    ``where`` selects hours by the ingest columns, e.g. ``"year = '2025'"``.
    The old layers stay in use until callers switch to the returned roots.
    Readings are deduplicated within their ingest hour, as hourly runs do. The
    raw lines are parsed once. ``partitions`` other than the target's are the
    layout of the returned roots.
    """
    use_utc(spark)
    stamp = processed_at or datetime.now(timezone.utc)
    if partitions is not None:
        target = replace(target, silver_partitions=tuple(partitions))
    staged = new_folder(spark, "outcomes")
    outcomes = Outcomes(read_bronze(spark, bronze).where(where), staged)

    readings = dedup_readings(
        clean_tagged(outcomes.usable(), stamp), key=[*S.INGEST_COLUMNS, *S.READING_KEY]
    )
    write_silver(readings, target.silver, None, target.silver_partitions)
    write_rejects(outcomes.rejects(), target.rejects, None)
    storage.remove(spark, staged)

    folder = new_folder(spark, "facts")
    silver = read_silver(spark, target.silver)
    kpis.sensor_facts(silver, S.INGEST_COLUMNS).write.parquet(folder)
    facts = spark.read.parquet(folder)
    statistics = kpis.statistics_of(facts, S.INGEST_COLUMNS)
    tables = {
        "sensor_statistics": statistics,
        "well_health_scores": kpis.health_scores(statistics, S.INGEST_COLUMNS),
        "alert_summary": kpis.alerts_of(facts, S.INGEST_COLUMNS),
    }
    for name, table in tables.items():
        write_gold(name, table, target.gold, None)
    storage.remove(spark, folder)

    hour = F.expr(ingest_hour())
    scores = read_gold(spark, target.gold, "well_health_scores")
    alerts = read_gold(spark, target.gold, "alert_summary")
    upsert_well_health(spark, target.well_health, serving.serving_health(scores, hour))
    write_alert_windows(serving.serving_alerts(alerts, hour), target.sensor_alerts)
    return replace(target, bronze=bronze)
