"""What the hourly runs did: one row per ingest hour, that of its last run."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegauge import schema as S
from lakegauge import storage
from lakegauge.functions.timeparts import in_ingest_scope, ingest_hour, ingest_path
from lakegauge.operators.kpis import QUALITY_MEASURES
from lakegauge.sources.bronze import hour_availability

# raw_count is what the writers of the raw table had counted before the run;
# blank lines are in it, but no rows.
RUN_COUNTS = ["raw_count", "rows_in", "rows_rejected", *QUALITY_MEASURES]
_RUN = T.StructType([T.StructField(name, T.LongType()) for name in RUN_COUNTS])


def raw_count(spark: SparkSession, bronze: str, hour: datetime) -> int:
    """Raw lines that an ingest hour has now."""
    rows = hour_availability(spark, bronze).where(in_ingest_scope(hour))
    return rows.agg(F.sum("raw_count")).first()[0] or 0


def note_run(
    spark: SparkSession, root: str, hour: datetime, counts: dict[str, int]
) -> None:
    """Note the counts of an hour's run, replacing an earlier run of it."""
    row = [[counts.get(name, 0) for name in RUN_COUNTS]]
    spark.createDataFrame(row, _RUN).coalesce(1).write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).parquet(ingest_path(root, hour))


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    """The counts of all runs with their ingest hour."""
    schema = T.StructType([*_RUN.fields, *S.INGEST_FIELDS])
    if not storage.exists(spark, root):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(root)


def pending_hours(spark: SparkSession, bronze: str, root: str) -> list[datetime]:
    """Ingest hours whose raw lines no run has read, oldest first: those
    without a run, and those that got lines after it. The driver gets one value
    per such hour; lines are not read where their writers have counted them."""
    landed = hour_availability(spark, bronze)
    done = read_runs(spark, root).selectExpr(*S.INGEST_COLUMNS, "raw_count AS read")
    left = landed.join(done, S.INGEST_COLUMNS, "left").where(
        "read IS NULL OR read <> raw_count"
    )
    seconds = left.selectExpr(f"unix_seconds({ingest_hour()}) AS at").orderBy(F.col("at"))
    return [datetime.fromtimestamp(r["at"], timezone.utc) for r in seconds.collect()]
