"""Clean and KPI tables: Parquet below ingest-time directories."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegauge import schema as S
from lakegauge import storage
from lakegauge.functions.timeparts import ingest_hour, ingest_path


def read_silver(
    spark: SparkSession,
    root: str,
    hour: datetime | None = None,
    scope: str = "hour",
) -> DataFrame:
    """Clean readings of one ingest hour or day, or all of them.

    The declared schema covers the directory columns too, so ids that look
    like numbers stay strings whatever the session's inference settings.
    """
    return _read_hours(spark, root, S.SILVER_SCHEMA, hour, scope)


def read_gold(
    spark: SparkSession, root: str, table: str, hour: datetime | None = None
) -> DataFrame:
    """A KPI table of one hour, or its history over all hours."""
    schema = T.StructType(S.GOLD_SCHEMAS[table].fields + S.INGEST_FIELDS)
    return _read_hours(spark, f"{root.rstrip('/')}/{table}", schema, hour, "hour")


def read_history(
    spark: SparkSession, root: str, table: str, where: str = "true"
) -> DataFrame:
    """A KPI table of all hours with ``window_start``, the hour, instead of the
    directory columns; ``where`` on those prunes directories."""
    rows = read_gold(spark, root, table).where(where)
    return rows.withColumn("window_start", F.expr(ingest_hour())).drop(*S.INGEST_COLUMNS)


def _read_hours(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    hour: datetime | None,
    scope: str,
) -> DataFrame:
    """Enter the wanted directory directly instead of listing the whole root."""
    path = root if hour is None else ingest_path(root, hour, scope)
    if not storage.exists(spark, path):
        return spark.createDataFrame([], schema)
    table = spark.read.schema(schema).option("basePath", root).parquet(path)
    return table.select(*schema.names)  # directory columns come last otherwise
