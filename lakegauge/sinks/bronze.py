"""Batch writing of raw rows, the twin of the streaming landing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegauge import schema as S
from lakegauge.functions.timeparts import ingest_columns
from lakegauge.session import use_utc


def counts_root(root: str) -> str:
    """Where the lines per hour of a raw table are kept: beside it."""
    return f"{root.rstrip('/')}_counts"


def lines_per_hour(rows: DataFrame, arrival: str) -> DataFrame:
    """Rows per ingest hour; reads nothing but the arrival."""
    hours = rows.selectExpr(*ingest_columns(arrival))
    return hours.groupBy(*S.INGEST_COLUMNS).agg(F.expr("count(*) AS raw_count"))


def write_bronze(raw: DataFrame, root: str, arrival: str) -> None:
    """Write raw rows as JSON lines below their ingest hour.

    NULL fields are written as such, so a line always has all fields. Nothing
    is shuffled: raw data is the bulkiest there is and arrives in time order,
    so a task meets few hours. Range-partition by arrival first if not. The
    lines per hour are counted in a pass over the arrivals alone.
    """
    use_utc(raw.sparkSession)
    lines = raw.selectExpr(*S.RAW_COLUMNS, *ingest_columns(arrival))
    writer = lines.write.mode("errorifexists").option("ignoreNullFields", "false")
    writer.partitionBy(*S.INGEST_COLUMNS).json(root)
    _write_counts(raw, root, arrival)


def write_lines(lines: DataFrame, root: str, arrival: str) -> None:
    """The same for lines (``value``) that are JSON already, or should be."""
    use_utc(lines.sparkSession)
    rows = lines.selectExpr("value", *ingest_columns(arrival))
    rows.write.mode("errorifexists").partitionBy(*S.INGEST_COLUMNS).text(root)
    _write_counts(lines, root, arrival)


def _write_counts(rows: DataFrame, root: str, arrival: str) -> None:
    counts = lines_per_hour(rows, arrival)
    counts.write.mode("errorifexists").parquet(f"{counts_root(root)}/batch")
