"""Tables by ingest hour.

Given an hour, a sink replaces that hour as a whole. Without one it writes
all hours of its input, told apart by the ingest columns, into a root that
does not exist yet.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame

from lakegauge import schema as S
from lakegauge.functions.timeparts import ingest_path

SILVER_PARTITIONS = ["well_id", "sensor_type"]
# Lets a reader skip row groups without a well.
_CLUSTERED = {"parquet.bloom.filter.enabled#well_id": "true"}


def _hour_columns(hour: datetime | None) -> list[str]:
    """The ingest columns a row must bring: none when the path has them."""
    return S.INGEST_COLUMNS if hour is None else []


def _write(
    df: DataFrame,
    root: str,
    hour: datetime | None,
    partitions: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
) -> None:
    columns = [*_hour_columns(hour), *partitions]
    if hour is None:
        writer, path = df.write.mode("errorifexists"), root
    else:
        # Static: partitions that no longer have rows must go as well.
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        path = ingest_path(root, hour)
    if columns:
        writer = writer.partitionBy(*columns)
    writer.options(**(options or {})).parquet(path)


def write_silver(
    readings: DataFrame,
    root: str,
    hour: datetime | None,
    partitions: Sequence[str] = tuple(SILVER_PARTITIONS),
) -> None:
    """Write clean readings of one ingest hour, or of all hours.

    ``rebalance`` brings the rows of a directory together so that it gets few
    files, and adaptive execution splits a directory that outgrows the target
    size over several tasks and merges small ones. With very many wells pass
    ``partitions=()``: rows are then clustered inside larger files, and
    Parquet statistics and a bloom filter per well take the place of
    directories. A table has one of the two layouts.
    """
    hours = _hour_columns(hour)
    rows = readings.select(*S.SILVER_COLUMNS, *hours)
    rows = rows.hint("rebalance", *hours, *SILVER_PARTITIONS)
    if not partitions:
        rows = rows.sortWithinPartitions(*hours, *SILVER_PARTITIONS, "timestamp")
    _write(rows, root, hour, partitions, {} if partitions else _CLUSTERED)


def write_rejects(rejected: DataFrame, root: str, hour: datetime | None) -> None:
    """Write the rows cleaning left out, for inspection and replay."""
    if hour is None:
        rejected = rejected.hint("rebalance", *S.INGEST_COLUMNS)
    else:
        rejected = rejected.drop(*S.INGEST_COLUMNS)
    _write(rejected, root, hour)


def write_gold(table: str, rows: DataFrame, root: str, hour: datetime | None) -> None:
    """Write one KPI table to ``root/table/year=/...``."""
    hours = _hour_columns(hour)
    rows = rows.select(*S.GOLD_SCHEMAS[table].fieldNames(), *hours)
    if hours:
        rows = rows.hint("rebalance", *hours)
    _write(rows, f"{root.rstrip('/')}/{table}", hour)
