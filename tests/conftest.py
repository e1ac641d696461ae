from __future__ import annotations

import sys
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lakegauge import schema as S  # noqa: E402

HOUR = datetime(2026, 3, 26, 14, tzinfo=timezone.utc)
RUN = datetime(2026, 3, 26, 15, 5, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def raw_of(spark):
    """Raw rows from dicts; missing fields take usable defaults."""

    def build(*rows: dict):
        base = dict(
            well_id="WELL-001",
            location="North Sea Block A",
            depth_m=2400.0,
            timestamp="2026-03-26T14:00:00.000001",
            sensor_type="pressure",
            value=1000.0,
            unit="PSI",
            is_anomaly=False,
        )
        return spark.createDataFrame([{**base, **row} for row in rows], S.RAW_SCHEMA)

    return build


@pytest.fixture
def readings_of(spark):
    """Clean readings from (well, sensor, seconds after HOUR, value, flags)."""

    def build(*rows: dict):
        base = dict(
            well_id="WELL-001",
            location="North Sea Block A",
            depth_m=2400.0,
            timestamp=HOUR,
            sensor_type="pressure",
            value=1000.0,
            unit="PSI",
            is_anomaly=False,
            value_valid=True,
        )
        columns = [f for f in S.SILVER_FIELDS if f.name in base]
        return spark.createDataFrame(
            [{**base, **row} for row in rows], S.T.StructType(columns)
        )

    return build


def rows_of(df):
    """Rows as sorted tuples, whatever their order."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


def executed_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
