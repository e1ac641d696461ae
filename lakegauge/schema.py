"""Declared schemas and the fixed domain rules.

Every source is read with a schema from this module, so no job infers types
from files. Timestamps are instants; sessions run with
``spark.sql.session.timeZone=UTC`` because producers send naive UTC strings.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

# One raw message. Fields are declared nullable: a file cannot enforce more.
RAW_FIELDS = [
    T.StructField("well_id", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("depth_m", T.DoubleType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("sensor_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("unit", T.StringType()),
    T.StructField("is_anomaly", T.BooleanType()),
]
RAW_SCHEMA = T.StructType(RAW_FIELDS)
RAW_COLUMNS = RAW_SCHEMA.fieldNames()

# Filled by the JSON parser with the text of a line it could not parse.
CORRUPT = "_corrupt_record"

# Ingest-time partition columns. Strings, so that "03" stays "03".
INGEST_COLUMNS = ["year", "month", "day", "hour"]
INGEST_FIELDS = [T.StructField(name, T.StringType()) for name in INGEST_COLUMNS]

BRONZE_SCHEMA = T.StructType(
    RAW_FIELDS + [T.StructField(CORRUPT, T.StringType())] + INGEST_FIELDS
)

SILVER_FIELDS = [
    T.StructField("well_id", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("depth_m", T.DoubleType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("sensor_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("unit", T.StringType()),
    T.StructField("is_anomaly", T.BooleanType()),
    T.StructField("value_valid", T.BooleanType()),
    T.StructField("processed_at", T.TimestampType()),
    T.StructField("silver_version", T.StringType()),
]
SILVER_SCHEMA = T.StructType(SILVER_FIELDS + INGEST_FIELDS)
SILVER_COLUMNS = [field.name for field in SILVER_FIELDS]
SILVER_VERSION = "1.0"

# A message as a topic source delivers it: key and value bytes, arrival time.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("arrival", T.TimestampType()),
    ]
)

# A reading is identified by these columns; replays repeat them.
READING_KEY = ["well_id", "timestamp", "sensor_type"]
# Without these a reading is unusable and goes to the rejects.
REQUIRED = ["well_id", "timestamp", "sensor_type", "value"]


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, kind) for n, kind in columns.items()])


_STRING, _DOUBLE, _LONG = T.StringType(), T.DoubleType(), T.LongType()

GOLD_SCHEMAS = {
    "sensor_statistics": _table(
        well_id=_STRING,
        sensor_type=_STRING,
        location=_STRING,
        avg_value=_DOUBLE,
        min_value=_DOUBLE,
        max_value=_DOUBLE,
        stddev_value=_DOUBLE,
        reading_count=_LONG,
        anomaly_count=_LONG,
        anomaly_rate=_DOUBLE,
    ),
    "well_health_scores": _table(
        well_id=_STRING,
        location=_STRING,
        avg_anomaly_rate=_DOUBLE,
        overall_avg_value=_DOUBLE,
        total_readings=_LONG,
        total_anomalies=_LONG,
        health_score=_DOUBLE,
        status=_STRING,
    ),
    "alert_summary": _table(
        well_id=_STRING,
        sensor_type=_STRING,
        severity=_STRING,
        alert_count=_LONG,
    ),
}

# Serving tables. alert_count is BIGINT: one hot sensor can pass 2^31 alerts.
WELL_HEALTH_SCHEMA = _table(
    well_id=_STRING,
    location=_STRING,
    health_score=T.DecimalType(5, 1),
    status=_STRING,
    avg_anomaly_rate=T.DecimalType(6, 4),
    total_readings=_LONG,
    total_anomalies=_LONG,
    updated_at=T.TimestampType(),
)
SENSOR_ALERTS_SCHEMA = _table(
    well_id=_STRING,
    sensor_type=_STRING,
    severity=_STRING,
    alert_count=_LONG,
    window_start=T.TimestampType(),
)


class SensorRule(NamedTuple):
    """Unit and the three value ranges of one sensor type, bounds inclusive."""

    unit: str
    valid: tuple[float, float]
    normal: tuple[float, float]
    anomaly: tuple[float, float]


# Sensor rules.
SENSOR_RULES = {
    "pressure": SensorRule("PSI", (0.0, 2000.0), (800.0, 1200.0), (1400.0, 1800.0)),
    "temperature": SensorRule("celsius", (-10.0, 200.0), (60.0, 90.0), (110.0, 140.0)),
    "flow_rate": SensorRule("m3/hr", (-5.0, 500.0), (50.0, 150.0), (0.0, 20.0)),
    "vibration": SensorRule("mm/s", (0.0, 20.0), (0.5, 3.0), (5.0, 9.0)),
    "rpm": SensorRule("rpm", (0.0, 5000.0), (1200.0, 1800.0), (200.0, 700.0)),
}

# Well dimension (id, location, depth in metres).
WELLS = [
    ("WELL-001", "North Sea Block A", 2400.0),
    ("WELL-002", "North Sea Block B", 3100.0),
    ("WELL-003", "Gulf Platform C", 1800.0),
    ("WELL-004", "Gulf Platform D", 2900.0),
    ("WELL-005", "Offshore Rig E", 3500.0),
]

# Points a health score loses when the whole share is bad.
ANOMALY_POINTS = 40.0
INVALID_POINTS = 30.0
VIBRATION_POINTS = 20.0
RPM_POINTS = 10.0
# Wear limits of the four-term score.
VIBRATION_LIMIT = 5.0
RPM_LIMIT = 800.0
# Lowest score of each status, best first; below all: CRITICAL.
STATUS_FLOORS = [("HEALTHY", 80.0), ("WARNING", 60.0)]
