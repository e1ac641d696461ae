"""Sensor readings derived from an ``events`` table.

``events`` has event_id, ts, user_id, event_type and value. The mapping is
row by row: every event becomes a reading, on a batch or a streaming table.
The second form, ``raw_messages``, also damages fields of some rows, so that
the cleaning operators have something to do. No event is left out of either.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakegauge import schema as S
from lakegauge.functions.labels import lookup, valid_range
from lakegauge.sinks.bronze import write_bronze, write_lines
from lakegauge.sources.messages import encode_messages
from lakegauge.workspace import new_folder

# Which event type stands for which sensor.
SENSOR_OF_EVENT = {
    "click": "pressure",
    "error": "temperature",
    "purchase": "flow_rate",
    "signup": "vibration",
    "view": "rpm",
}
# One well has a much lower anomaly limit, so that it is not healthy.
ODD_WELL, ODD_LIMIT, LIMIT = 3, 20.0, 150.0

EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
)

_landed: dict[tuple[str, str, str], str] = {}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, path: str, **options) -> DataFrame:
    """Event files as a stream."""
    return spark.readStream.schema(EVENTS_SCHEMA).options(**options).parquet(path)


def to_readings(table: DataFrame) -> DataFrame:
    """Clean readings, one per event."""
    wells = dict(enumerate(S.WELLS, start=1))
    sensors = {event: f"'{sensor}'" for event, sensor in SENSOR_OF_EVENT.items()}
    units = {e: f"'{S.SENSOR_RULES[s].unit}'" for e, s in SENSOR_OF_EVENT.items()}
    numbered = table.selectExpr("*", f"user_id % {len(wells)} + 1 AS number")
    return numbered.selectExpr(
        "event_id",
        "concat('WELL-', lpad(CAST(number AS STRING), 3, '0')) AS well_id",
        f"{lookup('number', {n: repr(w[1]) for n, w in wells.items()})} AS location",
        f"{lookup('number', {n: f'{w[2]}D' for n, w in wells.items()})} AS depth_m",
        "CAST(ts AS TIMESTAMP) AS timestamp",
        f"{lookup('event_type', sensors)} AS sensor_type",
        "value",
        f"{lookup('event_type', units)} AS unit",
        f"value > if(number = {ODD_WELL}, {ODD_LIMIT}D, {LIMIT}D) AS is_anomaly",
    ).selectExpr("*", f"{valid_range()} AS value_valid")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_readings(events(spark, sf_dir))


# Timestamps as producers write them.
_ISO = """date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")"""
_ISO_SECONDS = """date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss")"""


def to_raw(table: DataFrame, *others: str) -> DataFrame:
    """Undamaged raw rows (text timestamps) of a readings table."""
    texts = [f"{_ISO} AS timestamp" if n == "timestamp" else n for n in S.RAW_COLUMNS]
    return table.selectExpr(*texts, *others)


def raw_messages(spark: SparkSession, sf_dir: str, *others: str) -> DataFrame:
    """Raw rows as an at-least-once source delivers them.

    All events once, one in ten a second time, and with missing, blank,
    padded or unreadable fields in some rows. ``others`` are further columns
    of the readings.
    """
    delivered = readings(spark, sf_dir).selectExpr(
        "*", "explode(sequence(1, if(event_id % 10 = 3, 2, 1))) AS delivery"
    )
    return delivered.selectExpr(
        """CASE WHEN event_id % 97 = 0 THEN NULL
                WHEN event_id % 89 = 0 THEN '  '
                WHEN event_id % 13 = 1 THEN concat(' ', well_id, ' ')
                ELSE well_id END AS well_id""",
        "if(event_id % 53 = 0, NULL, location) AS location",
        "depth_m",
        f"""CASE WHEN event_id % 101 = 0 THEN 'not-a-time'
                 WHEN event_id % 103 = 0 THEN {_ISO_SECONDS}
                 ELSE {_ISO} END AS timestamp""",
        """if(event_id % 13 = 1, concat(' ', upper(sensor_type)), sensor_type)
             AS sensor_type""",
        "if(event_id % 107 = 0, NULL, value) AS value",
        "unit",
        "if(event_id % 59 = 0, NULL, is_anomaly) AS is_anomaly",
        *others,
    )


def damaged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`raw_messages` as JSON lines of three ingest hours, with more that
    goes wrong: lines cut off, values that are no number, sensors nobody
    knows, wells that report from a second place, and text in the place of
    numbers and flags."""
    rows = raw_messages(spark, sf_dir, "event_id").selectExpr(
        "event_id",
        "well_id",
        "if(event_id % 73 = 0, 'Dock 9', location) AS location",
        "depth_m",
        "timestamp",
        "if(event_id % 71 = 0, 'humidity', sensor_type) AS sensor_type",
        "if(event_id % 67 = 0, double('NaN'), value) AS value",
        "unit",
        "is_anomaly",
    )
    written = rows.selectExpr(
        "event_id",
        f"""to_json(struct({", ".join(S.RAW_COLUMNS)}),
            map('ignoreNullFields', 'false')) AS line""",
    )
    deep = """regexp_replace(line, '"depth_m":[0-9.]+', '"depth_m":"deep"')"""
    odd = """regexp_replace(line, '"is_anomaly":[a-z]+', '"is_anomaly":"maybe"')"""
    return written.selectExpr(
        f"""CASE WHEN event_id % 61 = 0 THEN left(line, 20)
                 WHEN event_id % 79 = 0 THEN {deep}
                 WHEN event_id % 83 = 0 THEN {odd}
                 ELSE line END AS value""",
        "TIMESTAMP '2024-02-01 00:00:00' "
        "+ make_interval(0, 0, 0, 0, CAST(event_id % 3 AS INT)) AS arrival",
    )


def _in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undamaged raw rows with their arrival, in arrival order over the
    session's number of shuffle partitions."""
    arriving = to_raw(readings(spark, sf_dir), "timestamp AS arrival")
    return arriving.repartitionByRange(parts(spark), "arrival")


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def landed_once(
    spark: SparkSession, sf_dir: str, label: str, write: Callable[[str], None]
) -> str:
    """Folder of an input that is written on first use in a session."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _landed:
        folder = new_folder(spark, label)
        write(folder)
        _landed[key] = folder
    return _landed[key]


def landed_raw(spark: SparkSession, sf_dir: str) -> str:
    """:func:`raw_messages` as JSON lines."""
    rows = raw_messages(spark, sf_dir)
    return landed_once(spark, sf_dir, "raw", rows.write.json)


def landed_raw_files(spark: SparkSession, sf_dir: str) -> str:
    """:func:`raw_messages` as several files that each span the whole time."""
    rows = raw_messages(spark, sf_dir).repartition(parts(spark))
    return landed_once(spark, sf_dir, "raw-files", rows.write.json)


def landed_events(spark: SparkSession, sf_dir: str) -> str:
    """The events as several files that each span the whole time."""
    rows = events(spark, sf_dir).repartition(parts(spark))
    return landed_once(spark, sf_dir, "events", rows.write.parquet)


def landed_bronze(spark: SparkSession, sf_dir: str) -> str:
    """Undamaged raw rows as JSON lines below ingest-hour directories."""
    rows = _in_order(spark, sf_dir)
    return landed_once(
        spark, sf_dir, "bronze", lambda root: write_bronze(rows, root, "arrival")
    )


def landed_damaged(spark: SparkSession, sf_dir: str) -> str:
    """:func:`damaged_lines` below ingest-hour directories."""
    lines = damaged_lines(spark, sf_dir)
    return landed_once(
        spark, sf_dir, "damaged", lambda root: write_lines(lines, root, "arrival")
    )


def landed_messages(spark: SparkSession, sf_dir: str) -> str:
    """Undamaged raw rows as encoded messages in several files."""
    messages = encode_messages(_in_order(spark, sf_dir))
    return landed_once(spark, sf_dir, "messages", messages.write.parquet)
