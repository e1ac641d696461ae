"""The registered queries, one per operator, on an ``events`` table.

Each takes (spark, sf_dir) and reads the whole table. Timestamps leave as
``timestamp_ntz`` named ``ts``, as the input table has them.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegauge import fixtures as X
from lakegauge import schema as S
from lakegauge.functions import timeparts
from lakegauge.operators import cleaning, dedup, kpis, serving, windows
from lakegauge.plans.hourly import Roots, clean_to_kpis, run_pending
from lakegauge.plans.rebuild import rebuild
from lakegauge.session import use_utc
from lakegauge.sinks.hours import write_gold, write_silver
from lakegauge.sinks.serving import (
    read_sensor_alerts,
    read_well_health,
    upsert_well_health,
    write_alert_windows,
)
from lakegauge.sources import bronze as B
from lakegauge.sources.messages import decode_messages, encode_messages
from lakegauge.sources.tables import read_gold, read_history, read_silver
from lakegauge.streaming import landing, merging
from lakegauge.workspace import new_folder

REJECTED_SCHEMA = T.StructType(
    [
        *S.RAW_FIELDS,
        T.StructField(S.CORRUPT, T.StringType()),
        T.StructField(cleaning.REASON, T.StringType()),
        *S.INGEST_FIELDS,
    ]
)

Query = Callable[[SparkSession, str], DataFrame]

# The run that writes the whole fixture as one ingest hour.
RUN_HOUR = datetime(2024, 2, 1, tzinfo=timezone.utc)
# The ingest hour that the pruning query asks for.
PRUNED_HOUR = datetime(2024, 1, 15, 12, tzinfo=timezone.utc)
_DAY = "CAST(date_trunc('DAY', timestamp) AS TIMESTAMP) AS window_start"

_queries: dict[str, Query] = {}


def _query(function: Query) -> Query:
    """Register under the function's name; sessions run in UTC."""
    name = function.__name__.removesuffix("_query")

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        use_utc(spark)
        return _plain(function(spark, sf_dir))

    _queries[name] = run
    return function


def _plain(result: DataFrame) -> DataFrame:
    """Result columns in types that every engine hands out alike.

    UTC instants become naive timestamps (and ``timestamp`` is renamed to
    ``ts``), decimals become doubles.
    """
    columns = []
    for name, kind in result.dtypes:
        if kind == "timestamp":
            renamed = "ts" if name == "timestamp" else name
            columns.append(f"CAST(`{name}` AS TIMESTAMP_NTZ) AS `{renamed}`")
        elif kind.startswith("decimal"):
            columns.append(f"CAST(`{name}` AS DOUBLE) AS `{name}`")
        else:
            columns.append(f"`{name}`")
    return result.selectExpr(*columns)


def queries() -> dict[str, Query]:
    return dict(_queries)


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.read_bronze(spark, X.landed_raw(spark, sf_dir))


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(_raw(spark, sf_dir), RUN_HOUR).select(
        *S.RAW_COLUMNS, "value_valid"
    )


def _health(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = kpis.health_scores(kpis.sensor_statistics(X.readings(spark, sf_dir)))
    return serving.serving_health(scores, RUN_HOUR)


def _stored(
    spark: SparkSession, sf_dir: str, table: str, write: Callable[[Roots], None]
) -> Roots:
    """Roots with one KPI or serving table of the readings, written on first use."""
    folder = X.landed_once(
        spark, sf_dir, f"stored-{table}", lambda base: write(Roots.below(base))
    )
    return Roots.below(folder)


def _stored_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The health scores of all hours, as hourly runs keep them."""

    def write(roots: Roots) -> None:
        hourly = X.readings(spark, sf_dir).selectExpr(
            "*", *timeparts.ingest_columns("timestamp")
        )
        statistics = kpis.statistics_of(
            kpis.sensor_facts(hourly, S.INGEST_COLUMNS), S.INGEST_COLUMNS
        )
        scores = kpis.health_scores(statistics, S.INGEST_COLUMNS)
        write_gold("well_health_scores", scores, roots.gold, None)

    gold = _stored(spark, sf_dir, "scores", write).gold
    return read_history(spark, gold, "well_health_scores")


def _stored_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(roots: Roots) -> None:
        upsert_well_health(spark, roots.well_health, _health(spark, sf_dir))

    return read_well_health(spark, _stored(spark, sf_dir, "health", write).well_health)


def _stored_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(roots: Roots) -> None:
        write_alert_windows(_hourly_alerts(spark, sf_dir), roots.sensor_alerts)

    return read_sensor_alerts(spark, _stored(spark, sf_dir, "alerts", write).sensor_alerts)


def _hourly_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alerts table as hourly runs would have filled it."""
    hourly = X.readings(spark, sf_dir).selectExpr(
        "*", f"{timeparts.hour_bucket('timestamp')} AS window_start"
    )
    alerts = kpis.alert_counts(hourly, ["window_start"])
    return serving.serving_alerts(alerts, F.col("window_start"))


# Sources and sinks


@_query
def bronze_scan(spark, sf_dir):
    return _raw(spark, sf_dir).select(*S.RAW_COLUMNS)


@_query
def bronze_hour_prune(spark, sf_dir):
    return (
        B.read_bronze(spark, X.landed_bronze(spark, sf_dir))
        .where(timeparts.in_ingest_scope(PRUNED_HOUR))
        .select(*S.RAW_COLUMNS, *S.INGEST_COLUMNS)
    )


@_query
def rejects(spark, sf_dir):
    return cleaning.rejects(_raw(spark, sf_dir)).select(
        *S.RAW_COLUMNS, cleaning.REASON
    )


def _written_silver(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    readings = cleaning.add_audit(X.readings(spark, sf_dir), RUN_HOUR)
    write_silver(readings, root, RUN_HOUR)
    return read_silver(spark, root, RUN_HOUR)


@_query
def silver_scan(spark, sf_dir):
    silver = _written_silver(spark, sf_dir, new_folder(spark, "silver"))
    return silver.groupBy(*S.INGEST_COLUMNS, "well_id", "sensor_type").agg(
        F.expr("count(*) AS reading_count"), F.expr("max(value) AS max_value")
    )


@_query
def silver_roundtrip(spark, sf_dir):
    return _written_silver(spark, sf_dir, new_folder(spark, "silver"))


@_query
def gold_snapshot(spark, sf_dir):
    roots = Roots.below(new_folder(spark, "layers"))
    _written_silver(spark, sf_dir, roots.silver)
    clean_to_kpis(spark, roots, RUN_HOUR)
    statistics, scores, alerts = (
        read_gold(spark, roots.gold, table, RUN_HOUR)
        for table in ("sensor_statistics", "well_health_scores", "alert_summary")
    )

    return (
        statistics.selectExpr(
            "'sensor_statistics' AS table_name",
            "well_id",
            "sensor_type AS item",
            "reading_count AS row_count",
            "stddev_value AS figure",
        )
        .union(
            scores.selectExpr(
                "'well_health_scores'",
                "well_id",
                "status",
                "total_readings",
                "health_score",
            )
        )
        .union(
            alerts.selectExpr(
                "'alert_summary'",
                "well_id",
                "concat_ws('/', sensor_type, severity)",
                "alert_count",
                "NULL",
            )
        )
    )


@_query
def encode_messages_query(spark, sf_dir):
    messages = encode_messages(X.to_raw(X.readings(spark, sf_dir)))
    kinds = {f.name: f.dataType.simpleString() for f in S.RAW_FIELDS[1:]}
    keys = ", ".join(f"'{name}'" for name in kinds)
    return messages.selectExpr(
        "CAST(key AS STRING) AS message_key",
        f"json_tuple(CAST(value AS STRING), {keys}) AS ({', '.join(kinds)})",
    ).selectExpr(
        "message_key", *[f"CAST({name} AS {kind})" for name, kind in kinds.items()]
    )


@_query
def decode_messages_query(spark, sf_dir):
    raw = X.to_raw(X.readings(spark, sf_dir))
    return decode_messages(encode_messages(raw)).select(*S.RAW_COLUMNS)


@_query
def ingest_partitions(spark, sf_dir):
    return X.readings(spark, sf_dir).selectExpr(
        "event_id", *timeparts.ingest_columns("timestamp")
    )


def _landed(
    spark: SparkSession, sf_dir: str, files_per_batch: int | None = None
) -> DataFrame:
    """Raw table that a stream landed from the encoded messages."""
    root = new_folder(spark, "landing")
    reader = spark.readStream.schema(S.MESSAGE_SCHEMA)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.parquet(X.landed_messages(spark, sf_dir))
    progress = new_folder(spark, "progress")
    _drain(landing.land_messages(stream, root, progress, available_now=True))
    return B.read_bronze(spark, root).select(*S.RAW_COLUMNS, *S.INGEST_COLUMNS)


@_query
def bronze_sink_roundtrip(spark, sf_dir):
    """Several micro-batches, cut by a number of files, into one raw table."""
    return _landed(spark, sf_dir, files_per_batch=_files_per_batch(spark))


def _drain(query) -> None:
    """Wait for a stream that stops by itself; raises if it failed."""
    query.awaitTermination()


@_query
def well_health_upsert(spark, sf_dir):
    """The health of all days, computed in one pass, in three batches: even
    days, then the odd days (out of order), then the even days again."""
    daily = X.readings(spark, sf_dir).selectExpr("*", _DAY)
    facts = kpis.sensor_facts(daily, ["window_start"])
    scores = kpis.health_scores(facts, ["window_start"])
    root = new_folder(spark, "well_health")
    for parity in (0, 1, 0):
        days = scores.where(f"day(window_start) % 2 = {parity}")
        batch = serving.serving_health(days, F.col("window_start"))
        upsert_well_health(spark, root, batch)
    return read_well_health(spark, root)


@_query
def alerts_append(spark, sf_dir):
    """The windows of all days in one pass; a retried run writes the odd days
    a second time."""
    daily = X.readings(spark, sf_dir).selectExpr("*", _DAY)
    alerts = kpis.alert_counts(daily, ["window_start"])
    typed = serving.serving_alerts(alerts, F.col("window_start"))
    root = new_folder(spark, "sensor_alerts")
    write_alert_windows(typed, root)
    write_alert_windows(typed.where("day(window_start) % 2 = 1"), root)
    return read_sensor_alerts(spark, root).drop("window")


@_query
def serving_cast(spark, sf_dir):
    typed = ["health_score", "avg_anomaly_rate", "total_readings", "total_anomalies"]
    kinds = ", ".join(f"typeof({name})" for name in typed)
    return _health(spark, sf_dir).selectExpr("*", f"concat_ws(', ', {kinds}) AS types")


# Projections, filters, labels


@_query
def clean_required(spark, sf_dir):
    parsed = cleaning.parse_timestamps(cleaning.normalise_strings(_raw(spark, sf_dir)))
    return cleaning.drop_incomplete(parsed).select(*S.RAW_COLUMNS)


@_query
def parse_ts(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return raw.selectExpr(
        "timestamp AS text",
        "sensor_type",
        "value",
        f"{timeparts.parse_instant('timestamp')} AS timestamp",
    )


@_query
def normalise_strings(spark, sf_dir):
    return cleaning.normalise_strings(_raw(spark, sf_dir)).select(*S.RAW_COLUMNS)


@_query
def validate_ranges(spark, sf_dir):
    bare = X.readings(spark, sf_dir).drop("value_valid")
    return cleaning.flag_valid(bare).select(
        "event_id", "sensor_type", "value", "value_valid"
    )


@_query
def audit_columns(spark, sf_dir):
    return cleaning.add_audit(X.readings(spark, sf_dir), RUN_HOUR).select(
        "event_id", "processed_at", "silver_version"
    )


@_query
def anomaly_rows(spark, sf_dir):
    return kpis.anomaly_rows(X.readings(spark, sf_dir))


@_query
def invalid_rows(spark, sf_dir):
    return kpis.invalid_rows(X.readings(spark, sf_dir))


@_query
def alert_severity(spark, sf_dir):
    return kpis.with_severity(X.readings(spark, sf_dir)).select(
        "event_id", "well_id", "sensor_type", "value", "severity"
    )


@_query
def health_status(spark, sf_dir):
    scores = kpis.health_scores(kpis.sensor_statistics(X.readings(spark, sf_dir)))
    return scores.select("well_id", "location", "health_score", "status")


@_query
def health_view(spark, sf_dir):
    scores = kpis.health_scores(kpis.sensor_statistics(X.readings(spark, sf_dir)))
    return serving.health_view(scores)


@_query
def dash_well_status(spark, sf_dir):
    """From the serving table: the well reaches the file as a filter."""
    return serving.well_status(_stored_health(spark, sf_dir), "WELL-003")


@_query
def classify_band(spark, sf_dir):
    return kpis.classify_band(X.readings(spark, sf_dir)).select(
        "event_id", "sensor_type", "value", "band"
    )


# Deduplication


@_query
def dedup_key(spark, sf_dir):
    return dedup.dedup_readings(_clean(spark, sf_dir))


@_query
def dedup_row(spark, sf_dir):
    return dedup.dedup_rows(_raw(spark, sf_dir).select(*S.RAW_COLUMNS))


@_query
def drop_counts(spark, sf_dir):
    return dedup.drop_counts(_raw(spark, sf_dir))


# Aggregates and scores


@_query
def sensor_stats(spark, sf_dir):
    return kpis.sensor_statistics(X.readings(spark, sf_dir))


@_query
def well_rollup(spark, sf_dir):
    return kpis.well_rollup(kpis.sensor_statistics(X.readings(spark, sf_dir)))


@_query
def alert_summary(spark, sf_dir):
    return kpis.alert_summary(X.readings(spark, sf_dir))


@_query
def anomalies_by_sensor(spark, sf_dir):
    return kpis.anomalies_by_sensor(X.readings(spark, sf_dir))


@_query
def quality_summary(spark, sf_dir):
    return kpis.quality_summary(_clean(spark, sf_dir))


@_query
def serving_counts(spark, sf_dir):
    """Rows of the serving tables; no column of them is read."""
    return serving.serving_counts(
        _stored_health(spark, sf_dir), _stored_alerts(spark, sf_dir)
    )


@_query
def dash_active_alerts(spark, sf_dir):
    return serving.active_alerts(_stored_alerts(spark, sf_dir))


@_query
def health_scores(spark, sf_dir):
    return kpis.health_scores(kpis.sensor_statistics(X.readings(spark, sf_dir)))


@_query
def health_scores_full(spark, sf_dir):
    return kpis.health_scores_full(kpis.sensor_facts(X.readings(spark, sf_dir)))


# Time windows


@_query
def hour_bucket(spark, sf_dir):
    return windows.readings_per_hour(X.readings(spark, sf_dir))


@_query
def tumbling_stats(spark, sf_dir):
    return windows.tumbling_statistics(X.readings(spark, sf_dir))


@_query
def rolling_avg(spark, sf_dir):
    return windows.rolling_average(X.readings(spark, sf_dir))


@_query
def dash_anomaly_series(spark, sf_dir):
    """From the KPI tables that hourly runs keep, not from readings."""
    return windows.anomaly_series(_stored_scores(spark, sf_dir))


# Whole runs


def _results(spark: SparkSession, roots: Roots) -> DataFrame:
    """What a run leaves behind in each table, by ingest hour."""
    hour = f"concat_ws('-', {', '.join(S.INGEST_COLUMNS)}) AS ingest_hour"
    stamped = "date_format({}, 'yyyy-MM-dd-HH') AS ingest_hour"
    statistics, scores, alerts = (
        read_gold(spark, roots.gold, table)
        for table in ("sensor_statistics", "well_health_scores", "alert_summary")
    )
    place = "coalesce(location, '?')"
    parts = [
        read_silver(spark, roots.silver)
        .groupBy(F.expr(hour), "well_id", F.expr("sensor_type AS item"))
        .agg(F.expr("count(*) AS row_count"), F.expr("max(value) AS figure"))
        .selectExpr("'silver' AS table_name", "*"),
        spark.read.schema(REJECTED_SCHEMA)
        .parquet(roots.rejects)
        .groupBy(F.expr(hour), F.expr(f"{cleaning.REASON} AS item"))
        .agg(
            F.expr("count(*) AS row_count"),
            F.expr(f"CAST(count({S.CORRUPT}) AS DOUBLE) AS figure"),
        )
        .selectExpr("'rejects'", "ingest_hour", "NULL", "item", "row_count", "figure"),
        statistics.selectExpr(
            "'sensor_statistics'", hour, "well_id",
            f"concat_ws('/', sensor_type, {place})", "reading_count", "avg_value",
        ),
        scores.selectExpr(
            "'well_health_scores'", hour, "well_id",
            f"concat_ws('/', status, {place})", "total_readings", "health_score",
        ),
        alerts.selectExpr(
            "'alert_summary'", hour, "well_id",
            "concat_ws('/', sensor_type, severity)", "alert_count", "NULL",
        ),
        read_well_health(spark, roots.well_health).selectExpr(
            "'well_health'", stamped.format("updated_at"), "well_id",
            f"concat_ws('/', status, {place})", "total_readings",
            "CAST(health_score AS DOUBLE)",
        ),
        read_sensor_alerts(spark, roots.sensor_alerts).selectExpr(
            "'sensor_alerts'", stamped.format("window_start"), "well_id",
            "concat_ws('/', sensor_type, severity)", "alert_count", "NULL",
        ),
    ]
    return functools.reduce(DataFrame.union, parts)


@_query
def hourly_run(spark, sf_dir):
    """All hours of the raw table, one by one, as a scheduler would."""
    roots = Roots.below(new_folder(spark, "hourly"))
    roots = replace(roots, bronze=X.landed_damaged(spark, sf_dir))
    run_pending(spark, roots, RUN_HOUR)
    return _results(spark, roots)


@_query
def rebuild_run(spark, sf_dir):
    """The same tables from a few jobs over all hours."""
    target = Roots.below(new_folder(spark, "rebuilt"), silver_partitions=())
    raw = X.landed_damaged(spark, sf_dir)
    return _results(spark, rebuild(spark, raw, target, processed_at=RUN_HOUR))


@_query
def field_errors(spark, sf_dir):
    """Fields whose text is no value of their type, and the lines they are in."""
    found = cleaning.field_errors(
        B.read_bronze(spark, X.landed_damaged(spark, sf_dir))
    )
    return found.selectExpr(
        "well_id", "timestamp AS sent", "sensor_type", "field", "text",
        "length(raw_text) > length(text) AS in_line",
    )


# Reports


@_query
def top_alerts(spark, sf_dir):
    return serving.top_alerts(kpis.alert_counts(X.readings(spark, sf_dir)))


@_query
def lowest_health(spark, sf_dir):
    return serving.lowest_health(_stored_health(spark, sf_dir))


@_query
def dash_health_all(spark, sf_dir):
    return serving.health_by_well(_stored_health(spark, sf_dir))


@_query
def hour_availability(spark, sf_dir):
    return B.hour_availability(spark, X.landed_bronze(spark, sf_dir))


# Streaming


@_query
def stream_landing(spark, sf_dir):
    return _landed(spark, sf_dir)


def _files_per_batch(spark: SparkSession) -> int:
    """So many that the several files of an input make a few micro-batches."""
    return max(1, X.parts(spark) // 3)


@_query
def stream_clean_dedup(spark, sf_dir):
    """Micro-batches that each have readings of the whole time."""
    raw = B.stream_bronze(
        spark,
        X.landed_raw_files(spark, sf_dir),
        files_per_trigger=_files_per_batch(spark),
    )
    root, progress = new_folder(spark, "live"), new_folder(spark, "progress")
    _drain(merging.merge_clean(raw, root, progress, available_now=True))
    return merging.read_clean(spark, root).select(*S.RAW_COLUMNS, "value_valid")


@_query
def stream_drop_counts(spark, sf_dir):
    """Exact counts of a stream, whatever its cuts and retries."""
    raw = B.stream_bronze(
        spark,
        X.landed_raw_files(spark, sf_dir),
        files_per_trigger=_files_per_batch(spark),
    )
    root, progress = new_folder(spark, "live"), new_folder(spark, "progress")
    _drain(merging.merge_clean(raw, root, progress, available_now=True, fan=2))
    return merging.stream_counts(spark, root)


@_query
def stream_hourly_stats(spark, sf_dir):
    events = X.stream_events(
        spark,
        X.landed_events(spark, sf_dir),
        maxFilesPerTrigger=_files_per_batch(spark),
    )
    root, progress = new_folder(spark, "live"), new_folder(spark, "progress")
    _drain(
        merging.merge_hourly_statistics(
            X.to_readings(events), root, progress, available_now=True
        )
    )
    return merging.read_hourly_statistics(spark, root)
