from __future__ import annotations

import json
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakegauge import fixtures as X
from lakegauge import schema as S
from lakegauge import storage, workspace
from lakegauge.functions.timeparts import in_ingest_scope
from lakegauge.operators import cleaning, kpis, serving
from lakegauge.sinks import hours
from lakegauge.sinks.bronze import write_bronze
from lakegauge.sinks.serving import (
    read_sensor_alerts,
    read_well_health,
    upsert_well_health,
    write_alert_windows,
    write_sensor_alerts,
)
from lakegauge.sources import bronze
from lakegauge.sources.messages import decode_messages, encode_messages
from lakegauge.sources.tables import read_gold, read_silver
from lakegauge.sources.topics import topic_options
from tests.conftest import HOUR, RUN, executed_plan, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture
def silver_of(readings_of):
    def build(*rows):
        return cleaning.add_audit(readings_of(*rows), RUN)

    return build


# Silver


def test_silver_roundtrip(spark, tmp_path, silver_of):
    root = str(tmp_path / "silver")
    readings = silver_of(
        dict(well_id="001"), dict(well_id="a/b=c d", location=None), dict(value=-0.5)
    )
    hours.write_silver(readings, root, HOUR)
    back = read_silver(spark, root, HOUR)
    assert back.schema.names == S.SILVER_SCHEMA.names
    assert rows_of(back.select(*S.SILVER_COLUMNS)) == rows_of(
        readings.select(*S.SILVER_COLUMNS)
    )
    row = back.where(F.col("well_id") == "001").first()
    assert (row.year, row.month, row.day, row.hour) == ("2026", "03", "26", "14")


def test_silver_rerun_replaces_the_hour(spark, tmp_path, silver_of):
    root = str(tmp_path / "silver")
    other = HOUR + timedelta(hours=1)
    hours.write_silver(silver_of({}), root, other)
    hours.write_silver(silver_of(dict(well_id="gone"), dict(well_id="a")), root, HOUR)
    hours.write_silver(silver_of(dict(well_id="a"), dict(well_id="b")), root, HOUR)
    assert rows_of(read_silver(spark, root, HOUR).select("well_id")) == [
        ("a",),
        ("b",),
    ]
    assert read_silver(spark, root, HOUR, "day").count() == 3
    assert read_silver(spark, root).count() == 3


def test_silver_ignores_the_session_overwrite_mode(spark, tmp_path, silver_of):
    root = str(tmp_path / "silver")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        hours.write_silver(silver_of(dict(well_id="gone")), root, HOUR)
        hours.write_silver(silver_of(dict(well_id="a")), root, HOUR)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert rows_of(read_silver(spark, root, HOUR).select("well_id")) == [("a",)]


def test_silver_without_well_directories(spark, tmp_path, silver_of):
    root = str(tmp_path / "silver")
    readings = silver_of(dict(well_id="b"), dict(well_id="a"))
    hours.write_silver(readings, root, HOUR, partitions=())
    assert rows_of(read_silver(spark, root, HOUR).select("well_id")) == [
        ("a",),
        ("b",),
    ]


def test_silver_missing_hour_is_empty(spark, tmp_path):
    missing = read_silver(spark, str(tmp_path / "silver"), HOUR)
    assert missing.isEmpty()
    assert missing.schema == S.SILVER_SCHEMA


def test_silver_scan_prunes_directories_and_columns(spark, tmp_path, silver_of):
    root = str(tmp_path / "silver")
    hours.write_silver(silver_of({}, dict(well_id="b")), root, HOUR)
    picked = (
        read_silver(spark, root)
        .where(in_ingest_scope(HOUR))
        .where("well_id = 'b'")
        .where(F.col("value") > 5)
        .select("value")
    )
    plan = executed_plan(picked)
    partition_filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    for name in (*S.INGEST_COLUMNS, "well_id"):
        assert name in partition_filters
    assert "GreaterThan(value,5.0)" in plan
    assert "ReadSchema: struct<value:double>" in plan


def test_silver_splits_a_hot_directory(spark, tmp_path):
    """One sensor holds all rows; adaptive execution writes it in parts."""
    root, source = str(tmp_path / "silver"), str(tmp_path / "source")
    cleaning.add_audit(
        X.readings(spark, "/root/testdata/sf0.1")
        .withColumn("well_id", F.lit("hot"))
        .withColumn("sensor_type", F.lit("rpm")),
        RUN,
    ).repartition(8).write.parquet(source)
    readings = spark.read.parquet(source)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512KB")
    try:
        hours.write_silver(readings, root, HOUR)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = list(Path(root).rglob("*.parquet"))
    assert len(files) > 1
    assert read_silver(spark, root, HOUR).count() == readings.count()


# Gold


def test_gold_roundtrip_and_history(spark, tmp_path, readings_of):
    root = str(tmp_path / "gold")
    for hour in (HOUR, HOUR + timedelta(hours=1), HOUR):
        statistics = kpis.sensor_statistics(readings_of({}, dict(well_id="b")))
        hours.write_gold("sensor_statistics", statistics, root, hour)
    assert read_gold(spark, root, "sensor_statistics", HOUR).count() == 2
    assert read_gold(spark, root, "sensor_statistics").count() == 4
    assert read_gold(spark, root, "alert_summary", HOUR).isEmpty()


# Bronze


def test_bronze_hour(spark, tmp_path):
    root = tmp_path / "bronze"
    folder = root / "year=2026" / "month=03" / "day=26" / "hour=14"
    folder.mkdir(parents=True)
    (folder / "batch.json").write_text(json.dumps({"well_id": "W", "value": 1.5}) + "\n")
    assert bronze.hour_available(spark, str(root), HOUR)
    assert not bronze.hour_available(spark, str(root), HOUR + timedelta(hours=1))
    row = bronze.read_bronze_hour(spark, str(root), HOUR).first()
    assert (row.well_id, row.value, row.month, row.hour) == ("W", 1.5, "03", "14")
    later = bronze.read_bronze_hour(spark, str(root), HOUR + timedelta(hours=1))
    assert later.isEmpty() and later.schema == S.BRONZE_SCHEMA
    assert rows_of(bronze.hour_availability(spark, str(root))) == [
        ("2026", "03", "26", "14", 1)
    ]


def test_hidden_files_are_no_data(spark, tmp_path):
    folder = tmp_path / "year=2026" / "month=03" / "day=26" / "hour=14"
    folder.mkdir(parents=True)
    (folder / "_SUCCESS").write_text("")
    (folder / "_temporary" / "0").mkdir(parents=True)
    (folder / "_temporary" / "0" / "part-0.json").write_text("{}")
    assert not bronze.hour_available(spark, str(tmp_path), HOUR)


# Messages


def test_message_roundtrip(spark, raw_of):
    raw = raw_of({}, dict(location=None, is_anomaly=None), dict(location='say "ö"\n'))
    messages = encode_messages(raw)
    assert messages.dtypes == [("key", "binary"), ("value", "binary")]
    body = json.loads(messages.where("value like '%null%'").first().value)
    assert list(body) == S.RAW_COLUMNS and body["location"] is None
    assert rows_of(decode_messages(messages).select(*S.RAW_COLUMNS)) == rows_of(raw)


def test_bad_messages_do_not_fail(spark):
    messages = spark.createDataFrame(
        [(b"k", b"not json"), (b"k", b"\xff\xfe{"), (b"k", None)],
        "key binary, value binary",
    )
    reasons = cleaning.rejects(decode_messages(messages)).select(cleaning.REASON)
    assert rows_of(reasons) == [("malformed",), ("malformed",), ("null_key",)]


def test_topic_options():
    options = topic_options("host:1", "readings", max_messages=5000)
    assert options["minOffsetsPerTrigger"] == "100"
    assert options["maxTriggerDelay"] == "30s"
    assert options["startingOffsets"] == "earliest"
    assert options["maxOffsetsPerTrigger"] == "5000"
    assert "maxOffsetsPerTrigger" not in topic_options("host:1", "readings")


# Serving


def scores_of(spark, *rows):
    return spark.createDataFrame(list(rows), S.GOLD_SCHEMAS["well_health_scores"])


def score(well, location="x", total=10, value=90.0, status="HEALTHY"):
    return (well, location, 0.25, 1.0, total, 1, value, status)


def test_serving_types(spark):
    health = serving.serving_health(scores_of(spark, score("a")), RUN)
    assert [(f.name, f.dataType) for f in health.schema] == [
        (f.name, f.dataType) for f in S.WELL_HEALTH_SCHEMA
    ]
    alerts = spark.createDataFrame([("a", "rpm", "WARNING", 2**40)], S.GOLD_SCHEMAS["alert_summary"])
    typed = serving.serving_alerts(alerts, HOUR)
    assert typed.dtypes[3:] == [("alert_count", "bigint"), ("window_start", "timestamp")]
    assert typed.first().alert_count == 2**40


def test_one_serving_row_per_well(spark):
    scores = scores_of(
        spark, score("a", "x", 5), score("a", "y", 7), score("a", None, 7), score("b")
    )
    rows = serving.serving_health(scores, RUN).select("well_id", "location")
    assert rows_of(rows) == [("a", "y"), ("b", "x")]


def test_upsert(spark, tmp_path):
    root = str(tmp_path / "well_health")
    later = HOUR + timedelta(hours=1)

    def write(hour, *rows):
        batch = serving.serving_health(scores_of(spark, *rows), hour)
        upsert_well_health(spark, root, batch)

    def state():
        return rows_of(
            read_well_health(spark, root).select("well_id", "location", "status")
        )

    assert read_well_health(spark, root).isEmpty()
    write(HOUR, score("a"), score("b"))
    write(later, score("b", "moved", status="WARNING"), score("c"))
    expected = [("a", "x", "HEALTHY"), ("b", "moved", "WARNING"), ("c", "x", "HEALTHY")]
    assert state() == expected
    write(later, score("b", "moved", status="WARNING"), score("c"))
    write(HOUR, score("b", status="CRITICAL"))
    assert state() == expected


def test_unfinished_versions_are_not_seen(spark, tmp_path):
    root = str(tmp_path / "well_health")
    for well in ("a", "b", "c", "d", "e"):
        batch = serving.serving_health(scores_of(spark, score(well)), RUN)
        upsert_well_health(spark, root, batch, keep=2)
    names = sorted(storage.children(spark, root))
    assert names == ["version=0000000003", "version=0000000004"]
    (Path(root) / "version=0000000004" / "_SUCCESS").unlink()
    assert read_well_health(spark, root).count() == 4
    upsert_well_health(
        spark, root, serving.serving_health(scores_of(spark, score("f")), RUN)
    )
    assert read_well_health(spark, root).count() == 5
    names = sorted(storage.children(spark, root))
    assert names == ["version=0000000003", "version=0000000005"]


def test_alerts_are_replaced_per_window(spark, tmp_path):
    root = str(tmp_path / "sensor_alerts")
    later = HOUR + timedelta(hours=1)

    def write(hour, *rows):
        alerts = spark.createDataFrame(list(rows), S.GOLD_SCHEMAS["alert_summary"])
        write_sensor_alerts(serving.serving_alerts(alerts, hour), root, hour)

    assert read_sensor_alerts(spark, root).isEmpty()
    write(HOUR, ("a", "rpm", "WARNING", 3), ("b", "rpm", "WARNING", 1))
    write(later, ("a", "rpm", "WARNING", 2))
    write(HOUR, ("a", "rpm", "WARNING", 4))
    total = serving.active_alerts(read_sensor_alerts(spark, root))
    assert [tuple(r) for r in total.collect()] == [("a", "rpm", "WARNING", 6)]
    recent = serving.active_alerts(read_sensor_alerts(spark, root), since=later)
    assert [tuple(r) for r in recent.collect()] == [("a", "rpm", "WARNING", 2)]
    write(HOUR)
    assert read_sensor_alerts(spark, root).count() == 1


def test_alert_backfill_equals_single_windows(spark, tmp_path):
    rows = [("a", "rpm", "WARNING", n) for n in (1, 2)]
    single, bulk = str(tmp_path / "single"), str(tmp_path / "bulk")
    parts = []
    for hour, row in zip((HOUR, HOUR + timedelta(hours=1)), rows):
        alerts = spark.createDataFrame([row], S.GOLD_SCHEMAS["alert_summary"])
        parts.append(serving.serving_alerts(alerts, hour))
        write_sensor_alerts(parts[-1], single, hour)
    for _ in range(2):
        write_alert_windows(parts[0].union(parts[1]), bulk)
    assert rows_of(read_sensor_alerts(spark, bulk)) == rows_of(
        read_sensor_alerts(spark, single)
    )


def test_reports(spark):
    wells = [score(w, value=v) for w, v in zip("fedcba", (60.0, 70.0, 70.0, 1.0, 5.0, 9.0))]
    health = serving.serving_health(scores_of(spark, *wells), RUN)
    lowest = [r.well_id for r in serving.lowest_health(health).collect()]
    assert lowest == ["c", "b", "a", "f", "d"]
    bars = serving.health_by_well(health)
    assert bars.columns == ["Well", "Health Score"]
    assert [r.Well for r in bars.collect()] == list("abcdef")
    panel = serving.well_status(health, "f")
    assert panel.columns == ["Health Score", "Status"]
    assert [float(r[0]) for r in panel.collect()] == [60.0]
    alerts = spark.createDataFrame([], S.SENSOR_ALERTS_SCHEMA)
    assert tuple(serving.serving_counts(health, alerts).first()) == (6, 0)
    assert tuple(serving.serving_counts(health.limit(0), alerts).first()) == (0, 0)


def test_status_panel_filter_reaches_the_files(spark, tmp_path):
    root = str(tmp_path / "well_health")
    batch = serving.serving_health(scores_of(spark, score("a"), score("b")), RUN)
    upsert_well_health(spark, root, batch)
    plan = executed_plan(serving.well_status(read_well_health(spark, root), "a"))
    assert "EqualTo(well_id,a)" in plan
    assert "ReadSchema: struct<well_id:string,health_score:decimal(5,1),status:string>" in plan


def test_top_alerts_never_sorts_globally(spark):
    alerts = kpis.alert_counts(X.readings(spark, SF))
    top = serving.top_alerts(alerts)
    assert top.count() == 10
    assert "TakeOrderedAndProject" in executed_plan(top)


# Workspace


def test_shared_folder_is_read_from_the_session(spark):
    folder = workspace.shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    first, second = (workspace.new_folder(spark, "x") for _ in range(2))
    assert first != second and first.startswith(folder)


class FakeSession:
    """Just what the workspace asks of a session without the setting."""

    def __init__(self, master, application):
        self.conf = self
        self.sparkContext = self
        self.master, self.applicationId = master, application

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return default


def test_local_session_without_the_setting():
    one, other = FakeSession("local[2]", "one"), FakeSession("local[2]", "other")
    assert workspace.shared_folder(one) == workspace.shared_folder(one)
    assert workspace.shared_folder(one) != workspace.shared_folder(other)


def test_cluster_session_without_the_setting():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace.shared_folder(FakeSession("yarn", "three"))


def test_other_session_zones_are_overruled(spark, tmp_path, raw_of):
    root, alerts_root = str(tmp_path / "bronze"), str(tmp_path / "alerts")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        arriving = raw_of({}).withColumn("arrival", F.lit(HOUR))
        write_bronze(arriving, root, "arrival")
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        alerts = spark.createDataFrame(
            [("a", "rpm", "WARNING", 1)], S.GOLD_SCHEMAS["alert_summary"]
        )
        write_alert_windows(serving.serving_alerts(alerts, HOUR), alerts_root)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert bronze.hour_available(spark, root, HOUR)
    assert "window=2026-03-26T14-00" in storage.children(spark, alerts_root)


def test_timestamps_written_in_utc(spark, tmp_path, silver_of):
    root = str(tmp_path / "silver")
    hours.write_silver(silver_of({}), root, HOUR)
    row = read_silver(spark, root, HOUR).first()
    assert row.timestamp == datetime(2026, 3, 26, 14)


def test_clustered_layout_skips_row_groups(spark, tmp_path, silver_of):
    """A well between others is told from the file by its bloom filter."""
    root = str(tmp_path / "silver")
    wells = [f"W{n:04d}" for n in range(0, 2000, 2)]
    readings = silver_of(*[dict(well_id=w) for w in wells]).coalesce(1)
    hours.write_silver(readings, root, HOUR, partitions=())
    for well, found in (("W0500", 1), ("W0501", 0)):
        rows = read_silver(spark, root, HOUR).where(F.col("well_id") == well)
        assert "EqualTo(well_id," in executed_plan(rows)
        frame = rows.select("well_id")
        assert frame.count() == found
    assert _read_rows(spark, root, "W0501") == 0 < _read_rows(spark, root, "W0500")


def _read_rows(spark, root, well):
    """Rows that a scan hands on before its filter."""
    rows = read_silver(spark, root, HOUR).where(F.col("well_id") == well).select("value")
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan()
    nodes, found = [plan], 0
    while nodes:
        node = nodes.pop()
        if node.nodeName().startswith("Scan"):
            found += node.metrics().apply("numOutputRows").value()
        children = node.children()
        nodes += [children.apply(k) for k in range(children.size())]
    return found
