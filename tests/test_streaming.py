from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegauge import fixtures as X
from lakegauge import schema as S
from lakegauge import storage
from lakegauge.functions.timeparts import ingest_columns
from lakegauge.operators import cleaning, dedup, windows
from lakegauge.sources import bronze
from lakegauge.sources.messages import decode_messages, encode_messages
from lakegauge.streaming import landing, merging
from lakegauge.streaming import readings as streams
from lakegauge.streaming.segments import Segments
from tests.conftest import HOUR, RUN, executed_plan, plan_of, rows_of

SF = "/root/testdata/sf0.001"


class Inbox:
    """A folder that is read as a stream, and where files can be added."""

    def __init__(self, spark, folder, schema):
        self.spark, self.folder, self.schema = spark, str(folder), schema

    def add(self, df):
        df.coalesce(1).write.mode("append").parquet(self.folder)

    def stream(self, **options):
        reader = self.spark.readStream.schema(self.schema).options(**options)
        return reader.parquet(self.folder)


@pytest.fixture
def messages(spark, tmp_path):
    return Inbox(spark, tmp_path / "inbox", S.MESSAGE_SCHEMA)


def message(spark, *rows):
    return spark.createDataFrame(list(rows), S.MESSAGE_SCHEMA)


def drain(query):
    query.awaitTermination()


def test_landing_keeps_every_message(spark, tmp_path, messages):
    root, progress = str(tmp_path / "bronze"), str(tmp_path / "progress")
    messages.add(
        message(
            spark,
            (b"k", b'{"well_id": "a",\n "value": 1.5}', HOUR),
            (b"k", b"not json", HOUR + timedelta(hours=1)),
        )
    )
    drain(landing.land_messages(messages.stream(), root, progress, available_now=True))
    rows = bronze.read_bronze(spark, root).select("well_id", "value", S.CORRUPT, "hour")
    assert rows_of(rows) == [("a", 1.5, None, "14"), (None, None, "not json", "15")]
    one_hour = bronze.read_bronze_hour(spark, root, HOUR)
    assert [r.well_id for r in one_hour.collect()] == ["a"]
    assert bronze.hour_available(spark, root, HOUR)


def test_landing_restarts_where_it_stopped(spark, tmp_path, messages):
    root, progress = str(tmp_path / "bronze"), str(tmp_path / "progress")
    for number in range(3):
        messages.add(message(spark, (b"k", b'{"value": %d}' % number, HOUR)))
        for _ in range(2):
            drain(
                landing.land_messages(
                    messages.stream(maxFilesPerTrigger=1),
                    root,
                    progress,
                    available_now=True,
                )
            )
    values = bronze.read_bronze(spark, root).select("value")
    assert rows_of(values) == [(0.0,), (1.0,), (2.0,)]


def test_landing_in_micro_batches_equals_batch(spark, tmp_path, messages):
    root, progress = str(tmp_path / "bronze"), str(tmp_path / "progress")
    readings = X.readings(spark, SF).withColumn("arrival", F.lit(HOUR))
    raw = X.to_raw(readings, "arrival")
    encode_messages(raw).repartition(3).write.parquet(messages.folder)
    stream = messages.stream(maxFilesPerTrigger=1)
    drain(landing.land_messages(stream, root, progress, available_now=True))
    expected = raw.selectExpr(*S.RAW_COLUMNS, *ingest_columns("arrival"))
    landed = bronze.read_bronze(spark, root).drop(S.CORRUPT)
    assert rows_of(landed) == rows_of(expected)


@pytest.mark.parametrize("salts", [1, 8])
def test_stream_dedup_equals_batch(spark, tmp_path, salts):
    folder = str(tmp_path / "raw")
    X.raw_messages(spark, SF).repartition(5).write.json(folder)
    cleaned = streams.clean_stream(bronze.stream_bronze(spark, folder), salts=salts)
    columns = [*S.RAW_COLUMNS, "value_valid"]
    table, progress = str(tmp_path / "table"), str(tmp_path / "progress")
    drain(
        landing.start_files(
            cleaned.select(*columns), table, progress, available_now=True
        )
    )
    batch = dedup.dedup_readings(
        cleaning.clean(bronze.read_bronze(spark, folder), RUN).select(*columns)
    )
    assert rows_of(spark.read.parquet(table)) == rows_of(batch)


@pytest.mark.parametrize("salts", [1, 8])
def test_replays_in_later_batches_are_dropped(spark, tmp_path, raw_of, salts):
    inbox = Inbox(spark, tmp_path / "inbox", S.RAW_SCHEMA)
    table, progress = str(tmp_path / "table"), str(tmp_path / "progress")

    def run():
        cleaned = streams.clean_stream(inbox.stream(), delay="30 minutes", salts=salts)
        drain(landing.start_files(cleaned, table, progress, available_now=True))
        return spark.read.parquet(table).count()

    inbox.add(raw_of({}, {}))
    assert run() == 1
    inbox.add(raw_of({}, dict(timestamp="2026-03-26T14:10:00")))
    assert run() == 2
    inbox.add(raw_of(dict(timestamp="2026-03-26T14:10:00"), dict(well_id="W2")))
    assert run() == 3


@pytest.mark.parametrize("clock, kept", [("timestamp", 2), ("arrival", 3)])
def test_old_readings_and_the_clock(spark, tmp_path, messages, raw_of, clock, kept):
    """A day-old reading comes after a watermark has moved on."""
    table, progress = str(tmp_path / "table"), str(tmp_path / "progress")

    def run(second, *rows):
        arrival = F.lit(HOUR + timedelta(seconds=second)).alias("arrival")
        messages.add(encode_messages(raw_of(*rows).select("*", arrival)))
        raw = decode_messages(messages.stream())
        cleaned = streams.clean_stream(raw, delay="10 minutes", clock=clock)
        drain(landing.start_files(cleaned, table, progress, available_now=True))

    run(0, dict(timestamp="2026-03-26T14:00:00"))
    run(1, dict(timestamp="2026-03-26T16:00:00"))
    old = dict(timestamp="2026-03-25T14:00:00")
    run(2, old, old)
    run(3, old)
    assert spark.read.parquet(table).count() == kept


def test_late_rows_miss_their_closed_window(spark, tmp_path, readings_of):
    inbox = Inbox(spark, tmp_path / "inbox", readings_of({}).schema)
    table, progress = str(tmp_path / "table"), str(tmp_path / "progress")

    def run():
        hourly = streams.hourly_statistics_stream(inbox.stream(), delay="10 minutes")
        drain(landing.start_files(hourly, table, progress, available_now=True))
        found = spark.read.schema(hourly.schema).parquet(table)
        return rows_of(found.select(F.hour("window_start"), "reading_count"))

    def at(minutes):
        return dict(timestamp=HOUR + timedelta(minutes=minutes))

    inbox.add(readings_of(at(0), at(59), at(65)))
    assert run() == []
    inbox.add(readings_of(at(30), at(71)))
    assert run() == [(14, 3)]
    inbox.add(readings_of(at(31), at(140)))
    assert run() == [(14, 3), (15, 2)]


def test_stream_statistics_equal_batch(spark, tmp_path):
    readings = X.to_readings(X.stream_events(spark, f"{SF}/events*.parquet"))
    hourly = streams.hourly_statistics_stream(readings, delay="0 seconds")
    table, progress = str(tmp_path / "table"), str(tmp_path / "progress")
    drain(landing.start_files(hourly, table, progress, available_now=True))
    batch = windows.tumbling_statistics(X.readings(spark, SF))
    latest = X.readings(spark, SF).agg(F.max("timestamp")).first()[0]
    closed = batch.where(F.col("window_end") <= F.lit(latest))
    assert rows_of(spark.read.parquet(table)) == rows_of(closed)


@pytest.mark.parametrize("files", [1, 2, 6])
def test_merged_stream_equals_batch(spark, tmp_path, files):
    """However the files, which all span the whole time, are cut into batches."""
    folder, root = str(tmp_path / "raw"), str(tmp_path / "live")
    X.raw_messages(spark, SF).repartition(6).write.json(folder)
    raw = bronze.stream_bronze(spark, folder, files_per_trigger=files)
    drain(merging.merge_clean(raw, root, str(tmp_path / "progress"), available_now=True))
    columns = [*S.RAW_COLUMNS, "value_valid"]
    all_raw = bronze.read_bronze(spark, folder)
    batch = dedup.dedup_readings(cleaning.clean(all_raw, RUN).select(*columns))
    assert rows_of(merging.read_clean(spark, root).select(*columns)) == rows_of(batch)
    rejected = spark.read.parquet(f"{root}/rejects").drop("batch")
    expected = cleaning.rejects(all_raw).select(*rejected.columns)
    assert rows_of(rejected) == rows_of(expected)


@pytest.mark.parametrize("files", [1, 2, 6])
def test_merged_statistics_equal_batch(spark, tmp_path, files):
    folder, root = str(tmp_path / "events"), str(tmp_path / "live")
    X.events(spark, SF).repartition(6).write.parquet(folder)
    events = X.stream_events(spark, folder, maxFilesPerTrigger=files)
    query = merging.merge_hourly_statistics(
        X.to_readings(events), root, str(tmp_path / "progress"), available_now=True
    )
    drain(query)
    batch = windows.tumbling_statistics(X.readings(spark, SF))
    found = merging.read_hourly_statistics(spark, root)
    assert rows_of(found.select(*batch.columns)) == rows_of(batch)


# Segments


NUMBERS = "number bigint, day string"


def _numbers(spark, *numbers):
    return spark.createDataFrame([(n, f"d{n % 2}") for n in numbers], NUMBERS)


def _segments(spark, root, **options):
    schema = spark.createDataFrame([], NUMBERS).schema
    return Segments(spark, str(root), schema, DataFrame.distinct, ["day"], **options)


def test_segments_are_folded(spark, tmp_path):
    table = _segments(spark, tmp_path / "t", fan=2, levels=2)
    for batch in range(11):
        table.add(_numbers(spark, batch, 100), batch)
        if batch == 6:  # a retry, with other numbers in the place of the first
            table.add(_numbers(spark, 60, 100), batch)
    # Whole levels of four, then of two, then the latest.
    assert table.live() == [(0, 3), (4, 7), (8, 9), (10, 10)]
    rows = [r.number for r in table.read().collect()]
    assert sorted(set(rows)) == [0, 1, 2, 3, 4, 5, 7, 8, 9, 10, 60, 100]
    assert rows.count(100) == 4
    table.compact()
    assert table.live() == [(0, 7), (8, 9), (10, 10)]
    assert table.read().where("number = 100").count() == 3
    assert table.read().where("day = 'd1'").distinct().count() == 5


def test_a_thousand_batches_are_few_directories(spark, tmp_path, monkeypatch):
    """Names only: the fold is told by the number of the batch."""
    table = _segments(spark, tmp_path / "t")
    made = set()
    table._write = lambda rows, span: made.add(span)
    table._complete = lambda: sorted(made)
    table.path = lambda span: span
    monkeypatch.setattr(storage, "remove", lambda _, span: made.remove(span))
    table.read = lambda spans=None: None
    table.fold = lambda rows: rows
    empty, most = None, 0
    for batch in range(1000):
        table.add(empty, batch)
        most = max(most, len(made))
    assert most <= 4 * 16 and len(table.live()) <= 3 * 16
    covered = [n for first, last in table.live() for n in range(first, last + 1)]
    assert covered == list(range(1000))


def test_unfinished_segments_do_not_count(spark, tmp_path):
    table = _segments(spark, tmp_path / "t", fan=2)
    table.add(_numbers(spark, 1), 0)
    table.add(_numbers(spark, 2), 1)
    for name in ("batch=000000000000-000000000001", "batch=000000000002-000000000002"):
        (tmp_path / "t" / name).mkdir()
    assert table.live() == [(0, 0), (1, 1)]
    table.add(_numbers(spark, 3), 2)  # folds over the unfinished one
    assert table.live() == [(0, 1), (2, 2)]
    assert rows_of(table.read().select("number")) == [(1,), (2,), (3,)]


def test_late_copies_and_folds(spark, tmp_path, raw_of):
    """A copy that comes after its first was folded, and a failed batch."""
    inbox = Inbox(spark, tmp_path / "inbox", S.RAW_SCHEMA)
    root, progress = str(tmp_path / "live"), str(tmp_path / "progress")

    def at(minute, **other):
        return dict(timestamp=f"2026-03-26T14:{minute:02d}:00", **other)

    for batch in range(5):
        inbox.add(raw_of(at(batch), at(0), at(9, well_id=None), {"value": None}))
        query = merging.merge_clean(
            inbox.stream(), root, progress, available_now=True, fan=2
        )
        drain(query)
    readings = merging.clean_segments(spark, root, fan=2)
    assert readings.live() == [(0, 3), (4, 4)]
    assert readings.read().count() == 4 + 2
    assert merging.read_clean(spark, root).count() == 5
    assert merging.read_clean(spark, root, "day < '2026-03-26'").isEmpty()
    counts = merging.stream_counts(spark, root)
    assert counts.columns == ["rows_in", "rows_clean", "rows_unique", "rows_dropped", "rows_duplicate"]
    assert tuple(counts.first()) == (20, 10, 5, 10, 5)
    reasons = merging.reject_segments(spark, root).read().groupBy(cleaning.REASON).count()
    assert rows_of(reasons) == [("bad_value", 5), ("null_key", 5)]


def test_stream_rejects_keep_their_text(spark, tmp_path, messages):
    root, progress = str(tmp_path / "live"), str(tmp_path / "progress")
    messages.add(message(spark, (b"k", b"not json", HOUR), (b"k", b'{"value": 1}', HOUR)))
    raw = decode_messages(messages.stream())
    drain(merging.merge_clean(raw, root, progress, available_now=True))
    rejected = merging.reject_segments(spark, root).read()
    assert rows_of(rejected.select(cleaning.REASON, S.CORRUPT)) == [
        ("malformed", "not json"),
        ("null_key", None),
    ]


def test_no_stream_yet(spark, tmp_path):
    root = str(tmp_path / "none")
    assert merging.read_clean(spark, root).isEmpty()
    assert merging.read_hourly_statistics(spark, root).isEmpty()
    assert tuple(merging.stream_counts(spark, root).first()) == (0, 0, 0, 0, 0)


def test_states_merge_like_one_batch(spark, readings_of):
    """Far from zero, close together, single values, a missing one."""
    values = [1e9 + k / 8 for k in range(40)] + [None, 5.0, -1e-3]
    rows = [
        dict(value=v, is_anomaly=k % 3 == 0, sensor_type="rpm" if k % 7 else "flow_rate")
        for k, v in enumerate(values)
    ]
    whole = windows.tumbling_statistics(readings_of(*rows, dict(well_id="b", value=None)))
    parts = [rows[:1], rows[1:11], rows[11:], [dict(well_id="b", value=None)]]
    states = [windows.tumbling_states(readings_of(*part)) for part in parts]
    together = states[0].union(states[1]).union(states[2]).union(states[3])
    folded = windows.merge_states(windows.merge_states(states[0].union(states[1])).union(
        states[2]).union(states[3]))
    for found in (windows.merge_states(together), folded):
        statistics = windows.tumbling_statistics_of(found)
        assert rows_of(statistics.select(*whole.columns)) == rows_of(whole)


def test_statistics_read_states_only(spark, tmp_path):
    """Readings are gone when the statistics are read."""
    root = str(tmp_path / "live")
    X.events(spark, SF).repartition(4).write.parquet(str(tmp_path / "events"))
    events = X.stream_events(spark, str(tmp_path / "events"), maxFilesPerTrigger=1)
    drain(
        merging.merge_hourly_statistics(
            X.to_readings(events), root, str(tmp_path / "progress"), available_now=True
        )
    )
    assert [p.name for p in (tmp_path / "live").iterdir()] == ["states"]
    found = merging.read_hourly_statistics(spark, root, "window_start >= '2024-01-02'")
    assert "GreaterThanOrEqual(window_start" in executed_plan(found)
    batch = windows.tumbling_statistics(X.readings(spark, SF))
    later = batch.where("window_start >= '2024-01-02'")
    assert rows_of(found.select(*batch.columns)) == rows_of(later)


# Landing


def test_landing_keeps_no_file_log(spark, tmp_path, messages):
    root, progress = str(tmp_path / "bronze"), str(tmp_path / "progress")
    messages.add(message(spark, *[(b"k", b'{"value": 1}', HOUR)] * 3, (b"k", b"{}", RUN)))
    drain(landing.land_messages(messages.stream(), root, progress, available_now=True))
    assert not (tmp_path / "bronze" / "_spark_metadata").exists()
    for frame in (bronze.read_bronze(spark, root), bronze.read_bronze_hour(spark, root, HOUR)):
        assert "MetadataLogFileIndex" not in plan_of(frame)
        assert frame.schema == S.BRONZE_SCHEMA
    counts = bronze.hour_availability(spark, root)
    assert "json" not in plan_of(counts).lower() and "text" not in plan_of(counts).lower()
    assert rows_of(counts) == rows_of(bronze.counted_lines(spark, root))


def test_a_retried_batch_lands_once(spark, tmp_path, messages):
    """The last batch is written, but its commit is lost."""
    root, progress = str(tmp_path / "bronze"), tmp_path / "progress"

    def land():
        stream = messages.stream(maxFilesPerTrigger=1)
        drain(landing.land_messages(stream, root, str(progress), available_now=True))

    for number in range(3):
        arrival = HOUR + timedelta(hours=number % 2)
        messages.add(message(spark, (b"k", b'{"value": %d}' % number, arrival)))
    land()
    for lost in (progress / "commits").glob("*2*"):
        lost.unlink()
    for _ in range(2):
        land()
    rows = bronze.read_bronze(spark, root).select("hour", "value")
    assert rows_of(rows) == [("14", 0.0), ("14", 2.0), ("15", 1.0)]
    assert rows_of(bronze.hour_availability(spark, root).select("hour", "raw_count")) == [
        ("14", 2),
        ("15", 1),
    ]


def test_two_streams_share_a_root(spark, tmp_path, messages):
    root = str(tmp_path / "bronze")
    messages.add(message(spark, (b"k", b'{"value": 1}', HOUR)))
    for name in ("one", "two"):
        stream = messages.stream()
        drain(landing.land_messages(stream, root, str(tmp_path / name), available_now=True))
    assert bronze.read_bronze(spark, root).count() == 2
    assert bronze.hour_availability(spark, root).first().raw_count == 2


def test_the_source_starts_batches(monkeypatch):
    """No interval is set unless one is asked for."""
    seen = []

    class Writer:
        def foreachBatch(self, _):
            return self

        def option(self, *_):
            return self

        def trigger(self, **how):
            seen.append(how)
            return self

        def start(self):
            return seen

    class Rows:
        sparkSession, writeStream = None, Writer()

    monkeypatch.setattr(merging, "use_utc", lambda _: None)
    merging.start_batches(Rows(), None, "c", every=None)
    assert seen == []
    merging.start_batches(Rows(), None, "c", every="30 seconds")
    merging.start_batches(Rows(), None, "c", available_now=True, every=None)
    assert seen == [{"processingTime": "30 seconds"}, {"availableNow": True}]
