from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakegauge import fixtures as X
from lakegauge import schema as S
from lakegauge.operators import cleaning, dedup
from lakegauge.plans.outcomes import Outcomes
from lakegauge.sources.bronze import read_bronze
from tests.conftest import RUN, executed_plan, plan_of, rows_of

GOOD = dict(
    well_id="WELL-001",
    location="North Sea Block A",
    depth_m=2400,
    timestamp="2024-03-18T10:23:45.123456",
    sensor_type="pressure",
    value=1023.4,
    unit="PSI",
    is_anomaly=False,
)

LINES = {
    "good": (json.dumps(GOOD), None),
    "padded": (json.dumps({**GOOD, "well_id": " W ", "sensor_type": " RPM"}), None),
    "not json": ("not json", "malformed"),
    "cut off": (json.dumps(GOOD)[:60], "malformed"),
    "no id": ('{"value":2.0}', "null_key"),
    "empty object": ("{}", "null_key"),
    "blank id": (json.dumps({**GOOD, "well_id": "  "}), "null_key"),
    "blank time": (json.dumps({**GOOD, "timestamp": " "}), "null_key"),
    "bad time": (json.dumps({**GOOD, "timestamp": "not-a-time"}), "bad_timestamp"),
    "quoted number": (json.dumps({**GOOD, "value": "7.5"}), "bad_value"),
    "text value": (json.dumps({**GOOD, "value": "abc"}), "bad_value"),
    "nan": (json.dumps({**GOOD, "value": "NaN"}), "bad_value"),
    "null value": (json.dumps({**GOOD, "value": None}), "bad_value"),
    "unknown sensor": (json.dumps({**GOOD, "sensor_type": "humidity"}), None),
    "extra field": (json.dumps({**GOOD, "firmware": "2.1"}), None),
}


@pytest.fixture
def landed(spark, tmp_path):
    def write(*names):
        folder = tmp_path / "raw"
        folder.mkdir(exist_ok=True)
        text = "\n".join(LINES[name][0] for name in names)
        (folder / "part.json").write_text(text + "\n")
        return read_bronze(spark, str(folder))

    return write


@pytest.mark.parametrize("name", LINES)
def test_reject_reason(landed, name):
    raw = landed(name)
    reason = LINES[name][1]
    found = [r[cleaning.REASON] for r in cleaning.rejects(raw).collect()]
    assert found == ([] if reason is None else [reason])
    assert cleaning.clean(raw, RUN).count() == (1 if reason is None else 0)
    tagged = cleaning.tag_rejects(raw)
    assert cleaning.clean_tagged(tagged, RUN).count() == (1 if reason is None else 0)


def test_nothing_gets_lost(landed):
    raw = landed(*LINES)
    assert raw.count() == len(LINES)
    assert cleaning.rejects(raw).count() + cleaning.clean(raw, RUN).count() == len(LINES)


def test_rejects_keep_the_line(landed):
    kept = cleaning.rejects(landed("not json")).first()
    assert kept[S.CORRUPT] == "not json"


def test_normalise_strings(raw_of):
    raw = raw_of(
        dict(well_id=" WELL-001 ", sensor_type="  PRESSURE ", location=" x "),
        dict(well_id="\tW", sensor_type=" "),
    )
    rows = cleaning.normalise_strings(raw).select("well_id", "sensor_type", "location")
    assert rows_of(rows) == [
        ("WELL-001", "pressure", " x "),
        ("\tW", None, "North Sea Block A"),
    ]


def test_clean_columns_and_types(raw_of):
    cleaned = cleaning.clean(raw_of({}), RUN)
    assert cleaned.columns == S.SILVER_COLUMNS
    assert [f.dataType for f in cleaned.schema] == [f.dataType for f in S.SILVER_FIELDS]
    row = cleaned.first()
    assert row.timestamp == datetime(2026, 3, 26, 14, 0, 0, 1)
    assert row.processed_at == datetime(2026, 3, 26, 15, 5)
    assert row.silver_version == "1.0"
    assert row.value_valid is True


def test_flagged_rows_stay(raw_of):
    raw = raw_of(dict(value=9999.0, is_anomaly=True), dict(is_anomaly=None))
    rows = cleaning.clean(raw, RUN).select("is_anomaly", "value_valid")
    assert rows_of(rows) == [(None, True), (True, False)]


def test_exact_replays_become_one(raw_of):
    cleaned = cleaning.clean(raw_of({}, {}, {}), RUN)
    assert dedup.dedup_readings(cleaned).count() == 1
    assert dedup.dedup_rows(cleaned).count() == 1


def test_dedup_survivor_is_deterministic(spark, raw_of):
    variants = [
        dict(value=3.0),
        dict(value=1.0, location=None),
        dict(value=1.0, location="b", is_anomaly=None),
        dict(value=1.0, location="b", is_anomaly=True),
        dict(value=1.0, location="c"),
    ]
    for order in (variants, variants[::-1]):
        cleaned = cleaning.clean(raw_of(*order), RUN).repartition(3)
        row = dedup.dedup_readings(cleaned).first()
        assert (row.value, row.location, row.is_anomaly) == (1.0, "b", True)


def test_dedup_keeps_columns_and_order(raw_of):
    cleaned = cleaning.clean(raw_of({}, dict(well_id="W2")), RUN)
    assert dedup.dedup_readings(cleaned).schema.names == cleaned.schema.names
    assert rows_of(dedup.dedup_readings(cleaned)) == rows_of(cleaned)


def test_dedup_of_a_hot_reading(spark, raw_of):
    """Half the rows are copies of one reading; they combine before the shuffle."""
    copies = raw_of({}).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(20000))))
    others = raw_of({}).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(20000))))
    others = others.withColumn("well_id", F.concat(F.lit("W"), "n"))
    raw = copies.unionByName(others).drop("n").repartition(4)
    unique = dedup.dedup_readings(cleaning.clean(raw, RUN))
    assert unique.count() == 20001
    plan = unique._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_min" in plan


def test_drop_counts(raw_of):
    raw = raw_of(
        {}, {}, dict(value=5.0), dict(well_id=None), dict(timestamp="x"), dict(unit="y")
    )
    assert dedup.drop_counts(raw).first().asDict() == dict(
        rows_in=6, rows_clean=4, rows_unique=1, rows_dropped=2, rows_duplicate=3
    )


def test_drop_counts_of_nothing(raw_of):
    counts = dedup.drop_counts(raw_of({}).limit(0)).first().asDict()
    assert set(counts.values()) == {0}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_fixture_sizes(spark, sf):
    """Known sizes of the damaged fixture: rows, usable rows, unique rows."""
    expected = {"sf0.001": (1100, 1056, 960), "sf0.01": (11000, 10558, 9596)}[sf]
    raw = X.raw_messages(spark, f"/root/testdata/{sf}")
    counts = dedup.drop_counts(raw).first()
    assert (counts.rows_in, counts.rows_clean, counts.rows_unique) == expected


# Outcomes


ODD_LINES = [
    '{"well_id": "a", "timestamp": "2026-03-26T14:00:00", "sensor_type": "rpm", '
    '"value": 1, "depth_m": "deep", "is_anomaly": 7}',
    '{"well_id": "b", "timestamp": "2026-03-26T14:00:00", "sensor_type": "rpm", "value": 2}',
    '{"well_id": "c", "timestamp": "2026-03-26T14:00:00", "sensor_type": "rpm", '
    '"value": "two"}',
    '{"well_id": "d", "timestamp": "2026-03-26T14:00:00", "sensor_type": "rpm", '
    '"value": 3, "location": {"x": 1}}',
    "not json",
    '{"well_id": "e", "value": ',
]


@pytest.fixture
def odd_lines(spark, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    (folder / "a.json").write_text("\n".join(ODD_LINES) + "\n")
    return read_bronze(spark, str(folder))


def test_no_field_vanishes(spark, odd_lines):
    """A damaged row is a reading and, with its text, among the rejects."""
    kept = cleaning.clean(odd_lines, RUN)
    assert rows_of(kept.select("well_id")) == [("a",), ("b",), ("d",)]
    rejected = cleaning.rejects(odd_lines).select(cleaning.REASON, S.CORRUPT)
    reasons = {text: reason for reason, text in map(tuple, rejected.collect())}
    assert reasons == {
        ODD_LINES[0]: "bad_field",
        ODD_LINES[2]: "bad_value",
        ODD_LINES[4]: "malformed",
        ODD_LINES[5]: "malformed",
    }


def test_field_errors(odd_lines):
    found = cleaning.field_errors(odd_lines).select("well_id", "field", "text")
    assert rows_of(found) == [
        ("a", "depth_m", "deep"),
        ("a", "is_anomaly", "7"),
        ("c", "value", "two"),
    ]


def test_lines_are_parsed_once(spark, odd_lines, tmp_path):
    """What the outcomes give comes from their folder alone."""
    outcomes = Outcomes(odd_lines, str(tmp_path / "staged"))
    assert outcomes.counts() == {"clean": 2, "damaged": 1, "rejected": 3}
    for frame in (outcomes.usable(), outcomes.rejects()):
        plan = plan_of(frame).lower()
        assert "filescan json" not in plan and "relation [" in plan
        plan = executed_plan(frame)
        assert "/staged]" in plan and "/lines]" not in plan
    assert rows_of(outcomes.rejects()) == rows_of(cleaning.rejects(odd_lines))
    again = cleaning.clean_tagged(outcomes.usable(), RUN).select(*S.RAW_COLUMNS)
    assert rows_of(again) == rows_of(cleaning.clean(odd_lines, RUN).select(*S.RAW_COLUMNS))
