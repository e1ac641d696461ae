from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lakegauge import fixtures as X
from lakegauge import schema as S
from lakegauge.operators import kpis
from tests.conftest import executed_plan, rows_of

SF = "/root/testdata/sf0.001"


def test_single_reading_has_no_deviation(readings_of):
    row = kpis.sensor_statistics(readings_of(dict(value=7.0))).first()
    assert row.stddev_value is None
    assert (row.avg_value, row.min_value, row.max_value) == (7.0, 7.0, 7.0)
    assert (row.reading_count, row.anomaly_count, row.anomaly_rate) == (1, 0, 0.0)


def test_statistics_schema(readings_of):
    row = kpis.sensor_statistics(readings_of({}))
    assert row.schema.names == S.GOLD_SCHEMAS["sensor_statistics"].names


def test_sample_deviation(readings_of):
    row = kpis.sensor_statistics(
        readings_of(dict(value=2.0), dict(value=4.0), dict(value=9.0))
    ).first()
    assert row.stddev_value == 3.61
    assert row.avg_value == 5.0


def test_unset_flags_count_as_not_anomalous(readings_of):
    readings = readings_of(dict(is_anomaly=None), dict(is_anomaly=None))
    statistics = kpis.sensor_statistics(readings)
    assert statistics.first().anomaly_count == 0
    score = kpis.health_scores(statistics).first()
    assert (score.health_score, score.status) == (100.0, "HEALTHY")


def test_well_rate_is_the_mean_of_rounded_sensor_rates(readings_of):
    rows = [dict(sensor_type="pressure", is_anomaly=i == 0) for i in range(3)]
    rows += [dict(sensor_type="rpm", is_anomaly=False) for _ in range(97)]
    row = kpis.health_scores(kpis.sensor_statistics(readings_of(*rows))).first()
    assert row.avg_anomaly_rate == 0.1667
    assert row.health_score == 93.3
    assert (row.total_readings, row.total_anomalies) == (100, 1)


def test_two_locations_are_two_rows(readings_of):
    readings = readings_of(dict(location="a"), dict(location="b"), dict(location=None))
    assert kpis.health_scores(kpis.sensor_statistics(readings)).count() == 3


def test_full_score_extremes(readings_of):
    worst = [
        dict(sensor_type="vibration", value=99.0, is_anomaly=True, value_valid=False),
        dict(sensor_type="rpm", value=-1.0, is_anomaly=True, value_valid=False),
    ]
    row = kpis.health_scores_full(kpis.sensor_facts(readings_of(*worst))).first()
    assert (row.health_score, row.status) == (0.0, "CRITICAL")


def test_full_score_terms(readings_of):
    rows = [
        dict(sensor_type="vibration", value=5.0),
        dict(sensor_type="vibration", value=5.01),
        dict(sensor_type="rpm", value=800.0),
        dict(sensor_type="rpm", value=799.0),
        dict(sensor_type="rpm", value=1500.0),
        dict(sensor_type="rpm", value=1500.0),
        dict(sensor_type="pressure", value=1.0, value_valid=False),
        dict(sensor_type="pressure", value=1.0, value_valid=None),
    ]
    row = kpis.health_scores_full(kpis.sensor_facts(readings_of(*rows))).first()
    assert row.invalid_share == 0.125
    assert row.high_vibration_share == 0.5
    assert row.low_rpm_share == 0.25
    assert row.health_score == round(100 - 30 * 0.125 - 20 * 0.5 - 10 * 0.25, 1)


def test_full_score_without_those_sensors(readings_of):
    row = kpis.health_scores_full(kpis.sensor_facts(readings_of({}))).first()
    assert (row.high_vibration_share, row.low_rpm_share) == (0.0, 0.0)
    assert row.health_score == 100.0


def test_alerts_order_and_severity(readings_of):
    rows = [dict(is_anomaly=True)] * 2
    rows += [dict(is_anomaly=True, value_valid=False, sensor_type="rpm")]
    rows += [dict(is_anomaly=True, value_valid=None, sensor_type="flow_rate")]
    rows += [dict(is_anomaly=None, value_valid=False), dict(value_valid=False)]
    found = [tuple(r) for r in kpis.alert_summary(readings_of(*rows)).collect()]
    assert found == [
        ("WELL-001", "pressure", "WARNING", 2),
        ("WELL-001", "flow_rate", "WARNING", 1),
        ("WELL-001", "rpm", "CRITICAL", 1),
    ]


def test_alerts_from_facts_equal_alerts_from_readings(spark, readings_of):
    choice = random.Random(3)
    rows = [
        dict(
            well_id=choice.choice(["a", "b"]),
            location=choice.choice(["x", "y", None]),
            sensor_type=choice.choice(["rpm", "pressure"]),
            is_anomaly=choice.choice([True, False, None]),
            value_valid=choice.choice([True, False, None]),
        )
        for _ in range(200)
    ]
    readings = readings_of(*rows)
    assert rows_of(kpis.alerts_of(kpis.sensor_facts(readings))) == rows_of(
        kpis.alert_counts(readings)
    )
    table = X.readings(spark, SF)
    assert rows_of(kpis.alerts_of(kpis.sensor_facts(table))) == rows_of(
        kpis.alert_counts(table)
    )


def test_quality_summary(readings_of):
    rows = [dict(is_anomaly=True), dict(value_valid=False), dict(location=None)]
    rows += [dict(is_anomaly=None, value_valid=None)] * 5
    assert kpis.quality_summary(readings_of(*rows)).first().asDict() == dict(
        total_records=8,
        anomaly_records=1,
        invalid_records=1,
        missing_location=1,
        anomaly_percent=12.5,
        invalid_percent=12.5,
    )


def test_quality_summary_of_nothing(readings_of):
    row = kpis.quality_summary(readings_of({}).limit(0)).first()
    assert (row.total_records, row.anomaly_percent, row.invalid_percent) == (
        0,
        None,
        None,
    )


def test_empty_input(readings_of):
    nothing = readings_of({}).limit(0)
    assert kpis.health_scores(kpis.sensor_statistics(nothing)).count() == 0
    assert kpis.alert_summary(nothing).count() == 0
    assert kpis.anomalies_by_sensor(nothing).count() == 0


def test_band_with_a_rules_table(spark):
    rules = spark.createDataFrame(
        [(name, *rule.normal, *rule.anomaly) for name, rule in S.SENSOR_RULES.items()],
        "sensor_type string, normal_low double, normal_high double, "
        "anomaly_low double, anomaly_high double",
    )
    readings = X.readings(spark, SF).union(
        X.readings(spark, SF).limit(1).withColumn("sensor_type", F.lit("humidity"))
    )
    by_rules = kpis.classify_band_with(readings, rules)
    assert by_rules.columns == [*readings.columns, "band"]
    assert rows_of(by_rules) == rows_of(kpis.classify_band(readings))


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_results_do_not_depend_on_partitioning(spark, partitions):
    readings = X.readings(spark, SF)
    expected = rows_of(kpis.sensor_statistics(readings))
    shuffled = readings.repartition(partitions, "event_id")
    assert rows_of(kpis.sensor_statistics(shuffled)) == expected


def test_unused_counts_are_pruned(spark):
    plan = executed_plan(kpis.sensor_statistics(X.readings(spark, SF)))
    assert "value_valid" not in plan
    assert plan.count("Exchange") == 1
