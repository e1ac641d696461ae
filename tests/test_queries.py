"""Every registered query against its SQL twin, and rules for all plans."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from check_queries import compare, connect
from lakegauge import catalog, oracle
from tests.conftest import executed_plan

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


@pytest.mark.parametrize("name", catalog.queries())
def test_query_equals_sql(spark, connection, name):
    good, text = compare(spark, connection, name, SF)
    assert good, text


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(oracle.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() == 5


@pytest.mark.parametrize("name", catalog.queries())
def test_plan_rules(spark, name):
    """No Python workers, cross joins or joins at all, one-task gathers only
    for results that are a single row."""
    plan = executed_plan(catalog.queries()[name](spark, SF))
    for operator in ("Python", "Pandas", "Cartesian", "NestedLoop", "Join"):
        assert operator not in plan
    single = ("drop_counts", "quality_summary", "serving_counts", "stream_drop_counts")
    if name not in single:
        assert "SinglePartition" not in plan


def test_stored_tables_answer_dashboards(spark):
    """No reading is touched, and filters reach the files."""
    found = catalog.queries()
    for name in ("dash_anomaly_series", "dash_well_status", "dash_active_alerts",
                 "serving_counts", "lowest_health", "dash_health_all"):
        plan = executed_plan(found[name](spark, SF))
        assert "events" not in plan and "/stored-" in plan
    plan = executed_plan(found["dash_well_status"](spark, SF))
    assert "EqualTo(well_id,WELL-003)" in plan
    assert "ReadSchema: struct<>" in executed_plan(found["serving_counts"](spark, SF))


def test_availability_reads_counts(spark):
    plan = executed_plan(catalog.queries()["hour_availability"](spark, SF))
    assert "bronze" in plan and "_counts" in plan
    assert "json" not in plan.lower() and "text" not in plan.lower()
