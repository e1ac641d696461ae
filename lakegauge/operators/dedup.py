"""Removing replayed readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegauge import schema as S
from lakegauge.operators.cleaning import REASON, parse_timestamps, tag_rejects

# Columns that decide between copies first; the others follow in table order.
PREFERENCE = ["value", "location", "is_anomaly"]


def dedup_readings(
    readings: DataFrame,
    key: Sequence[str] = tuple(S.READING_KEY),
    preference: Sequence[str] = tuple(PREFERENCE),
) -> DataFrame:
    """One row per natural key, the same row on every run.

    The survivor is the smallest row by ``preference`` and then the remaining
    columns, NULLs last. Written as an aggregate and not as a ranking window:
    ``min`` combines before the shuffle, so a reading replayed a billion times
    leaves each map task as one row. Being deterministic it also survives a
    recomputed task, where "any first row" could mix two answers.
    """
    first = [name for name in preference if name in readings.columns]
    rest = [
        name for name in readings.columns if name not in key and name not in first
    ]
    if not first + rest:
        return readings.distinct()
    ordered = [
        f"isnull({name}) AS {name}__missing, {name}" for name in [*first, *rest]
    ]
    smallest = F.expr(f"min(struct({', '.join(ordered)})) AS __row")
    picked = [
        name if name in key else f"__row.{name} AS {name}" for name in readings.columns
    ]
    return readings.groupBy(*key).agg(smallest).selectExpr(*picked)


def dedup_rows(rows: DataFrame) -> DataFrame:
    """Distinct whole rows."""
    return rows.dropDuplicates()


def drop_counts(raw: DataFrame) -> DataFrame:
    """Rows read, usable and unique, with the two differences, in one pass.

    Copies are counted per natural key first and the groups are summed up
    next; all unusable rows share one group. Both steps combine map-side.
    """
    usable = f"{REASON} IS NULL"
    keyed = parse_timestamps(tag_rejects(raw)).selectExpr(
        f"{usable} AS usable",
        *[f"CASE WHEN {usable} THEN {name} END AS {name}" for name in S.READING_KEY],
    )
    copies = keyed.groupBy("usable", *S.READING_KEY).agg(F.expr("count(*) AS copies"))
    counted = copies.agg(
        F.expr("coalesce(sum(copies), 0) AS rows_in"),
        F.expr("coalesce(sum(copies) FILTER (WHERE usable), 0) AS rows_clean"),
        F.expr("count_if(usable) AS rows_unique"),
    )
    return counted.selectExpr(
        "*",
        "rows_in - rows_clean AS rows_dropped",
        "rows_clean - rows_unique AS rows_duplicate",
    )
