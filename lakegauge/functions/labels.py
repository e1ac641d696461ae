"""Domain rules as CASE expressions generated from the rule tables."""

from __future__ import annotations

from collections.abc import Mapping

from lakegauge import schema as S

Rules = Mapping[str, S.SensorRule]


def _number(x: float) -> str:
    return f"({x!r}D)"


def _text(x: str) -> str:
    escaped = x.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def lookup(key: str, results: Mapping, otherwise: str = "NULL") -> str:
    """CASE over the values of ``key``; the results are SQL text."""
    branches = " ".join(
        f"WHEN {_text(k) if isinstance(k, str) else k} THEN {result}"
        for k, result in results.items()
    )
    return f"CASE {key} {branches} ELSE {otherwise} END"


def _between(value: str, bounds: tuple[float, float]) -> str:
    low, high = bounds
    return f"{value} BETWEEN {_number(low)} AND {_number(high)}"


def valid_range(
    sensor: str = "sensor_type", value: str = "value", rules: Rules = S.SENSOR_RULES
) -> str:
    """Inclusive range check; a sensor type without a rule is valid.

    NULL values give NULL and NaN gives false for the known types.
    """
    checks = {name: _between(value, rule.valid) for name, rule in rules.items()}
    return lookup(sensor, checks, "true")


def value_band(
    sensor: str = "sensor_type", value: str = "value", rules: Rules = S.SENSOR_RULES
) -> str:
    """``normal``, ``anomaly`` or ``between``; NULL for an unknown type."""
    bands = {
        name: band_of(value, *map(_number, rule.normal + rule.anomaly))
        for name, rule in rules.items()
    }
    return lookup(sensor, bands)


def band_of(value: str, low: str, high: str, odd_low: str, odd_high: str) -> str:
    """Band of a value given its normal and anomaly ranges."""
    return (
        f"CASE WHEN {value} IS NULL OR {low} IS NULL THEN NULL "
        f"WHEN {value} BETWEEN {low} AND {high} THEN 'normal' "
        f"WHEN {value} BETWEEN {odd_low} AND {odd_high} THEN 'anomaly' "
        "ELSE 'between' END"
    )


def alert_severity(value_valid: str = "value_valid") -> str:
    """CRITICAL only when the value is known to be out of range."""
    return f"CASE WHEN NOT {value_valid} THEN 'CRITICAL' ELSE 'WARNING' END"


def health_score(losses: Mapping[str, float]) -> str:
    """100 minus the losses, clamped to 0..100, before rounding.

    ``losses`` maps a share (SQL text) to the points lost when it is 1.
    """
    terms = "".join(f" - {_number(points)} * {x}" for x, points in losses.items())
    return f"greatest(0D, least(100D, 100D{terms}))"


def health_status(score: str = "health_score") -> str:
    """Status of an already rounded score."""
    branches = " ".join(
        f"WHEN {score} >= {_number(floor)} THEN {_text(label)}"
        for label, floor in S.STATUS_FLOORS
    )
    return f"CASE {branches} ELSE 'CRITICAL' END"
