"""Timestamps: parsing, ingest partition columns and hour arithmetic."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from lakegauge.schema import INGEST_COLUMNS

# Date and time of day are both required: Spark would otherwise read a bare
# time as today and a bare year as its first of January.
_DATE_AND_TIME = "^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}"

# The directory formats of the ingest partition columns.
_INGEST_FORMATS = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}


def parse_instant(text: str) -> str:
    """ISO-8601 text to a timestamp, NULL when it is not one.

    Accepts a missing fraction and zone suffixes; zone-less text is read in
    the session zone (UTC).
    """
    return (
        f"CASE WHEN {text} RLIKE '{_DATE_AND_TIME}' THEN try_to_timestamp({text}) END"
    )


def ingest_columns(arrival: str) -> list[str]:
    """Zero-padded year, month, day and hour strings of the arrival time."""
    return [
        f"date_format({arrival}, '{_INGEST_FORMATS[name]}') AS {name}"
        for name in INGEST_COLUMNS
    ]


def hour_bucket(instant: str) -> str:
    """Start of the hour an instant falls into."""
    return f"date_trunc('hour', {instant})"


def ingest_hour() -> str:
    """Timestamp of the ingest partition a row was read from."""
    columns = ", ".join(INGEST_COLUMNS)
    return f"to_timestamp(concat_ws(' ', {columns}), 'yyyy MM dd HH')"


def previous_hour(now: datetime | None = None) -> datetime:
    """Start of the last complete hour, the default batch window."""
    now = now or datetime.now(timezone.utc)
    return now.replace(minute=0, second=0, microsecond=0) - timedelta(hours=1)


def ingest_values(moment: datetime) -> dict[str, str]:
    """Partition column values of a moment, as written in directory names."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc)
    return {
        "year": f"{moment.year:04d}",
        "month": f"{moment.month:02d}",
        "day": f"{moment.day:02d}",
        "hour": f"{moment.hour:02d}",
    }


def ingest_path(root: str, moment: datetime, scope: str = "hour") -> str:
    """Directory of an ingest hour (``scope="hour"``) or day (``"day"``)."""
    values = ingest_values(moment)
    parts = [f"{name}={values[name]}" for name in _scope_columns(scope)]
    return "/".join([root.rstrip("/"), *parts])


def in_ingest_scope(moment: datetime, scope: str = "hour") -> str:
    """Filter on the partition columns only, so that it prunes directories."""
    values = ingest_values(moment)
    return " AND ".join(f"{name} = '{values[name]}'" for name in _scope_columns(scope))


def _scope_columns(scope: str) -> list[str]:
    depths = {"day": 3, "hour": 4}
    if scope not in depths:
        raise ValueError(f"scope must be one of {sorted(depths)}, not {scope!r}")
    return INGEST_COLUMNS[: depths[scope]]
