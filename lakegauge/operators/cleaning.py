"""Raw readings to clean readings and rejects."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegauge import schema as S
from lakegauge.functions.labels import valid_range
from lakegauge.functions.timeparts import parse_instant

REASON = "reject_reason"
BAD_FIELD = "bad_field"
OUTCOME = "outcome"
CLEAN, DAMAGED, REJECTED = "clean", "damaged", "rejected"


def _replaced(df: DataFrame, **expressions: str) -> DataFrame:
    """All columns in order, some computed anew; unknown names are added."""
    kept = [
        f"{expressions[name]} AS {name}" if name in expressions else name
        for name in df.columns
    ]
    new = [name for name in expressions if name not in df.columns]
    return df.selectExpr(*kept, *[f"{expressions[name]} AS {name}" for name in new])


def _blank_to_null(text: str) -> str:
    return f"nullif(trim({text}), '')"


def normalise_strings(raw: DataFrame) -> DataFrame:
    """Trim ids, trim and lower sensor types; blank becomes NULL.

    Only spaces are trimmed. The other text columns stay as sent.
    """
    return _replaced(
        raw,
        well_id=_blank_to_null("well_id"),
        sensor_type=_blank_to_null("lower(sensor_type)"),
    )


def parse_timestamps(raw: DataFrame) -> DataFrame:
    """Replace the timestamp string by a timestamp, NULL when unreadable."""
    return _replaced(raw, timestamp=parse_instant("trim(timestamp)"))


def reject_reason(columns: list[str]) -> str:
    """Why a normalised raw row is unusable, NULL for a usable one.

    ``malformed``: the line was no JSON object. ``null_key``: well, sensor or
    timestamp missing. ``bad_timestamp``: present but unreadable.
    ``bad_value``: missing, not a number in JSON, or NaN.
    """
    cases = {
        "null_key": "well_id IS NULL OR sensor_type IS NULL "
        f"OR {_blank_to_null('timestamp')} IS NULL",
        "bad_timestamp": f"{parse_instant('trim(timestamp)')} IS NULL",
        "bad_value": "value IS NULL OR isnan(value)",
    }
    if S.CORRUPT in columns:
        fields = ", ".join(f"CAST({name} AS STRING)" for name in S.RAW_COLUMNS)
        unreadable = f"{S.CORRUPT} IS NOT NULL AND coalesce({fields}) IS NULL"
        cases = {"malformed": unreadable, **cases}
    branches = " ".join(f"WHEN {when} THEN '{name}'" for name, when in cases.items())
    return f"CASE {branches} END"


def tag_rejects(raw: DataFrame) -> DataFrame:
    """Normalised raw rows with a ``reject_reason`` column."""
    normal = normalise_strings(raw)
    return _replaced(normal, **{REASON: reject_reason(normal.columns)})


def with_outcome(raw: DataFrame) -> DataFrame:
    """Tagged rows with their outcome: ``clean``, ``rejected``, or ``damaged``
    for a usable row with an optional field that the parser could not take.

    The parser gives the text of a line with any such field in ``CORRUPT``;
    unless the row is unusable for it, the others of its fields are good.
    """
    tagged = tag_rejects(raw)
    damaged = f"{S.CORRUPT} IS NOT NULL" if S.CORRUPT in tagged.columns else "false"
    return tagged.selectExpr(
        "*",
        f"""CASE WHEN {REASON} IS NOT NULL THEN '{REJECTED}'
            WHEN {damaged} THEN '{DAMAGED}' ELSE '{CLEAN}' END AS {OUTCOME}""",
    )


def rejects_of(outcomes: DataFrame) -> DataFrame:
    """Rows with a reason and their raw text: those that cleaning leaves out,
    and with ``bad_field`` the damaged ones, which are readings all the same."""
    left = outcomes.where(f"{OUTCOME} <> '{CLEAN}'")
    return _replaced(left, **{REASON: f"coalesce({REASON}, '{BAD_FIELD}')"}).drop(
        OUTCOME
    )


def rejects(raw: DataFrame) -> DataFrame:
    """Rows that cleaning leaves out or takes without a field, each with its
    reason and raw text."""
    return rejects_of(with_outcome(raw))


def field_errors(raw: DataFrame) -> DataFrame:
    """One row per declared field whose text the parser could not take:
    ``field`` and ``text`` beside the line and what it has of the reading's key.

    Only lines with such a field are looked at again, as variants, which keep
    a field's own type. Lines that are no JSON object have no fields.
    """
    lines = raw.where(f"{S.CORRUPT} IS NOT NULL").selectExpr(
        "*", f"try_parse_json({S.CORRUPT}) AS line"
    )
    sent = {n: f"try_variant_get(line, '$.{n}', 'string')" for n in S.RAW_COLUMNS}
    lost = ", ".join(
        f"if({n} IS NULL, struct('{n}' AS field, {text} AS text), NULL)"
        for n, text in sent.items()
    )
    return lines.selectExpr(
        *[f"coalesce({n}, {sent[n]}) AS {n}" for n in S.READING_KEY],
        f"{S.CORRUPT} AS raw_text",
        f"inline(filter(array({lost}), e -> e.text IS NOT NULL))",
    )


def drop_incomplete(parsed: DataFrame) -> DataFrame:
    """Keep rows whose required fields are all present; NaN counts as missing."""
    return parsed.na.drop(subset=S.REQUIRED)


def flag_valid(readings: DataFrame) -> DataFrame:
    """Add ``value_valid``. Out-of-range readings are flagged, never dropped."""
    return _replaced(readings, value_valid=valid_range())


def add_audit(
    readings: DataFrame,
    processed_at: datetime | Column,
    version: str = S.SILVER_VERSION,
) -> DataFrame:
    """Stamp rows with the run time and the layout version."""
    return readings.withColumns(
        {
            "processed_at": F.lit(processed_at).cast("timestamp"),
            "silver_version": F.lit(version),
        }
    )


def clean_tagged(tagged: DataFrame, processed_at: datetime | Column) -> DataFrame:
    """Clean readings from rows already tagged by :func:`tag_rejects`."""
    usable = parse_timestamps(tagged.where(f"{REASON} IS NULL"))
    return add_audit(flag_valid(usable.drop(REASON, S.CORRUPT)), processed_at)


def clean(raw: DataFrame, processed_at: datetime | Column) -> DataFrame:
    """Normalise, parse, drop incomplete, flag and stamp. Works on streams."""
    usable = drop_incomplete(parse_timestamps(normalise_strings(raw)))
    return add_audit(flag_valid(usable.drop(S.CORRUPT)), processed_at)
