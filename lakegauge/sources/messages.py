"""Messages: JSON objects as UTF-8 bytes, keyed by well."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegauge import schema as S


# Bytes as text. A cast, since decoding would fail on invalid UTF-8.
MESSAGE_TEXT = "CAST(value AS STRING)"


def encode_messages(raw: DataFrame) -> DataFrame:
    """Raw rows to ``key`` and ``value`` bytes; the other columns stay.

    All eight fields are written, NULLs included.
    """
    fields = ", ".join(S.RAW_COLUMNS)
    body = f"to_json(struct({fields}), map('ignoreNullFields', 'false'))"
    others = [name for name in raw.columns if name not in S.RAW_COLUMNS]
    return raw.selectExpr(
        "CAST(well_id AS BINARY) AS key", f"CAST({body} AS BINARY) AS value", *others
    )


def decode_messages(messages: DataFrame) -> DataFrame:
    """``value`` bytes to raw rows; the text of bad JSON is kept."""
    schema = T.StructType([*S.RAW_FIELDS, T.StructField(S.CORRUPT, T.StringType())])
    parsed = F.from_json(
        F.expr(MESSAGE_TEXT),
        schema,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": S.CORRUPT},
    )
    others = [name for name in messages.columns if name not in ("key", "value")]
    return messages.select(parsed.alias("__row"), *others).select("__row.*", *others)
