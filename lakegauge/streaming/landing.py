"""Raw landing of messages, and a file sink for streams in order."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakegauge.functions.timeparts import ingest_columns
from lakegauge.schema import INGEST_COLUMNS
from lakegauge.session import use_utc
from lakegauge.sinks.bronze import counts_root, lines_per_hour
from lakegauge.sources.bronze import count_segments
from lakegauge.sources.messages import MESSAGE_TEXT
from lakegauge.sources.topics import BATCH_SECONDS
from lakegauge.streaming.merging import start_batches


def start_files(
    rows: DataFrame,
    root: str,
    checkpoint: str,
    file_format: str = "parquet",
    partitions: Sequence[str] = (),
    every: str = f"{BATCH_SECONDS} seconds",
    available_now: bool = False,
) -> StreamingQuery:
    """Append a stream to files, each row exactly once.

    The checkpoint and the sink's file log make a restarted or retried
    micro-batch write the same files once. ``available_now`` drains what is
    there and stops; otherwise a micro-batch starts at each interval.
    """
    use_utc(rows.sparkSession)
    writer = (
        rows.writeStream.format(file_format)
        .outputMode("append")
        .option("path", root)
        .option("checkpointLocation", checkpoint)
    )
    if partitions:
        writer = writer.partitionBy(*partitions)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=every).start()


def raw_lines(messages: DataFrame) -> DataFrame:
    """One text line per message with its ingest partition columns.

    The message is kept as it came, readable or not, so the raw layer stays
    a full record. Only line breaks, which JSON has outside of strings alone,
    become blanks to keep one message on one line.
    """
    line_breaks = "'[\\r\\n]+'"
    return messages.selectExpr(
        f"""CASE WHEN {MESSAGE_TEXT} RLIKE {line_breaks}
            THEN regexp_replace({MESSAGE_TEXT}, {line_breaks}, ' ')
            ELSE {MESSAGE_TEXT} END AS value""",
        *ingest_columns("arrival"),
    )


def land_messages(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    available_now: bool = False,
    every: str | None = None,
) -> StreamingQuery:
    """Land a message stream as JSON lines below its arrival hour.

    A micro-batch has a directory of its own in each hour it has messages for,
    and replaces these when it is retried: a message's arrival does not change,
    so the retry writes the same ones. Nothing is shuffled and no log of files
    is kept; a reader enters an hour's directory like that of any other table.
    The lines per hour are kept beside the root, batch by batch, for
    :func:`lakegauge.sources.bronze.hour_availability`.

    By default the source says when a batch starts: a topic by its size and
    time limits. Give ``every`` for sources without such limits. A root belongs
    to streams; several may share it, each with its checkpoint.
    """
    spark = messages.sparkSession
    stream = hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]
    counts = count_segments(spark, f"{counts_root(root)}/{stream}")

    def add(batch: DataFrame, batch_id: int) -> None:
        name = F.lit(f"{stream}-{batch_id:012d}").alias("batch")
        lines = raw_lines(batch).select("*", name)
        (
            lines.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*INGEST_COLUMNS, "batch")
            .text(root)
        )
        counts.add(lines_per_hour(batch, "arrival"), batch_id)

    return start_batches(messages, add, checkpoint, available_now, every)
