"""Topic source. Needs the Spark topic connector on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# A micro-batch starts at 100 messages or after 30 seconds.
BATCH_MESSAGES = 100
BATCH_SECONDS = 30


def topic_options(
    servers: str,
    topic: str,
    min_messages: int = BATCH_MESSAGES,
    max_delay_seconds: int = BATCH_SECONDS,
    max_messages: int | None = None,
) -> dict[str, str]:
    """Reader options: start at the oldest message, batch by size or time."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "minOffsetsPerTrigger": str(min_messages),
        "maxTriggerDelay": f"{max_delay_seconds}s",
    }
    if max_messages is not None:
        options["maxOffsetsPerTrigger"] = str(max_messages)
    return options


def stream_topic(
    spark: SparkSession, servers: str, topic: str, **batching
) -> DataFrame:
    """Messages of a topic as a stream of key, value and arrival time."""
    reader = spark.readStream.format("kafka").options(
        **topic_options(servers, topic, **batching)
    )
    return reader.load().selectExpr("key", "value", "timestamp AS arrival")
