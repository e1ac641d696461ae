"""Session settings the jobs are meant to run with.

None of them changes a result. Everything a result depends on (overwrite
mode, schemas, time zone) is set by the jobs themselves.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Adaptive execution sizes shuffles at run time: start with many
    # partitions, merge small ones, split hot ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    # Streaming state beyond executor memory.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Do not record a Python stack per Column operation.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def use_utc(spark: SparkSession) -> None:
    """Producers send naive UTC, so a session reads and writes times as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def build_session(
    app_name: str, cores: int | None = None, **settings: str
) -> SparkSession:
    """Session with the settings above.

    ``cores``, the cores of the whole cluster, sets the initial number of
    shuffle partitions to four per core. At 100 TB raise
    ``spark.sql.adaptive.coalescePartitions.initialPartitionNum`` so that a
    partition stays near the advisory size.
    """
    builder = SparkSession.builder.appName(app_name).config(map=SETTINGS)
    if cores is not None:
        builder = builder.config("spark.sql.shuffle.partitions", 4 * cores)
    return builder.config(map=settings).getOrCreate()
