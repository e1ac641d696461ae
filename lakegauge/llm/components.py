"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegauge.workspace import new_folder


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The rows, written to and read from the shared folder."""
    spark, root = frame.sparkSession, new_folder(frame.sparkSession, label)
    frame.write.parquet(root)
    return spark.read.schema(frame.schema).parquet(root)


def components(links: DataFrame) -> DataFrame:
    """(id, component), the smallest id reachable, for ids in links (a, b).

    Every round takes the smallest label among the neighbours and then the
    label of that label, so the rounds grow with the logarithm of the longest
    way. A round is a written table; the driver learns how many labels moved.
    """
    both = links.select("a", "b").union(links.select("b", "a")).distinct()
    both = stored(both, "links")
    labels = both.groupBy(F.col("a").alias("id")).agg(
        F.least(F.col("id"), F.min("b")).alias("component")
    )
    labels = stored(labels, "labels")
    while True:
        near = (
            both.join(labels, both["b"] == labels["id"])
            .groupBy("a")
            .agg(F.min("component").alias("near"))
        )
        nearest = labels.join(near, labels["id"] == near["a"]).select(
            "id", "component", F.least("component", "near").alias("label")
        )
        target = labels.select(
            F.col("id").alias("_id"), F.col("component").alias("_component")
        )
        moved = nearest.join(target, F.col("label") == F.col("_id")).select(
            "id",
            F.least("label", "_component").alias("component"),
            (F.least("label", "_component") < F.col("component")).alias("moved"),
        )
        moved = stored(moved, "labels")
        labels = moved.select("id", "component")
        if moved.where("moved").isEmpty():
            return labels
