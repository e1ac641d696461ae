"""Raw rows parsed once and dealt out by their outcome."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegauge.operators import cleaning
from lakegauge.operators.cleaning import CLEAN, DAMAGED, OUTCOME, REJECTED


class Outcomes:
    """The tagged rows of a raw table, in a folder by outcome.

    The lines are parsed by the job that writes the folder and not again:
    readings, rejects and counts come from its columns. Counts are those of
    the written rows, so a task that ran twice does not add to them. Nothing
    is shuffled.
    """

    def __init__(self, raw: DataFrame, folder: str) -> None:
        tagged = cleaning.with_outcome(raw)
        tagged.write.partitionBy(OUTCOME).parquet(folder)
        self.rows = raw.sparkSession.read.schema(tagged.schema).parquet(folder)

    def counts(self) -> dict[str, int]:
        found = {
            row[OUTCOME]: row["count"]
            for row in self.rows.groupBy(OUTCOME).count().collect()
        }
        return {name: found.get(name, 0) for name in (CLEAN, DAMAGED, REJECTED)}

    def usable(self) -> DataFrame:
        """Tagged rows for :func:`lakegauge.operators.cleaning.clean_tagged`."""
        return self.rows.where(F.col(OUTCOME) != REJECTED).drop(OUTCOME)

    def rejects(self) -> DataFrame:
        return cleaning.rejects_of(self.rows)
