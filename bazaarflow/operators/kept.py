"""Facets that are kept up batch by batch instead of being counted anew.

What only grows, rows and the highest price per category, is one small partial
per batch that is added up on reading. What follows the newest rows is a window of
those rows' few columns: a batch's newest rows push out the oldest ones.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarflow.operators.clean import serving_columns
from bazaarflow.operators.counts import facet, price_ceiling
from bazaarflow.operators.serve import latest
from bazaarflow.schema import KEY, SNAPSHOT_ROWS, TIME

_TOTALS = "category string, rows long, top_price double, batch_id long"


def partial_totals(batch: DataFrame) -> DataFrame:
    """Rows and highest price per category; partials of several batches add up to those of all rows."""
    return serving_columns(batch).groupBy("category").agg(F.count(F.lit(1)).alias("rows"), F.max("price_num").alias("top_price"))


def united_totals(partials: DataFrame) -> DataFrame:
    return partials.groupBy("category").agg(F.sum("rows").alias("rows"), F.max("top_price").alias("top_price"))


@dataclass(frozen=True)
class KeptFacets:
    """Partials and windows below ``path``, updated by one writer with ascending batch numbers.

    A repeated batch overwrites what it wrote before. The window is the newest ``rows``
    stored rows, ties in the order of ``tie_break``.
    """

    path: str
    rows: int = SNAPSHOT_ROWS
    tie_break: tuple[str, ...] = (KEY,)

    def _columns(self) -> list[str]:
        return list(dict.fromkeys([TIME, *self.tie_break, "category", "location", "price_num"]))

    def update(self, batch: DataFrame, batch_id: int) -> None:
        """Take in rows that were just stored; costs what the batch and one window cost."""
        partial_totals(batch).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/totals/batch_id={batch_id}")
        newest = latest(batch, self.rows, list(self.tie_break))  # whole rows leave before columns are derived
        entering = serving_columns(newest).select(*self._columns())
        before = self.window(batch.sparkSession, batch_id - 1)
        both = entering if before is None else before.unionByName(entering)
        latest(both, self.rows, list(self.tie_break)).write.mode("overwrite").parquet(f"{self.path}/window/batch_id={batch_id}")

    def window(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """The newest rows after a batch."""
        return None if batch_id < 0 else spark.read.parquet(f"{self.path}/window/batch_id={batch_id}")

    def totals(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """Rows and highest price per category of all rows up to a batch."""
        partials = spark.read.schema(_TOTALS).parquet(f"{self.path}/totals")
        return united_totals(partials.where(F.col("batch_id") <= batch_id))

    def side_bar(self, spark: SparkSession, batch_id: int) -> dict[str, DataFrame]:
        """The choices of the search screen after a batch, from the window alone."""
        window = self.window(spark, batch_id)
        return {"categories": facet(window, "category"), "locations": facet(window, "location"), "ceiling": price_ceiling(window)}
