"""Bounded sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarflow.sources.streams import open_files


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def table_stream(
    spark: SparkSession, folder: str, name: str, files_per_batch: int | None = None
) -> DataFrame:
    """The same table as a stream, whether it is one file or a folder of files."""
    schema = table(spark, folder, name).schema
    # The pattern matches the one name; a file is accepted as a pattern only.
    return open_files(spark, f"{folder}/{name}.[p]arquet", schema, files_per_batch=files_per_batch)


def pages(df: DataFrame, categories: dict[str, str]) -> DataFrame:
    """Stored pages with their category, all categories in one scan.

    ``categories`` maps a category to what the ``page_url`` of its pages starts
    with; the first one that fits counts, other pages are left out.
    """
    category = F.lit(None).cast("string")
    for name, address in reversed(categories.items()):
        category = F.when(F.col("page_url").startswith(address), F.lit(name)).otherwise(category)
    return df.withColumn("category", category).where(F.col("category").isNotNull())
