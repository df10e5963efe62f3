"""Defaults, prices, recency and length limits."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarflow.functions.dates import is_recent
from bazaarflow.functions.text import price_number, source_key
from bazaarflow.schema import DEFAULT_CATEGORY, DEFAULT_LOCATION, MAX_LENGTHS


def fill_defaults(df: DataFrame) -> DataFrame:
    """Only NULL is filled; 'N/A' stays a value of its own."""
    return df.fillna({"location": DEFAULT_LOCATION, "category": DEFAULT_CATEGORY})


def with_price_number(df: DataFrame) -> DataFrame:
    return df.withColumn("price_num", price_number(F.col("price_text")))


def with_source_key(df: DataFrame) -> DataFrame:
    return df.withColumn("source_clean", source_key(F.col("source")))


def serving_columns(df: DataFrame) -> DataFrame:
    """Everything the search screen derives from a stored listing."""
    return with_source_key(with_price_number(fill_defaults(df)))


def recent_only(
    df: DataFrame,
    column: str = "date_text",
    as_of: datetime | str | None = None,
    strict: bool = False,
) -> DataFrame:
    return df.where(is_recent(F.col(column), as_of, strict=strict))


def too_long(limits: dict[str, int]) -> Column:
    """Names of the columns that exceed their limit."""
    names = [
        F.when(F.length(name) > size, F.lit(name)) for name, size in limits.items()
    ]
    return F.array_compact(F.array(*names))


def valid_lengths(df: DataFrame, limits: dict[str, int] = MAX_LENGTHS) -> DataFrame:
    return df.where(F.size(too_long(limits)) == 0)


def invalid_lengths(df: DataFrame, limits: dict[str, int] = MAX_LENGTHS) -> DataFrame:
    return df.select("*", too_long(limits).alias("too_long")).where(F.size("too_long") > 0)
