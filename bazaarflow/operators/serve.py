"""What the search screen shows: newest rows, filters, cards."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarflow.functions.text import any_of, badge, shown_date, shown_image, shown_price
from bazaarflow.schema import ALL_LABEL, GRID_COLUMNS, KEY, SNAPSHOT_ROWS, TIME


def newest_first(tie_break: list[str], time: str = TIME) -> list:
    return [F.desc_nulls_last(time), *[F.asc_nulls_last(name) for name in tie_break]]


def latest(
    df: DataFrame,
    rows: int = SNAPSHOT_ROWS,
    tie_break: list[str] | None = None,
    time: str = TIME,
) -> DataFrame:
    """The newest rows. Each task keeps its own best ``rows``; nothing is sorted whole."""
    return df.orderBy(*newest_first(tie_break or [KEY], time)).limit(rows)


def _reached(stored: DataFrame, at: Column, rows: int) -> str | None:
    """The latest value that at least ``rows`` rows lie at or after, as text.

    Rows are counted per value before they are brought together, and every
    value has a row, so ``rows`` values are all that has to be looked at.
    """
    per_value = stored.where(at.isNotNull()).groupBy(at.alias("_at")).agg(F.count(F.lit(1)).alias("_n"))
    newest = per_value.orderBy(F.desc("_at")).limit(rows).select(F.col("_at").cast("string"), "_n")
    total = 0
    for value, count in newest.collect():
        total += count
        if total >= rows:
            return value
    return None


def latest_of_table(
    stored: DataFrame,
    rows: int = SNAPSHOT_ROWS,
    tie_break: list[str] | None = None,
    time: str = TIME,
) -> DataFrame:
    """The same for a large table: first the day, then the exact time that
    ``rows`` rows reach, and only rows from there on are sorted.

    ``latest`` sends ``rows`` whole rows of every task to one; here the first
    two scans read the time column alone, and the last one has the time as a
    pushed filter, which also skips older row groups. ``time`` is a number of
    seconds or a TIMESTAMP_NTZ.
    """
    kind = stored.schema[time].dataType
    at = F.col(time)
    numeric = isinstance(kind, T.NumericType)
    day = (F.floor(at / 86400) * 86400).cast(kind) if numeric else F.to_date(at)
    for step in (day, at):
        start = _reached(stored, step, rows)
        if start is None:  # fewer rows have a time
            break
        stored = stored.where(at >= F.lit(start).cast(kind))
    return latest(stored, rows, tie_break, time)


def by_category(df: DataFrame, category: str = ALL_LABEL) -> DataFrame:
    return df if category == ALL_LABEL else df.where(F.col("category") == category)


def by_location(df: DataFrame, location: str = ALL_LABEL) -> DataFrame:
    return df if location == ALL_LABEL else df.where(F.col("location") == location)


def by_sources(df: DataFrame, sources: list[str] | None = None) -> DataFrame:
    """Source contains any of the given texts in any letter case; none given means all rows."""
    if not sources:
        return df
    return df.where(F.lower("source").rlike(any_of(re.escape(text.lower()) for text in sources)))


def by_budget(df: DataFrame, budget: float | None = None) -> DataFrame:
    """Up to and including the budget; an unknown price is 0 and passes."""
    return df if budget is None else df.where(F.col("price_num") <= F.lit(budget))


def by_keyword(df: DataFrame, keyword: str = "", literal: bool = False) -> DataFrame:
    """Title matches the expression in any letter case, accents included."""
    if not keyword:
        return df
    pattern = "(?iU)" + (re.escape(keyword) if literal else keyword)
    return df.where(F.coalesce(F.col("title").rlike(pattern), F.lit(False)))


def search(
    df: DataFrame,
    category: str = ALL_LABEL,
    location: str = ALL_LABEL,
    sources: list[str] | None = None,
    budget: float | None = None,
    keyword: str = "",
    literal: bool = False,
) -> DataFrame:
    """All criteria together; those left at their default filter nothing."""
    df = by_location(by_category(df, category), location)
    df = by_budget(by_sources(df, sources), budget)
    return by_keyword(df, keyword, literal)


def cards(
    df: DataFrame,
    tag: str,
    matching: str,
    other: str,
    tie_break: list[str] | None = None,
    columns: int = GRID_COLUMNS,
) -> DataFrame:
    """Display values of a search result, dealt out over the grid columns.

    ``df`` comes from a snapshot, whose rows are bounded, so the numbering
    window, which has no partitions, is no larger than that.
    """
    order = newest_first(tie_break or [KEY])
    place = F.row_number().over(W.orderBy(*order)) - 1
    return df.select(
        place.cast("long").alias("place"),
        (place % columns).cast("long").alias("slot"),
        shown_image(F.col("image_url")).alias("image"),
        badge(F.col("source"), tag, matching, other).alias("badge"),
        "source",
        "title",
        shown_price(F.col("price_text")).alias("price"),
        "location",
        shown_date(F.col("date_text")).alias("date"),
        "url",
    )
