"""The search screen over stored listings."""

from __future__ import annotations

from pyspark.sql import DataFrame

from bazaarflow.operators.clean import serving_columns
from bazaarflow.operators.counts import facet, price_ceiling
from bazaarflow.operators.serve import cards, latest_of_table, search
from bazaarflow.schema import SNAPSHOT_ROWS


def snapshot(stored: DataFrame, rows: int = SNAPSHOT_ROWS, tie_break: list[str] | None = None) -> DataFrame:
    """Newest rows first, then defaults and derived columns on those only."""
    return serving_columns(latest_of_table(stored, rows, tie_break))


def found_cards(
    served: DataFrame,
    tag: str,
    matching: str,
    other: str,
    tie_break: list[str] | None = None,
    **criteria,
) -> DataFrame:
    """Cards of those rows of a snapshot that meet the criteria."""
    return cards(search(served, **criteria), tag, matching, other, tie_break)


def result_cards(
    stored: DataFrame,
    tag: str,
    matching: str,
    other: str,
    tie_break: list[str] | None = None,
    rows: int = SNAPSHOT_ROWS,
    **criteria,
) -> DataFrame:
    served = snapshot(stored, rows, tie_break)
    return found_cards(served, tag, matching, other, tie_break, **criteria)


def side_bar(served: DataFrame) -> dict[str, DataFrame]:
    """Choices of the search screen, all from the snapshot: categories, locations, ceiling and row count."""
    return {
        "categories": facet(served, "category"),
        "locations": facet(served, "location"),
        "ceiling": price_ceiling(served),
    }
