"""Posting dates written in French."""

from __future__ import annotations

import functools
import operator
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from bazaarflow.functions.text import let
from bazaarflow.schema import FULL_MONTHS, MONTHS, RECENT_DAYS, RECENT_MARKS

# (?U): the month word may hold accents, the gaps may be no-break spaces.
_DAY_MONTH_YEAR = r"(?U)[0-9]{1,2}\s+\w+\s+[0-9]{4}"


def month_number(word: Column, strict: bool) -> Column:
    """Month of a French name. Unknown words count as January.

    ``strict`` knows the short names only, so a full name is January as well.
    """
    names = MONTHS if strict else {**MONTHS, **FULL_MONTHS}
    pairs = [F.lit(item) for pair in names.items() for item in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), word), F.lit(1))


def _date_of_parts(parts: Column, strict: bool) -> Column:
    month = month_number(F.get(parts, F.lit(1)), strict)
    spelled = F.concat_ws("-", F.get(parts, F.lit(2)), month, F.get(parts, F.lit(0)))
    return F.when(F.size(parts) == 3, F.try_to_date(spelled, "y-M-d"))


def posted_date(text: Column, strict: bool = False) -> Column:
    """First "day month year" in the text; NULL if none, or not a real date."""
    parts = F.split(F.regexp_extract(text, _DAY_MONTH_YEAR, 0), r"(?U)\s+")
    return let(parts, lambda found: _date_of_parts(found, strict))


def is_recent(
    text: Column,
    as_of: datetime | str | None = None,
    days: int = RECENT_DAYS,
    strict: bool = False,
) -> Column:
    """True for today/yesterday marks, or a date not before ``as_of`` - days.

    ``as_of`` is a wall-clock time (default: now); the date counts as midnight.
    """
    now = F.localtimestamp() if as_of is None else F.lit(str(as_of)).cast("timestamp_ntz")
    bound = now - F.expr(f"interval {int(days)} days")

    def test(text: Column) -> Column:
        marked = functools.reduce(operator.or_, [text.contains(mark) for mark in RECENT_MARKS])
        return marked | F.coalesce(posted_date(text, strict).cast("timestamp_ntz") >= bound, F.lit(False))

    return F.coalesce(let(text, test), F.lit(False))
