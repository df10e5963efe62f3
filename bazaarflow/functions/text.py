"""Text, price and markup expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from html import unescape
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from bazaarflow.schema import (
    MISSING,
    NO_IMAGE_URL,
    NO_PRICE_LABEL,
)

# Named references by the standard library's table: those that end in a semicolon, and old ones that need none.
_NAMED = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}
_BARE = sorted((name for name in html5 if not name.endswith(";")), key=lambda name: (-len(name), name))
# Numbers that don't stand for the character with that code point.
_PLANES = [plane << 16 | end for plane in range(17) for end in (0xFFFE, 0xFFFF)]
_ODD = {n: unescape(f"&#{n};") for n in (*range(160), *range(0xFDD0, 0xFDF0), *_PLANES) if unescape(f"&#{n};") != chr(n)}
_BEYOND = 0x110000


def price_number(price: Column) -> Column:
    """All digits of the text glued into one number; 0.0 when there are none."""
    digits = F.regexp_replace(price, "[^0-9]", "")
    return F.coalesce(digits.try_cast("double"), F.lit(0.0))


def source_key(source: Column) -> Column:
    return F.replace(F.lower(F.coalesce(source, F.lit("None"))), F.lit(" "), F.lit(""))


def text_or(text: Column, default: Column | str) -> Column:
    return F.coalesce(text, default if isinstance(default, Column) else F.lit(default))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _map(entries: dict) -> Column:
    """A literal map."""
    return F.str_to_map(F.lit("\x02".join(f"{key}\x01{value}" for key, value in entries.items())), F.lit("\x02"), F.lit("\x01"))


def _character(number: Column) -> Column:
    odd = F.element_at(_map(_ODD), number.cast("string"))
    plain = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    none = number.between(0xD800, 0xDFFF) | (number >= _BEYOND)
    return F.when(none, F.lit("\ufffd")).otherwise(F.coalesce(odd, plain))


def _reference(after: Column) -> Column:
    """What follows an ampersand, with the character reference it may begin with decoded."""
    numeric = F.regexp_extract(after, r"^#(?:[0-9]+|[xX][0-9a-fA-F]+);?", 0)
    decimal = F.regexp_extract(after, r"^#0*([0-9]+)", 1)
    hexadecimal = F.regexp_extract(after, r"^#[xX]0*([0-9a-fA-F]+)", 1)
    # Longer numbers lie beyond all code points.
    number = (
        F.when((F.length(decimal) > 7) | (F.length(hexadecimal) > 6), _BEYOND)
        .when(decimal != "", decimal.try_cast("int")).otherwise(F.conv(hexadecimal, 16, 10).try_cast("int"))
    )
    name = F.regexp_extract(after, r"^([^\t\n\f <&#;]{1,32});", 1)
    known = F.element_at(_map(_NAMED), name)
    bare = F.regexp_extract(after, "^(?:" + "|".join(_BARE) + ")", 0)
    old = F.element_at(_map({n: html5[n] for n in _BARE}), bare)

    def decoded(character: Column, length: Column) -> Column:
        return F.concat(character, F.substr(after, length + 1))

    return (
        F.when(numeric != "", decoded(_character(number), F.length(numeric)))
        .when((name != "") & known.isNotNull(), decoded(known, F.length(name) + 1))
        .when(bare != "", decoded(old, F.length(bare)))
        .otherwise(F.concat(F.lit("&"), after))
    )


def decode_entities(text: Column) -> Column:
    """All character references decoded as a browser and the tolerant reader do, each once."""
    parts = F.split(text, "&", -1)
    rest = F.transform(F.slice(parts, F.lit(2), F.size(parts)), _reference)
    decoded = F.array_join(F.concat(F.slice(parts, 1, 1), rest), "")
    return F.when(text.contains("&"), decoded).otherwise(text)


def strip(text: Column) -> Column:
    """Trim every kind of Unicode white space, not blanks only."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def markup_text(html: Column) -> Column:
    """Text of an element or its inside: each text node stripped, then glued."""
    nodes = F.split(html, r"<[^>]*>")
    return F.array_join(F.transform(nodes, lambda node: strip(decode_entities(node))), "")


def without_scripts(html: Column) -> Column:
    """Drop comments, scripts and styles, whose content only looks like markup."""
    return F.regexp_replace(
        html, r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>", ""
    )


def shown_price(price: Column) -> Column:
    return F.when(price.isin(MISSING, "", "0"), F.lit(NO_PRICE_LABEL)).otherwise(price)


def shown_image(image: Column) -> Column:
    return F.when(
        F.coalesce(image, F.lit("")).isin("", MISSING), F.lit(NO_IMAGE_URL)
    ).otherwise(image)


def shown_date(date_text: Column) -> Column:
    return F.substring(date_text, 1, 10)


def badge(source: Column, tag: str, matching: str, other: str) -> Column:
    return F.when(F.lower(source).contains(tag.lower()), F.lit(matching)).otherwise(F.lit(other))


def label(text: Column, size: int) -> Column:
    return F.substring(text, 1, size)


def any_of(patterns: Iterable[str]) -> str:
    return "|".join(patterns)
