"""HTML pages to one row per list item.

Two readers give the same columns. ``tolerant`` builds the element tree of a
page inside a Python task, so nested and unclosed markup is read rightly.
``native`` uses regular expressions only and never leaves the JVM; it is for
markup in which no list is nested in an item. Everything after the reading -
skipping ad slots, mandatory children, recency, links, defaults - is shared.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarflow.functions.dates import is_recent
from bazaarflow.functions.text import (
    decode_entities,
    let,
    markup_text,
    text_or,
    without_scripts,
)
from bazaarflow.functions.urls import resolve_image, resolve_url
from bazaarflow.operators.page_tree import (
    Node,
    child_items,
    elements,
    outer_html,
    read_page,
    text_of,
)
from bazaarflow.schema import AD_SLOT_CLASS, LISTING_FIELDS, MISSING, Site


@dataclass(frozen=True)
class ItemSpec:
    """Where things are in a page. ``None`` for a class accepts any."""

    list_tag: str = "ul"
    list_class: str | None = "cars-list"
    item_tag: str = "li"
    title_tag: str | None = "h3"  # inside the link; None takes the whole link
    date_class: str = "date"
    price_class: str = "price"
    location_class: str = "location"
    views_class: str = "views"
    image_tag: str = "img"
    image_class: str = "lazy"
    image_attribute: str = "data-original"


RAW_ITEM = (
    "item_no bigint, classes array<string>, date_html string, date_text string, "
    "has_link boolean, title string, href string, price string, location string, "
    "views string, has_image boolean, image_src string"
)
RAW_FIELDS = [field.strip().split(" ")[0] for field in RAW_ITEM.split(",")]


def read_items(
    pages: DataFrame,
    spec: ItemSpec = ItemSpec(),
    html: str = "html",
    reader: str = "tolerant",
) -> DataFrame:
    """Raw fields of every item, NULL where an element is absent."""
    if reader == "native":
        return _read_native(pages, spec, html)
    if reader == "tolerant":
        return _read_tolerant(pages, spec, html)
    raise ValueError(f"unknown reader {reader!r}")


def drop_ad_slots(items: DataFrame, css_class: str = AD_SLOT_CLASS) -> DataFrame:
    return items.where(~F.array_contains("classes", css_class))


def with_mandatory(items: DataFrame, date: bool = True) -> DataFrame:
    """Keep items that have a link and, unless waived, a date element."""
    kept = items.where(F.col("has_link"))
    return kept.where(F.col("date_html").isNotNull()) if date else kept


def extract_items(
    pages: DataFrame,
    site: Site,
    spec: ItemSpec = ItemSpec(),
    reader: str = "tolerant",
    as_of: datetime | str | None = None,
    strict_months: bool = False,
    scraped_at: str | None = None,
) -> DataFrame:
    """Listings of pages ``(category, html)``, recent ones only."""
    stamp = F.col(scraped_at) if scraped_at else F.unix_timestamp()
    narrow = pages.select("category", stamp.alias("scraped_at"), "html")
    items = with_mandatory(drop_ad_slots(read_items(narrow, spec, reader=reader)))
    recent = items.where(is_recent(F.col("date_html"), as_of, strict=strict_months))
    return recent.select(
        F.lit(site.tag).alias("source"),
        "category",
        text_or(F.col("views"), F.col("category")).alias("subcategory"),
        text_or(F.col("title"), MISSING).alias("title"),
        text_or(F.col("price"), MISSING).alias("price_text"),
        text_or(F.col("location"), MISSING).alias("location"),
        resolve_url(text_or(F.col("href"), ""), site.base_url).alias("url"),
        resolve_image(F.col("has_image"), F.col("image_src"), site.base_url).alias("image_url"),
        "date_text",
        "scraped_at",
    ).select(*LISTING_FIELDS)


# --- tolerant reader ---------------------------------------------------------

_ROWS_PER_CHUNK = 4096
_ARROW_TYPES = [
    pa.int64(), pa.list_(pa.string()), pa.string(), pa.string(),
    pa.bool_(), pa.string(), pa.string(), pa.string(), pa.string(),
    pa.string(), pa.bool_(), pa.string(),
]


def _item_row(number: int, item: Node, spec: ItemSpec) -> tuple:
    """The first element of each kind, found in one walk over the item."""
    by_class = {
        spec.date_class: None, spec.price_class: None,
        spec.location_class: None, spec.views_class: None,
    }
    link = image = None
    for node in elements(item):
        for css_class in node.classes:
            if css_class in by_class and by_class[css_class] is None:
                by_class[css_class] = node
        if link is None and node.tag == "a":
            link = node
        if image is None and node.tag == spec.image_tag and spec.image_class in node.classes:
            image = node
    title = link
    if link is not None and spec.title_tag:
        title = next((node for node in elements(link) if node.tag == spec.title_tag), None)
    date = by_class[spec.date_class]
    return (
        number,
        item.classes,
        outer_html(date),
        text_of(date),
        link is not None,
        text_of(title),
        link.attributes.get("href") if link is not None else None,
        text_of(by_class[spec.price_class]),
        text_of(by_class[spec.location_class]),
        text_of(by_class[spec.views_class]),
        image is not None,
        image.attributes.get(spec.image_attribute) if image is not None else None,
    )


def _read_tolerant(pages: DataFrame, spec: ItemSpec, html: str) -> DataFrame:
    kept = [name for name in pages.columns if name != html]
    kept_types = [f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema if f.name != html]

    def assemble(batch: pa.RecordBatch, at: list[int], rows: list[tuple]) -> pa.RecordBatch:
        sides = [batch.column(name).take(pa.array(at, pa.int32())) for name in kept]
        fields = [pa.array(column, kind) for column, kind in zip(zip(*rows), _ARROW_TYPES)]
        return pa.RecordBatch.from_arrays(sides + fields, kept + RAW_FIELDS)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = [], []
            for index, text in enumerate(batch.column(html)):
                if not text.is_valid:
                    continue
                root = _root_of(text.as_py())
                if root is None:
                    continue
                items = child_items(root, spec.list_tag, spec.list_class, spec.item_tag)
                for number, item in enumerate(items):
                    at.append(index)
                    rows.append(_item_row(number, item, spec))
                    if len(rows) == _ROWS_PER_CHUNK:
                        yield assemble(batch, at, rows)
                        at, rows = [], []
            if rows:
                yield assemble(batch, at, rows)

    return pages.select(*kept, html).mapInArrow(read, ", ".join([*kept_types, RAW_ITEM]))


def _root_of(html: str) -> Node | None:
    """The page's tree; None if the parser gives up on it."""
    try:
        return read_page(html)
    except (AssertionError, ValueError, IndexError):
        return None


def rejected_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Pages the tolerant reader can't read, with the reason; the other columns are kept."""
    kept = [name for name in pages.columns if name != html]
    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema if f.name != html]

    def failed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(html).to_pylist()
            at = [n for n, text in enumerate(texts) if text is None or _root_of(text) is None]
            reasons = ["no text" if texts[n] is None else "unreadable markup" for n in at]
            sides = [batch.column(name).take(pa.array(at, pa.int32())) for name in kept]
            yield pa.RecordBatch.from_arrays([*sides, pa.array(reasons, pa.string())], [*kept, "reason"])

    return pages.select(*kept, html).mapInArrow(failed, ", ".join([*types, "reason string"]))


# --- native reader -----------------------------------------------------------

_CLASS_OF = r"""(?is)^<\w+\b[^>]*?\sclass\s*=\s*["']([^"']*)["']"""


def _class_test(css_class: str) -> str:
    return rf"""(?=[^>]*?\sclass\s*=\s*["'](?:[^"']*\s)?{re.escape(css_class)}(?:\s[^"']*)?["'])"""


def _found(source: Column, pattern: str) -> Column:
    """The first match, NULL if there is none. Patterns never match nothing."""
    return F.nullif(F.regexp_extract(source, pattern, 0), F.lit(""))


def _by_tag(source: Column, tag: str) -> Column:
    return _found(source, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>")


def _by_class(source: Column, css_class: str) -> Column:
    return _found(source, rf"(?is)<(\w+)\b{_class_test(css_class)}[^>]*>.*?</\1\s*>")


def _attribute(element: Column, name: str) -> Column:
    """An attribute of the element's own tag; NULL when it is not there."""
    pattern = rf"""(?is)^<[^>]*?\s{name}\s*=\s*("[^"]*"|'[^']*')"""
    quoted = F.nullif(F.regexp_extract(element, pattern, 1), F.lit(""))
    bare = let(quoted, lambda text: F.substring(text, 2, F.length(text) - 2))
    return let(bare, decode_entities)


def _read_native(pages: DataFrame, spec: ItemSpec, html: str) -> DataFrame:
    kept = [name for name in pages.columns if name != html]
    of_class = _class_test(spec.list_class) if spec.list_class else ""
    list_pattern = rf"(?is)<{spec.list_tag}\b{of_class}[^>]*>(.*?)</{spec.list_tag}\s*>"
    item_pattern = rf"(?is)(<{spec.item_tag}\b[^>]*>.*?)</{spec.item_tag}\s*>"
    lists = F.regexp_extract_all(without_scripts(F.col(html)), F.lit(list_pattern), F.lit(1))
    found = F.flatten(
        F.transform(lists, lambda body: F.regexp_extract_all(body, F.lit(item_pattern), F.lit(1)))
    )
    items = pages.select(*kept, F.posexplode(found).alias("item_no", "item"))
    item = F.col("item")
    inner = F.regexp_replace(item, r"(?s)^<[^>]*>", "")
    image_pattern = rf"(?is)<{spec.image_tag}\b{_class_test(spec.image_class)}[^>]*>"
    elements = F.struct(
        F.split(F.regexp_extract(item, _CLASS_OF, 1), r"\s+").alias("classes"),
        _by_class(inner, spec.date_class).alias("date"),
        _by_tag(inner, "a").alias("link"),
        _by_class(inner, spec.price_class).alias("price"),
        _by_class(inner, spec.location_class).alias("location"),
        _by_class(inner, spec.views_class).alias("views"),
        _found(inner, image_pattern).alias("image"),
    )
    # A generator, so that filters above cannot copy the patterns into
    # themselves and run them again for every use.
    parts = items.select(*kept, "item_no", F.inline(F.array(elements)))
    title = _by_tag(F.col("link"), spec.title_tag) if spec.title_tag else F.col("link")
    fields = F.struct(
        F.col("item_no").cast("long").alias("item_no"),
        "classes",
        decode_entities(F.col("date")).alias("date_html"),
        markup_text(F.col("date")).alias("date_text"),
        F.col("link").isNotNull().alias("has_link"),
        markup_text(title).alias("title"),
        _attribute(F.col("link"), "href").alias("href"),
        markup_text(F.col("price")).alias("price"),
        markup_text(F.col("location")).alias("location"),
        markup_text(F.col("views")).alias("views"),
        F.col("image").isNotNull().alias("has_image"),
        _attribute(F.col("image"), spec.image_attribute).alias("image_src"),
    )
    return parts.select(*kept, F.inline(F.array(fields)))


# --- single fields of a page -------------------------------------------------


def page_field(html: Column, tag: str, default: str = MISSING) -> Column:
    """Text of the first element with this tag."""
    return text_or(markup_text(_by_tag(without_scripts(html), tag)), default)


def page_attribute(html: Column, tag: str, name: str) -> Column:
    return _attribute(_found(html, rf"(?is)<{tag}\b[^>]*>"), name)


def page_class_text(html: Column, css_class: str, fallback: Column) -> Column:
    """Text of the first element with this class, or another column."""
    return text_or(markup_text(_by_class(without_scripts(html), css_class)), fallback)
