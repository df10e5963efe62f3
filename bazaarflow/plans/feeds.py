"""From raw input to stored listings, in batch or as a stream."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bazaarflow.operators.dedup import merged, stream_dedup
from bazaarflow.operators.flatten import flatten_sections
from bazaarflow.operators.html_items import extract_items
from bazaarflow.operators.parse import parse_messages, to_messages
from bazaarflow.schema import FEED_A, FEED_B, LISTING_FIELDS, Feed, Site
from bazaarflow.streaming.insert import Target, start_insert, storable
from bazaarflow.streaming.seen import PARTS, stream_dedup_counted


def payload_messages(payloads: DataFrame, site: Site, **options) -> DataFrame:
    """Site A: nested payloads to the messages of its feed."""
    return to_messages(flatten_sections(payloads, site, **options), FEED_A)


def page_messages(
    pages: DataFrame, site: Site, as_of: datetime | str | None = None, **options
) -> DataFrame:
    """Site B: HTML pages to the messages of its feed."""
    return to_messages(extract_items(pages, site, as_of=as_of, **options), FEED_B)


def merged_feeds(raw_a: DataFrame, raw_b: DataFrame) -> DataFrame:
    """Messages of both feeds, parsed into one frame."""
    return merged(parse_messages(raw_a, FEED_A), parse_messages(raw_b, FEED_B))


def store_feed(
    raw: DataFrame,
    feed: Feed,
    target: Target,
    checkpoint: str,
    every: str | None = "10 seconds",
) -> StreamingQuery:
    """Messages to the target; every batch is compared with all stored keys."""
    return start_insert(parse_messages(raw, feed), target, feed.name, checkpoint, every)


def store_feed_by_state(
    raw: DataFrame,
    feed: Feed,
    target: Target,
    checkpoint: str,
    every: str | None = "10 seconds",
    salts: int = 1,
    other_writers: bool = True,
) -> StreamingQuery:
    """As above with the seen keys in streaming state.

    A batch is compared with the rows of other writers only. If there are
    none (``other_writers=False``) it costs what its own rows cost, however
    large the target is. Rows that cannot be stored do not enter the state;
    ``set_aside_feed`` is the query that keeps them.
    """
    # The raw text has done its work; it doesn't travel through the state.
    fitting = parse_messages(raw, feed).where(storable()).select(*LISTING_FIELDS)
    once = stream_dedup(fitting, salts=salts)
    against = "others" if other_writers else "none"
    return start_insert(once, target, f"{feed.name}_by_state", checkpoint, every, against)


def store_feed_counted(
    raw: DataFrame,
    feed: Feed,
    target: Target,
    checkpoint: str,
    every: str | None = "10 seconds",
    limit: int = 10_000,
    keep: int = 5_000,
    parts: int = PARTS,
) -> StreamingQuery:
    """As above with a seen-set that never outgrows its limit.

    What it forgot passes again, so every batch is compared with the stored keys; the seen-set
    keeps most copies away from that.
    """
    fitting = parse_messages(raw, feed).where(storable()).select(*LISTING_FIELDS)
    once = stream_dedup_counted(fitting, limit=limit, keep=keep, parts=parts)
    return start_insert(once, target, f"{feed.name}_counted", checkpoint, every)


def store_merged_feeds(
    raw_a: DataFrame,
    raw_b: DataFrame,
    target: Target,
    checkpoint: str,
    every: str | None = "10 seconds",
) -> StreamingQuery:
    """Both feeds in one query: one writer, so a key both bring is stored once."""
    return start_insert(merged_feeds(raw_a, raw_b), target, "merged", checkpoint, every)


def unstorable(raw: DataFrame, feed: Feed) -> DataFrame:
    """Messages without a key or with values too long for the target."""
    return parse_messages(raw, feed).where(~F.coalesce(storable(), F.lit(False)))


def set_aside_feed(
    raw: DataFrame,
    feed: Feed,
    target: Target,
    checkpoint: str,
    every: str | None = "10 seconds",
) -> StreamingQuery:
    """Only the rows that cannot be stored, to the target's rejects."""
    return start_insert(unstorable(raw, feed), target, f"{feed.name}_rejects", checkpoint, every, "none")
