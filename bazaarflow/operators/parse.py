"""Messages to listings and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarflow.schema import FEED_A, KEY, LISTING_FIELDS, TEXT_FIELDS, TIME, WIRE_NAMES, Feed

_BROKEN = "_broken"


def unify_time(df: DataFrame, time_field: str, target: str = TIME) -> DataFrame:
    """Fractional seconds become whole seconds (cut off) under the common name."""
    whole = F.col(time_field).try_cast("long").alias(target)
    kept = [F.col(name) for name in df.columns if name not in (time_field, target)]
    return df.select(*kept, whole)


def parse_messages(raw: DataFrame, feed: Feed = FEED_A, value: str = "value") -> DataFrame:
    """JSON in ``value`` to the canonical columns.

    ``raw`` keeps the text and ``broken`` holds it again when it did not fit
    the schema, so that bad messages can be set aside instead of lost.
    """
    schema = T.StructType([*feed.message_schema.fields, T.StructField(_BROKEN, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    text = raw.select(F.col(value).cast("string").alias("raw"))
    # A generator reads each message once; filters on parsed fields could
    # otherwise copy the whole parse into themselves, field by field.
    data = text.select("raw", F.inline(F.array(F.from_json("raw", schema, options))))
    flat = data.select(
        *[F.col(WIRE_NAMES[name]).alias(name) for name in TEXT_FIELDS],
        F.col(feed.time_field).alias("_time"),
        "raw",
        F.col(_BROKEN).alias("broken"),
    )
    return unify_time(flat, "_time").select(*LISTING_FIELDS, "raw", "broken")


def parse_fields(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Fields of the JSON objects in a column as columns of their own; the other columns are kept."""
    kept = [name for name in df.columns if name != column]
    return df.select(*kept, F.inline(F.array(F.from_json(column, schema))))


def accepted(parsed: DataFrame, key: str = KEY) -> DataFrame:
    return parsed.where(F.col(key).isNotNull()).select(*LISTING_FIELDS)


def rejected(parsed: DataFrame, key: str = KEY) -> DataFrame:
    """Messages without a key, with the reason."""
    reason = (
        F.when(F.col("raw").isNull(), "empty message")
        .when(F.col("broken").isNotNull(), "unreadable message")
        .otherwise("no key")
    )
    return parsed.where(F.col(key).isNull()).select("raw", reason.alias("reason"))


def to_messages(df: DataFrame, feed: Feed = FEED_A) -> DataFrame:
    """One UTF-8 JSON object per row; absent values are written as null."""
    fields = [F.col(name).alias(WIRE_NAMES[name]) for name in TEXT_FIELDS]
    time = F.col(TIME).cast(feed.time_type).alias(feed.time_field)
    body = F.to_json(F.struct(*fields, time), {"ignoreNullFields": "false"})
    return df.select(body.cast("binary").alias("value"))
