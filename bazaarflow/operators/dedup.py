"""One row per key: in a batch, along a stream, against stored rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bazaarflow.schema import KEY, TIME


def first_per_key(
    df: DataFrame, key: str = KEY, order: list[Column | str] | None = None
) -> DataFrame:
    """The earliest row of each key; NULL keys form one group.

    Equal times fall back on all other columns, so the result is reproducible.
    ``row_number() = 1`` makes Spark keep one row per key in every task before
    the shuffle, so a key that holds a third of the rows is no hot spot.
    """
    if order is None:
        rest = [name for name in df.columns if name not in (key, TIME)]
        order = [F.asc_nulls_last(name) for name in [TIME, *rest]]
    rank = F.row_number().over(W.partitionBy(key).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def collated(key: Column | str, collation: str) -> Column:
    """The key as a database compares it: equal where the collation has no difference (``UTF8_LCASE``, ``UNICODE_CI_AI`` and so on)."""
    return F.collate(F.col(key) if isinstance(key, str) else key, collation)


def first_per_collated_key(df: DataFrame, key: str = KEY, collation: str = "UTF8_LCASE", order: list[Column | str] | None = None) -> DataFrame:
    """The earliest row of each key, where keys that differ in letter case (or accents) only are one key.

    Rows keep the key as they spell it; equal times go by the spelling, then by all other columns.
    """
    if order is None:
        rest = [name for name in df.columns if name not in (key, TIME)]
        order = [F.asc_nulls_last(name) for name in [TIME, key, *rest]]
    rank = F.row_number().over(W.partitionBy(collated(key, collation)).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def drop_known_collated(batch: DataFrame, target: DataFrame, key: str = KEY, collation: str = "UTF8_LCASE") -> DataFrame:
    """Rows whose key the target has in no spelling that the collation takes for the same. Rows without a key never pass."""
    stored = target.where(F.col(key).isNotNull()).select(collated(key, collation).alias("_known"))
    keyed = batch.where(F.col(key).isNotNull()).withColumn("_key", collated(key, collation))
    return keyed.join(stored, F.col("_key") == F.col("_known"), "left_anti").select(*batch.columns)


def stream_dedup_collated(stream: DataFrame, key: str = KEY) -> DataFrame:
    """A key in any letter case passes once along a stream. State compares bytes, so it holds the lower-case key."""
    return stream.withColumn("_lower", F.lower(key)).dropDuplicates(["_lower"]).drop("_lower")


def stream_dedup(stream: DataFrame, key: str = KEY, salts: int = 1) -> DataFrame:
    """A key once let through never passes again; state grows with the keys.

    With ``salts`` above 1 rows are first reduced per key and salt, a hash of
    the whole row, so that a very frequent key is spread over that many state tasks
    and at most that many of its rows ever reach the second, exact step.
    """
    if salts > 1:
        salt = F.pmod(F.xxhash64(*stream.columns), F.lit(salts))
        stream = stream.withColumn("_salt", salt).dropDuplicates([key, "_salt"]).drop("_salt")
    return stream.dropDuplicates([key])


def stream_dedup_bounded(
    stream: DataFrame, event_time: str, delay: str = "3 days", key: str = KEY
) -> DataFrame:
    """As above, but a key is forgotten once the watermark has passed it.

    ``event_time`` must be a TIMESTAMP; duplicates further apart than
    ``delay`` can both pass.
    """
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def with_event_time(df: DataFrame, seconds: str = TIME, name: str = "event_time") -> DataFrame:
    return df.withColumn(name, F.timestamp_seconds(seconds))


def distinct_keys(df: DataFrame, key: str = KEY) -> DataFrame:
    return df.select(key).distinct()


def known_keys(batch: DataFrame, target: DataFrame, key: str = KEY) -> DataFrame:
    """Stored keys that the batch brings again, each once."""
    stored = target.select(key).where(F.col(key).isNotNull())
    return stored.join(distinct_keys(batch, key), key, "left_semi").distinct()


def drop_known(
    batch: DataFrame, target: DataFrame, key: str = KEY, salts: int = 1
) -> DataFrame:
    """Rows whose key is not stored yet. Rows without a key never pass.

    Only the key column of the target is read. A very frequent batch key is
    split by adaptive execution; where that is off, ``salts`` spreads each key
    over that many tasks. Only known keys, at most one per batch key, are
    repeated for it.
    """
    keyed = batch.where(F.col(key).isNotNull())
    if salts == 1:
        stored = target.select(key).where(F.col(key).isNotNull())
        return keyed.join(stored, key, "left_anti").select(*batch.columns)
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    known = known_keys(batch, target, key).withColumn("_salt", every_salt)
    salted = keyed.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)))
    return salted.join(known, [key, "_salt"], "left_anti").select(*batch.columns)


def new_keys(batch: DataFrame, target: DataFrame, key: str = KEY) -> DataFrame:
    """Except by key: distinct batch keys that are not stored."""
    return drop_known(distinct_keys(batch, key), target, key)


def merged(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of both feeds in one table, matched by column name."""
    return first.unionByName(second)
