"""Streaming operators and sinks as queries over whole tables.

The streams read the given tables and run until those are used up. Results
are written below the shared working folder and read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarflow.operators import dedup, parse
from bazaarflow.plans import example_listings as example
from bazaarflow.plans.checked import FIELDS, STORED, checked, over_listings
from bazaarflow.plans.feeds import (
    set_aside_feed,
    store_feed,
    store_feed_by_state,
    store_merged_feeds,
)
from bazaarflow.schema import FEED_A, FEED_B, LISTING_FIELDS
from bazaarflow.sources.scratch import working_folder
from bazaarflow.sources.tables import table_stream
from bazaarflow.streaming.insert import insert_new, start_insert
from bazaarflow.streaming.targets import LakeTarget

_ORDER = "scraped_at, source, category, subcategory, title, price_text, location, image_url, date_text"
# The stored part first, then what it lacks: one row per address each.
_STORED_FIRST = (
    f"final as (select {FIELDS} from (select *, row_number() over (partition by url order by {_ORDER}) as n "
    "from listings where url in (select url from stored) and scraped_at < "
    f"{example.STORED_BEFORE}) where n = 1 union all "
    f"select {FIELDS} from (select *, row_number() over (partition by url order by {_ORDER}) as n "
    "from listings where url not in (select url from stored)) where n = 1)"
)

_EARLIEST = (
    f"earliest as (select {FIELDS} from (select *, row_number() over (partition by url order by {_ORDER}) as n "
    "from listings) where n = 1)"
)


def _drain(stream: DataFrame, folder: str) -> DataFrame:
    """Run a stream into files and read them back."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/out")


@checked(over_listings("select distinct url from listings"))
def stream_dedup(spark, folder):
    unique = dedup.stream_dedup(example.listings_stream(spark, folder))
    return _drain(unique, working_folder(spark, "dedup")).select("url")


@checked(
    over_listings(
        "select distinct case when listing_no % 3 = 0 then 'https://x.example/hot' else url end as url from listings"
    )
)
def stream_dedup_hot(spark, folder):
    """One key on a third of the rows, spread over eight state tasks."""
    hot = example.with_hot_url(example.listings_stream(spark, folder))
    return _drain(dedup.stream_dedup(hot, salts=8), working_folder(spark, "dedup")).select("url")


@checked("select distinct user_id from events")
def stream_dedup_bounded(spark, folder):
    events = table_stream(spark, folder, "events").withColumn("event_time", F.col("ts").cast("timestamp"))
    unique = dedup.stream_dedup_bounded(events, "event_time", key="user_id")
    return _drain(unique, working_folder(spark, "dedup")).select("user_id")


def _prepared(spark: SparkSession, folder: str) -> LakeTarget:
    """A target that already holds the older listings."""
    target = LakeTarget(working_folder(spark, "target")).create(spark)
    insert_new(example.stored_part(example.listings(spark, folder)), target, "backfill", staged=True)
    return target


def _streamed(spark: SparkSession, folder: str) -> LakeTarget:
    target = _prepared(spark, folder)
    query = start_insert(
        example.listings_stream(spark, folder), target, "listings",
        working_folder(spark, "checkpoint"), every=None,
    )
    query.awaitTermination()
    return target


@checked(over_listings(f"select {FIELDS} from final", STORED, _STORED_FIRST))
def insert_batches(spark, folder):
    """Two overlapping loads, the second one twice under one batch number."""
    target = _prepared(spark, folder)
    for batch_id in (1, 1, 2):
        insert_new(example.listings(spark, folder), target, "again", batch_id, staged=True)
    return target.read(spark).select(*LISTING_FIELDS)


@checked(over_listings(f"select {FIELDS} from final", STORED, _STORED_FIRST))
def stream_insert(spark, folder):
    return _streamed(spark, folder).read(spark).select(*LISTING_FIELDS)


@checked(over_listings(f"select {FIELDS} from earliest", _EARLIEST))
def stream_feed(spark, folder):
    """Messages through parsing into an empty target; the earliest row of each address stays."""
    target = LakeTarget(working_folder(spark, "target")).create(spark)
    sent = parse.to_messages(example.listings_stream(spark, folder), FEED_A)
    store_feed(sent, FEED_A, target, working_folder(spark, "checkpoint"), every=None).awaitTermination()
    return target.read(spark).select(*LISTING_FIELDS)


@checked(over_listings("select distinct url from listings"))
def stream_feed_by_state(spark, folder):
    """The same with the seen keys in state, beside a backfilled target."""
    target = _prepared(spark, folder)
    sent = parse.to_messages(example.listings_stream(spark, folder), FEED_A)
    query = store_feed_by_state(sent, FEED_A, target, working_folder(spark, "checkpoint"), every=None)
    query.awaitTermination()
    return target.read(spark).select("url")


@checked(over_listings("select distinct url from listings"))
def stream_merged_feeds(spark, folder):
    """Both feeds, with different time fields, by one query."""
    stream = example.listings_stream(spark, folder)
    is_a = F.col("source") == example.SITE_A.tag
    raw_a = parse.to_messages(stream.where(is_a), FEED_A)
    raw_b = parse.to_messages(stream.where(~is_a), FEED_B)
    target = LakeTarget(working_folder(spark, "target")).create(spark)
    query = store_merged_feeds(raw_a, raw_b, target, working_folder(spark, "checkpoint"), every=None)
    query.awaitTermination()
    return target.read(spark).select("url")


@checked(
    over_listings(
        "select 'no key' as reason, count(*) as rows from listings where category is null or location is null"
    )
)
def stream_rejects(spark, folder):
    """Messages that were cut short, or have no address, are kept aside."""
    sent = example.spoiled_messages(example.listings_stream(spark, folder))
    target = LakeTarget(working_folder(spark, "target")).create(spark)
    query = set_aside_feed(sent, FEED_A, target, working_folder(spark, "checkpoint"), every=None)
    query.awaitTermination()
    return target.rejected(spark).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


@checked(
    over_listings(
        "select cast(sum(total) as bigint) as total, cast(sum(rejected) as bigint) as rejected, "
        "cast(sum(new) as bigint) as new, cast(sum(duplicates) as bigint) as duplicates from ("
        "select count(*) as total, 0 as rejected, count(distinct url) as new, "
        "count(*) - count(distinct url) as duplicates from stored union all "
        "select count(*), 0, count(distinct url) filter (where url not in (select url from stored)), "
        "count(*) - count(distinct url) filter (where url not in (select url from stored)) from listings)",
        STORED,
    )
)
def batch_log(spark, folder):
    """What the finished batches counted, added up."""
    log = _streamed(spark, folder).log(spark)
    return log.agg(*[F.sum(name).alias(name) for name in ("total", "rejected", "new", "duplicates")])


@checked(
    over_listings(
        "select category, count(*) as rows from final group by category", STORED, _STORED_FIRST
    )
)
def inserted_per_category(spark, folder):
    per_batch = _streamed(spark, folder).categories(spark)
    return per_batch.groupBy("category").agg(F.sum("rows").alias("rows"))


@checked(
    over_listings(
        f"select {FIELDS} from final order by scraped_at desc, url limit 2000", STORED, _STORED_FIRST
    )
)
def newest_stored(spark, folder):
    """The newest rows by way of the batch log."""
    return _streamed(spark, folder).newest(spark).select(*LISTING_FIELDS)


@checked(
    over_listings(
        "select count(*) as rows, count(*) as ids, cast(1 as bigint) as first_id, count(*) as last_id from final",
        STORED, _STORED_FIRST,
    )
)
def stored_ids(spark, folder):
    """Ids are distinct and leave no gap."""
    stored = _streamed(spark, folder).read(spark)
    return stored.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("ids"),
        F.min("id").alias("first_id"), F.max("id").alias("last_id"),
    )


@checked(
    over_listings(
        "select count(distinct url) as rows, count(distinct url) as ids, count(distinct url) as urls, "
        "1 as first_id, count(distinct url) as last_id from listings"
    )
)
def stored_ids_two_writers(spark, folder):
    """Batches of two writers in turn: ids stay distinct and dense, addresses single."""
    target = LakeTarget(working_folder(spark, "target")).create(spark)
    rows = example.listings(spark, folder)
    for number, (writer, batch_id) in enumerate((("a", 0), ("b", 0), ("a", 1), ("b", 1))):
        insert_new(rows.where(F.col("listing_no") % 4 == number), target, writer, batch_id, staged=True)
    return target.read(spark).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("ids"), F.count_distinct("url").alias("urls"),
        F.min("id").alias("first_id"), F.max("id").alias("last_id"),
    )


@checked(
    over_listings(
        "select 'no key' as reason, count(*) as rows from listings where listing_no % 5 = 0 "
        "union all select 'too long: source', count(*) from listings where listing_no % 5 <> 0 and listing_no % 7 = 0"
    )
)
def insert_rejects(spark, folder):
    """A staged load with rows that have no address or too long a source."""
    target = LakeTarget(working_folder(spark, "target")).create(spark)
    number = F.col("listing_no")
    rows = example.listings(spark, folder).select(
        *[F.col(c) for c in LISTING_FIELDS if c not in ("url", "source")], "listing_no",
        F.when(number % 5 != 0, F.col("url")).alias("url"),
        F.when(number % 7 == 0, F.repeat(F.lit("x"), 300)).otherwise(F.col("source")).alias("source"),
    )
    insert_new(rows, target, "load", staged=True)
    found = target.rejected(spark).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))
    return found
