"""The committed store as queries over whole tables: pruned look-ups, several writers, upkeep."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarflow.plans import example_listings as example
from bazaarflow.plans.checked import FIELDS, STORED, checked, over_listings
from bazaarflow.plans.checked_streams import _STORED_FIRST
from bazaarflow.schema import KEY, LISTING_FIELDS
from bazaarflow.sources.scratch import working_folder
from bazaarflow.streaming.committed import CommittedTarget
from bazaarflow.streaming.insert import insert_new


def _store(spark: SparkSession, folder: str) -> tuple[CommittedTarget, DataFrame]:
    """A store that holds the older listings, and all listings."""
    target = CommittedTarget(working_folder(spark, "store"), buckets=16).create(spark)
    rows = example.listings(spark, folder)
    insert_new(example.stored_part(rows), target, "backfill", staged=True)
    return target, rows


def _by_key(rows: DataFrame, parts: int) -> list[DataFrame]:
    """All rows in batches; copies of a key stay together, so the earliest row is the one stored."""
    part = F.pmod(F.xxhash64(KEY, F.lit("part")), F.lit(parts))
    return [rows.where(part == n) for n in range(parts)]


@checked(over_listings(f"select {FIELDS} from final", STORED, _STORED_FIRST))
def insert_pruned(spark, folder):
    """Batches whose look-ups read only the buckets, files and row groups that can hold their keys."""
    target, rows = _store(spark, folder)
    for batch_id, batch in enumerate(_by_key(rows, 3)):
        insert_new(batch, target, "pruned", batch_id, staged=True)
    return target.read(spark).select(*LISTING_FIELDS)


@checked(over_listings(f"select {FIELDS} from final", STORED, _STORED_FIRST))
def insert_after_compact(spark, folder):
    """The store is compacted between batches, and one of them is repeated after that."""
    target, rows = _store(spark, folder)
    first, second = _by_key(rows, 2)
    insert_new(first, target, "writer", 0, staged=True)
    target.compact(spark, rows_per_file=5_000)
    insert_new(first, target, "writer", 0, staged=True)
    insert_new(second, target, "writer", 1, staged=True)
    target.compact(spark)
    return target.read(spark).select(*LISTING_FIELDS)


@checked(
    over_listings(f"select {FIELDS} from final order by scraped_at desc, url limit 2000", STORED, _STORED_FIRST)
)
def newest_after_compact(spark, folder):
    """The newest rows from the files that reach their times."""
    target, rows = _store(spark, folder)
    insert_new(rows, target, "writer", 0, staged=True)
    target.compact(spark, rows_per_file=5_000)
    return target.newest(spark).select(*LISTING_FIELDS)


@checked(
    over_listings(
        "select count(distinct url) as rows, count(distinct url) as ids, count(distinct url) as urls, "
        "1 as first_id, count(distinct url) as last_id, 2 * count(*) as offered from listings"
    )
)
def stored_ids_two_drivers(spark, folder):
    """Two writers that know nothing of each other store all rows at once: addresses stay single, ids dense."""
    path = working_folder(spark, "store")
    CommittedTarget(path, buckets=16).create(spark)
    rows = example.listings(spark, folder)

    def writes(name: str) -> None:
        for batch_id, batch in enumerate(_by_key(rows, 2)):
            insert_new(batch, CommittedTarget(path), name, batch_id, staged=True)

    with ThreadPoolExecutor(2) as both:
        for done in [both.submit(writes, name) for name in ("one", "two")]:
            done.result()
    target = CommittedTarget(path)
    offered = target.log(spark).agg(F.sum("total").alias("offered")).first()["offered"]
    return target.read(spark).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("ids"), F.count_distinct("url").alias("urls"),
        F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.lit(offered).alias("offered"),
    )
