"""Insert-if-absent, for one batch and for a stream of batches."""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bazaarflow.operators.clean import too_long
from bazaarflow.operators.counts import category_counts
from bazaarflow.operators.dedup import first_per_key
from bazaarflow.schema import KEY, LISTING_FIELDS, MAX_LENGTHS, TIME
from bazaarflow.sources.scratch import working_folder
from bazaarflow.streaming.committed import ATTEMPTS, CommittedTarget, Lost, Transaction
from bazaarflow.streaming.targets import JdbcTarget, LakeTarget

Target = LakeTarget | JdbcTarget | CommittedTarget

# Largest total of batch keys (bytes, with overhead) sent to every executor.
SMALL_KEYS = 32 * 1024 * 1024
_KEY_OVERHEAD = 32


def storable(key: str = KEY):
    """Rows that have a key and fit the target's columns."""
    return F.col(key).isNotNull() & (F.size(too_long(MAX_LENGTHS)) == 0)


def insert_new(
    batch: DataFrame,
    target: Target,
    writer: str | None = None,
    batch_id: int = 0,
    against: str = "all",
    staged: bool = False,
    key: str = KEY,
) -> Row:
    """Append the rows whose key the target lacks; returns the counts.

    The batch may carry extra columns; they are kept for rejected rows only.
    ``against`` tells which stored rows to compare with: "all", those of
    "others" than this writer, or "none" for a sole writer whose input has
    every key once.

    A micro-batch is held in memory for the steps below. ``staged`` is for
    loads too large for that: the input is scanned again where needed, and the
    new rows go to a table in the working folder before they are numbered.

    A ``CommittedTarget`` may have other writers at the same time, in any driver:
    a batch that another one overtook is compared anew with what that one stored.
    """
    writer = writer or uuid.uuid4().hex
    if not isinstance(target, CommittedTarget):
        return _insert(batch, target, writer, batch_id, against, staged, key)
    for _ in range(ATTEMPTS):
        attempt = target.begin(batch.sparkSession)
        report = attempt.done(writer, batch_id)
        if report:
            return report
        try:
            return _insert(batch, attempt, writer, batch_id, against, staged, key)
        except Lost:
            continue
    raise Lost(target.path)


def _insert(
    batch: DataFrame, target: LakeTarget | JdbcTarget | Transaction, writer: str, batch_id: int, against: str, staged: bool, key: str
) -> Row:
    spark = batch.sparkSession
    fits = storable(key)
    if not staged:
        batch = batch.persist()
    fresh = None
    try:
        size = batch.agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if(~fits).alias("rejected"),
            F.coalesce(F.sum(F.when(fits, F.octet_length(key) + _KEY_OVERHEAD)), F.lit(0)).alias("bytes"),
        ).first()
        if size.total == 0:
            return _report(size, 0, None, None)

        if size.rejected:
            reason = F.when(F.col(key).isNull(), "no key").otherwise(
                F.concat(F.lit("too long: "), F.array_join(too_long(MAX_LENGTHS), ", "))
            )
            rejects = batch.where(~fits).select(
                F.to_json(F.struct("*")).alias("record"), reason.alias("reason")
            )
            target.set_aside(rejects, size.rejected, writer, batch_id)

        wanted = batch.where(fits).select(*LISTING_FIELDS)
        fresh = first_per_key(wanted, key)
        if against != "none":
            small = size.bytes <= SMALL_KEYS
            keys = wanted.select(key).distinct()
            stored = target.stored(spark, keys, small, writer, batch_id, against == "others", key)
            # One row per key on both sides, so no join partition can be hot;
            # the rows are already hashed by key for the anti join.
            fresh = fresh.join(stored, key, "left_anti").select(*LISTING_FIELDS)
        fresh = _written(fresh) if staged else fresh.persist()
        found = fresh.agg(
            F.count(F.lit(1)).alias("new"),
            F.count(TIME).alias("timed_rows"),
            F.min(TIME).alias("first_time"),
            F.max(TIME).alias("last_time"),
        ).first()
        last_id = target.append(fresh, found.new, writer, batch_id)
        report = _report(size, found.new, found, last_id)
        target.finish(report, category_counts(fresh), writer, batch_id)
        return report
    finally:
        for held in (fresh, batch):
            if held is not None and not staged:
                held.unpersist()


def _written(df: DataFrame) -> DataFrame:
    place = working_folder(df.sparkSession, "new-rows")
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def _report(size: Row, new: int, found: Row | None, last_id: int | None) -> Row:
    return Row(
        total=size.total,
        rejected=size.rejected,
        new=new,
        duplicates=size.total - size.rejected - new,
        last_id=last_id,
        timed_rows=found.timed_rows if found else 0,
        first_time=found.first_time if found else None,
        last_time=found.last_time if found else None,
    )


def state_settings(partitions: int) -> dict[str, str]:
    """Session settings for stateful streams, to be made before the first start.

    The number of state partitions stays fixed for the life of a checkpoint.
    """
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }


#: Live inserting queries of this driver by target folder.
_INSERTING: dict[str, StreamingQuery] = {}


def _claim(path: str, name: str) -> None:
    """Two live queries would each miss what the other is about to store."""
    live = _INSERTING.get(path)
    if live is not None and live.isActive:
        raise ValueError(f"{live.name} is inserting into {path}; merge the feeds into one query instead of starting {name}")


def start_insert(
    listings: DataFrame,
    target: Target,
    name: str,
    checkpoint: str,
    every: str | None = "10 seconds",
    against: str = "all",
) -> StreamingQuery:
    """Feed a stream into the target; ``every=None`` takes what is there and ends.

    The query id in the checkpoint is the writer, so a restart goes on with
    its batches and a new checkpoint never overwrites those of an old one. A
    failing batch stops the query and is repeated by the next start.
    ``against`` is as in ``insert_new``; streams that passed ``stream_dedup``
    need "others" at most. A second query that inserts into the folder of a ``LakeTarget``
    is refused while the first one lives: feeds that share keys go through
    ``store_merged_feeds``. Queries of other drivers are not seen there; a
    ``CommittedTarget`` takes any number of them.
    """
    if against != "none" and isinstance(target, LakeTarget):
        _claim(target.path, name)
    started = threading.Event()
    identity: dict[str, str] = {}

    def store(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        insert_new(batch, target, identity["writer"], batch_id, against)

    writer = (
        listings.writeStream.queryName(name)
        .foreachBatch(store)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    query = writer.start()
    if against != "none" and isinstance(target, LakeTarget):
        _INSERTING[target.path] = query
    identity["writer"] = query.id
    started.set()
    return query


def run_until_stopped(query: StreamingQuery) -> None:
    """Wait for the query; an interrupt stops it in an orderly way."""
    try:
        query.awaitTermination()
    except KeyboardInterrupt:
        query.stop()
