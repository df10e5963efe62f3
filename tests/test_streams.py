"""Streams against their batch form, restarts, failures, and the targets."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from bazaarflow.operators import dedup, parse
from bazaarflow.plans import example_listings as example
from bazaarflow.plans.feeds import (
    page_messages,
    set_aside_feed,
    store_feed,
    store_feed_by_state,
    unstorable,
)
from bazaarflow.schema import FEED_A, FEED_B, LISTING_FIELDS, Site
from bazaarflow.sources.scratch import working_folder
from bazaarflow.sources.streams import open_files
from bazaarflow.sources.tables import table_stream
from bazaarflow.streaming import insert as insert_module
from bazaarflow.streaming.insert import insert_new, start_insert, state_settings
from bazaarflow.streaming.targets import (
    JdbcTarget,
    LakeTarget,
    column_types,
    rejected_ddl,
    table_ddl,
    with_ids,
)

SCHEMA = ", ".join(f"{n} {'bigint' if n == 'scraped_at' else 'string'}" for n in LISTING_FIELDS)


def listing(url, time=1, **more):
    row = dict.fromkeys(LISTING_FIELDS)
    row.update(url=url, scraped_at=time, category="c", **more)
    return tuple(row[name] for name in LISTING_FIELDS)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


@pytest.fixture
def target(spark, tmp_path):
    return LakeTarget(str(tmp_path / "target")).create(spark)


def urls(spark, target):
    return sorted(row.url for row in target.read(spark).collect())


def add_file(df, folder):
    df.coalesce(1).write.mode("append").parquet(str(folder))


def test_stream_dedup_over_batches(spark, tmp_path):
    folder = tmp_path / "in"
    out = str(tmp_path / "out")

    def run():
        stream = dedup.stream_dedup(open_files(spark, str(folder), SCHEMA, files_per_batch=1))
        query = (
            stream.writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return sorted((r.url for r in spark.read.schema(SCHEMA).parquet(out).collect()), key=str)

    add_file(frame(spark, listing("a"), listing(None), listing(None), listing("b")), folder)
    assert run() == [None, "a", "b"]
    add_file(frame(spark, listing("a"), listing("c"), listing(None)), folder)
    assert sorted(run(), key=str) == sorted(["a", "b", "c", None], key=str)


@pytest.mark.parametrize("salts", [1, 4])
def test_stream_dedup_equals_batch(spark, tmp_path, folder, salts):
    df = example.with_hot_url(example.listings(spark, folder)).select(*LISTING_FIELDS)
    df.repartition(5).write.parquet(str(tmp_path / "in"))
    stream = dedup.stream_dedup(open_files(spark, str(tmp_path / "in"), SCHEMA, files_per_batch=2), salts=salts)
    name = f"unique_{salts}"
    stream.writeStream.format("memory").queryName(name).trigger(availableNow=True).start().awaitTermination()
    found = [row.url for row in spark.table(name).collect()]
    assert len(found) == len(set(found))
    assert set(found) == {row.url for row in dedup.distinct_keys(df).collect()}


def test_bounded_dedup_forgets(spark, tmp_path):
    folder = tmp_path / "in"

    def run():
        stream = dedup.with_event_time(open_files(spark, str(folder), SCHEMA, files_per_batch=1))
        unique = dedup.stream_dedup_bounded(stream, "event_time", "1 day")
        query = (
            unique.select("url", "scraped_at").writeStream.format("parquet")
            .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        rows = spark.read.schema("url string, scraped_at bigint").parquet(str(tmp_path / "out")).collect()
        return sorted((r.url, r.scraped_at) for r in rows)

    day = 86400
    add_file(frame(spark, listing("a", day), listing("a", day + 5)), folder)
    assert [url for url, _ in run()] == ["a"]
    add_file(frame(spark, listing("a", day + 60), listing("z", 10 * day)), folder)
    assert [url for url, _ in run()] == ["a", "z"]
    add_file(frame(spark, listing("a", 11 * day)), folder)
    assert [url for url, _ in run()] == ["a", "a", "z"]


def test_insert_is_idempotent(spark, target):
    batch = frame(spark, listing("a"), listing("a", 0, title="first"), listing("b"), listing(None),
                  listing("c", price_text="x" * 51))
    report = insert_new(batch, target, "w", 0)
    assert (report.total, report.rejected, report.new, report.duplicates) == (5, 2, 2, 1)
    assert insert_new(batch, target, "w", 1).new == 0
    assert insert_new(batch, target).new == 0
    assert urls(spark, target) == ["a", "b"]
    assert target.read(spark).where("url = 'a'").first().title == "first"
    reasons = {row.reason for row in target.rejected(spark).collect()}
    assert reasons == {"no key", "too long: price_text"}


def test_staged_load(spark, target, folder):
    df = example.listings(spark, folder).select(*LISTING_FIELDS)
    insert_new(example.stored_part(df), target, "w", 0)
    report = insert_new(df.repartition(5), target, "load", 0, staged=True)
    unique = dedup.distinct_keys(df).count()
    assert report.total == df.count() and report.last_id == unique
    assert sorted(r.id for r in target.read(spark).collect()) == list(range(1, unique + 1))
    assert insert_new(df, target, "load", 1, staged=True).new == 0


def test_table_stream_reads_a_folder(spark, tmp_path, folder):
    df = example.listings(spark, folder).select("url", "listing_no")
    df.repartition(3).write.parquet(str(tmp_path / "many.parquet"))
    stream = table_stream(spark, str(tmp_path), "many", files_per_batch=2)
    stream.writeStream.format("memory").queryName("many").trigger(availableNow=True).start().awaitTermination()
    assert sorted(spark.table("many").collect()) == sorted(df.collect())


def test_repeated_batch_replaces_itself(spark, target):
    insert_new(frame(spark, listing("a"), listing("b")), target, "w", 0)
    insert_new(frame(spark, listing("a"), listing("b")), target, "w", 0)
    assert urls(spark, target) == ["a", "b"]
    assert target.log(spark).count() == 1


def test_large_key_sets_are_not_broadcast(spark, target, monkeypatch):
    insert_new(frame(spark, listing("a")), target, "w", 0)
    monkeypatch.setattr(insert_module, "SMALL_KEYS", 0)
    assert insert_new(frame(spark, listing("a"), listing("b")), target, "w", 1).new == 1
    assert urls(spark, target) == ["a", "b"]


def test_counts_add_up(spark, target, folder):
    df = example.listings(spark, folder).withColumn(
        "url", F.when(F.col("location").isNotNull(), F.col("url"))
    )
    report = insert_new(df, target)
    assert report.total == report.new + report.duplicates + report.rejected == df.count()
    assert report.rejected > 0 and report.duplicates > 0
    per_category = target.categories(spark).agg(F.sum("rows")).first()[0]
    assert per_category == report.new == target.read(spark).count()


def test_ids_are_dense_over_batches(spark, target):
    rows = [listing(f"u{n}") for n in range(100)]
    insert_new(frame(spark, *rows[:37]).repartition(5), target, "w", 0)
    insert_new(frame(spark, *rows).repartition(7), target, "w", 1)
    assert sorted(r.id for r in target.read(spark).collect()) == list(range(1, 101))


def test_with_ids_survives_coalesce(spark):
    df = spark.range(1000).repartition(9).persist()
    ids = sorted(r.id2 for r in with_ids(df.withColumnRenamed("id", "x"), 5)
                 .withColumnRenamed("id", "id2").coalesce(2).collect())
    assert ids == list(range(6, 1006))
    df.unpersist()


def test_newest_uses_the_log_and_loses_nothing(spark, target):
    for batch in range(6):
        rows = [listing(f"u{batch}-{n}", batch * 10 + n) for n in range(4)]
        insert_new(frame(spark, *rows, listing(f"none{batch}", None)), target, "w", batch)
    for size in (1, 4, 5, 11, 24, 40):
        stored = target.read(spark).collect()
        expected = sorted(stored, key=lambda r: (r.scraped_at is None, -(r.scraped_at or 0), r.url))[:size]
        assert [r.url for r in target.newest(spark, size).collect()] == [r.url for r in expected]


def test_stream_resumes_and_repeats_failed_batch(spark, tmp_path, target, monkeypatch):
    folder, checkpoint = tmp_path / "in", str(tmp_path / "cp")

    def run():
        stream = open_files(spark, str(folder), SCHEMA, files_per_batch=1)
        query = start_insert(stream, target, "resume", checkpoint, every=None)
        query.awaitTermination()

    add_file(frame(spark, listing("a"), listing("b")), folder)
    run()
    add_file(frame(spark, listing("b"), listing("c")), folder)
    finish = LakeTarget.finish

    def broken(*args):
        raise RuntimeError("lost after the rows were written")

    monkeypatch.setattr(LakeTarget, "finish", broken)
    with pytest.raises(StreamingQueryException):
        run()
    monkeypatch.setattr(LakeTarget, "finish", finish)
    run()
    assert urls(spark, target) == ["a", "b", "c"]
    assert sorted(r.batch_id for r in target.log(spark).collect()) == [0, 1]
    run()
    assert urls(spark, target) == ["a", "b", "c"]


def test_new_checkpoint_keeps_old_rows(spark, tmp_path, target):
    add_file(frame(spark, listing("a")), tmp_path / "one")
    add_file(frame(spark, listing("a"), listing("b")), tmp_path / "two")
    for name in ("one", "two"):
        stream = open_files(spark, str(tmp_path / name), SCHEMA)
        start_insert(stream, target, name, str(tmp_path / f"cp-{name}"), every=None).awaitTermination()
    assert urls(spark, target) == ["a", "b"]


@pytest.mark.parametrize("store", [store_feed, store_feed_by_state])
def test_feeds_into_one_target(spark, tmp_path, target, store):
    sent_a = parse.to_messages(frame(spark, listing("a"), listing("a"), listing("b")), FEED_A)
    bad = spark.createDataFrame([("nope",), ('{"url":null}',)], "value string")
    add_file(sent_a.select(F.col("value").cast("string")).unionByName(bad), tmp_path / "a")
    sent_b = parse.to_messages(frame(spark, listing("b"), listing("c")), FEED_B)
    add_file(sent_b.select(F.col("value").cast("string")), tmp_path / "b")
    for feed, name in ((FEED_A, "a"), (FEED_B, "b")):
        raw = open_files(spark, str(tmp_path / name), "value string")
        store(raw, feed, target, str(tmp_path / f"cp-{name}"), every=None).awaitTermination()
    assert urls(spark, target) == ["a", "b", "c"]
    raw = spark.read.parquet(str(tmp_path / "a"))
    assert unstorable(raw, FEED_A).count() == 2
    if store is store_feed_by_state:
        raw = open_files(spark, str(tmp_path / "a"), "value string")
        set_aside_feed(raw, FEED_A, target, str(tmp_path / "cp-r"), every=None).awaitTermination()
    assert target.rejected(spark).count() == 2
    assert urls(spark, target) == ["a", "b", "c"]


def test_state_feed_with_rocksdb(spark, tmp_path, target):
    settings = state_settings(4)
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        folder = tmp_path / "in"
        for rows in ([listing("a"), listing("b")], [listing("b"), listing("c"), listing("a", 9)]):
            sent = parse.to_messages(frame(spark, *rows), FEED_B)
            add_file(sent.select(F.col("value").cast("string")), folder)
            raw = open_files(spark, str(folder), "value string", files_per_batch=1)
            store_feed_by_state(raw, FEED_B, target, str(tmp_path / "cp"), every=None, salts=2).awaitTermination()
        assert urls(spark, target) == ["a", "b", "c"]
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_sole_writer_reads_no_stored_rows(spark, tmp_path, target, monkeypatch):
    monkeypatch.setattr(LakeTarget, "stored", None)
    folder = tmp_path / "in"
    for rows in ([listing("a"), listing("a")], [listing("a"), listing("b")]):
        sent = parse.to_messages(frame(spark, *rows), FEED_A)
        add_file(sent.select(F.col("value").cast("string")), folder)
        raw = open_files(spark, str(folder), "value string")
        query = store_feed_by_state(
            raw, FEED_A, target, str(tmp_path / "cp"), every=None, other_writers=False
        )
        query.awaitTermination()
    assert urls(spark, target) == ["a", "b"]
    assert sorted(r.id for r in target.read(spark).collect()) == [1, 2]


def test_pages_to_messages_as_a_stream(spark, tmp_path, folder):
    made = example.item_pages(example.listings(spark, folder)).select("category", "html", "scraped_at")
    made.write.parquet(str(tmp_path / "in"))
    stream = open_files(spark, str(tmp_path / "in"), made.schema)
    sent = page_messages(stream, Site("s", "b"), as_of=example.AS_OF, scraped_at="scraped_at")
    sent.writeStream.format("memory").queryName("sent").trigger(availableNow=True).start().awaitTermination()
    batch = page_messages(made, Site("s", "b"), as_of=example.AS_OF, scraped_at="scraped_at")
    assert sorted(r.value for r in spark.table("sent").collect()) == sorted(r.value for r in batch.collect())


def test_relational_target_options():
    target = JdbcTarget({"url": "jdbc:x", "user": "u"}, "ads")
    assert target.write_options()["dbtable"] == "ads"
    assert target.newest_options(5)["query"] == (
        "select * from ads order by case when timestamp_scraped is null then 1 else 0 end, "
        "timestamp_scraped desc, url limit 5"
    )
    ddl = table_ddl("ads")
    assert "url VARCHAR(768) UNIQUE" in ddl and "titre TEXT" in ddl and "AUTO_INCREMENT" in ddl
    assert "prix VARCHAR(50)" in column_types()
    assert target.rejected_options("o'x", 3)["query"] == "select record, reason from ads_rejected where writer = 'o''x' and batch_id = 3"
    assert "ads_rejected" in rejected_ddl("ads") and "batch_id BIGINT" in rejected_ddl("ads")


@pytest.mark.parametrize("small, limit", [(True, 10), (True, 1), (False, 10)])
def test_relational_lookup(spark, monkeypatch, small, limit):
    """By key list, by broadcast, or left to the join: the same known keys."""
    stored = frame(spark, listing("a"), listing("c"), listing("d"))
    monkeypatch.setattr(JdbcTarget, "read", lambda self, spark: stored)
    keys = spark.createDataFrame([("a",), ("b",), ("c",)], "url string")
    found = JdbcTarget({}, "t", limit).stored(spark, keys, small, "w", 0, False)
    known = {row.url for row in keys.join(found, "url", "left_semi").collect()}
    assert known == {"a", "c"}
    if small:
        assert {row.url for row in found.collect()} == known


def test_working_folder_is_below_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    made = working_folder(spark, "x")
    assert made != working_folder(spark, "x")
    if shared:
        assert made.startswith(shared)
