"""Bounded memory of keys, polled fetches, kept facets, keys in other spellings: small cases."""

import random
from html import unescape
from html.entities import html5

import pandas as pd
import pytest
from pyspark.sql import functions as F

from bazaarflow.functions.text import decode_entities
from bazaarflow.operators import counts, dedup
from bazaarflow.operators.kept import KeptFacets, partial_totals, united_totals
from bazaarflow.plans import checked_feeds
from bazaarflow.plans.checked_feeds import _rocksdb
from bazaarflow.sources.polled import FetchReader, polls, store_fetch
from bazaarflow.streaming.seen import _SeenKeys, require_rocksdb, stream_dedup_counted

LISTING = "source string, category string, subcategory string, title string, price_text string, location string, url string, image_url string, date_text string, scraped_at long"


def run(stream, place):
    writer = stream.writeStream.format("parquet").option("path", f"{place}/out").option("checkpointLocation", f"{place}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()


def test_counted_dedup_forgets_the_oldest(spark, tmp_path):
    """Keys above the limit are forgotten oldest first; rows without a key never pass; state survives a restart."""
    batches = [["a", "b", None, "b"], ["c", "d"], ["e", "a"], ["e", "c"]]
    with _rocksdb(spark):
        for half in (batches[:2], batches[2:]):
            for keys in half:
                rows = [(k, n) for n, k in enumerate(keys)]
                spark.createDataFrame(rows, "url string, n long").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
            stream = spark.readStream.schema("url string, n long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
            run(stream_dedup_counted(stream, limit=3, keep=2, part=F.lit(0)), tmp_path)
        # a, b pass; c, d make four keys, so only they stay; then a and e are new again, and push out c and d.
        passed = sorted(r.url for r in spark.read.parquet(f"{tmp_path}/out").collect())
        assert passed == sorted(["a", "b", "c", "d", "a", "e", "c"])
        state = spark.read.format("statestore").option("stateVarName", "seen").load(f"{tmp_path}/checkpoint")
        assert state.count() == 3


class _Messages:
    """A list state that counts the accesses to it."""

    def __init__(self):
        self.values, self.sent = [], 0

    def getListState(self, name, schema):  # noqa: N802
        return self

    def exists(self):
        return bool(self.values)

    def get(self):
        self.sent += 1
        return iter(self.values)

    def appendList(self, values):  # noqa: N802
        self.sent += 1
        self.values += values

    def put(self, values):
        self.sent += 1
        self.values = values


def test_counted_dedup_asks_the_state_once_per_batch():
    """However many keys a batch has; of rows with one key the first by the order passes."""
    state, seen = _Messages(), _SeenKeys("url", ["n"], limit=1500, keep=700, columns=["url", "n"])
    seen.init(state)
    for first, new, held in ((0, 1000, 1000), (0, 0, 1000), (500, 500, 1500), (1200, 700, 700)):
        keys = [f"{k:06d}" for k in range(first, first + 1000)]
        rows = pd.DataFrame({"url": keys + keys, "n": [*range(1000, 2000), *range(1000)]})
        out = pd.concat(seen.handleInputRows((0,), iter([rows[:900], rows[900:]]), None))
        assert (len(out), len(state.values)) == (new, held)
        assert (out["n"] < 1000).all()
    assert state.sent <= 8


def test_batches_are_dealt_into_files(spark, tmp_path, monkeypatch):
    """No file holds a whole batch of a large table, and a batch without rows doesn't mix with the next."""
    monkeypatch.setattr(checked_feeds, "ROWS_PER_FILE", 50)
    rows = spark.range(600).selectExpr("id as listing_no", "cast(id as string) as url").where("listing_no % 6 <> 1")
    batches, seen = checked_feeds.Batches(spark, "", rows, each=lambda part: part.where("listing_no < 594")), []

    def start(stream):
        note = lambda batch, n: seen.append(sorted(r.listing_no for r in batch.collect()))
        return stream.writeStream.foreachBatch(note).option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start()

    batches.run(start)
    assert seen == [[n for n in range(594) if n % 6 == b and b != 1] for b in range(6)]
    files = spark.read.parquet(batches.place).groupBy(F.input_file_name()).count().collect()
    assert len(files) >= 10 and max(r["count"] for r in files) <= 60


def test_counted_dedup_needs_its_store(spark):
    with pytest.raises(ValueError, match="RocksDB"):
        require_rocksdb(spark)


def test_polls_stop_and_resume(spark, tmp_path):
    pages = spark.range(10).selectExpr("id as page_id", "concat('p', id) as html")
    folder, progress = f"file://{tmp_path}/polls", f"file://{tmp_path}/progress/polls.json"
    seen = []

    def note(batch, batch_id):
        seen.append(sorted(r.page_id for r in batch.collect()))

    def poll_until_read():
        stream = polls(spark, folder, pages.schema, progress, polls_per_batch=1)
        query = stream.writeStream.foreachBatch(note).option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(processingTime="0 seconds").start()
        query.processAllAvailable()
        query.stop()

    for poll in range(3):
        store_fetch(pages.where(F.col("page_id") % 3 == poll), folder, poll)
    poll_until_read()
    (tmp_path / "polls" / "poll=000000004").mkdir()  # a poll that is still being written
    poll_until_read()
    store_fetch(pages, folder, 3)
    poll_until_read()
    assert [s for s in seen if s] == [[0, 3, 6, 9], [1, 4, 7], [2, 5, 8], list(range(10))]
    with pytest.raises(ValueError, match="progress"):
        polls(spark, folder, pages.schema, polls_per_batch=1)


def test_poll_offsets(tmp_path):
    from pyspark.sql.types import StructType

    options = {"folder": str(tmp_path), "perBatch": "2", "progress": str(tmp_path / "p.json")}
    reader = FetchReader(options, StructType())
    assert reader.initialOffset() == reader.latestOffset() == {"poll": 0}
    for poll in (0, 1, 2, 7):
        (tmp_path / f"poll={poll:09d}").mkdir()
        (tmp_path / f"poll={poll:09d}" / "_SUCCESS").touch()
        (tmp_path / f"poll={poll:09d}" / "part-0.parquet").touch()
    assert reader.latestOffset() == {"poll": 2}
    assert len(reader.partitions({"poll": 0}, {"poll": 2})) == 2
    # A new reader goes on where the planned ones end, and planning again changes nothing.
    again = FetchReader(options, StructType())
    assert again.latestOffset() == {"poll": 8}
    assert len(again.partitions({"poll": 0}, {"poll": 2})) == 2
    assert again.latestOffset() == {"poll": 8}


def test_kept_facets_follow_the_window(spark, tmp_path):
    def ads(numbers, category):
        rows = [("s", category, "", f"t{n}", str(n), f"city{n % 2}", f"u{n}", None, None, n) for n in numbers]
        return spark.createDataFrame(rows, LISTING)

    kept = KeptFacets(f"{tmp_path}/kept", rows=4)
    kept.update(ads(range(10, 16), "old"), 0)
    kept.update(ads([1, 2, 14, 20], "new"), 1)
    kept.update(ads([1, 2, 14, 20], "new"), 1)  # a repeated batch
    bars = kept.side_bar(spark, 1)
    assert [r.value for r in bars["categories"].collect()][1:] == ["new", "old"]
    assert [tuple(r) for r in bars["ceiling"].collect()] == [(20.0, 4)]
    assert sorted(tuple(r) for r in kept.totals(spark, 1).collect()) == [("new", 4, 20.0), ("old", 6, 15.0)]
    kept.update(ads(range(30, 34), None), 2)
    assert [r.value for r in kept.side_bar(spark, 2)["categories"].collect()][1:] == ["Divers"]
    both = partial_totals(ads([1], "x")).unionByName(partial_totals(ads([5, 6], "x")))
    assert [tuple(r) for r in united_totals(both).collect()] == [("x", 3, 6.0)]


def test_collated_keys(spark):
    rows = spark.createDataFrame([("A", 2), ("a", 1), ("É", 3), ("e", 4), (None, 5), (None, 6)], "url string, scraped_at long")
    assert sorted(r.scraped_at for r in dedup.first_per_collated_key(rows).collect()) == [1, 3, 4, 5]
    assert sorted(r.scraped_at for r in dedup.first_per_collated_key(rows, collation="UNICODE_CI_AI").collect()) == [1, 3, 5]
    stored = spark.createDataFrame([("E",), (None,)], "url string")
    assert sorted(r.url for r in dedup.drop_known_collated(rows, stored).collect()) == ["A", "a", "É"]
    assert sorted(r.url for r in dedup.drop_known_collated(rows, stored, collation="UNICODE_CI_AI").collect()) == ["A", "a"]


def test_entities_are_the_library_s(spark):
    """Every name, odd numbers and broken references, against the reader that builds the element tree."""
    rng = random.Random(5)
    texts = [f"a&{name}b &{name} &{name}" for name in html5]
    texts += [f"&#{n};&#{n} &#x{n:x};&#X0{n:X}z" for n in (0, 1, 9, 13, 31, 127, 128, 150, 159, 160, 233, 0xD800, 0xDFFF, 0xFDD0, 0xFFFE, 0xFFFF, 0x1F600, 0x10FFFF, 0x110000, 10**9, 10**30)]
    pieces = ["&", "#", ";", "amp", "lt", "x41", "#65", "#x", "notit", "not", "é", " ", "\n", "Aacute", "&amp;", "=", "1", "CounterClockwiseContourIntegral"]
    texts += ["".join(rng.choices(pieces, k=rng.randint(0, 8))) for _ in range(400)] + ["&" * 5000, "&" + "a" * 100 + ";"]
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    for r in rows.select("n", decode_entities(F.col("text")).alias("out")).collect():
        assert r.out == unescape(texts[r.n]), texts[r.n][:100]


def test_sketches_unite(spark):
    rows = spark.range(20_000).selectExpr("cast(id % 6000 as string) as url", "id % 4 as batch")
    parts = [counts.key_sketch(rows.where(F.col("batch") == n)) for n in range(4)]
    both = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    about = counts.distinct_estimate(both).first().keys
    assert abs(about - 6000) < 180
