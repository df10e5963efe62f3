"""The store for several drivers: commits, lost races, pruned look-ups, compaction."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from bazaarflow.schema import LISTING_FIELDS
from bazaarflow.sources.folders import create_once, listed, read_text
from bazaarflow.streaming import committed
from bazaarflow.streaming.committed import CommittedTarget, Lost
from bazaarflow.streaming.insert import insert_new, start_insert

SCHEMA = ", ".join(f"{name} {'long' if name == 'scraped_at' else 'string'}" for name in LISTING_FIELDS)


def ads(spark, numbers, source="s"):
    rows = [tuple(n if f == "scraped_at" else f"u{n:06d}" if f == "url" else source if f == "source" else f"{f}{n}" for f in LISTING_FIELDS) for n in numbers]
    return spark.createDataFrame(rows, SCHEMA)


def urls(df):
    return sorted(int(r.url[1:]) for r in df.select("url").collect())


@pytest.fixture
def target(spark, tmp_path):
    return CommittedTarget(f"file://{tmp_path}/store", buckets=4).create(spark)


def test_create_once(spark, tmp_path):
    place = f"{tmp_path}/a/b.json"
    assert create_once(spark, place, "one é")
    assert not create_once(spark, place, "two")
    assert read_text(spark, place) == "one é"
    assert [n for n in listed(spark, f"{tmp_path}/a") if not n.endswith(".crc")] == ["b.json"]
    assert listed(spark, f"{tmp_path}/none") == []


def test_repeated_batch_adds_nothing(spark, target):
    first = insert_new(ads(spark, range(10)), target, "w", 0)
    again = insert_new(ads(spark, range(10)), target, "w", 0)
    assert (first.new, again.new) == (10, 10) and first == again
    assert urls(target.read(spark)) == list(range(10))
    assert insert_new(ads(spark, range(5, 15)), target, "w", 1).new == 5
    assert target.log(spark).count() == 2


def test_empty_batch_and_empty_store(spark, target):
    assert target.read(spark).count() == 0 and target.newest(spark).count() == 0 and target.rejected(spark).count() == 0
    assert insert_new(ads(spark, []), target, "w", 0).total == 0
    assert target.compact(spark) == 0
    assert insert_new(ads(spark, [1, 1, 1]), target, "w", 1).new == 1


def test_a_lost_race_is_run_again(spark, target, monkeypatch):
    """Another driver commits overlapping keys between a batch's look-up and its commit."""
    original, lost = CommittedTarget.commit, []

    def overtaken(self, session, after, change):
        if not lost:
            lost.append(True)
            monkeypatch.setattr(CommittedTarget, "commit", original)
            insert_new(ads(spark, range(5, 12), "other"), CommittedTarget(target.path), "other", 0)
        return original(self, session, after, change)

    monkeypatch.setattr(CommittedTarget, "commit", overtaken)
    report = insert_new(ads(spark, range(10)), target, "w", 0)
    assert lost and report.new == 5
    rows = target.read(spark).collect()
    assert sorted(r.url for r in rows) == [f"u{n:06d}" for n in range(12)]
    assert sorted(r.id for r in rows) == list(range(1, 13))
    with pytest.raises(Lost):
        target.commit(spark, target.snapshot(spark, 0), {"added": []})


def test_another_process_commits(spark, target, tmp_path):
    """A batch of a second driver process lies between two of this one."""
    insert_new(ads(spark, range(10)), target, "here", 0)
    script = f"""
import sys
sys.path[:0] = {[os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]!r}
from pyspark.sql import SparkSession
from test_committed import ads
from bazaarflow.streaming.committed import CommittedTarget
from bazaarflow.streaming.insert import insert_new
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
print("new", insert_new(ads(spark, range(5, 20)), CommittedTarget({target.path!r}), "there", 0).new)
spark.stop()
"""
    kept = {k: v for k, v in os.environ.items() if not k.startswith(("PYSPARK_GATEWAY", "SPARK_"))}
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300, env=kept, cwd=tmp_path)
    assert "new 10" in done.stdout, done.stderr[-2000:]
    assert insert_new(ads(spark, range(25)), target, "here", 1).new == 5
    rows = target.read(spark).collect()
    assert sorted(r.id for r in rows) == list(range(1, 26)) and len({r.url for r in rows}) == 25


def test_few_keys_open_few_files(spark, target, monkeypatch):
    monkeypatch.setattr(committed, "SMALL_BATCH", 0)
    insert_new(ads(spark, range(0, 4000)), target, "w", 0)
    monkeypatch.undo()
    insert_new(ads(spark, range(4000, 4010)), target, "w", 1)
    keys = ads(spark, [17, 99_999]).select("url")
    found = target.begin(spark).stored(spark, keys, True, "w", 2, False)
    plan = found._jdf.queryExecution().explainString(found._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "bucket#" in plan.split("PartitionFilters")[1].split("\n")[0]
    assert "In(url" in plan and "ReadSchema: struct<url:string>" in plan
    files = target.snapshot(spark).files.values()
    assert len(files) == 5  # one per bucket, and the small batch
    assert len(found.inputFiles()) <= 2
    assert urls(found) == [17]


@pytest.mark.parametrize("lookup", [1_000, 3])
def test_look_ups_agree(spark, target, monkeypatch, lookup):
    monkeypatch.setattr(committed, "SMALL_BATCH", 20)
    monkeypatch.setattr(committed, "LOOKUP", lookup)
    insert_new(ads(spark, range(0, 100, 2)), target, "w", 0)
    insert_new(ads(spark, range(1, 20, 2)), target, "w", 1)
    keys = ads(spark, range(90, 130)).union(ads(spark, [3])).select("url")
    for small in (True, False):
        found = urls(target.begin(spark).stored(spark, keys, small, "v", 0, False))
        assert [n for n in found if n in {*range(90, 130), 3}] == [3, *range(90, 100, 2)]
        assert not small or len(found) == 6
    assert target.begin(spark).stored(spark, keys, True, "w", 2, True).count() == 0


def test_compaction(spark, target):
    for n in range(6):
        insert_new(ads(spark, range(n * 50, n * 50 + 60)), target, "w", n)
    before = target.read(spark)
    files = len(target.snapshot(spark).files)
    assert files == 6
    assert target.compact(spark, rows_per_file=40) >= 8
    state = target.snapshot(spark)
    assert all(f["bucket"] is not None for f in state.files.values())
    assert urls(before) == urls(target.read(spark)) == list(range(310))  # the old frame still has its files
    assert urls(target.read(spark, version=2)) == list(range(110))
    log = target.log(spark).collect()
    assert len(log) == 1 and log[0].total == 360 and log[0].new == 310 and log[0].last_id == 310
    # A batch from before is known, the next one goes on with the ids.
    assert insert_new(ads(spark, range(50)), target, "w", 0).new == 0
    assert insert_new(ads(spark, range(305, 320)), target, "w", 6).last_id == 320
    assert urls(target.newest(spark, rows=15)) == list(range(305, 320))
    # Only files that reach the newest times are read.
    assert len(target.newest(spark, rows=15).inputFiles()) < len(target.snapshot(spark).files)
    # Versions after the file list are read on top of it.
    assert json.loads(read_text(spark, target._manifest(target.versions(spark)[-1])))["added"]


def test_rejects_belong_to_their_batch(spark, target):
    odd = ads(spark, range(4)).withColumn("url", F.when(F.col("url") > "u000001", F.col("url")))
    report = insert_new(odd, target, "w", 0)
    assert (report.new, report.rejected) == (2, 2)
    assert [r.reason for r in target.rejected(spark).collect()] == ["no key"] * 2
    target.compact(spark)
    assert target.rejected(spark).count() == 2


def test_streams_into_one_store(spark, target, tmp_path):
    """Two queries at once, with keys that both bring, and a restart."""
    for name, numbers in (("a", range(40)), ("b", range(20, 60))):
        ads(spark, numbers, name).repartition(4).write.parquet(f"{tmp_path}/{name}")

    def start(name):
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 2).parquet(f"{tmp_path}/{name}")
        return start_insert(stream, target, name, f"{tmp_path}/checkpoint-{name}", every=None)

    for query in [start("a"), start("b")]:
        query.awaitTermination()
    ads(spark, range(50, 70), "a").coalesce(1).write.mode("append").parquet(f"{tmp_path}/a")
    start("a").awaitTermination()
    rows = target.read(spark).collect()
    assert sorted(r.url for r in rows) == [f"u{n:06d}" for n in range(70)]
    assert sorted(r.id for r in rows) == list(range(1, 71))
