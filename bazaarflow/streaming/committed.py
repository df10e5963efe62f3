"""A store of listings that several drivers may write to.

Data files are only seen through numbered manifests. A writer prepares its files
beside those of others and then creates the next manifest, which exactly one
writer can; whoever loses looks at what the winner stored and tries again. Rows
lie in buckets by a hash of their key. A file's manifest entry has its bucket and
its ranges of key and time, and the file itself a Bloom filter of its keys, so a
small batch opens few files and few row groups of those.

Folder: ``manifests/<version>.json`` (what a version adds),
``states`` (whole file lists, written by ``compact``), ``data`` and ``rejected``.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarflow.operators.serve import latest
from bazaarflow.schema import KEY, LISTING, LISTING_FIELDS, SNAPSHOT_ROWS, TIME
from bazaarflow.sources.folders import create_once, listed, read_text
from bazaarflow.streaming.targets import with_ids

#: Buckets of a new store, fixed for its life; keys that are looked up by value.
BUCKETS = 64
LOOKUP = 1_000
#: Rows of a compacted file, and rows for which Bloom filters are sized.
ROWS_PER_FILE = 1_000_000
#: Rows up to which a batch becomes one file without buckets.
SMALL_BATCH = 100_000
#: Attempts against other writers before a batch fails.
ATTEMPTS = 20

STORED = T.StructType([*LISTING.fields, T.StructField("id", T.LongType()), T.StructField("created_at", T.TimestampType())])
_BUCKETED = T.StructType([*STORED.fields, T.StructField("bucket", T.IntegerType())])
_REJECTED = "record string, reason string"
_COUNTED = ("total", "rejected", "new", "duplicates", "last_id", "timed_rows", "first_time", "last_time")
_SUMS = ("total", "rejected", "new", "duplicates", "timed_rows")
_LOG = ", ".join(f"{name} long" for name in _COUNTED) + ", writer string, batch_id long"


class Lost(Exception):
    """Another writer created the next manifest first."""


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class Snapshot:
    """The store as of one version: its files and the log of its batches, as rows of plain values."""

    version: int
    buckets: int
    files: dict[str, dict]
    rejected: dict[tuple[str, int], list[str]]
    log: dict[tuple[str, int], dict]

    @property
    def last_id(self) -> int:
        return max((entry["last_id"] or 0 for entry in self.log.values()), default=0)


@dataclass(frozen=True)
class CommittedTarget:
    """Listings below ``path``, for ``insert_new`` and streams by any number of drivers.

    A driver holds the list of files, as Spark does for every table it reads;
    rows, keys and filters stay in the files.
    """

    path: str
    buckets: int = BUCKETS

    def create(self, spark: SparkSession) -> CommittedTarget:
        """Make version 0 unless it exists; the buckets of an existing store stay."""
        create_once(spark, self._manifest(0), json.dumps({"buckets": self.buckets, "added": []}))
        return self

    def _manifest(self, version: int) -> str:
        return f"{self.path}/manifests/{version:012d}.json"

    def versions(self, spark: SparkSession) -> list[int]:
        return sorted(int(name[:12]) for name in listed(spark, f"{self.path}/manifests") if name.endswith(".json") and name[:12].isdigit())

    def snapshot(self, spark: SparkSession, version: int | None = None) -> Snapshot:
        """The newest version, or an older one: its last whole file list and what came after it."""
        wanted = [v for v in self.versions(spark) if version is None or v <= version]
        if not wanted:
            raise FileNotFoundError(f"no store at {self.path}")
        changes: list[dict] = []
        for number in reversed(wanted):
            changes.append(json.loads(read_text(spark, self._manifest(number))))
            if "state" in changes[-1] or number == 0:
                break
        files, rejected, log, buckets = {}, {}, {}, self.buckets
        for change in reversed(changes):
            buckets = change.get("buckets", buckets)
            if "state" in change:
                whole = json.loads(read_text(spark, f"{self.path}/{change['state']}"))
                files = {f["path"]: f for f in whole["files"]}
                rejected = {(r["writer"], r["batch_id"]): r["paths"] for r in whole["rejected"]}
                log = {(entry["writer"], entry["batch_id"]): entry for entry in whole["log"]}
                continue
            files |= {f["path"]: f for f in change["added"]}
            if "log" in change:
                batch = (change["log"]["writer"], change["log"]["batch_id"])
                log[batch] = change["log"]
                rejected[batch] = change["rejected"]
        return Snapshot(wanted[-1], buckets, files, rejected, log)

    def commit(self, spark: SparkSession, after: Snapshot, change: dict) -> None:
        """Make the change the version after the snapshot, or raise ``Lost``."""
        if not create_once(spark, self._manifest(after.version + 1), json.dumps({"buckets": after.buckets} | change)):
            raise Lost(self.path)

    def begin(self, spark: SparkSession) -> Transaction:
        return Transaction(self, self.snapshot(spark))

    def _files(self, spark: SparkSession, files: list[dict]) -> DataFrame:
        """Rows of the files with their bucket, a partition column that filters and joins can prune by."""
        if not files:
            return spark.createDataFrame([], _BUCKETED)
        reader = spark.read.schema(T.StructType([*STORED.fields, T.StructField("commit", T.StringType()), _BUCKETED["bucket"]]))
        return reader.option("basePath", f"{self.path}/data").parquet(*[f"{self.path}/{f['path']}" for f in files]).drop("commit")

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """All rows of a version. Later versions, compacted ones too, leave its files alone."""
        return self._files(spark, list(self.snapshot(spark, version).files.values())).drop("bucket")

    def rejected(self, spark: SparkSession) -> DataFrame:
        paths = [f"{self.path}/{p}" for found in self.snapshot(spark).rejected.values() for p in found]
        return spark.read.schema(_REJECTED).parquet(*paths) if paths else spark.createDataFrame([], _REJECTED)

    def log(self, spark: SparkSession) -> DataFrame:
        """One row per finished batch."""
        rows = [tuple(entry[name] for name in (*_COUNTED, "writer", "batch_id")) for entry in self.snapshot(spark).log.values()]
        return spark.createDataFrame(rows, _LOG)

    def newest(self, spark: SparkSession, rows: int = SNAPSHOT_ROWS, tie_break: list[str] | None = None) -> DataFrame:
        """The newest rows, reading only files that can hold them.

        Files whose earliest times are latest are added up until they hold enough
        rows; a file that ends before the earliest time among them is not read.
        """
        files = [f for f in self.snapshot(spark).files.values()]
        reached, floor = 0, None
        for f in sorted((f for f in files if f["timed_rows"]), key=lambda f: -f["first_time"]):
            reached += f["timed_rows"]
            if reached >= rows:
                floor = f["first_time"]
                break
        if floor is None:
            return latest(self._files(spark, files).drop("bucket"), rows, tie_break)
        late = [f for f in files if f["timed_rows"] and f["last_time"] >= floor]
        return latest(self._files(spark, late).drop("bucket").where(F.col(TIME) >= floor), rows, tie_break)

    def compact(self, spark: SparkSession, rows_per_file: int = ROWS_PER_FILE) -> int:
        """Rewrite small files and roll the manifests up into one file list; returns the files now.

        Rows of micro-batches come into their buckets, and each bucket is cut into ranges
        of time, so the newest rows lie in few files. Files of a bucket with at least half of
        ``rows_per_file`` rows stay as they are. Old files are not touched, as readers of
        older versions may need them. The log keeps one row per writer, whose batch numbers
        ascend, as those of a streaming query do. A batch stored meanwhile makes this start again.
        """
        for _ in range(ATTEMPTS):
            before = self.snapshot(spark)
            kept = [f for f in before.files.values() if f["bucket"] is not None and 2 * f["rows"] >= rows_per_file]
            whole = {f["path"] for f in kept}
            small = [f for f in before.files.values() if f["path"] not in whole]
            files = kept
            if small:
                parts = -(-sum(f["rows"] for f in small) // rows_per_file)
                rows = self._files(spark, small)
                rows = rows.withColumn("bucket", F.coalesce("bucket", bucket_of(F.col(KEY), before.buckets)))
                # Ranges of (bucket, time): a file holds one bucket's slice of time.
                dealt = rows.repartitionByRange(parts, "bucket", TIME, KEY).sortWithinPartitions("bucket", TIME, KEY)
                files = kept + self._write(dealt, "compacted", -1, rows_per_file)
            state = f"states/{uuid.uuid4().hex}.json"
            whole_state = {
                "files": files, "log": _rolled(before.log),
                "rejected": [{"writer": w, "batch_id": b, "paths": paths} for (w, b), paths in before.rejected.items()],
            }
            create_once(spark, f"{self.path}/{state}", json.dumps(whole_state))
            try:
                self.commit(spark, before, {"state": state, "added": []})
                return len(files)
            except Lost:
                continue
        raise Lost(self.path)

    def _write(self, rows: DataFrame, writer: str, batch_id: int, ndv: int = ROWS_PER_FILE) -> list[dict]:
        """Files of rows that carry ``bucket``, in a folder of their own, with what a manifest says of them."""
        spark = rows.sparkSession
        commit = f"commit={uuid.uuid4().hex}"
        place = f"{self.path}/data/{commit}"
        (
            rows.write.partitionBy("bucket")
            .option(f"parquet.bloom.filter.enabled#{KEY}", "true")
            .option(f"parquet.bloom.filter.expected.ndv#{KEY}", str(ndv))
            .parquet(place)
        )
        if not any(name.startswith("bucket=") for name in listed(spark, place)):
            return []
        back = spark.read.schema(_BUCKETED).parquet(place)
        # One row per file, from two columns of the rows just written.
        found = back.groupBy(F.col("_metadata.file_path").alias("path"), "bucket").agg(
            F.count(F.lit(1)).alias("rows"), F.min(KEY).alias("first_key"), F.max(KEY).alias("last_key"),
            F.min(TIME).alias("first_time"), F.max(TIME).alias("last_time"), F.count(TIME).alias("timed_rows"),
        )
        return [
            r.asDict() | {"path": "data/" + commit + r["path"].split(commit, 1)[1], "writer": writer, "batch_id": batch_id} for r in found.collect()
        ]


def _rolled(log: dict[tuple[str, int], dict]) -> list[dict]:
    """One entry per writer: sums, extremes and the last batch."""
    rolled: dict[str, dict] = {}
    for entry in log.values():
        had = rolled.setdefault(entry["writer"], dict(entry) | {"rolled": True, **dict.fromkeys(_SUMS, 0), "first_time": None, "last_time": None})
        for name in _SUMS:
            had[name] += entry[name] or 0
        for name, pick in (("batch_id", max), ("last_id", max), ("first_time", min), ("last_time", max)):
            had[name] = pick((v for v in (had[name], entry[name]) if v is not None), default=None)
    return list(rolled.values())


@dataclass
class Transaction:
    """One batch on its way into the store; the interface ``insert_new`` writes to."""

    target: CommittedTarget
    snapshot: Snapshot
    aside: list[str] = field(default_factory=list)
    added: list[dict] = field(default_factory=list)

    def done(self, writer: str, batch_id: int) -> Row | None:
        """What the batch counted, if it is in the store already: a commit is whole, so nothing is left to repeat."""
        for entry in self.snapshot.log.values():
            if entry["writer"] == writer and entry["batch_id"] == batch_id and not entry.get("rolled"):
                return Row(**{name: entry[name] for name in _COUNTED})
            if entry["writer"] == writer and batch_id <= entry["batch_id"] and entry.get("rolled"):
                # Its own counts went into the sum of all.
                return Row(**(dict.fromkeys(_COUNTED, 0) | {"last_id": entry["last_id"]}))
        return None

    def stored(
        self, spark: SparkSession, keys: DataFrame, small: bool, writer: str, batch_id: int, others_only: bool, key: str = KEY
    ) -> DataFrame:
        """Stored keys to compare a batch with, from the files that can hold them.

        Few keys go into the scan as values: files are chosen by bucket and key
        range, row groups by their statistics and Bloom filters. More keys, whose
        size is checked by the caller, are broadcast and prune by bucket; beyond that
        the whole key column is joined. Rows that ``compact`` moved count as others'.
        """
        files = [f for f in self.snapshot.files.values() if not (others_only and f["writer"] == writer)]
        bucket = bucket_of(F.col(key), self.snapshot.buckets).alias("bucket")
        few = keys.select(key, bucket).limit(LOOKUP + 1).collect() if small else []
        if small and len(few) <= LOOKUP:
            by_bucket: dict[int, list[str]] = {}
            for row in few:
                by_bucket.setdefault(row["bucket"], []).append(row[0])
            every = sorted(row[0] for row in few)

            def able(f: dict) -> bool:
                among = every if f["bucket"] is None else by_bucket.get(f["bucket"], [])
                return any(f["first_key"] <= k <= f["last_key"] for k in among)

            found = self.target._files(spark, [f for f in files if able(f)])
            within = F.col("bucket").isNull() | F.col("bucket").isin(sorted(by_bucket))
            return F.broadcast(found.where(within & F.col(key).isin(every)).select(key).distinct())
        loose = self.target._files(spark, [f for f in files if f["bucket"] is None]).select(key)
        dealt = self.target._files(spark, [f for f in files if f["bucket"] is not None]).select(key, "bucket")
        if small:
            wanted = F.broadcast(keys.select(key, bucket))
            dealt = dealt.join(wanted, ["bucket", key], "left_semi").select(key)
            return F.broadcast(dealt.union(loose.join(wanted, key, "left_semi")).distinct())
        return dealt.select(key).union(loose)

    def append(self, fresh: DataFrame, rows: int, writer: str, batch_id: int) -> int:
        """Write rows under new ids, to be seen once committed; returns the last id given."""
        if not rows:
            return self.snapshot.last_id
        start = self.snapshot.last_id
        numbered = with_ids(fresh, start).withColumn("created_at", F.current_timestamp())
        if rows <= SMALL_BATCH:  # one file, in a bucket once compacted
            dealt = numbered.withColumn("bucket", F.lit(None).cast("int")).coalesce(1).sortWithinPartitions(KEY)
        else:
            bucketed = numbered.withColumn("bucket", bucket_of(F.col(KEY), self.snapshot.buckets))
            # Large batches are written by many tasks; compaction makes their files larger.
            files = -(-rows // (SMALL_BATCH or rows))  # 0: one file a bucket
            dealt = bucketed.repartitionByRange(files, "bucket", KEY).sortWithinPartitions("bucket", KEY)
        self.added = self.target._write(dealt, writer, batch_id, min(rows, SMALL_BATCH or rows))
        return start + rows

    def set_aside(self, rejects: DataFrame, rows: int, writer: str, batch_id: int) -> None:
        place = f"rejected/commit={uuid.uuid4().hex}"
        rejects.repartition(rows // ROWS_PER_FILE + 1).write.parquet(f"{self.target.path}/{place}")
        self.aside = [place]

    def finish(self, report: Row, categories: DataFrame, writer: str, batch_id: int) -> None:
        """Make the batch visible."""
        entry = {name: report[name] for name in _COUNTED} | {"writer": writer, "batch_id": batch_id}
        change = {"added": self.added, "log": entry, "rejected": self.aside}
        self.target.commit(categories.sparkSession, self.snapshot, change)
