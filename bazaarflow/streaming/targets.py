"""Stores of listings: a folder of parquet files, or a relational table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarflow.operators.serve import latest
from bazaarflow.schema import (
    KEY,
    LISTING,
    LISTING_FIELDS,
    MAX_LENGTHS,
    SNAPSHOT_ROWS,
    TIME,
    WIRE_NAMES,
)

_PARTITIONING = [T.StructField("writer", T.StringType()), T.StructField("batch_id", T.LongType())]
_STORED = T.StructType(
    [
        *LISTING.fields,
        T.StructField("id", T.LongType()),
        T.StructField("created_at", T.TimestampType()),
        *_PARTITIONING,
    ]
)
_REJECTED = T.StructType(
    [T.StructField("record", T.StringType()), T.StructField("reason", T.StringType()), *_PARTITIONING]
)
_CATEGORIES = T.StructType(
    [T.StructField("category", T.StringType()), T.StructField("rows", T.LongType()), *_PARTITIONING]
)
_LOG = T.StructType(
    [
        T.StructField(name, T.LongType())
        for name in (
            "total", "rejected", "new", "duplicates", "last_id",
            "timed_rows", "first_time", "last_time",
        )
    ]
    + _PARTITIONING
)
_ROW_BITS = (1 << 33) - 1  # row part of monotonically_increasing_id
ROWS_PER_FILE = 1_000_000


def with_ids(df: DataFrame, start: int) -> DataFrame:
    """Dense numbers from ``start + 1``, without passing rows through one task.

    Every task numbers its own rows; only one count per task is brought
    together to find where each task begins.
    """
    placed = df.withColumn("_task", F.spark_partition_id()).withColumn(
        "_row", F.monotonically_increasing_id().bitwiseAND(_ROW_BITS)
    )
    per_task = placed.groupBy("_task").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.orderBy("_task").rowsBetween(W.unboundedPreceding, -1))
    begins = per_task.select("_task", F.coalesce(before, F.lit(0)).alias("_before"))
    number = F.lit(start + 1) + F.col("_before") + F.col("_row")
    # One row per task of df, so the broadcast side is bounded.
    return placed.join(F.broadcast(begins), "_task").select(*df.columns, number.alias("id"))


def _files(rows: int) -> int:
    return rows // ROWS_PER_FILE + 1


@dataclass(frozen=True)
class LakeTarget:
    """Parquet folders partitioned by writer (a streaming query) and batch.

    A batch owns its partition and overwrites it, so a repeated batch leaves
    no second copy. ``log`` has one row per finished batch. Ids go on from the
    highest id in the log of all writers, whose batches may alternate but not
    overlap: ``start_insert`` lets one query at a time insert into a folder.
    """

    path: str

    def create(self, spark: SparkSession) -> LakeTarget:
        """Make the folders unless they exist."""
        for name, schema in self._tables().items():
            empty = spark.createDataFrame([], schema)
            empty.write.mode("ignore").partitionBy("writer", "batch_id").parquet(f"{self.path}/{name}")
        return self

    @staticmethod
    def _tables() -> dict[str, T.StructType]:
        return {"listings": _STORED, "rejected": _REJECTED, "categories": _CATEGORIES, "log": _LOG}

    def _read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.schema(self._tables()[name]).parquet(f"{self.path}/{name}")

    def read(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "listings")

    def rejected(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "rejected")

    def categories(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "categories")

    def log(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "log")

    def stored(
        self, spark: SparkSession, keys: DataFrame, small: bool, writer: str, batch_id: int,
        others_only: bool, key: str = KEY,
    ) -> DataFrame:
        """Stored keys to compare a batch with.

        The batch's own partition never counts (it may be left from a failed
        attempt). ``others_only`` leaves out all of the writer's partitions,
        for a stream whose state already keeps its keys apart.
        """
        own = F.col("writer") == writer
        mine = own if others_only else own & (F.col("batch_id") == batch_id)
        stored = self.read(spark).where(~mine).select(key)
        if small:
            # Scan the stored keys in place; only those of the batch come back.
            return F.broadcast(stored.join(F.broadcast(keys), key, "left_semi").distinct())
        return stored

    def last_id(self, spark: SparkSession, writer: str, batch_id: int) -> int:
        """The highest id of all writers' other batches."""
        mine = (F.col("writer") == writer) & (F.col("batch_id") == batch_id)
        return self.log(spark).where(~mine).agg(F.max("last_id")).first()[0] or 0

    def append(self, fresh: DataFrame, rows: int, writer: str, batch_id: int) -> int:
        """Store rows under new ids; returns the last id given."""
        spark = fresh.sparkSession
        start = self.last_id(spark, writer, batch_id)
        numbered = with_ids(fresh, start).withColumn("created_at", F.current_timestamp())
        self._overwrite(numbered, "listings", writer, batch_id, rows)
        return start + rows

    def set_aside(self, rejects: DataFrame, rows: int, writer: str, batch_id: int) -> None:
        # A shuffle, not a coalesce, which would pull the scan before it into as few tasks.
        self._overwrite(rejects.repartition(_files(rows)), "rejected", writer, batch_id, rows)

    def finish(self, report: Row, categories: DataFrame, writer: str, batch_id: int) -> None:
        spark = categories.sparkSession
        self._overwrite(categories, "categories", writer, batch_id, 1)
        counted = [name for name in _LOG.fieldNames() if name not in ("writer", "batch_id")]
        entry = spark.range(1).select(
            *[F.lit(report[name]).cast("long").alias(name) for name in counted]
        )
        self._overwrite(entry, "log", writer, batch_id, 1)

    def _overwrite(self, df: DataFrame, name: str, writer: str, batch_id: int, rows: int) -> None:
        place = f"{self.path}/{name}/writer={writer}/batch_id={batch_id}"
        df.coalesce(_files(rows)).write.mode("overwrite").parquet(place)

    def newest(self, spark: SparkSession, rows: int = SNAPSHOT_ROWS, tie_break: list[str] | None = None) -> DataFrame:
        """The newest rows, reading recent batches only.

        The log tells a time that at least ``rows`` stored rows reach: the
        batches that start latest are added up until they hold enough. Rows
        before that time cannot be among the newest.
        """
        log = self.log(spark).where(F.col("timed_rows") > 0)
        # Each of these batches has a row, so ``rows`` of them always suffice.
        starts = log.orderBy(F.desc("first_time")).limit(rows).select("first_time", "timed_rows").collect()
        reached, floor = 0, None
        for start in starts:
            reached += start.timed_rows
            if reached >= rows:
                floor = start.first_time
                break
        stored = self.read(spark)
        if floor is not None:
            late = log.where(F.col("last_time") >= floor).select("writer", "batch_id")
            stored = stored.where(F.col(TIME) >= floor).join(late, ["writer", "batch_id"], "left_semi")
        return latest(stored.select(*LISTING_FIELDS, "id", "created_at"), rows, tie_break)


@dataclass(frozen=True)
class JdbcTarget:
    """A table with a unique key in a database, under the message field names.

    ``id`` and ``created_at`` are the database's business.
    """

    options: dict[str, str]
    table: str
    lookup_limit: int = 1000

    def _names(self) -> list[Column]:
        return [F.col(name).alias(WIRE_NAMES[name]) for name in LISTING_FIELDS]

    def _back(self) -> list[Column]:
        return [F.col(WIRE_NAMES[name]).alias(name) for name in LISTING_FIELDS]

    def read_options(self) -> dict[str, str]:
        return {**self.options, "dbtable": self.table}

    def newest_options(self, rows: int = SNAPSHOT_ROWS) -> dict[str, str]:
        """Sorting and limit are left to the database."""
        time = WIRE_NAMES[TIME]
        none_last = f"case when {time} is null then 1 else 0 end"
        order = f"order by {none_last}, {time} desc, {WIRE_NAMES[KEY]} limit {int(rows)}"
        return {**self.options, "query": f"select * from {self.table} {order}"}

    def write_options(self) -> dict[str, str]:
        return {"batchsize": "5000", **self.options, "dbtable": self.table}

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.format("jdbc").options(**self.read_options()).load().select(*self._back())

    def newest(self, spark: SparkSession, rows: int = SNAPSHOT_ROWS) -> DataFrame:
        found = spark.read.format("jdbc").options(**self.newest_options(rows)).load()
        return latest(found.select(*self._back()), rows)

    def stored(
        self, spark: SparkSession, keys: DataFrame, small: bool, writer: str, batch_id: int,
        others_only: bool, key: str = KEY,
    ) -> DataFrame:
        """Few keys are looked up by index; many are joined to the key column.

        After a failed attempt the rows it did commit show up here, so the
        repeated batch adds the missing ones only.
        """
        stored = self.read(spark).select(key)
        few = keys.limit(self.lookup_limit + 1).collect() if small else []
        if small and len(few) <= self.lookup_limit:
            return F.broadcast(stored.where(F.col(key).isin([row[0] for row in few])))
        if small:
            return F.broadcast(stored.join(F.broadcast(keys), key, "left_semi").distinct())
        return stored

    def append(self, fresh: DataFrame, rows: int, writer: str, batch_id: int) -> None:
        named = fresh.select(*self._names())
        named.write.format("jdbc").options(**self.write_options()).mode("append").save()

    def set_aside(self, rejects: DataFrame, rows: int, writer: str, batch_id: int) -> None:
        """Rejected rows go to a table beside the target, which ``rejected_ddl`` makes.

        A repeated batch adds what its first attempt didn't.
        """
        there = rejects.sparkSession.read.format("jdbc").options(**self.rejected_options(writer, batch_id)).load()
        missing = rejects.select("record", "reason").exceptAll(there.select("record", "reason"))
        named = missing.withColumns({"writer": F.lit(writer), "batch_id": F.lit(batch_id)})
        options = {**self.write_options(), "dbtable": f"{self.table}_rejected"}
        named.write.format("jdbc").options(**options).mode("append").save()

    def rejected_options(self, writer: str, batch_id: int) -> dict[str, str]:
        """The rows that an earlier attempt at the batch left; the database chooses them."""
        name = writer.replace("'", "''")
        query = f"select record, reason from {self.table}_rejected where writer = '{name}' and batch_id = {int(batch_id)}"
        return {**self.options, "query": query}

    def finish(self, report: Row, categories: DataFrame, writer: str, batch_id: int) -> None:
        """The database keeps no batch log."""


def column_types() -> str:
    """Column types for Spark's ``createTableColumnTypes`` option."""
    sized = [f"{WIRE_NAMES[name]} VARCHAR({size})" for name, size in MAX_LENGTHS.items()]
    return ", ".join(sized)


def table_ddl(table: str) -> str:
    """Target table with generated id, unique key and insertion time."""
    lines = ["id INT AUTO_INCREMENT PRIMARY KEY"]
    for name in LISTING_FIELDS:
        if name == TIME:
            kind = "BIGINT"
        else:
            kind = f"VARCHAR({MAX_LENGTHS[name]})" if name in MAX_LENGTHS else "TEXT"
        lines.append(f"{WIRE_NAMES[name]} {kind}" + (" UNIQUE" if name == KEY else ""))
    lines.append("created_at TIMESTAMP DEFAULT CURRENT_TIMESTAMP")
    return f"CREATE TABLE IF NOT EXISTS {table} (\n  " + ",\n  ".join(lines) + "\n)"


def rejected_ddl(table: str) -> str:
    """Table for rejected rows beside the target."""
    return f"CREATE TABLE IF NOT EXISTS {table}_rejected (\n  record TEXT,\n  reason VARCHAR(500),\n  writer VARCHAR(64),\n  batch_id BIGINT\n)"
