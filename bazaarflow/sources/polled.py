"""A source that is polled again and again: every poll's fetches, each once, as a stream.

A poll is a folder ``poll=<number>`` of parquet files that counts once its
``_SUCCESS`` mark is there. Polls of the same pages repeat what earlier ones
brought; what is new among it is for the operators behind the source.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

NAME = "stored_fetches"


def store_fetch(pages: DataFrame, folder: str, poll: int) -> None:
    """Keep what one poll fetched. A poll that is stored again replaces itself as long as no stream has read it."""
    pages.write.mode("overwrite").parquet(f"{folder}/poll={poll:09d}")


def polls(spark: SparkSession, folder: str, schema: StructType, progress: str | None = None, polls_per_batch: int = 0) -> DataFrame:
    """The stored polls in order as a stream.

    ``polls_per_batch`` bounds a micro-batch of a stream with a timed trigger; 0 takes all there
    are. The bound needs ``progress``, a file in a shared folder that belongs
    to the query like its checkpoint and notes the polls planned so far: a restarted
    query goes on from there.
    """
    if polls_per_batch and not progress:
        raise ValueError("polls_per_batch needs a progress file")
    spark.dataSource.register(FetchSource)
    options = {"folder": folder, "perBatch": str(polls_per_batch), "progress": progress or ""}
    return spark.readStream.format(NAME).schema(schema).options(**options).load()


class FetchSource(DataSource):
    """Registered under ``stored_fetches``; ``polls`` sets its options."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:  # noqa: N802
        return FetchReader(self.options, schema)


class OneFile(InputPartition):
    def __init__(self, path: str):
        self.path = path


class FetchReader(DataSourceStreamReader):
    """Offsets are numbers of polls: those below an offset have been read."""

    def __init__(self, options: dict, schema: StructType):
        self.folder, self.per_batch, self.progress = options["folder"], int(options["perBatch"]), options["progress"]
        self.columns = schema.fieldNames()

    def _place(self, path: str) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else path.replace("file:", "", 1))

    def _polls(self) -> list[int]:
        """Complete polls, ascending."""
        system, place = self._place(self.folder)
        listed = system.get_file_info(fs.FileSelector(place, recursive=True, allow_not_found=True))
        found = (re.search(r"poll=(\d+)/_SUCCESS$", f.path) for f in listed)
        return sorted(int(m.group(1)) for m in found if m)

    def initialOffset(self) -> dict:  # noqa: N802
        return {"poll": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        planned, there = self._planned(), self._polls()
        waiting = [poll for poll in there if poll >= planned]
        if self.per_batch:
            waiting = waiting[: self.per_batch]
        return {"poll": waiting[-1] + 1 if waiting else planned}

    def partitions(self, start: dict, end: dict) -> list[OneFile]:
        # Spark has noted the offsets before it plans; what is planned is never offered again.
        if end["poll"] > self._planned():
            self._plan(end["poll"])
        system, place = self._place(self.folder)
        files = system.get_file_info(fs.FileSelector(place, recursive=True, allow_not_found=True))
        within = []
        for f in files:
            poll = re.search(r"poll=(\d+)/[^/_.][^/]*\.parquet$", f.path)
            if poll and start["poll"] <= int(poll.group(1)) < end["poll"]:
                within.append(OneFile(f.path))
        return within

    def read(self, partition: OneFile) -> Iterator[pa.RecordBatch]:
        system, _ = self._place(self.folder)
        with system.open_input_file(partition.path) as source:
            for batch in pq.ParquetFile(source).iter_batches(1024, columns=self.columns):
                yield batch.select(self.columns)

    def _planned(self) -> int:
        if not self.progress:
            return getattr(self, "_seen", 0)
        system, place = self._place(self.progress)
        if system.get_file_info(place).type == fs.FileType.NotFound:
            return 0
        with system.open_input_stream(place) as source:
            return json.loads(source.read())["poll"]

    def _plan(self, poll: int) -> None:
        self._seen = poll
        if self.progress:
            system, place = self._place(self.progress)
            system.create_dir(place.rpartition("/")[0], recursive=True)
            # Written aside and moved, so a reader finds the old or the new number.
            with system.open_output_stream(f"{place}.new") as out:
                out.write(json.dumps({"poll": poll}).encode())
            system.move(f"{place}.new", place)

    def commit(self, end: dict) -> None:
        """Stored polls stay; nothing to do."""
