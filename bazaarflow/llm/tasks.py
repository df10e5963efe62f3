"""Helpers shared by the operators: written tables and rows inside tasks."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Iterator
from functools import wraps

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarflow.sources.scratch import working_folder


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The frame as a table in the shared working folder: computed once, safe from lost executors."""
    path = working_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(table: DataFrame) -> None:
    """Remove a table that ``written`` made, once nothing is worked out from it any more."""
    spark = table.sparkSession
    jvm, settings = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for file in table.inputFiles()[:1]:
        place = jvm.org.apache.hadoop.fs.Path(file).getParent()
        place.getFileSystem(settings).delete(place, True)


def let_go(spark: SparkSession) -> None:
    """What is out of use leaves disks and memory now, not when some process's heap next runs full.

    The driver's collection ends the shuffles of frames that are gone. Executors then give back broadcasts, buffers
    beside the heap and code of earlier plans, and their heaps shrink to what is in use.
    """
    gc.collect()
    context = spark.sparkContext
    context._jvm.System.gc()
    if not context._jsc.sc().isLocal():  # there the driver is the executor
        executors = max(1, context._jsc.sc().getExecutorMemoryStatus().size() - 1)
        # Idle executors get one task each.
        spark.range(0, executors, 1, executors).select(F.expr("java_method('java.lang.System', 'gc')")).collect()


#: Rows of one class that one task of a join may get, and classes that may be broadcast instead.
HOT = 200
BROADCAST = 10_000


def join_classes(rows: DataFrame, classes: DataFrame, keys: list[str], size: str) -> DataFrame:
    """Inner join of rows with their class, one row per class, that holds the number ``size`` of its rows.

    A class with many rows goes to every task, so its rows stay where they are; there are at most
    ``BROADCAST`` such classes. The others meet by their keys.
    """
    total = classes.agg(F.sum(size)).first()[0] or 0
    many = F.col(size) > max(HOT, total // BROADCAST)
    hot = F.broadcast(classes.where(many))
    cold = rows.join(F.broadcast(classes.where(many).select(*keys)), keys, "left_anti").join(classes.where(~many), keys)
    return rows.join(hot, keys).unionByName(cold)


def row_numbers() -> Iterator[int]:
    """Numbers that no other task of the same stage gives."""
    number = TaskContext.get().partitionId() << 40
    while True:
        yield number
        number += 1


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8, null as empty."""
    return [text or b"" for text in column.cast(pa.binary()).to_pylist()]


def slices(part: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batch a few rows at a time, so that few texts at once become Python objects."""
    for at in range(0, part.num_rows, rows):
        yield part.slice(at, rows)


#: The setting for rows of an Arrow batch, and how many an operator in small batches gets.
BATCH, FEW = "spark.sql.execution.arrow.maxRecordsPerBatch", 512


def in_small_batches(operator):
    """The operator's tables are written with few rows in an Arrow batch.

    A batch of 10,000 texts, the default, lies in the executor's and the worker's memory as a whole,
    beside the heap. The session's own setting is back when the operator returns; what it returns must be
    worked out from written tables alone.
    """

    @wraps(operator)
    def run(docs: DataFrame, *args, **named) -> DataFrame:
        settings = docs.sparkSession.conf
        before, rows = settings.get(BATCH, None), int(settings.get(BATCH))
        settings.set(BATCH, str(min(rows, FEW) if rows > 0 else FEW))
        try:
            return operator(docs, *args, **named)
        finally:
            settings.unset(BATCH) if before is None else settings.set(BATCH, before)

    return run


def batches(columns: dict[str, pa.DataType], rows: Iterator[tuple], size: int = 8192) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of bounded length."""
    schema = pa.schema(list(columns.items()))
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        turned = zip(*held, strict=True)
        return pa.record_batch([pa.array(v, t) for v, t in zip(turned, columns.values(), strict=True)], schema=schema)

    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield batch()
            held.clear()
    if held:
        yield batch()


def kept(purpose: str, key, make):
    """What ``make`` gives, made once per Python worker: shipped code has fresh globals in every task.

    A worker holds one thing at a time. Whatever was made for another purpose
    or key is let go first, so a worker that lives through many jobs does not grow.
    """
    held = sys.__dict__.setdefault("_bazaarflow_held", {})
    if held.get("name") != (purpose, key):
        held.clear()
        give_back()
        held.update(thing=make(), name=(purpose, key))
    return held["thing"]


def give_back() -> None:
    """What the worker keeps for other tasks is let go; free memory goes back to the system, where its library can do that."""
    sys.__dict__.get("_bazaarflow_held", {}).clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another system's library
        pass
