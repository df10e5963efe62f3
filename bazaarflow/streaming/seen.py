"""Seen keys bounded by count: a stream's memory of keys that never outgrows its limit."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from bazaarflow.schema import KEY

#: Parts of the state, each with its own limit.
PARTS = 64
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def require_rocksdb(spark: SparkSession) -> None:
    """State with maps, and state larger than memory, needs this store; say so before a stream starts."""
    if "RocksDB" not in spark.conf.get(_PROVIDER, ""):
        raise ValueError(f"set {_PROVIDER} to {ROCKSDB} before the stream starts (state_settings has it)")


class _SeenKeys(StatefulProcessor):
    """Of one part: the seen keys in their order of arrival.

    They are read and written as one list, not key by key, as each access to the state is a message
    to the JVM. A list never holds more than ``limit`` keys.
    """

    def __init__(self, key: str, order: list[str], limit: int, keep: int, columns: list[str]):
        self.key, self.order, self.limit, self.keep, self.columns = key, order, limit, keep, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getListState("seen", "key string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held = [k for (k,) in self.seen.get()] if self.seen.exists() else []
        known = set(held)
        # The rows of one part in one micro-batch, which the source's admission limit bounds.
        batch = pd.concat([some[some[self.key].notna() & ~some[self.key].isin(known)] for some in rows], ignore_index=True)
        # Only rows that share a key need the whole order.
        again = batch[self.key].duplicated(keep=False)
        first = batch[again].sort_values([self.key, *self.order], kind="stable").drop_duplicates(self.key)
        batch = pd.concat([batch[~again], first]).sort_values(self.key, kind="stable")
        fresh = batch[self.key].tolist()
        if len(held) + len(fresh) <= self.limit:
            if fresh:
                self.seen.appendList([(k,) for k in fresh])
        elif self.keep:
            self.seen.put([(k,) for k in (held + fresh)[-self.keep :]])
        else:
            self.seen.clear()
        yield batch[self.columns]

    def close(self) -> None:
        pass


def stream_dedup_counted(
    stream: DataFrame, key: str = KEY, limit: int = 10_000, keep: int = 5_000, parts: int = PARTS, part: Column | None = None,
    order: list[str] | None = None,
) -> DataFrame:
    """A key passes unless it is among those last seen; ``limit`` bounds each of ``parts`` parts of the state.

    A part that holds more than ``limit`` keys after a micro-batch forgets all
    but the ``keep`` that came last (all of them with 0), so its state never holds more than ``limit``
    keys and those of a batch. Keys of one batch count in ascending order and
    their first row by ``order`` passes. Rows without a key never pass. ``part`` may
    be any whole number that depends on the key alone. Needs the RocksDB state store.
    """
    require_rocksdb(stream.sparkSession)
    where = F.pmod(F.xxhash64(key), F.lit(parts)) if part is None else part
    rest = [name for name in stream.columns if name != key] if order is None else order
    # Rows without a key would all meet in one part.
    dealt = stream.where(F.col(key).isNotNull()).withColumn("_part", where.cast("long"))
    return dealt.groupBy("_part").transformWithStateInPandas(
        statefulProcessor=_SeenKeys(key, rest, limit, keep, stream.columns), outputStructType=stream.schema, outputMode="append", timeMode="none"
    )
