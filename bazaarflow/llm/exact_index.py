"""Exact copies through an extendible-hash index kept in shared files.

A scan writes one index row per document; the normalised text itself, packed,
goes along once per task and text. A directory of hash prefixes is doubled
until no bucket holds more texts than its capacity; owner tasks then read the
buckets, chain texts with the same hash and compare their bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarflow.llm.tasks import batches, forget, give_back, join_classes, row_numbers, utf8, written

BLANKS = b" \t\n\x0b\x0c\r"
#: Texts in a bucket before it is split, and bits of a hash that one pass may use.
CAPACITY = 10_000
BITS = 18
#: Bytes of packed texts that a scan task remembers to recognise repeats.
REMEMBERED = 16 << 20


def exact_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per document row: which row of its class of equal texts stays.

    Texts are equal when identical after all ASCII blanks are deleted; null
    counts as empty, so null, empty and blank texts are one class. The row with
    the most code points stays, then the smallest id (null ids last), then any
    one row, so of repeated rows exactly one has ``kept``. Other columns of
    ``docs`` are ignored, an empty table gives an empty result.

    ``same_text`` (a hash of the whole original text) tells rows with one id
    but different texts apart.
    """
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("same_text"),
        F.col(text).cast("string").alias("text"),
    )
    index = written(
        rows.mapInArrow(
            _index_rows,
            "row long, entry long, doc_id long, same_text long, n_chars long, hash long, sha string, body binary",
        ),
        "exact-index",
    )
    chained = _chained(index, capacity)
    light = written(index.drop("body").join(chained, "entry", "left").na.fill(0, ["chain"]), "exact-rows")
    forget(index)  # the texts are on the disks no longer than they are compared
    # Partial maxima and counts are made in every task before the shuffle.
    groups = light.groupBy("hash", "chain").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.max(F.struct("n_chars", (-F.col("doc_id")).alias("a"), (-F.col("row")).alias("b"))).alias("best"),
    )
    groups = written(groups, "exact-classes")
    return join_classes(light, groups, ["hash", "chain"], "group_size").select(
        "doc_id",
        (-F.col("best.a")).alias("keep_id"),
        "group_size",
        (F.col("row") == -F.col("best.b")).alias("kept"),
        F.col("sha").alias("text_sha256"),
        "same_text",
    )


def _index_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    give_back()  # what earlier tasks of the worker needed
    numbers = row_numbers()
    pack = zstandard.ZstdCompressor(level=1).compress
    columns = {
        "row": pa.int64(), "entry": pa.int64(), "doc_id": pa.int64(), "same_text": pa.int64(),
        "n_chars": pa.int64(), "hash": pa.int64(), "sha": pa.string(), "body": pa.binary(),
    }

    def rows() -> Iterator[tuple]:
        seen: dict[int, list[tuple[bytes, int]]] = {}
        held = 0
        for part in parts:
            counts = pc.fill_null(pc.utf8_length(part.column("text")), 0).to_pylist()
            keys = zip(part.column("doc_id").to_pylist(), part.column("same_text").to_pylist(), counts, strict=True)
            for (doc, same, count), raw in zip(keys, utf8(part.column("text")), strict=True):
                body = raw.translate(None, BLANKS)
                sha = hashlib.sha256(body)
                hashed = int.from_bytes(sha.digest()[:8], "big", signed=True)
                number = next(numbers)
                known = seen.get(hashed, [])
                entry = next((e for other, e in known if other == body), None)
                if entry is None:
                    entry = number
                    seen.setdefault(hashed, []).append((body, number))
                    held += len(body)
                    yield number, entry, doc, same, count, hashed, sha.hexdigest(), pack(body)
                    if held > REMEMBERED:
                        seen.clear()
                        held = 0
                else:
                    yield number, entry, doc, same, count, hashed, sha.hexdigest(), None

    return batches(columns, rows(), 2048)


def directory(sizes: dict[int, int], capacity: int, bits: int = BITS) -> dict[int, tuple[int, int]]:
    """Directory of the index: for every hash prefix of ``bits`` bits the bucket (prefix, local depth) it points to.

    Starts with one bucket; an overfull bucket splits by its next bit, which
    doubles the directory where the bucket was as deep as the directory. A bucket as deep
    as ``bits`` stays and chains.
    """
    found: dict[int, tuple[int, int]] = {}
    waiting = [(0, 0)]
    while waiting:
        prefix, depth = waiting.pop()
        span = 1 << (bits - depth)
        slots = range(prefix * span, (prefix + 1) * span)
        if depth < bits and sum(sizes.get(s, 0) for s in slots) > capacity:
            waiting += [(2 * prefix, depth + 1), (2 * prefix + 1, depth + 1)]
        else:
            found |= {s: (prefix, depth) for s in slots if s in sizes}
    return found


def _chained(index: DataFrame, capacity: int) -> DataFrame:
    """Entries that follow another text with the same hash, with their place in the chain."""
    spark = index.sparkSession
    slot = F.shiftrightunsigned(F.col("hash"), 64 - BITS)
    texts = index.where(F.col("body").isNotNull())
    # At most 2 ** BITS counts.
    sizes = {r["slot"]: r["count"] for r in texts.groupBy(slot.alias("slot")).count().collect()}
    buckets = directory(sizes, max(capacity, sum(sizes.values()) >> (BITS - 1)))
    numbers = {bucket: n for n, bucket in enumerate(sorted(set(buckets.values()), key=lambda b: b[0] << (BITS - b[1])))}
    table = spark.createDataFrame([(s, numbers[b]) for s, b in buckets.items()], "slot long, bucket int")
    owned = (
        texts.select("entry", "hash", "body", slot.alias("slot"))
        .join(F.broadcast(table), "slot")  # at most 2 ** BITS rows
        .repartitionByRange(max(1, len(numbers)), "bucket")  # a task for every bucket
        .sortWithinPartitions("bucket", "hash", "entry")
        .select("entry", "hash", "body")
    )
    return written(owned.mapInArrow(_chains, "entry long, chain long"), "exact-chains")


def _chains(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress

    def rows() -> Iterator[tuple]:
        current, first, chain = None, b"", []
        for part in parts:
            for entry, hashed, body in zip(*(part.column(n).to_pylist() for n in ("entry", "hash", "body")), strict=True):
                if hashed != current:
                    current, first, chain = hashed, body, []
                    continue
                if not chain:
                    chain = [unpack(first)]
                plain = unpack(body)
                if plain not in chain:
                    chain.append(plain)
                if place := chain.index(plain):
                    yield entry, place

    return batches({"entry": pa.int64(), "chain": pa.int64()}, rows())
