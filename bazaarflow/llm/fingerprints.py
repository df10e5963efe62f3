"""Document fingerprints by content-defined chunking.

A gear hash over the bytes of a text marks cut points; a strict mask holds
before the usual chunk size and a loose one after it, so sizes stay near it.
A fingerprint is the set of chunk digests with the bytes that each stands for;
an insertion or a cut changes only the chunks around it.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarflow.llm.tasks import batches

LEAST, USUAL, MOST = 16, 40, 160
STRICT, LOOSE = np.uint32(0xFC000000), np.uint32(0xF0000000)
#: Ranges of ids that are handed to tasks, and documents in a range at least.
RANGES = 4096
RANGE_ROWS = 4_000
_GEAR = np.random.default_rng(5).integers(0, 2**32, 256, np.uint32)

Print = dict[int, int]


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of a text."""
    size = len(data)
    if size <= LEAST:
        return [size] if size else []
    # hash[i] = sum of gear[data[i - j]] << j: doubled windows give all 32 terms in five steps.
    gear = _GEAR[np.frombuffer(data, np.uint8)]
    for shift in (1, 2, 4, 8, 16):
        more = gear.copy()
        more[shift:] += gear[:-shift] << np.uint32(shift)
        gear = more
    loose = np.flatnonzero((gear & LOOSE) == 0)
    strict = loose[(gear[loose] & STRICT) == 0].tolist()
    loose = loose.tolist()
    out, start = [], 0
    while size - start > LEAST:
        # A cut lies behind the byte whose hash marks it.
        n = bisect_left(strict, start + LEAST - 1)
        end = strict[n] + 1 if n < len(strict) and strict[n] < start + USUAL else None
        if end is None:
            n = bisect_left(loose, start + USUAL - 1)
            end = loose[n] + 1 if n < len(loose) and loose[n] < start + MOST else min(size, start + MOST)
        out.append(end)
        start = end
    if start < size:
        out.append(size)
    return out


def fingerprint(data: bytes) -> Print:
    """Chunk digests with the bytes they stand for."""
    found: Print = {}
    start = 0
    for end in cuts(data):
        digest = xxhash.xxh3_64_intdigest(data[start:end]) >> 16
        found[digest] = found.get(digest, 0) + end - start
        start = end
    return found


def containment(one: Print, other: Print) -> float:
    """Share of the first one's bytes whose chunks the other has too; two empty ones are alike."""
    total = sum(one.values())
    if not total:
        return 1.0 if not other else 0.0
    if len(one) <= len(other):
        shared = sum(min(w, other[d]) for d, w in one.items() if d in other)
    else:
        shared = sum(min(w, one[d]) for d, w in other.items() if d in one)
    return shared / total


def shown(found: Print) -> str:
    """``digest:bytes`` in order of the digests."""
    return ",".join(f"{d:012x}:{w}" for d, w in sorted(found.items()))


def _in_order(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows in ranges of ascending ids; every range ends with a copy of the next one's first row (`extra`).

    Ranges follow from quantiles of the ids, at most RANGES of them, so what
    the driver sees is bounded. Rows with one id lie in one range.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    key = F.coalesce(F.col("doc_id"), F.lit(-(2**63)))  # null ids come first
    count = rows.count()
    parts = max(1, min(RANGES, count // RANGE_ROWS))
    edges = sorted(set(rows.select(F.percentile_approx(key, [n / parts for n in range(1, parts)], 10 * RANGES)).first()[0] or [])) if parts > 1 else []
    # One row for each range.
    ranged = rows.withColumn("range", _place(key, edges).cast("int"))
    firsts = {r["range"]: r["first"] for r in ranged.groupBy("range").agg(F.min(key).alias("first")).collect()}
    order = sorted(firsts)
    heads = docs.sparkSession.createDataFrame(
        [(firsts[r], order[n - 1]) for n, r in enumerate(order)], "head long, into int"
    )
    # The first row of a range, also where an id is repeated, is that with the smallest text.
    copies = (
        ranged.join(F.broadcast(heads), key == F.col("head"))  # at most RANGES rows
        .groupBy("doc_id", "into").agg(F.min("text").alias("text"))
        .select("doc_id", "text", F.col("into").alias("range"), F.lit(True).alias("extra"))
    )
    whole = ranged.select("doc_id", "text", "range", F.lit(False).alias("extra")).union(copies)
    return whole.repartition(max(1, len(order)), "range").sortWithinPartitions("range", "extra", F.col("doc_id").asc_nulls_first(), "text")


def _place(key: Column, edges: list[int]) -> Column:
    """Number of edges that are not above the key, by halves."""
    if not edges:
        return F.lit(0)
    middle = len(edges) // 2
    return F.when(key < edges[middle], _place(key, edges[:middle])).otherwise(_place(key, edges[middle + 1 :]) + middle + 1)


def compared_with_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every document and of its edited text, and how much of its own each contains.

    The edited text has the last half of its code points replaced by as many
    first ones of the next document, by ascending id, the last document's next
    being the first. Null texts count as empty; null ids come first; rows with
    one id follow each other by text. A single document is its own next. An
    empty table gives an empty result; other columns are ignored.
    """
    columns = {
        "doc_id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(),
        "edited_fingerprint": pa.string(), "near_edited": pa.float64(), "near_next": pa.float64(),
    }

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        held = None
        for part in parts:
            for row in zip(*(part.column(n).to_pylist() for n in ("range", "extra", "doc_id", "text")), strict=True):
                found = fingerprint(row[3].encode())
                # A copy from the next range only ends this one.
                if held is not None and not held[0][1] and held[0][0] == row[0]:
                    (_, _, doc, one), own = held
                    half = len(one) // 2
                    edited = (one[: len(one) - half] + row[3][:half]).encode()
                    other = own if not half else fingerprint(edited)
                    yield (
                        doc, len(one), hashlib.sha256(edited).hexdigest(), shown(own), shown(other),
                        containment(own, other), containment(own, found),
                    )
                held = row, found

    ordered = _in_order(docs, doc_id, text).select("range", "extra", "doc_id", "text")
    return ordered.mapInArrow(
        lambda parts: batches(columns, rows(parts), 512),
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the ``fingerprint`` of a text; all rows and columns stay, null texts count as empty."""

    @F.pandas_udf("string")
    def found(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part.map(lambda t: shown(fingerprint((t or "").encode())))

    column: Column = found(F.coalesce(F.col(text).cast("string"), F.lit("")))
    return docs.withColumn("fingerprint", column)
