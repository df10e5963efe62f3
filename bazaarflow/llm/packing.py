"""Documents into as few fixed-length token sequences as possible.

Sum-of-squares packing: a piece goes where the sum, over all residual gaps, of
the squared number of open bins with that gap becomes smallest. Pieces are
packed in shards; what lies in bins that a shard leaves with room is packed
again over as few shards as hold it, until one shard is left or a level saves less
than a bin a shard. No shard gets many more pieces than ``SHARD``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarflow.llm.tasks import batches, kept, row_numbers, slices, utf8, written
from bazaarflow.llm.word_pieces import WordPieces

LENGTH = 4096
END = 1
#: Pieces that one shard packs, and the room a bin may be left with before it is packed again.
SHARD = 50_000
ROOM = 16
#: Bytes of text encoded at a time, and rows that become Python objects at a time.
AT_ONCE = 4 << 20
ROWS = 2048


def token_pieces(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, end: int = END) -> DataFrame:
    """Pieces of at most ``length`` ids: one per document, more only for longer ones.

    ``vocabulary`` is the path of a word-level BPE file, read by the driver.
    Every document ends with the id ``end``; a null or empty text is that id
    alone. ``row`` numbers the rows, so repeated ids stay apart.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(open(vocabulary, "rb").read())  # one vocabulary file

    def pieces(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = kept("word_pieces", vocabulary, lambda: WordPieces(shipped.value))
        numbers = row_numbers()
        last = np.array([end], "<u4").tobytes()

        def rows() -> Iterator[tuple]:
            for part in (few for whole in parts for few in slices(whole, ROWS)):
                ids = part.column("doc_id").to_pylist()
                for n, found in words.encode_parts(utf8(part.column("text")), AT_ONCE):
                    found += last
                    row = next(numbers)
                    for piece, start in enumerate(range(0, len(found), 4 * length)):
                        cut = found[start : start + 4 * length]
                        yield row, ids[n], piece, start // 4, len(cut) // 4, zlib.crc32(cut)

        return batches(
            {"row": pa.int64(), "doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64()}, rows()
        )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(pieces, "row long, doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(pieces: DataFrame, length: int = LENGTH, shard: int = SHARD) -> DataFrame:
    """Adds ``sequence_id`` and ``offset``; every piece has a ``length`` of 1 to the sequence length.

    Equal lengths are packed in any order. An empty table gives an empty result.
    """
    waiting = written(pieces, "pieces")
    schema = f"{waiting._jdf.schema().toDDL()}, sequence_id long, offset long, open boolean"
    done = []
    level, open_bins = 0, None
    while True:
        shards = max(1, -(-waiting.count() // shard))

        def packed(parts: Iterator[pa.RecordBatch], level=level, last=shards == 1) -> Iterator[pa.RecordBatch]:
            return _packed(parts, length, level, last)

        # Spread over shards by row, anew at every level; the numbers say nothing about lengths.
        dealt = waiting.repartition(shards, F.xxhash64("row", "piece", F.lit(level))) if shards > 1 else waiting.coalesce(1)
        placed = written(dealt.mapInArrow(packed, schema), f"packed-{level}")
        bins = placed.agg(F.count_distinct("sequence_id").alias("all"), F.count_distinct(F.when(F.col("open"), F.col("sequence_id"))).alias("open")).first()
        # Another level is of use only where this one saved bins, one in every shard.
        if shards == 1 or not bins["open"] or (open_bins is not None and bins["all"] + shards > open_bins):
            return reduce(DataFrame.unionByName, [*done, placed.drop("open")])
        done.append(placed.where(~F.col("open")).drop("open"))
        waiting = placed.where(F.col("open")).select(waiting.columns)
        level, open_bins = level + 1, bins["open"]


def _packed(parts: Iterator[pa.RecordBatch], length: int, level: int, last: bool) -> Iterator[pa.RecordBatch]:
    held = [part for part in parts if part.num_rows]
    if not held:
        return
    rows = pa.Table.from_batches(held)
    sizes = rows.column("length").to_numpy()
    bins, offsets = tight(sizes, length)
    filled = np.bincount(bins, weights=sizes).astype(np.int64)
    open_ = (length - filled > ROOM)[bins] if not last else np.zeros(len(sizes), bool)
    # Levels and tasks number their sequences apart.
    base = (level << 54) + next(row_numbers())
    out = rows.append_column("sequence_id", pa.array(bins + base)).append_column("offset", pa.array(offsets)).append_column("open", pa.array(open_))
    yield from out.to_batches(8192)


def tight(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Packs, then packs what lies in bins with room anew for as long as that needs fewer bins."""
    bins, offsets = sum_of_squares(sizes, length)
    while True:
        used = np.bincount(bins, weights=sizes)
        roomy = np.flatnonzero((used > 0) & (length - used > ROOM))
        again = np.flatnonzero(np.isin(bins, roomy))
        new, places = sum_of_squares(sizes[again], length)
        if not len(again) or new.max() + 1 >= len(roomy):
            return np.unique(bins, return_inverse=True)[1], offsets
        bins[again], offsets[again] = new + bins.max() + 1, places


def sum_of_squares(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every piece, longest pieces first; a tie goes to the fullest bin."""
    # Open bins per residual gap. A closed bin counts no more and a new bin is always at hand,
    # which half a bin at either end expresses: squares change by 2 * (n[g - s] - n[g]) + 2.
    count = np.zeros(length + 1)
    count[0], count[length] = -0.5, 0.5
    stacks: list[list[int]] = [[] for _ in range(length + 1)]
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    made = 0
    for at in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[at])
        gaps = count[size:]
        change = np.where(gaps > 0, count[: length + 1 - size] - gaps, np.inf)
        gap = int(change.argmin()) + size
        if gap == length:
            number, made = made, made + 1
        else:
            number = stacks[gap].pop()
            count[gap] -= 1
        bins[at], offsets[at] = number, length - gap
        rest = gap - size
        if rest:
            stacks[rest].append(number)
            count[rest] += 1
    return bins, offsets
