"""Token ids of all documents in binary files, ascending by document id.

Ids are replaced by their rank in the corpus, most frequent first, so that most
need one byte. A block of a file keeps the bytes of its ranks apart from the
control bytes, which hold the byte counts of four ranks each: a table with one
row per control byte gives all counts at once, and numpy gathers the ranks.

Folder: ``ranks.bin`` (ids by rank), ``manifest`` (a table of the files that
count, in order) and the files, each a run of blocks.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from bazaarflow.llm.tasks import batches, forget, kept, row_numbers, slices, utf8, written
from bazaarflow.llm.word_pieces import WordPieces

END = 1
#: Bytes of text encoded at a time, rows that become Python objects at a time, and ids of a block unless one document has more.
AT_ONCE = 8 << 20
ROWS = 2048
BLOCK = 1 << 20
MAGIC = b"TKIDS\x00\x01\n"
#: Documents, bytes of control and of ranks that follow. Every document starts a control byte of its own.
HEAD = "<QQQ"
_MANIFEST = "file string, task int, docs long, ids long, bytes long"
#: Bytes of each of the four ranks of a control byte, two bits a rank, the lowest first.
WIDTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1


def width_of(vocabulary: str) -> int:
    """Bytes that hold any id of the vocabulary file."""
    return 2 if Tokenizer.from_file(vocabulary).get_vocab_size() <= 1 << 16 else 4


def tokens(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", end: int = END, width: int = 4) -> DataFrame:
    """``doc_id``, ``row`` (numbers the rows) and ``ids`` of the whole text with ``end`` after them, as bytes.

    ``vocabulary`` is the path of a word-level BPE file, read by the driver. Null
    counts as empty, which is ``end`` alone. Ids are little-endian unsigned integers of ``width`` bytes.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(open(vocabulary, "rb").read())  # one vocabulary file

    def encoded(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = kept("word_pieces", vocabulary, lambda: WordPieces(shipped.value))
        last = np.array([end], "<u4").tobytes()

        def rows() -> Iterator[tuple]:
            numbers = row_numbers()
            for part in (few for whole in parts for few in slices(whole, ROWS)):
                ids = part.column("doc_id").to_pylist()
                for n, found in words.encode_parts(utf8(part.column("text")), AT_ONCE):
                    found += last
                    yield ids[n], next(numbers), found if width == 4 else np.frombuffer(found, "<u4").astype(f"<u{width}").tobytes()

        return batches({"doc_id": pa.int64(), "row": pa.int64(), "ids": pa.binary()}, rows(), 1024)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(encoded, "doc_id long, row long, ids binary")


def write_tokens(encoded: DataFrame, folder: str, width: int = 4) -> DataFrame:
    """Writes the rows of ``tokens`` into files below ``folder`` and returns the manifest.

    The ids are coded before they are sorted, so the shuffle moves what the files will hold.

    Documents ascend by id, null ids first; rows with one id follow each other by
    the checksum of their ids. A task writes one file under a name of its own and
    reports it in the manifest, so what a lost or repeated attempt left behind does
    not count. An empty table gives an empty manifest.
    """
    encoded = written(encoded, "tokens")
    ids = frequency_ranks(encoded, width)
    _store(f"{folder}/ranks.bin", ids.tobytes())
    rank = np.zeros(int(ids.max(initial=0)) + 1, np.uint32)
    rank[ids] = np.arange(len(ids), dtype=np.uint32)
    shipped = encoded.sparkSession.sparkContext.broadcast(rank)  # as long as the vocabulary

    def coded(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = shipped.value

        def rows() -> Iterator[tuple]:
            for part in parts:
                docs, numbers, ids = (part.column(c).to_pylist() for c in ("doc_id", "row", "ids"))
                yield from zip(docs, numbers, *zip(*_coded(ids, rank, width), strict=True), strict=True)

        columns = {"doc_id": pa.int64(), "row": pa.int64(), "crc": pa.int64(), "n": pa.int64(), "control": pa.binary(), "data": pa.binary()}
        return batches(columns, rows(), 1024)

    def stored(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _write_file(parts, folder)

    order = [F.col("doc_id").asc_nulls_first(), F.col("crc"), F.col("row")]
    rows = written(encoded.mapInArrow(coded, "doc_id long, row long, crc long, n long, control binary, data binary"), "token-codes")
    forget(encoded)
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    files = dealt.select("doc_id", "n", "control", "data").mapInArrow(stored, _MANIFEST)
    files.write.parquet(f"{folder}/manifest")
    forget(rows)
    return manifest(encoded.sparkSession, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The files in order: ``file``, ``docs``, ``ids``, ``bytes`` and ``start``, the ids of all files before."""
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file.
    return spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest").withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def frequency_ranks(encoded: DataFrame, width: int = 4) -> np.ndarray:
    """All ids that occur, the most frequent first, then by number."""

    def counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for part in parts:
            joined = b"".join(part.column("ids").to_pylist())
            found = np.bincount(np.frombuffer(joined, f"<u{width}"), minlength=len(total))
            found[: len(total)] += total
            total = found
        here = np.flatnonzero(total)
        yield pa.record_batch([pa.array(here), pa.array(total[here])], names=["id", "n"])

    counts = encoded.select("ids").mapInArrow(counted, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    rows = counts.orderBy(F.desc("n"), "id").collect()  # as many as the vocabulary has at most
    return np.array([r["id"] for r in rows], "<u4")


def pack_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and rank bytes."""
    width = 1 + (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = width - 1
    fours = codes.reshape(-1, 4)
    control = fours[:, 0] | fours[:, 1] << 2 | fours[:, 2] << 4 | fours[:, 3] << 6
    # Rows of four bytes, lowest first; of each the first `width` are kept.
    spread = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)
    return control.tobytes(), spread[np.arange(4) < width[:, None]].tobytes()


def _coded(texts: list[bytes], rank: np.ndarray, width: int) -> Iterator[tuple[int, int, bytes, bytes]]:
    """Checksum, count, control and rank bytes of each text's ids, about ``BLOCK`` ids at a time."""
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and size < BLOCK:
            size += len(texts[to]) // width
            to += 1
        some = texts[at:to]
        ids = np.frombuffer(b"".join(some), f"<u{width}").astype("<u4")
        counts = np.array([len(t) // width for t in some], np.int64)
        ends = np.cumsum(counts)
        places = -(-counts // 4) * 4
        last = np.cumsum(places)
        # Every text from a control byte of its own: its ids lie in fours, with the last places empty.
        padded = np.zeros(int(last[-1]), np.uint32)
        taken = np.zeros(len(padded), bool)
        where = np.arange(len(ids)) + np.repeat(last - places - ends + counts, counts)
        padded[where], taken[where] = rank[ids], True
        bytes_of = 1 + (padded >= 1 << 8).astype(np.uint8) + (padded >= 1 << 16) + (padded >= 1 << 24)
        fours = (bytes_of - 1).reshape(-1, 4)
        control = (fours[:, 0] | fours[:, 1] << 2 | fours[:, 2] << 4 | fours[:, 3] << 6).tobytes()
        bytes_of[~taken] = 0
        data = padded.view(np.uint8).reshape(-1, 4)[np.arange(4) < bytes_of[:, None]].tobytes()
        whole = ids.tobytes()
        stop = np.concatenate([[0], np.cumsum(bytes_of, dtype=np.int64)])[last].tolist()
        begin = 0
        for n, end, place, c, cut in zip(counts.tolist(), ends.tolist(), (last // 4).tolist(), (places // 4).tolist(), stop, strict=True):
            yield zlib.crc32(whole[4 * (end - n) : 4 * end]), n, control[place - c : place], data[begin:cut]
            begin = cut
        at = to


def unpack_ranks(control: bytes, data: bytes, counts: np.ndarray) -> np.ndarray:
    """The ranks of texts with so many ids each, by a look-up of the widths of four at a time."""
    width = WIDTHS[np.frombuffer(control, np.uint8)].ravel()
    # The last control byte of a text may have places to spare.
    places = -(-counts // 4) * 4
    first = np.cumsum(places) - places
    width = width[np.arange(len(width)) - np.repeat(first, places) < np.repeat(counts, places)]
    end = np.cumsum(width, dtype=np.int64)
    start = end - width
    raw = np.frombuffer(data, np.uint8)
    ranks = raw[start].astype(np.uint32)
    for more in (1, 2, 3):
        wide = np.flatnonzero(width > more)
        if not len(wide):
            break
        ranks[wide] |= raw[start[wide] + more].astype(np.uint32) << np.uint32(8 * more)
    return ranks


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else path.replace("file:", "", 1))


def _store(path: str, data: bytes) -> None:
    system, place = _place(path)
    system.create_dir(place.rpartition("/")[0], recursive=True)
    with system.open_output_stream(place, compression=None) as out:
        out.write(data)


def _write_file(parts: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get().partitionId()
    name = f"part-{task:06d}-{uuid.uuid4().hex}.ids"
    system, place = _place(f"{folder}/{name}")
    out, docs, total, size = None, 0, 0, len(MAGIC)
    held: list[tuple] = []
    waiting = 0

    def store_block() -> None:
        nonlocal out, docs, total, size, waiting
        out = out or _opened(system, place)
        names, counts, control, data = zip(*held, strict=True)
        block = b"".join([
            struct.pack(HEAD, len(held), sum(map(len, control)), sum(map(len, data))),
            np.array([n or 0 for n in names], "<i8").tobytes(), np.packbits([n is None for n in names]).tobytes(),
            np.array(counts, "<u8").tobytes(), *control, *data,
        ])
        out.write(block)
        docs, total, size, waiting = docs + len(held), total + waiting, size + len(block), 0
        held.clear()

    try:
        for part in parts:
            for row in zip(*(part.column(c).to_pylist() for c in ("doc_id", "n", "control", "data")), strict=True):
                held.append(row)
                waiting += row[1]
                if waiting >= BLOCK:
                    store_block()
        if held:
            store_block()
    finally:
        if out:
            out.close()
    if docs:
        schema = pa.schema([("file", pa.string()), ("task", pa.int32()), ("docs", pa.int64()), ("ids", pa.int64()), ("bytes", pa.int64())])
        yield pa.RecordBatch.from_pylist([{"file": name, "task": task, "docs": docs, "ids": total, "bytes": size}], schema)


def _opened(system: fs.FileSystem, place: str) -> pa.NativeFile:
    system.create_dir(place.rpartition("/")[0], recursive=True)
    out = system.open_output_stream(place, compression=None)
    out.write(MAGIC)
    return out


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """Documents from the files: ``doc_id``, ``start`` (ids of all documents before), ``n_tokens``, ``ids_crc32`` and, unless left out, ``ids``."""
    listed = manifest(spark, folder)
    columns = {"doc_id": pa.int64(), "start": pa.int64(), "n_tokens": pa.int64(), "ids_crc32": pa.int64()}
    if with_ids:
        columns["ids"] = pa.binary()

    def opened(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for part in parts:
                for name, start, size in zip(*(part.column(c).to_pylist() for c in ("file", "start", "bytes")), strict=True):
                    for row in _read_file(folder, name, start, size):
                        yield row if with_ids else row[:-1]

        return batches(columns, rows(), 1024)

    # A task for every file.
    dealt = listed.repartitionByRange(max(1, listed.count()), "task").select("file", "start", "bytes")
    return dealt.mapInArrow(opened, "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else ""))


def _read_file(folder: str, name: str, start: int, size: int) -> Iterator[tuple]:
    system, place = _place(f"{folder}/ranks.bin")
    with system.open_input_stream(place, compression=None) as source:
        by_rank = np.frombuffer(source.read(), "<u4")
    system, place = _place(f"{folder}/{name}")
    with system.open_input_stream(place, compression=None) as source:
        if source.read(len(MAGIC)) != MAGIC:
            raise ValueError(f"{name} is no file of token ids")
        at = len(MAGIC)
        while at < size:
            docs, control, data = struct.unpack(HEAD, source.read(struct.calcsize(HEAD)))
            names = np.frombuffer(source.read(8 * docs), "<i8").tolist()
            absent = np.unpackbits(np.frombuffer(source.read(-(-docs // 8)), np.uint8), count=docs).tolist()
            counts = np.frombuffer(source.read(8 * docs), "<u8").astype(np.int64)
            ids = by_rank[unpack_ranks(source.read(control), source.read(data), counts)].tobytes()
            ends = np.cumsum(counts).tolist()
            for doc, none, n, end in zip(names, absent, counts.tolist(), ends, strict=True):
                found = ids[4 * (end - n) : 4 * end]
                yield None if none else doc, start + end - n, n, zlib.crc32(found), found
            start += len(ids) // 4
            at += struct.calcsize(HEAD) + 16 * docs + -(-docs // 8) + control + data
