"""Byte-level BPE by longest matches and backtracking.

The vocabulary is an Aho-Corasick automaton over Latin-1 characters that stand
for bytes. A word is encoded left to right: the longest token that matches, or
the next shorter one, is taken if merging would leave the last token and it
side by side; where none is left, the last token is given back. That gives the
ids of the merge rules, as every prefix has only one such sequence.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarflow.llm.tasks import batches, kept

#: Words and token pairs remembered by a worker.
REMEMBERED = 400_000
#: A word is encoded without being remembered when it is longer.
LONGEST = 64


class BytePieces:
    """Encodes and decodes with the ranks of a rank file; ``pattern`` cuts a text into words."""

    def __init__(self, ranks: bytes, pattern: str):
        self.tokens: dict[bytes, int] = {}
        for line in ranks.splitlines():
            token, rank = line.split()
            self.tokens[base64.b64decode(token)] = int(rank)
        self.words = regex.compile(pattern)
        self.texts = dict((rank, token) for token, rank in self.tokens.items())
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.tokens.items():
            self.automaton.add_word(token.decode("latin-1"), (len(token), rank))
        self.automaton.make_automaton()
        self.halves: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], bool] = {}
        self.known: dict[str, bytes] = {}

    def _parts(self, token: int) -> tuple[int, int]:
        """The two tokens whose merge makes this one; a single byte has itself twice."""
        found = self.halves.get(token)
        if found is None:
            text = self.texts[token]
            parts = [text[n : n + 1] for n in range(len(text))]
            while len(parts) > 2:
                at = min(range(len(parts) - 1), key=lambda n: self.tokens.get(parts[n] + parts[n + 1], 1 << 40))
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            found = (self.tokens[parts[0]], self.tokens[parts[-1]])
            self.halves[token] = found
        return found

    def beside(self, left: int, right: int) -> bool:
        """Whether merging the two tokens' bytes together leaves exactly these two tokens.

        Goes back through the merges that made them: at the seam, no pair that
        once stood there may merge before one of its two sides did.
        """
        key = (left, right)
        found = self.joined.get(key)
        if found is not None:
            return found
        # Merge ranks equal token ids. The seam's pair (a, b) stands until the first
        # of the merges that take a or b away, whose rank is `until`.
        a, b, until = left, right, 1 << 40
        found = True
        while True:
            merged = self.tokens.get(self.texts[a] + self.texts[b])
            # Of equal ranks the leftmost merges first: one that takes `a` away stands left of the seam.
            if merged is not None and merged < until:
                found = False
                break
            if len(self.texts[a]) == 1 and len(self.texts[b]) == 1:
                break
            # The later of the two merges is undone first; of equal ones the right one came later.
            if len(self.texts[a]) > 1 and (a > b or len(self.texts[b]) == 1):
                until, a = a, self._parts(a)[1]
            else:
                until, b = b + 1, self._parts(b)[0]
        if len(self.joined) > REMEMBERED:
            self.joined.clear()
        self.joined[key] = found
        return found

    def word(self, data: bytes) -> list[int]:
        """Ids of one word."""
        whole = self.tokens.get(data)
        if whole is not None:
            return [whole]
        size = len(data)
        starting: list[list[tuple[int, int]]] = [[] for _ in range(size)]
        # Matches come by ending place, so those of a start come shortest first.
        for end, (length, token) in self.automaton.iter(data.decode("latin-1")):
            starting[end - length + 1].append((length, token))
        ids: list[int] = []
        at = 0
        lengths: list[int] = []
        choice = [len(starting[0]) - 1]
        closed = bytearray(size + 1)
        while at < size:
            options, n = starting[at], choice[-1]
            while n >= 0:
                length, token = options[n]
                if not closed[at + length] and (not ids or self.beside(ids[-1], token)):
                    break
                n -= 1
            if n >= 0:
                choice[-1] = n - 1
                ids.append(token)
                lengths.append(length)
                at += length
                if at < size:
                    choice.append(len(starting[at]) - 1)
            else:
                # No sequence goes on from here: whatever else leads here fails too.
                closed[at] = 1
                choice.pop()
                at -= lengths.pop()
                ids.pop()
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        known = self.known
        out = []
        for word in self.words.findall(text):
            found = known.get(word)
            if found is None:
                found = np.array(self.word(word.encode()), "<u4").tobytes()
                if len(word) <= LONGEST:
                    if len(known) > REMEMBERED:
                        known.clear()
                    known[word] = found
            out.append(found)
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.texts.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def byte_pieces(docs: DataFrame, ranks: str, pattern: str, doc_id: str = "doc_id", text: str = "text", with_ids: bool = True) -> DataFrame:
    """Per document row: ``ids`` of its whole text, their digest and the digest of the text decoded from them.

    ``ranks`` is the path of a rank file, read by the driver; no special tokens
    are known. Null counts as empty and has no ids; other columns are ignored;
    an empty table gives an empty result. Without ``with_ids`` the ids are left out.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(open(ranks, "rb").read())  # one vocabulary file
    columns = {"doc_id": pa.int64(), "n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
    if with_ids:
        columns["ids"] = pa.binary()

    def encoded(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = kept("byte_pieces", (ranks, pattern), lambda: BytePieces(shipped.value, pattern))

        def rows() -> Iterator[tuple]:
            for part in parts:
                for doc, one in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    ids = pieces.encode(one or "")
                    row = doc, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(pieces.decode(ids)).hexdigest()
                    yield (*row, ids) if with_ids else row

        return batches(columns, rows(), 1024)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(encoded, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids binary" if with_ids else ""))
