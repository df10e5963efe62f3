"""Token ids of whole texts by a word-level BPE vocabulary, many words at a time.

The vocabulary's rules never join text across ASCII blanks, so a text is cut
there and each different chunk is encoded once per task. Plain Latin chunks go
through array merges: all words of one length are merged together, one merge of
lowest rank per word and step. Every other chunk goes to the library. Chunks are
told apart and put together again as Arrow and numpy arrays; only different ones
become Python objects.
"""

from __future__ import annotations

import gc
import json
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

NONE = np.int32(2**31 - 1)
#: Printable ASCII and Latin letters, on which case and composition are plain.
PLAIN = re.compile("[\x21-\x7e¡-įı-ɏ]+")
LONGEST = 64
_LETTERS = "".join(c for c in map(chr, range(33, 0x250)) if c.isalpha() and PLAIN.fullmatch(c))
#: Bytes of chunks and their ids that a worker remembers, and what an entry costs beside them.
REMEMBERED = 64 << 20
ENTRY = 130


class WordPieces:
    """Encodes texts like the vocabulary file's tokenizer without special tokens."""

    def __init__(self, vocabulary: bytes):
        text = vocabulary.decode()
        self.library = Tokenizer.from_str(text)
        model = json.loads(text)
        ids, merges = model["model"]["vocab"], model["model"]["merges"]
        self.words = regex.compile(model["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        left, right, new = (np.array(x, np.int64) for x in zip(*((ids[a], ids[b], ids[a + b]) for a, b in pairs), strict=True))
        self.new = new.astype(np.int32)
        self._hash(left << 16 | right)
        names = [_byte_name(b) for b in range(256)]
        self.inner = np.array([ids[n] for n in names], np.int32)
        self.last = np.array([ids[n + "</w>"] for n in names], np.int32)
        # Signs of which the vocabulary's rules cut a run off a word and leave it whole.
        self.signs = bytes(
            c for c in range(33, 127)
            if not chr(c).isalnum() and c not in b"'<|>" and self.words.findall(f"a{chr(c)}!{chr(c)}") == ["a", f"{chr(c)}!{chr(c)}"]
        )
        # Letters, alone or before such a run: what most chunks are.
        self.plain = re.compile(f"(?:([{_LETTERS}]++)([{re.escape(self.signs.decode())}]*+)|[^ ]+)(?: |$)")
        # What was met since, and before, the memory was last half full.
        self.chunks: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.held = 0

    def _hash(self, keys: np.ndarray) -> None:
        bits = int(len(keys) * 6).bit_length()
        self.shift = np.uint64(32 - bits)
        slots = self._slot(keys)
        size = (1 << bits) + 64
        self.keys, self.ranks = np.full(size, -1, np.int64), np.full(size, NONE, np.int32)
        for rank, (key, slot) in enumerate(zip(keys.tolist(), slots.tolist(), strict=True)):
            while self.keys[slot] >= 0:
                slot += 1
            self.keys[slot], self.ranks[slot] = key, rank

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = (keys.astype(np.uint64) * np.uint64(2654435761)) & np.uint64(0xFFFFFFFF)
        return (mixed >> self.shift).astype(np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, NONE where they don't merge."""
        keys = left.astype(np.int64) << 16 | right
        slots = self._slot(keys)
        there = self.keys[slots]
        found = np.where(there == keys, self.ranks[slots], NONE)
        open_ = np.flatnonzero((there != keys) & (there >= 0))
        while len(open_):
            slots[open_] += 1
            there = self.keys[slots[open_]]
            hit = there == keys[open_]
            found[open_[hit]] = self.ranks[slots[open_[hit]]]
            open_ = open_[~hit & (there >= 0)]
        return found

    def _merged(self, words: list[bytes]) -> dict[bytes, bytes]:
        by_length: dict[int, list[bytes]] = {}
        for word in words:
            by_length.setdefault(len(word), []).append(word)
        out: dict[bytes, bytes] = {}
        for length, same in by_length.items():
            raw = np.frombuffer(b"".join(same), np.uint8).reshape(len(same), length)
            ids = self.inner[raw]
            ids[:, -1] = self.last[raw[:, -1]]
            at = np.arange(len(same))
            ranks = self._rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(same), length - 1)
            while True:
                if ranks.shape[1]:
                    place = ranks.argmin(1)
                    best = ranks[np.arange(len(at)), place]
                    ends = best == NONE
                else:
                    ends = np.ones(len(at), bool)
                if ends.any():
                    done = ids[ends].astype("<u4").tobytes()
                    step = 4 * ids.shape[1]
                    out.update(zip(map(same.__getitem__, at[ends].tolist()), [done[n : n + step] for n in range(0, len(done), step)], strict=True))
                    if ends.all():
                        break
                    goes_on = ~ends
                    ids, ranks, at, place, best = ids[goes_on], ranks[goes_on], at[goes_on], place[goes_on], best[goes_on]
                n, width = ids.shape
                row = np.arange(n)
                ids[row, place] = self.new[best]
                stay = np.ones((n, width), bool)
                stay[row, place + 1] = False
                ids = ids[stay].reshape(n, width - 1)
                stay = np.ones((n, width - 1), bool)
                stay[row, place] = False
                ranks = ranks[stay].reshape(n, width - 2)
                before, after = np.flatnonzero(place > 0), np.flatnonzero(place < width - 2)
                ranks[before, place[before] - 1] = self._rank(ids[before, place[before] - 1], ids[before, place[before]])
                ranks[after, place[after]] = self._rank(ids[after, place[after]], ids[after, place[after] + 1])
        return out

    def _learn(self, chunks: set[bytes]) -> None:
        known = self.chunks
        split: list[tuple[bytes, list[bytes]]] = []
        odd: list[bytes] = []
        words = {chunk for chunk in chunks if chunk.isalpha() and chunk.islower() and len(chunk) < LONGEST}
        others = chunks - words
        found = self.plain.findall(b" ".join(others).decode())
        plain = [x for x in (((word + signs).encode(), word.lower().encode(), signs.encode()) for word, signs in found if word) if len(x[0]) < LONGEST]
        for chunk in others.difference([chunk for chunk, _, _ in plain]):
            text = chunk.decode()
            if not PLAIN.fullmatch(text) or b"<|" in chunk:
                odd.append(chunk)
                continue
            cut = [w.encode() for w in self.words.findall(text.lower())]
            if max(map(len, cut)) > LONGEST:
                odd.append(chunk)
            else:
                split.append((chunk, cut))
        # A word has the ids that it has as a chunk of its own.
        words.update([word for _, word, _ in plain], [signs for _, _, signs in plain if signs], *(cut for _, cut in split))
        known.update(self._merged(list(self._recalled(words.difference(known)))))
        known.update([(chunk, known[word] + known[signs] if signs else known[word]) for chunk, word, signs in plain])
        known.update([(chunk, b"".join([known[w] for w in cut])) for chunk, cut in split])
        if odd:
            found = self.library.encode_batch([c.decode() for c in odd], add_special_tokens=False)
            for chunk, encoding in zip(odd, found, strict=True):
                self.chunks[chunk] = np.array(encoding.ids, "<u4").tobytes()

    def _recalled(self, chunks: set[bytes]) -> set[bytes]:
        """Brings forward those of the chunks that were met before, and returns the others."""
        again = self.older.keys() & chunks
        self.chunks.update(zip(again, map(self.older.__getitem__, again)))
        return chunks - again

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each UTF-8 text as little-endian unsigned 32-bit integers."""
        collecting = gc.isenabled()
        gc.disable()  # nothing here makes cycles, and the collector walks every list of chunks
        try:
            if self.held > REMEMBERED // 2:
                self.older, self.chunks, self.held = self.chunks, {}, 0
            known = self.chunks
            begins, places, different = _chunks(list(map(_small, texts)))
            ids = list(map(known.get, different))
            missing = {chunk for chunk, found in zip(different, ids, strict=True) if found is None}
            if missing:
                before = len(known)
                self._learn(self._recalled(missing))
                # New entries are the last ones.
                self.held += sum(map(len, islice(known, before, None))) + sum(map(len, islice(known.values(), before, None))) + ENTRY * (len(known) - before)
                ids = [known[chunk] if found is None else found for chunk, found in zip(different, ids, strict=True)]
            return _put_together(begins, places, ids)
        finally:
            if collecting:
                gc.enable()

    def encode_parts(self, texts: list[bytes], size: int) -> Iterator[tuple[int, bytes]]:
        """Place and ids of each text, about ``size`` bytes of text at a time."""
        at = 0
        while at < len(texts):
            to, held = at, 0
            while to < len(texts) and held < size:
                held += len(texts[to])
                to += 1
            yield from zip(range(at, to), self.encode(texts[at:to]), strict=True)
            at = to


def _small(text: bytes) -> bytes:
    """The text with a-z for A-Z, as the vocabulary's rules have it, unless it may hold marks that compose with letters, or special tokens."""
    return text if b"\xcc" in text or b"\xcd" in text or b"<|" in text else text.lower()


def _chunks(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Where each text's chunks begin, and end at last, each chunk's place among the different ones, and these."""
    plain = pa.array(texts, pa.binary())
    split = pc.ascii_split_whitespace(pa.Array.from_buffers(pa.string(), len(plain), plain.buffers()))
    begins, coded = split.offsets.to_numpy(), split.values.dictionary_encode()
    different = pa.Array.from_buffers(pa.binary(), len(coded.dictionary), coded.dictionary.buffers())
    return begins, coded.indices.to_numpy(), different.to_numpy(zero_copy_only=False).tolist()


def _put_together(begins: np.ndarray, places: np.ndarray, ids: list[bytes]) -> list[bytes]:
    """The ids of each text's chunks one after the other; ``ids`` are those of the different chunks."""
    lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    starts = np.cumsum(lengths) - lengths
    each = lengths[places]
    ends = np.concatenate([[0], np.cumsum(each)])
    at = np.arange(ends[-1]) + np.repeat(starts[places] - ends[:-1], each)
    out = np.frombuffer(b"".join(ids), "<u4")[at].tobytes()
    cuts = (4 * ends[begins]).tolist()
    return [out[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _byte_name(byte: int) -> str:
    """The printable character that stands for a byte in the vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    if byte in shown:
        return chr(byte)
    return chr(256 + [b for b in range(256) if b not in shown].index(byte))
