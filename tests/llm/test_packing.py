import zlib

import numpy as np
import public_tokenizers
import pytest
from frames import awkward, empty
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from bazaarflow.llm.packing import pack, sum_of_squares, tight, token_pieces
from bazaarflow.llm.word_pieces import WordPieces

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
WORDS = WordPieces(open(PATH, "rb").read())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abcdeABCDE éÉßü'st.,1-_<|>\n\tΣİ日́\x1f\x85\xa0"), st.characters(exclude_categories=["Cs"]))))
def test_ids_are_the_library_s(text):
    assert np.frombuffer(WORDS.encode([text.encode()])[0], "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def checked(rows, length):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at <= length
    return len(by)


@pytest.mark.parametrize("length", [8, 4096])
def test_pieces_and_places(spark, length):
    docs = awkward(spark)
    rows = pack(token_pieces(docs, PATH, length=length), length=length, shard=4).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.row, r.piece)):
        assert r.start == r.piece * length and 1 <= r.length <= length
        got.setdefault((r.row, r.doc_id), []).append((r.length, r.ids_crc32))
    wanted = []
    for doc, text in [(r.doc_id, r.text or "") for r in docs.collect()]:
        ids = np.array([*LIBRARY.encode(text, add_special_tokens=False).ids, 1], "<u4")
        wanted.append((doc, [(len(c), zlib.crc32(c.tobytes())) for c in (ids[n : n + length] for n in range(0, len(ids), length))]))
    assert sorted([(doc, p) for (_, doc), p in got.items()], key=repr) == sorted(wanted, key=repr)
    used, total = checked(rows, length), sum(r.length for r in rows)
    assert used <= -(-total // length) * 1.34 + 1


def test_empty(spark):
    assert pack(token_pieces(empty(spark), PATH)).count() == 0


def test_sum_of_squares_takes_the_smallest_sum():
    rng = np.random.default_rng(1)
    sizes, length = rng.integers(1, 20, 200), 20
    bins, offsets = sum_of_squares(sizes, length)
    count, fill = np.zeros(length + 1, int), {}
    for at in np.argsort(-sizes, kind="stable"):
        size, change = int(sizes[at]), {}
        for gap in [g for g in range(size, length) if count[g]] + [length]:
            after = count.copy()
            if gap < length:
                after[gap] -= 1
            if gap - size:
                after[gap - size] += 1
            change[gap] = (after[1:length] ** 2).sum()
        gap = length - offsets[at]
        assert change[gap] == min(change.values())
        if gap < length:
            count[gap] -= 1
        if gap - size:
            count[gap - size] += 1
        fill[bins[at]] = fill.get(bins[at], 0) + size
    assert max(fill.values()) <= length


def test_tight_is_near_the_bound():
    sizes = np.random.default_rng(2).integers(1, 3000, 5000)
    bins, offsets = tight(sizes, 4096)
    assert len(set(bins)) <= np.ceil(sizes.sum() / 4096) * 1.01
    assert bins.max() + 1 == len(set(bins))


def test_no_task_gets_all_pieces(spark, monkeypatch):
    from pyspark.sql import functions as F

    from bazaarflow.llm import packing

    frames = []
    monkeypatch.setattr(packing, "written", lambda df, purpose, write=packing.written: frames.append(write(df, purpose)) or frames[-1])
    # No two pieces fit together, so every bin stays open.
    pieces = spark.range(4000).select(F.col("id").alias("row"), F.lit(0).alias("piece"), F.lit(2500).cast("long").alias("length"))
    rows = pack(pieces, shard=500).collect()
    assert checked(rows, 4096) == len(rows) == 4000
    shards = [f.groupBy(F.shiftright("sequence_id", 40)).count().agg(F.max("count")).first()[0] for f in frames[1:]]
    assert len(shards) <= 3 and max(shards) < 1000


def test_chunks_that_recur_are_not_learned_again(monkeypatch):
    from bazaarflow.llm import word_pieces

    words, learned = WordPieces(open(PATH, "rb").read()), []
    monkeypatch.setattr(word_pieces, "REMEMBERED", 20_000)
    monkeypatch.setattr(words, "_learn", lambda chunks, learn=words._learn: learned.extend(chunks) or learn(chunks))
    for n in range(30):
        rare = " ".join(f"rare{chr(97 + n % 26)}{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60))
        text = f"Often, OFTEN often {rare}"
        assert np.frombuffer(words.encode([text.encode()])[0], "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
    assert learned.count(b"often") == learned.count(b"often,") == 1 and b"OFTEN" not in learned
    assert len(words.chunks) + len(words.older) < 400


@pytest.mark.parametrize("text", ["H̱ H̱. T̈ a<|ENDOFTEXT|> <|endoftext|>A", "ΑΣ ΑΣA AΣ İI K Å É", "A̱B Ǧ J̌"])
def test_capitals_beside_marks_and_special_tokens(text):
    for t in (text, text.lower(), "Some Words. " + text):
        assert np.frombuffer(WORDS.encode([t.encode()])[0], "<u4").tolist() == LIBRARY.encode(t, add_special_tokens=False).ids


def test_a_chunk_that_recurs_is_looked_up_once():
    class Counted(dict):
        looked_up = 0

        def __getitem__(self, chunk):
            self.looked_up += 1
            return super().__getitem__(chunk)

    words = WordPieces(open(PATH, "rb").read())
    words.chunks = Counted()
    texts = ["", " \t", "Same same,\x0b same!! " * 100, "  same é\x1cn,; \x85 2x I'm étÉ. ", "x" * 70 + "., same", "same\n"]
    for _ in range(2):
        for text, found in zip(texts, words.encode([t.encode() for t in texts]), strict=True):
            assert np.frombuffer(found, "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
    assert words.chunks.looked_up < 100
