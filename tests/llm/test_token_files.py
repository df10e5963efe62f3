import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from frames import awkward, empty
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from bazaarflow.llm import token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(text):
    return np.array([*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=50))
def test_ranks_round_trip(numbers):
    ranks = np.array(numbers, np.uint32)
    control, data = token_files.pack_ranks(ranks)
    assert len(control) == -(-len(numbers) // 4)
    assert len(data) == sum(max(1, -(-n.bit_length() // 8)) for n in numbers)
    assert token_files.unpack_ranks(control, data, np.array([len(numbers)])).tolist() == numbers
    # Several texts, each from a control byte of its own.
    parts = [ranks[:3], ranks[3:3], ranks[3:]]
    packed = [token_files.pack_ranks(p) for p in parts]
    both = [b"".join(x) for x in zip(*packed, strict=True)]
    assert token_files.unpack_ranks(*both, np.array([len(p) for p in parts])).tolist() == numbers


@pytest.mark.parametrize("block", [1 << 20, 5])
def test_texts_are_coded_together_as_alone(monkeypatch, block):
    monkeypatch.setattr(token_files, "BLOCK", block)
    rng = np.random.default_rng(2)
    rank = rng.permutation(70_000).astype(np.uint32)
    texts = [rng.integers(0, 2000 if n % 2 else 60_000, n % 11).astype("<u2") for n in range(60)]
    found = list(token_files._coded([t.tobytes() for t in texts], rank, 2))
    assert found == [(zlib.crc32(t.astype("<u4").tobytes()), len(t), *token_files.pack_ranks(rank[t])) for t in texts]
    assert list(token_files._coded([], rank, 2)) == []


def written(spark, docs, folder, width=4):
    listed = token_files.write_tokens(token_files.tokens(docs, PATH, width=width), folder, width)
    return listed, token_files.read_tokens(spark, folder).collect()


def check(rows, docs):
    """Rows in file order against the library, whatever the order of rows with one id."""
    at = 0
    seen = []
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at and 4 * r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(r.ids)
        at += r.n_tokens
        seen.append((r.doc_id is not None, r.doc_id or 0, r.ids_crc32, bytes(r.ids)))
    assert seen == sorted(seen)
    assert seen == sorted((d.doc_id is not None, d.doc_id or 0, zlib.crc32(ids_of(d.text)), ids_of(d.text)) for d in docs.collect())


@pytest.mark.parametrize("block", [1 << 20, 8])
def test_files_give_back_all_ids(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(token_files, "BLOCK", block)
    docs = awkward(spark)
    listed, rows = written(spark, docs, f"file://{tmp_path}/out")
    check(rows, docs)
    for r in listed.collect():
        assert os.path.getsize(f"{tmp_path}/out/{r.file}") == r.bytes


def test_given_documents(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").repartition(5)
    assert token_files.width_of(PATH) == 2
    _, rows = written(spark, docs, str(tmp_path / "out"), width=2)
    check(rows, docs)


def test_frequent_ids_come_first(spark):
    docs = spark.createDataFrame([(n, "rare" if n == 3 else "often often seldom") for n in range(5)], "doc_id long, text string")
    ranks = token_files.frequency_ranks(token_files.tokens(docs, PATH)).tolist()
    often, seldom, rare = (LIBRARY.encode(w, add_special_tokens=False).ids[0] for w in ("often", "seldom", "rare"))
    assert ranks == [often, 1, seldom, rare]


def test_files_of_lost_attempts_do_not_count(spark, tmp_path):
    docs = awkward(spark)
    _, rows = written(spark, docs, str(tmp_path / "out"))
    (tmp_path / "out" / "part-000000-lost.ids").write_bytes(b"half a file")
    assert len(token_files.read_tokens(spark, str(tmp_path / "out")).collect()) == len(rows)


def test_empty(spark, tmp_path):
    listed, rows = written(spark, empty(spark), str(tmp_path / "out"))
    assert listed.count() == 0 and rows == []
