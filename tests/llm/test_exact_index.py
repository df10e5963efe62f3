import hashlib
from collections import defaultdict

from frames import awkward, empty

from bazaarflow.llm import exact_index, tasks
from bazaarflow.llm.exact_index import directory, exact_copies


def brute(rows):
    classes = defaultdict(list)
    for doc, text in rows:
        plain = text or ""
        classes[plain.translate({c: None for c in (32, 9, 10, 11, 12, 13)})].append((doc, len(plain)))
    out = []
    for body, members in classes.items():
        keep = min(members, key=lambda m: (-m[1], m[0] is None, m[0] or 0))[0]
        out += [(doc, keep, len(members), hashlib.sha256(body.encode()).hexdigest()) for doc, _ in members]
    return sorted(out, key=repr)


def test_against_brute_force(spark):
    docs = awkward(spark)
    for capacity in (1, 50_000):
        found = exact_copies(docs, capacity=capacity).collect()
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found], key=repr) == brute(rows)
        assert sum(r.kept for r in found) == len({r.text_sha256 for r in found})


def test_empty(spark):
    assert exact_copies(empty(spark)).count() == 0


def test_directory_doubles_until_buckets_fit():
    sizes = {0: 5, 1: 5, 8: 1, 15: 1}
    found = directory(sizes, 6, bits=4)
    assert found[0] != found[1]
    assert found[8] == found[15] == (1, 1)
    assert directory({3: 100}, 6, bits=4)[3] == (3, 4)  # cannot split, chains


def test_chain_compares_bytes(spark):
    import pyarrow as pa
    import zstandard

    pack = zstandard.ZstdCompressor(level=1).compress
    rows = [(1, 7, b"a"), (2, 7, b"b"), (3, 7, b"a"), (4, 7, b"c"), (5, 8, b"b")]
    part = pa.RecordBatch.from_arrays(
        [pa.array([e for e, _, _ in rows]), pa.array([h for _, h, _ in rows]), pa.array([pack(b) for _, _, b in rows])],
        ["entry", "hash", "body"],
    )
    found = [tuple(r.values()) for b in exact_index._chains(iter([part])) for r in b.to_pylist()]
    assert found == [(2, 1), (4, 2)]


def test_texts_go_when_they_are_compared(spark, monkeypatch, tmp_path):
    made = []
    monkeypatch.setattr(tasks, "working_folder", lambda spark, purpose: made.append(purpose) or f"{tmp_path}/{purpose}-{len(made)}")
    docs = awkward(spark)
    found = exact_copies(docs)
    left = {p.name.rpartition("-")[0] for p in tmp_path.iterdir()}
    assert "exact-index" in made and "exact-index" not in left
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found.collect()], key=repr) == brute(rows)
