import hashlib
import random

from frames import awkward, empty

from bazaarflow.llm import fingerprints as fp

TEXTS = [" ".join(random.Random(n).choices(["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta"], k=300)) for n in range(40)]


def test_chunks_cover_and_resist_shifts():
    data = TEXTS[0].encode()
    ends = fp.cuts(data)
    sizes = [b - a for a, b in zip([0, *ends], ends, strict=False)]
    assert sum(sizes) == len(data) and max(sizes) <= fp.MOST and min(sizes[:-1]) >= fp.LEAST
    assert fp.containment(fp.fingerprint(data), fp.fingerprint(b"shifted by " + data)) > 0.9
    assert fp.containment(fp.fingerprint(data), fp.fingerprint(TEXTS[1].encode())) < 0.3
    assert fp.cuts(b"") == [] and fp.containment({}, {}) == 1 and fp.containment({}, {1: 2}) == 0


def test_hash_is_the_plain_gear_hash():
    data, h, hashes = TEXTS[2].encode(), 0, []
    for byte in data:
        h = ((h << 1) + int(fp._GEAR[byte])) & 0xFFFFFFFF
        hashes.append(h)
    ends, start = [], 0
    while start < len(data):
        end = min(len(data), start + fp.MOST)
        for at in range(start + fp.LEAST - 1, end):
            if hashes[at] & int(fp.STRICT if at < start + fp.USUAL - 1 else fp.LOOSE) == 0:
                end = at + 1
                break
        if len(data) - start <= fp.LEAST:
            end = len(data)
        ends.append(end)
        start = end
    assert fp.cuts(data) == ends


def test_edits(spark, monkeypatch):
    monkeypatch.setattr(fp, "RANGE_ROWS", 7)
    rows = [(3 * n, t) for n, t in enumerate(TEXTS)] + [(1, "é" * 9), (2, None), (200, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in fp.compared_with_edits(docs).collect()}
    ordered = sorted((i, t or "") for i, t in rows)
    assert len(got) == len(rows)
    for n, (doc, text) in enumerate(ordered):
        after = ordered[(n + 1) % len(ordered)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert got[doc].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[doc].n_chars == len(text)
        assert got[doc].fingerprint == fp.shown(fp.fingerprint(text.encode()))
        assert got[doc].near_next == fp.containment(fp.fingerprint(text.encode()), fp.fingerprint(after.encode()))
    assert 0.3 < got[0].near_edited < 0.7


def test_awkward(spark):
    docs = awkward(spark)
    assert fp.compared_with_edits(docs).count() == docs.count()
    assert fp.compared_with_edits(empty(spark)).count() == 0
    assert fp.fingerprints(docs).count() == docs.count()
    one = spark.createDataFrame([(1, "abc")], "doc_id long, text string")
    assert fp.compared_with_edits(one).first().edited_sha256 == hashlib.sha256(b"aba").hexdigest()
