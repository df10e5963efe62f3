import hashlib
import zlib

import pytest
from frames import awkward, empty
from pyspark.sql import functions as F

from bazaarflow.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(leaves, fan):
    """Root of a list of digests and every leaf's siblings, level by level."""
    paths, level, places = [[] for _ in leaves], leaves, list(range(len(leaves)))
    while len(level) > 1:
        for leaf, place in enumerate(places):
            run = place - place % fan
            paths[leaf].append((level[run:place], level[place + 1 : run + fan]))
        level = [h(*level[n : n + fan]) for n in range(0, len(level), fan)]
        places = [place // fan for place in places]
    return level[0], paths


def brute(rows, fan):
    """(source, order, leaf) to root, subroot and path, for every row."""
    groups = {}
    for source, order, leaf in rows:
        groups.setdefault(("1" + source if source is not None else "0").encode(), []).append((order, leaf))
    tops, found = [], []
    for name in sorted(groups):
        members = sorted(groups[name], key=lambda m: (m[0] is not None, m[0] or 0, m[1]))
        subroot, paths = tree([leaf for _, leaf in members], fan)
        tops.append(subroot)
        found.append((name, subroot, [(m, p) for m, p in zip(members, paths, strict=True)]))
    root, above = tree(tops, fan) if tops else (None, [])
    return sorted(
        (name, order is not None, order or 0, leaf, subroot, root, path + up)
        for (name, subroot, members), up in zip(found, above, strict=True) for (order, leaf), path in members
    )


@pytest.mark.parametrize(("rows", "groups", "fan", "digits"), [(1, 1, 3, 6), (41, 30, 3, 2), (200, 1, 2, 3)])
def test_against_brute_force(spark, rows, groups, fan, digits):
    data = [(n, f"s{n % groups if n % 3 else 0}" if n % 11 else None, h(str(n))) for n in range(rows)]
    data += data[:2]  # repeated rows are leaves of their own
    frame = spark.createDataFrame(data, "id long, source string, leaf string")
    found = merkle.manifest(frame, "source", ["id"], "leaf", fan, digits).withColumn("again", merkle.folded(F.col("path"), F.col("leaf")))
    seen = []
    for r in found.withColumn("proof", merkle.siblings_digest(F.col("path"))).collect():
        assert r.again == r.root
        assert r.proof == h(*[s.before + s.after for s in r.path])
        name = ("1" + r.source if r.source is not None else "0").encode()
        seen.append((name, r.id is not None, r.id or 0, r.leaf, r.subroot, r.root, [(s.before, s.after) for s in r.path]))
    expected = [(*r[:-1], [("".join(a), "".join(b)) for a, b in r[-1]]) for r in brute([(s, i, x) for i, s, x in data], fan)]
    assert sorted(seen) == expected


def test_awkward(spark):
    docs = awkward(spark).withColumns({"group": F.lit("x"), "digest": F.lit("y"), "rank": F.lit(1), "path": F.lit("z")}).drop("path")
    leaves = docs.withColumn("leaf", merkle.leaf_of(F.col("doc_id"), F.col("text")))
    found = merkle.manifest(leaves, "source", ["doc_id"], "leaf")
    assert found.columns == [*leaves.columns, "subroot", "root", "path"]
    rows = found.collect()
    assert len(rows) == docs.count()
    expected = brute([(r.source, r.doc_id, r.leaf) for r in rows], 3)
    assert {r.root for r in rows} == {expected[0][5]}
    assert sorted(r.leaf for r in rows) == sorted(
        h("-" if r.doc_id is None else f"{len(str(r.doc_id))}:{r.doc_id}", "-" if r.text is None else f"{len(r.text.encode())}:{r.text}") for r in rows
    )


def test_empty(spark):
    leaves = empty(spark).withColumn("leaf", merkle.leaf_of(F.col("doc_id")))
    assert merkle.manifest(leaves, "source", ["doc_id"], "leaf").count() == 0


def test_checksum_of_the_query(spark):
    """The checksum in the SQL is the one of the standard library."""
    import duckdb

    from bazaarflow.llm.queries import CRC

    for number in (0, 7, 123456789, -5):
        assert duckdb.sql(f"select {CRC} from (select {number} as doc_id)").fetchall()[0][0] == zlib.crc32(str(number).encode())
