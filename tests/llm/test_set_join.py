import os
import random
import re
import subprocess
import sys
import tempfile
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyspark
import pytest
from frames import awkward, empty

from bazaarflow.llm import set_join, tasks
from bazaarflow.llm.components import components


def shingles(text, words):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(found) < words:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[n : n + words]) for n in range(len(found) - words + 1))


def brute(rows, words, above, below):
    sets = [shingles(t, words) for _, t in rows]
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and below * both >= above * len(sets[a] | sets[b]):
                parent[max(top(a), top(b))] = min(top(a), top(b))
    groups = defaultdict(list)
    for n in range(len(rows)):
        groups[top(n)].append(rows[n][0])
    least = {k: min([i for i in v if i is not None], default=None) for k, v in groups.items()}
    return sorted([(i, len(s), least[top(n)]) for n, ((i, _), s) in enumerate(zip(rows, sets, strict=True))], key=repr)


def near_copies(seed, sizes=(4, 30, 150, 400), copies=12):
    """Texts with copies that differ in more and more words, so that similarities lie around the threshold."""
    rng = random.Random(seed)
    vocabulary = [f"w{n}" for n in range(300)]
    rows = []
    for size in sizes:
        base = rng.choices(vocabulary, k=size)
        for n in range(copies):
            text = list(base)
            for _ in range(n % 6):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            if n % 4 == 3:
                text += rng.choices(vocabulary, k=max(1, size // 20))
            rows.append((len(rows) * 7 % 1009, " ".join(text)))
    rows += [(2000 + n, " ".join(rng.choices(vocabulary, k=rng.choice([3, 9, 40])))) for n in range(30)]
    return rows


@pytest.mark.parametrize(("words", "above", "below"), [(3, 90, 100), (5, 80, 100), (1, 60, 100)])
def test_against_brute_force(spark, words, above, below):
    rows = near_copies(words)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = set_join.similar_components(docs, words=words, above=above, below=below).collect()
    wanted = brute(rows, words, above, below)
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in found], key=repr) == wanted
    assert sum(r.kept for r in found) == len({c for _, _, c in wanted})
    assert len({c for _, _, c in wanted}) < len(rows) - 5


def test_small_blocks_and_flushes_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(set_join, "SIDE", 3)
    monkeypatch.setattr(set_join, "ENTRIES", 40)
    rows = near_copies(8, sizes=(30, 60), copies=25)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = set_join.similar_components(docs).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in found], key=repr) == brute(rows, 3, 90, 100)


@pytest.mark.parametrize(
    ("words", "above", "texts"),
    [  # the first text has the smallest digest; the other two are similar and share only entries that it has too
        (1, 60, ["w390 w235 w56 w320 w331 w391 w119 w232 w171 w141 w268", "w390 w235 w56 w320 w331 w391 w85 w232", "w390 w235 w56 w320 w331 w391 w119 w232 w373"]),
        (5, 80, ["w330 w304 w341 w223 w199 w121 w265 w4 w334", "w330 w304 w341 w223 w199 w121 w265 w4 w161", "w330 w304 w341 w223 w199 w121 w265 w4"]),
        (2, 50, ["w399 w324 w207 w335 w91 w399 w120 w264 w202 w144", "w172 w324 w207 w335 w91 w399 w120 w264 w355", "w130 w324 w207 w335 w91 w399 w120 w152"]),
        (3, 90, [f"{a} w14 w245 w298 w368 w66 w396 w392 w286 w200 w251 w395 w119 w260 w192 w31 w210 w307 w43 w127 w344 w20 w232 w42 w150 {b}"
                 for a, b in (("w21", "w312"), ("w194", "w312"), ("w194", "w46"))]),
    ],
)
def test_entries_of_three_sets(spark, words, above, texts):
    digests = [set_join._digest(s) for s in set_join.shingle_sets([t.encode() for t in texts], words)]
    assert digests[0] == min(digests)
    for ids in ((3, 1, 2), (1, 2, 3)):
        rows = list(zip(ids, texts, strict=True))
        docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
        found = set_join.similar_components(docs, words=words, above=above).collect()
        assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in found], key=repr) == brute(rows, words, above, 100)


def test_awkward(spark):
    docs = awkward(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = set_join.similar_components(docs).collect()
    assert sorted([(r.doc_id, r.n_shingles) for r in found], key=repr) == [w[:2] for w in sorted(brute(rows, 3, 90, 100), key=lambda w: repr(w[:2]))]
    by_text = {r.doc_id: r.component_id for r in found if r.n_shingles == 2 and r.doc_id not in (4, 8)}
    assert by_text == {5: 5, 6: 5, 7: 5, None: 5}
    assert all(r.component_id == r.doc_id and r.kept for r in found if not r.n_shingles)
    assert set_join.similar_components(empty(spark)).count() == 0


def test_every_similar_pair_shares_an_entry():
    rng = np.random.default_rng(5)
    for counts in ({}, {s: 10**7 for s in range(200)}):  # plenty of sets make other cuts cheaper
        bands = set_join.Bands(80, 100, counts)
        for _ in range(400):
            size = int(rng.integers(2, 120))
            base = rng.integers(0, 2**64, size + 40, np.uint64)
            one, other = np.unique(base[:size]), np.unique(np.concatenate([base[int(rng.integers(0, size // 5 + 1)) : size], base[size : size + int(rng.integers(0, size // 6 + 1))]]))
            both = len(np.intersect1d(one, other))
            if 100 * both >= 80 * (len(one) + len(other) - both):
                a, b = (np.concatenate([e for e in bands.entries(s)] or [np.zeros(0, np.uint64)]) for s in (one, other))
                assert len(np.intersect1d(a, b)) or (one == other).all()


def test_partitions_follow_their_cost():
    few, many = set_join.partition(1, 10, 100), set_join.partition(1, 10, 10**9)
    assert few.double == 0 and many.double == 1
    for differ, size, count in ((0, 5, 10), (15, 150, 10**4), (40, 180, 10**6), (40, 180, 10**10)):
        cut = set_join.partition(differ, size, count)
        assert cut.single + 2 * cut.double >= differ + 1 + cut.spare


def test_components(spark):
    rng = random.Random(2)
    links = [(n, n + 1) for n in range(0, 60)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(40)] + [(5, 5)]
    parent = list(range(161))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(top(a), top(b))] = min(top(a), top(b))
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {n: top(n) for n in range(161) if top(n) != n}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sets_that_share_many_entries_are_compared_once(spark):
    rng = np.random.default_rng(3)
    sets = [rng.integers(0, 2**64, 400, np.uint64) for _ in range(2)]
    sets = [np.unique(s) for s in (sets[0], np.concatenate([sets[0][:390], sets[1][:10]]), sets[1])]
    profiles = spark.createDataFrame([(n, len(s), set_join.profile(s)) for n, s in enumerate(sets)], "digest long, n_shingles long, profile binary")
    cells = spark.createDataFrame([(cell, n, 3, n) for cell in range(40) for n in range(3)], "cell long, digest long, side int, root long")
    rows = set_join._possible_in(cells, profiles, 80, 100).collect()
    # One cell with the two sets that may be similar, not one per entry; the third is ruled out.
    assert len({r.cell for r in rows}) == 1
    assert sorted((r.digest, r.side) for r in rows) == [(0, 1), (1, 2)]


def test_the_same_sets_of_several_cells_are_compared_once(spark):
    one = np.unique(np.random.default_rng(4).integers(0, 2**64, 50, np.uint64))
    profiles = spark.createDataFrame([(n, len(one), set_join.profile(one)) for n in range(6)], "digest long, n_shingles long, profile binary")
    cells = spark.createDataFrame([(cell, n, 3, n) for cell in (7, 8, 9) for n in range(6)], "cell long, digest long, side int, root long")
    rows = set_join._possible_in(cells, profiles, 80, 100).collect()
    assert len({r.cell for r in rows}) == 1
    assert sorted((r.digest, r.side, r.root) for r in rows) == [(n, 3, n) for n in range(6)]


def test_cells_in_turns_lose_nothing(spark, monkeypatch):
    import zstandard

    turns = []
    monkeypatch.setattr(set_join, "ROUND", 4)
    monkeypatch.setattr(set_join, "_compared_at_once", lambda cells, *rest, f=set_join._compared_at_once: turns.append(cells.count()) or f(cells, *rest))
    words = " ".join(f"w{n}" for n in range(60)).split()
    texts = [(n, zstandard.compress(" ".join([*words, f"end{n % 4}"]).encode())) for n in range(8)]
    pairs = [(a, b) for a in range(8) for b in range(a)]
    cells = [(8 * a + b, n, side, None) for a, b in pairs for n, side in ((a, 2), (b, 1))]
    cells = spark.createDataFrame(cells, "cell long, digest long, side int, root long")
    found = set_join._compared(cells, spark.createDataFrame(texts, "digest long, body binary"), 3, 90, 100).collect()
    assert sorted((max(r.a, r.b), min(r.a, r.b)) for r in found) == sorted(pairs)
    assert len(turns) == 4 and sum(turns) == 56 and max(turns) < 40


def test_tables_are_written_in_small_batches(spark, monkeypatch):
    name, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    monkeypatch.setattr(set_join, "written", lambda df, purpose, f=set_join.written: seen.append(int(spark.conf.get(name))) or f(df, purpose))
    rows = near_copies(6, sizes=(30,))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before = spark.conf.get(name)
    found = set_join.similar_components(docs)
    assert seen and max(seen) <= 512 and spark.conf.get(name) == before
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in found.collect()], key=repr) == brute(rows, 3, 90, 100)
    spark.conf.set(name, "7")  # the session's own smaller number stays
    try:
        seen.clear()
        set_join.similar_components(docs)
        assert set(seen) == {7} and spark.conf.get(name) == "7"
    finally:
        spark.conf.unset(name)


def test_sets_with_a_long_common_passage_are_not_compared_with_each_other(spark, monkeypatch):
    rng = random.Random(11)
    passage = " ".join(f"p{n}" for n in range(150))
    own = [" ".join(f"o{k}x{n}" for k in range(60)) for n in range(60)]
    rows = [(n, f"{text} {passage}") for n, text in enumerate(own)]
    # Some have a similar one; it and the others share the passage and so many entries.
    for n in range(6):
        words = own[n].split()
        words[rng.randrange(60)] = "other"
        rows.append((100 + n, f"{' '.join(words)} {passage}"))
    compared = []
    monkeypatch.setattr(set_join, "SIDE", 8)
    monkeypatch.setattr(set_join, "_possible_in", lambda cells, *rest, f=set_join._possible_in: compared.append(cells.count()) or f(cells, *rest))
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    found = set_join.similar_components(docs, words=5, above=80).collect()
    wanted = brute(rows, 5, 80, 100)
    assert len({c for _, _, c in wanted}) == 60
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in found], key=repr) == wanted
    assert sum(compared) <= 2 * len(rows)  # blocks of all with all: several hundred for every entry


def test_frequencies_keep_the_order_of_counts(spark, monkeypatch):
    import zstandard

    monkeypatch.setattr(set_join, "COUNTED", 50)  # many parts
    monkeypatch.setattr(set_join, "PIECE", 9)
    rows = [" ".join(["often seen words", *(["now and then"] if n % 3 else []), f"w{n} a{n} b{n}"]) for n in range(30)]
    texts = spark.createDataFrame([(zstandard.compress(t.encode()),) for t in rows], "body binary").repartition(3)
    known = np.frombuffer(set_join._frequencies(texts, 3, 12), np.uint8)
    counts = np.zeros(1 << 12, np.int64)
    for found in set_join.shingle_sets([t.encode() for t in rows], 3):
        np.add.at(counts, found >> np.uint64(52), 1)
    assert len(known) == 1 << 12 and counts.max() >= 30
    assert ((known == 0) == (counts == 0)).all() and ((known == 1) == (counts == 1)).all()
    order = np.argsort(counts, kind="stable")
    assert (np.diff(known[order].astype(int)) >= 0).all()


def test_gaps_of_any_size_come_back():
    for places in ([0, 0, 254, 255, 510, 511, 511, 3000], [255], [7], [10**6, 10**6]):
        assert set_join._places(set_join._gaps(np.array(places))).tolist() == places


def test_large_tables_go_when_they_are_compared(spark, monkeypatch, tmp_path):
    made = []
    monkeypatch.setattr(tasks, "working_folder", lambda spark, purpose: made.append(purpose) or f"{tmp_path}/{purpose}-{len(made)}")
    rows = near_copies(9, sizes=(30,))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = set_join.similar_components(docs)
    left = {p.name.rpartition("-")[0] for p in tmp_path.iterdir()}
    assert {"set-texts", "shared-entries"} <= set(made)
    assert not left & {"set-texts", "shared-entries", "pairs", "profiles", "cells", "left-entries", "left-cells"}
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in found.collect()], key=repr) == brute(rows, 3, 90, 100)


def test_a_worker_lets_go_of_what_another_operator_kept():
    tasks.kept("a model", 1, lambda: [0] * 1000)
    tasks.give_back()
    made = []
    assert tasks.kept("a model", 1, lambda: made.append(1) or "made anew") == "made anew" and made
    assert tasks.kept("a model", 1, lambda: made.append(1)) == "made anew" and len(made) == 1
    tasks.give_back()


def test_executors_collect_their_garbage_too(spark):
    code = """
import sys
from pyspark.sql import SparkSession
from bazaarflow.llm.tasks import let_go

builder = SparkSession.builder.master("local-cluster[2,1,1024]").config("spark.executor.memory", "900m").config("spark.ui.enabled", "false")
spark = builder.config("spark.executor.extraJavaOptions", f"-Xlog:gc:file={sys.argv[1]}/gc-%p.log").getOrCreate()
while spark.sparkContext._jsc.sc().getExecutorMemoryStatus().size() < 3:
    pass
let_go(spark)
spark.stop()
"""
    with tempfile.TemporaryDirectory() as folder:
        path = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        own = {k: v for k, v in os.environ.items() if not k.startswith(("PYSPARK_GATEWAY", "SPARK_"))}
        home = Path(folder, "home")  # executors work below Spark's home
        home.mkdir()
        for part in Path(pyspark.__file__).parent.iterdir():
            if part.name != "work":
                (home / part.name).symlink_to(part)
        own |= {"PYTHONPATH": path, "SPARK_LOCAL_IP": "127.0.0.1", "SPARK_HOME": str(home), "SPARK_SCALA_VERSION": "2.13"}
        subprocess.run([sys.executable, "-c", code, folder], env=own, check=True, timeout=120, cwd=folder)
        collected = ["System.gc()" in open(f"{folder}/{name}").read() for name in os.listdir(folder) if name.endswith(".log")]
    assert collected == [True, True]
