"""The registered queries over whole small tables, and the pipeline against plain Python."""

import os

import corpus_pipeline
import duckdb
import pytest
from frames import awkward, empty
from pyspark.sql import functions as F
from test_pii import base
from test_set_join import brute

import __spark_entry__ as entry
from bazaarflow.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, folder, name):
    assert name in entry.queries()
    found = QUERIES[name](spark, folder)
    rows = [tuple(r) for r in found.collect()]
    assert rows
    if name in SQL:
        connection = duckdb.connect()
        for file in os.listdir(folder):
            connection.sql(f"create view {file.removesuffix('.parquet')} as select * from '{folder}/{file}'")
        other = connection.sql(SQL[name])
        at = [found.columns.index(c) for c in other.columns]
        assert sorted(found.columns) == sorted(other.columns)
        assert sorted([tuple(r[n] for n in at) for r in rows], key=repr) == sorted(other.fetchall(), key=repr)


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("length(text) < 3000")
    spoken = stage("language")(spark, docs, folder)
    assert spoken.columns == docs.columns
    assert spoken.count() == docs.where(F.col("text").rlike(r"\p{L}")).count()

    # Labels stay, those that lack get the language found.
    unlabelled = docs.withColumn("lang", F.when(F.col("doc_id") % 3 > 0, F.col("lang")))
    told = {r.doc_id: r.lang for r in docs.collect()}
    found = stage("language")(spark, unlabelled, folder).collect()
    long = [r for r in found if len(r.text) > 200]
    assert sum(r.lang == told[r.doc_id] for r in long) > 0.95 * len(long) and all(r.lang for r in found)
    assert all(r.lang == told[r.doc_id] for r in found if r.doc_id % 3)

    rows = {r.doc_id: r.text for r in spoken.collect()}
    single = {r.doc_id for r in stage("exact")(spark, spoken, folder).collect()}
    classes = {}
    for i, t in rows.items():
        classes.setdefault(t.translate({c: None for c in (32, 9, 10, 11, 12, 13)}), []).append((-len(t), i))
    assert single == {min(members)[1] for members in classes.values()}

    left = spoken.where(F.col("doc_id").isin(*single))
    near = {r.doc_id for r in stage("near")(spark, left, folder).collect()}
    assert near == {c for _, _, c in brute([(i, rows[i]) for i in single], 5, 80, 100)}

    clean = stage("personal")(spark, left, folder)
    assert clean.columns == docs.columns
    for r in clean.collect():
        for _, a, b in base(rows[r.doc_id]):
            assert rows[r.doc_id][a:b] not in r.text
        if not base(rows[r.doc_id]):
            assert r.text == rows[r.doc_id] and r.n_chars == len(r.text)


def test_awkward_stages(spark, folder):
    docs = awkward(spark)
    for name, function in corpus_pipeline.STAGES:
        found = function(spark, docs, folder)
        assert name == "packing" or found.columns == docs.columns
        kept = found.collect()
        assert kept
        if name == "exact":
            assert len(kept) == 9  # one for each different text without blanks
        assert function(spark, empty(spark), folder).count() == 0
