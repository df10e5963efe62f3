"""Every registered query against another SQL engine on the same tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from bazaarflow.plans.checked import CHECKED

QUERIES = {name: entry.queries()[name] for name in CHECKED}
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def other(folder):
    connection = duckdb.connect()
    for file in os.listdir(folder):
        name = file.removesuffix(".parquet")
        connection.sql(f"create view {name} as select * from '{folder}/{file}'")
    return connection


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def ordered(columns, rows):
    at = sorted(range(len(columns)), key=lambda n: columns[n])
    picked = [tuple(plain(row[n]) for n in at) for row in rows]
    return [columns[n] for n in at], sorted(picked, key=repr)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, folder, other, name):
    found = QUERIES[name](spark, folder)
    ours = ordered(found.columns, [tuple(row) for row in found.collect()])
    relation = other.sql(SQL[name])
    theirs = ordered(relation.columns, relation.fetchall())
    assert ours[0] == theirs[0]
    assert len(ours[1]) == len(theirs[1])
    assert ours[1] == theirs[1]
    assert ours[1], "the query should have rows"


def test_entry(spark):
    assert entry.entry(spark).count() > 0
