"""Small awkward tables."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, entry long, hash long, kind string, __n int"
LONG = "ab cd " * 20_000


def awkward(spark, texts=None):
    """Nulls, blanks, very long texts, repeated rows and ids, and columns with names that operators use themselves."""
    texts = texts if texts is not None else [
        (1, None), (2, ""), (3, "  \n\t"), (4, LONG), (5, "one two three four"), (5, "one two three four"),
        (6, "one two  three\nfour"), (7, "ONE two three four"), (None, "one two three four"), (None, None),
        (8, "ünïcödé 日本 😀 text"), (9, "12345"), (10, "a"), (11, "one two"), (5, "another text with the same id"),
    ]
    return spark.createDataFrame([(i, t, "en", "s", None, 1, 1, 1, "k", 1) for i, t in texts], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
