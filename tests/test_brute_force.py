"""Operators against plain Python on generated rows."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from bazaarflow.functions.dates import is_recent
from bazaarflow.functions.text import markup_text, price_number, shown_date
from bazaarflow.operators import counts, dedup, serve
from bazaarflow.operators.page_tree import elements, read_page, text_of
from bazaarflow.schema import MONTHS

AS_OF = datetime(2024, 3, 2, 9, 30)


@pytest.fixture
def chance():
    return random.Random(7)


def column(spark, texts, expression):
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, t string")
    rows = df.select("n", expression(F.col("t")).alias("v")).collect()
    return [row.v for row in sorted(rows)]


def test_price_number(spark, chance):
    texts = ["".join(chance.choices("0123456789 .,DHé-\u00a0\n", k=chance.randint(0, 14))) for _ in range(3000)]
    expected = [float(re.sub("[^0-9]", "", t) or 0) for t in texts]
    assert column(spark, texts, price_number) == expected


def test_recent(spark, chance):
    """Texts are written from what they mean, so each is known to be recent or not."""
    names = {number: [word for word, n in MONTHS.items() if n == number] for number in range(1, 13)}
    texts, recent = [], []
    for _ in range(4000):
        date = AS_OF + timedelta(days=chance.randint(-40, 40))
        start = AS_OF - timedelta(days=3)
        kind = chance.choice(["date", "date", "date", "word", "none"])
        if kind == "date":
            day = chance.choice([f"{date.day}", f"{date.day:02}"])
            word = chance.choice(names[date.month]) if names[date.month] else None
            if word is None:
                continue
            gap = chance.choice([" ", "  ", "\n"])
            text = f"{chance.choice(['', 'le ', '<b>'])}{day}{gap}{word}{gap}{date.year}{chance.choice(['', '</b>', '!'])}"
            # A written date has no time of day.
            recent.append(datetime(date.year, date.month, date.day) >= start)
        elif kind == "word":
            text = chance.choice(["Aujourd'hui, 10:00", "Hier 9:15", "<i class=cnt-today>", "Yesterday"])
            recent.append(True)
        else:
            text = chance.choice(["", "hier", "31 février", "32 Jan 2024", "2024-03-01", "31 Fév 2024", "bientôt"])
            recent.append(False)
        texts.append(text)
    found = column(spark, texts, lambda t: is_recent(t, AS_OF, strict=True))
    assert found == recent
    assert 100 < sum(found) < len(found) - 100


def test_markup_text(spark, chance):
    pieces = ["<b>", "</b>", " ", "é", "x &amp; y", "&lt;", "\u00a0", "\n", "<br>", "1 &euro;", "&amp;lt;"]
    texts = ["<p>" + "".join(chance.choices(pieces, k=8)) + "</p>" for _ in range(2000)]
    expected = [text_of(next(elements(read_page(t)))) for t in texts]
    # An end tag without a start tag closes nothing, so both see all the text.
    assert column(spark, texts, markup_text) == expected


def test_shown_date(spark):
    texts = ["2024-01-01T10:00", "été 2024 à midi", "", None]
    assert column(spark, texts, shown_date) == ["2024-01-01", "été 2024 à", "", None]


@pytest.fixture
def rows(spark, chance):
    made = []
    for n in range(2000):
        url = chance.choice(["hot", f"u{chance.randint(0, 400)}", f"v{n}", None])
        made.append((n, url, chance.choice([None, *range(30)]), chance.choice("abc")))
    return made, spark.createDataFrame(made, "n int, url string, scraped_at bigint, category string").repartition(6)


def age(row):
    return (row[2] is None, row[2] or 0, row[0])


def test_first_per_key(rows):
    made, df = rows
    best = {}
    for row in sorted(made, key=age, reverse=True):
        best[row[1]] = row[0]
    assert sorted(r.n for r in dedup.first_per_key(df).collect()) == sorted(best.values())


@pytest.mark.parametrize("salts", [1, 5])
def test_drop_known_and_counts(rows, salts):
    made, df = rows
    target = df.where("scraped_at < 4")
    stored = {row[1] for row in made if row[2] is not None and row[2] < 4}
    expected = [row[0] for row in made if row[1] is not None and row[1] not in stored]
    assert sorted(r.n for r in dedup.drop_known(df, target, salts=salts).collect()) == expected
    counted = counts.batch_counts(df, target).first()
    keyless = sum(row[1] is None for row in made)
    assert (counted.total, counted.rejected, counted.new) == (2000, keyless, len(expected))
    assert counted.duplicates == 2000 - keyless - len(expected)
    known = {r.url for r in dedup.known_keys(df, target).collect()}
    assert known == stored - {None}


@pytest.mark.parametrize("size", [1, 50, 700, 1999, 5000])
def test_latest(rows, size):
    made, df = rows
    newest = sorted(made, key=lambda r: (r[2] is None, -(r[2] or 0), r[0]))[:size]
    for operator in (serve.latest, serve.latest_of_table):
        found = operator(df, size, ["n"]).collect()
        assert [r.n for r in found] == [row[0] for row in newest]
