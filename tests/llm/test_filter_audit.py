import re
from collections import Counter
from itertools import permutations

import pytest
from frames import LONG, awkward, empty

from bazaarflow.llm import filter_audit


def fails(rows):
    """Letters that each row (id, text) fails."""
    least = {}
    for i, text in rows:
        if i is not None:
            least[text or ""] = min(least.get(text or "", i), i)
    out = []
    for i, text in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        found = "A" if len(words) < 200 else ""
        found += "B" if 100 * len(set(words)) < 50 * len(words) else ""
        found += "C" if 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text) else ""
        found += "D" if set(text) & set("#$%&*|") else ""
        found += "E" if i is not None and i > least[text] else ""
        out.append(found)
    return out


def brute(rows):
    """(part, letters, good, toxic) of every row to the table of the audit."""
    parts = {part for part, *_ in rows}
    counts = Counter()
    shapley = Counter()
    for order in map("".join, permutations("ABCDE")):
        for part, letters, good, toxic in rows:
            gone = False
            for step, letter in enumerate(order, 1):
                at = (part, order, step)
                if letter in letters:
                    counts[at, "redundant" if gone else "removed"] += 1
                    counts[at, "good_lost"] += good and not gone
                    counts[at, "toxic_lost"] += toxic and not gone
                    counts[at, "unique_fails"] += letters == letter
                    shapley[part, letter] += not gone
                    gone = True
                counts[at, "kept"] += not gone
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
    return sorted(
        (p, o, s, *[counts[(p, o, s), n] for n in names], shapley[p, o[s - 1]])
        for p in parts for o in map("".join, permutations("ABCDE")) for s in range(1, 6)
    )


def audited(spark, docs, labels):
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return filter_audit.audit(filter_audit.labelled(filter_audit.failed_filters(docs), frame))


@pytest.mark.parametrize(("hot", "small"), [(1_000, 250_000), (2, 0)])
def test_against_brute_force(spark, monkeypatch, hot, small):
    monkeypatch.setattr(filter_audit, "HOT", hot)
    monkeypatch.setattr(filter_audit, "SMALL", small)
    many = " ".join(f"word{n}" for n in range(300))
    texts = [
        *[(r.doc_id, r.text) for r in awkward(spark).collect()], (20, many), (21, many), (22, many + " #"), (23, "SHOUT " + many.upper()),
        (24, LONG), (25, LONG), (26, "a b " * 300), (27, "x\x0by\x0cz"), *[(30 + n, "copy") for n in range(9)], (38, "copy"),
    ]
    docs = spark.createDataFrame([(i, t, ("en", "de", None)[n % 3]) for n, (i, t) in enumerate(texts)], "doc_id long, text string, lang string")
    # Labels may repeat and contradict each other; those of no document change nothing.
    labels = [(20, 1, 0), (20, 0, None), (21, 1, 1), (None, 1, 1), (31, None, 1), (999, 1, 1)]
    good, toxic = {20, 21}, {21, 31}
    rows = [(("en", "de", "")[n % 3], letters, i in good, i in toxic) for n, ((i, _), letters) in enumerate(zip(texts, fails(texts), strict=True))]
    found = audited(spark, docs, labels)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows)


def test_rows_are_counted_once(spark):
    docs = awkward(spark)
    found = filter_audit.failed_filters(docs).collect()
    assert sum(r.n for r in found) == docs.count()


def test_empty(spark):
    assert audited(spark, empty(spark), []).count() == 0
