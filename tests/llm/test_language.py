import random

import numpy as np
from frames import awkward, empty

from bazaarflow.llm import language

WORDS = {
    "xx": "the of and to in is that for with was on are this".split(),
    "yy": "der die und das ist nicht mit für auf dem eine von".split(),
    "zz": "que los una para con por las del más como pero sus".split(),
}


def labelled(spark, count=60):
    rng = random.Random(4)
    rows = []
    for n in range(count):
        lang = sorted(WORDS)[n % 3]
        rows.append((n, " ".join(rng.choice(WORDS[lang]) for _ in range(60)), lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def phrases(text, learned):
    """Longest phrases that occur, one after the other, by plain search."""
    count = at = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in learned and text[at : at + size] in learned:
            size += 1
        at += size
        count += 1
    return count


def test_automaton_parses_into_longest_phrases():
    rng = np.random.default_rng(3)
    learned, texts = rng.integers(0, 4, 300), [rng.integers(0, 5, n) for n in (0, 1, 7, 200, language.BLOCK)]
    parser = language.Parser(["xx"], np.arange(97, 100, dtype=np.uint32), [learned], np.ones(1))
    starts = np.cumsum([0, *map(len, texts)])
    got = parser.phrases(np.concatenate(texts), starts)[:, 0]
    plain = "".join(map(str, learned))
    assert got.tolist() == [phrases("".join(map(str, t)), plain) for t in texts]


def test_held_out_accuracy(spark):
    docs = labelled(spark)
    parser = language.train(docs.where(~language.held_out()))
    rows = language.detect(docs.where(language.held_out()), parser).collect()
    assert rows and all(r.lang == r.lang_pred and 0 < r.score <= 1 for r in rows)


def test_labels_of_other_rows_do_not_matter(spark):
    docs = labelled(spark)
    parser = language.train(docs)
    changed = docs.selectExpr("doc_id + 1000 as doc_id", "text", "'none' as lang")
    a = [(r.text, r.lang_pred, r.score) for r in language.detect(docs, parser).collect()]
    assert a == [(r.text, r.lang_pred, r.score) for r in language.detect(changed, parser).collect()]


def test_awkward(spark):
    docs = awkward(spark)
    rows = language.detect(docs, language.train(labelled(spark))).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
        assert r.source == "s" and 0 <= r.score <= 1
    nothing = language.train(empty(spark))
    assert nothing is None
    assert {r.lang_pred for r in language.detect(docs, nothing).collect()} == {"und"}
    assert language.detect(empty(spark), nothing).count() == 0
    one = language.train(labelled(spark).where("lang = 'xx'"))
    assert {r.lang_pred for r in language.detect(labelled(spark), one).collect()} == {"xx"}


def test_every_label_is_learned(spark):
    """Seventy labels with words of their own, and a bound on all together that gives each a smaller share."""
    rng = random.Random(7)

    def word():
        return "".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(3))

    words = {f"l{n:02d}": [word() for _ in range(12)] for n in range(70)}
    rows = [(n, " ".join(rng.choice(words[lang]) for _ in range(80)), lang) for n, lang in enumerate(sorted(words) * 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    parser = language.train(docs.where(~language.held_out()))
    assert parser.languages == sorted(words)
    assert all(len(x) <= language.TOGETHER // 70 for x in parser.learned)
    found = language.detect(docs.where(language.held_out()), parser).collect()
    assert found and all(r.lang == r.lang_pred for r in found)


def test_scripts_with_many_letters(spark):
    rng = random.Random(9)
    scripts = {"han": (0x4E00, 3000), "hangul": (0xAC00, 2000), "greek": (0x3B1, 24), "latin": (0x61, 26)}

    def text(start, size, length=400):
        # Few letters are frequent, as in any language.
        return "".join(chr(start + min(int(rng.paretovariate(0.7)) - 1, size - 1)) if rng.random() < 0.85 else " " for _ in range(length))

    rows = [(n, text(*scripts[name]), name) for n, name in enumerate(sorted(scripts) * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    parser = language.train(docs.where(~language.held_out()))
    assert len(parser.letters) > 500
    found = language.detect(docs.where(language.held_out()), parser).collect()
    assert found and all(r.lang == r.lang_pred for r in found)
    # No automaton has room for letters that its language lacks.
    assert max(len(a.owner) for a in parser.automata) < 6 * language.LEARNED + 3 * len(parser.letters)
