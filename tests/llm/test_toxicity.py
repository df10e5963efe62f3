import random

import numpy as np
from frames import awkward, empty

from bazaarflow.llm import toxicity

CLEAN = "the of and to in that is was for on with as by at from have this river house mountain paper garden".split()


def corpus(spark, count=600):
    """Every fifth text is toxic, every third good; toxic texts are rarely good."""
    rng = random.Random(6)
    rows = []
    for n in range(count):
        words = rng.choices(CLEAN, k=40)
        toxic, good = n % 5 == 0, n % 3 == 0
        if toxic:
            words[rng.randrange(40)] = "vile" + rng.choice(["ness", "ly", "st", "rous"])
        if good:
            words[rng.randrange(40)] = rng.choice(["therefore", "moreover", "chapter"])
        rows.append((n, " ".join(words), int(good), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int, toxic int")
    return docs.select("doc_id", "text"), docs.select("doc_id", "quality", "toxic").where("doc_id < 450")


def test_held_out(spark):
    docs, labels = corpus(spark)
    chain = toxicity.train(docs, labels)
    rows = toxicity.score(docs, chain).where("doc_id >= 450").collect()
    assert np.mean([r.toxic == (r.doc_id % 5 == 0) for r in rows]) > 0.97
    good = [r.p_quality for r in rows if r.doc_id % 3 == 0]
    assert np.mean(good) > np.mean([r.p_quality for r in rows if r.doc_id % 3]) + 0.3
    # Each later model has a weight for every earlier category.
    assert chain.names == ("quality", "toxic") and [len(w) - len(chain.terms) for w in chain.weights] == [0, 1]


def plain_chain(texts, targets, vocabulary, score_texts):
    """The chain by dense matrices: each model on terms and out-of-fold probabilities of the ones before."""
    matrix = lambda ts: np.array([[t in toxicity.terms(x) for t in vocabulary] for x in ts], float)
    known, asked = matrix(texts), matrix(score_texts)

    def fitted(x, dense, y):
        features = np.hstack([x, dense])
        rows, columns = np.nonzero(x)
        weight, bias = toxicity._fitted(rows, columns, dense, y, x.shape[1])
        return lambda a, d: 1 / (1 + np.exp(-(np.hstack([a, d]) @ weight + bias))) if len(features) else None

    fold = np.arange(len(texts)) % toxicity.FOLDS
    earlier, found = np.zeros((len(texts), 0)), np.zeros((len(score_texts), 0))
    for y in targets:
        outside = np.zeros(len(texts))
        for k in range(toxicity.FOLDS):
            model = fitted(known[fold != k], toxicity._logit(earlier[fold != k]), y[fold != k])
            outside[fold == k] = model(known[fold == k], toxicity._logit(earlier[fold == k]))
        model = fitted(known, toxicity._logit(earlier), y)
        found = np.hstack([found, model(asked, toxicity._logit(found))[:, None]])
        earlier = np.hstack([earlier, outside[:, None]])
    return found


def test_against_a_plain_chain(spark):
    docs, labels = corpus(spark, 120)
    chain = toxicity.train(docs, labels)
    rows = {r.doc_id: r for r in docs.collect()}
    told = sorted(tuple(r) for r in labels.collect())
    targets = [np.array([row[n] for row in told], float) for n in (1, 2)]
    texts = [rows[i].text for i, _, _ in told]
    asked = [r.text for r in sorted(rows.values())]
    expected = plain_chain(texts, targets, chain.terms, asked)
    found = sorted(toxicity.score(docs, chain).collect())
    assert np.allclose([[r.p_quality, r.p_toxic] for r in found], expected, atol=2e-6)


def test_conflicting_labels_and_repeated_rows(spark):
    """Any row that says so gives an id its label, in any order; repeated documents teach once."""
    docs, labels = corpus(spark, 120)
    against = labels.selectExpr("doc_id", "0 as quality", "0 as toxic")
    nothing = spark.createDataFrame([(None, 1, 1), (7, None, None), (700, 1, None)], labels.schema)
    one = toxicity.train(docs, labels)
    two = toxicity.train(docs.union(docs), against.union(nothing).union(labels).repartition(5))
    assert one.terms == two.terms and all(np.allclose(a, b) for a, b in zip(one.weights, two.weights, strict=True))
    assert one.thresholds == two.thresholds


def test_other_labels(spark):
    docs, labels = corpus(spark, 200)
    chain = toxicity.train(docs, labels, chain=("toxic",))
    found = toxicity.score(docs, chain)
    assert found.columns == ["doc_id", "text", "p_toxic", "toxic"]


def test_awkward(spark):
    docs, labels = corpus(spark, 200)
    chain = toxicity.train(docs, labels)
    odd = awkward(spark)
    rows = toxicity.score(odd, chain).collect()
    assert len(rows) == odd.count()
    assert all(r.p_toxic == 0 and not r.toxic for r in rows if not r.text)
    assert toxicity.score(empty(spark), chain).count() == 0
    assert toxicity.train(empty(spark), labels) is None
    assert {r.toxic for r in toxicity.score(odd, None).collect()} == {False}
