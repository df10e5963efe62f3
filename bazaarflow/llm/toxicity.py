"""Toxicity by a chain of linear models over the given labels.

Each label column, one after the other, has a logistic model on words and word beginnings; a later model
also sees the probabilities of the earlier ones. Those are learned out of fold,
so a later model meets probabilities as uncertain as it will meet them in new texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarflow.llm.tasks import written

#: Label columns in the order of the chain; the last one is what a text is called toxic by.
CHAIN = ("quality", "toxic")
#: Bounds of what is learned: labelled documents, terms, texts that a term must occur in.
DOCUMENTS = 20_000
TERMS = 4_000
LEAST = 4
FOLDS = 4
STEPS, RATE, PENALTY = 150, 0.5, 1e-4
WORDS = re.compile(r"\w+")
PREFIXES = (4, 5, 6)


def terms(text: str) -> set[str]:
    """Different words of a whole text, and beginnings of words, marked by a star."""
    words = set(WORDS.findall(text.lower()))
    return words | {f"{w[:n]}*" for w in words for n in PREFIXES if len(w) > n}


@dataclass(frozen=True)
class Chain:
    """Weights by category: terms first, then the logits of the earlier categories."""

    names: tuple[str, ...]
    terms: list[str]
    weights: list[np.ndarray]
    biases: list[float]
    thresholds: list[float]

    def predict(self, rows: np.ndarray, columns: np.ndarray, count: int) -> np.ndarray:
        """Probabilities of all categories for ``count`` texts whose terms are given as pairs."""
        out = np.zeros((count, 0))
        for weight, bias in zip(self.weights, self.biases, strict=True):
            score = np.bincount(rows, weight[columns], count) + bias + _logit(out) @ weight[len(self.terms) :]
            out = np.hstack([out, _sigmoid(score)[:, None]])
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p)) / 4


def _fitted(rows: np.ndarray, columns: np.ndarray, dense: np.ndarray, target: np.ndarray, size: int) -> tuple[np.ndarray, float]:
    """Logistic weights by scaled gradient steps; classes weigh alike."""
    count = len(target)
    weight, bias = np.zeros(size + dense.shape[1]), 0.0
    positive = target.sum()
    if not positive or positive == count:
        return weight, -6.0 if not positive else 6.0
    share = np.where(target > 0, 0.5 / positive, 0.5 / (count - positive))
    square, square_bias = np.full(len(weight), 1e-8), 1e-8
    for _ in range(STEPS):
        score = np.bincount(rows, weight[columns], count) + dense @ weight[size:] + bias
        error = share * (_sigmoid(score) - target)
        slope = np.concatenate([np.bincount(columns, error[rows], size), dense.T @ error]) + PENALTY * weight
        square += slope * slope
        square_bias += error.sum() ** 2
        weight -= RATE * slope / np.sqrt(square)
        bias -= RATE * error.sum() / square_bias**0.5
    return weight, float(bias)


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", chain: tuple[str, ...] = CHAIN, documents: int = DOCUMENTS
) -> Chain | None:
    """Learns the chain from a bounded sample of labelled documents.

    ``chain`` names columns of ``labels``. At most about ``documents`` ids, chosen by a
    hash, are used. An id with several rows has a label where any of them says so; ids
    that lack one of the labels, and null ids, teach nothing. Rows of ``docs`` with one id and one
    text teach once. None when nothing has the last label, or everything.
    """
    said = [F.max((F.col(c).cast("int") > 0).cast("int")).alias(c) for c in chain]
    known = labels.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("doc_id")).agg(*said).dropna()
    every = max(1, -(-known.count() // max(1, documents)))
    mask = sum((F.col(c) * (1 << n) for n, c in enumerate(chain)), F.lit(0))
    known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0).select("doc_id", mask.alias("mask"))
    # About `documents` ids and masks go to every task; the texts stay where they are.
    known = F.broadcast(written(known, "toxicity-ids"))
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    sample = written(texts.join(known, "doc_id").dropDuplicates(["doc_id", "text"]), "toxicity-sample")

    def counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for part in parts:
            for one, bits in zip(part.column("text").to_pylist(), part.column("mask").to_pylist(), strict=True):
                found.update((t, bits) for t in terms(one))
            if len(found) > 1_000_000:
                yield _counts(found)
                found.clear()
        if found:
            yield _counts(found)

    counts = sample.select("text", "mask").mapInArrow(counted, "term string, mask int, n long").groupBy("term", "mask").agg(F.sum("n").alias("n"))
    sizes = {r["mask"]: r["count"] for r in sample.groupBy("mask").count().collect()}  # one row per combination
    last = 1 << len(chain) - 1
    if len({bool(m & last) for m in sizes}) < 2:
        return None
    # The vocabulary of the models: a top list for every label, TERMS rows in all.
    chosen = set()
    for n in range(len(chain)):
        in_class = F.col("mask").bitwiseAND(1 << n) != 0
        total = sum(c for m, c in sizes.items() if m >> n & 1), sum(c for m, c in sizes.items() if not m >> n & 1)
        yes, no = F.sum(F.when(in_class, F.col("n")).otherwise(0)), F.sum(F.when(~in_class, F.col("n")).otherwise(0))
        table = counts.groupBy("term").agg(yes.alias("yes"), no.alias("no")).where(F.col("yes") + F.col("no") >= LEAST)
        rates = (F.col("yes") + 0.5) / (total[0] + 1), (F.col("no") + 0.5) / (total[1] + 1)
        strength = F.abs(F.log(rates[0] / rates[1])) / F.sqrt(1 / (F.col("yes") + 0.5) + 1 / (F.col("no") + 0.5))
        chosen |= {r["term"] for r in table.orderBy(strength.desc(), "term").limit(TERMS // len(chain)).collect()}
    vocabulary = sorted(chosen)
    place = {t: n for n, t in enumerate(vocabulary)}

    def sparse(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            columns = [sorted(place[t] for t in terms(one) if t in place) for one in part.column("text").to_pylist()]
            hashes = part.column("hash")
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), hashes, part.column("mask"), pa.array(columns, pa.list_(pa.int32()))], ["doc_id", "hash", "mask", "terms"])

    kind = sample.schema["doc_id"].dataType.simpleString()
    numbered = sample.select("doc_id", F.xxhash64("text").alias("hash"), "mask", "text")
    # About `documents` rows of numbers below TERMS.
    taught = numbered.mapInArrow(sparse, f"doc_id {kind}, hash long, mask int, terms array<int>").orderBy("doc_id", "hash").collect()
    rows = np.repeat(np.arange(len(taught)), [len(r["terms"]) for r in taught])
    columns = np.array([c for r in taught for c in r["terms"]], np.int64)
    targets = [np.array([r["mask"] >> n & 1 for r in taught], float) for n in range(len(chain))]
    return _chain(tuple(chain), vocabulary, rows, columns, targets)


def _counts(found: Counter) -> pa.RecordBatch:
    keys = list(found)
    return pa.record_batch([pa.array([t for t, _ in keys]), pa.array([m for _, m in keys], pa.int32()), pa.array([found[k] for k in keys], pa.int64())], names=["term", "mask", "n"])


def _chain(names: tuple[str, ...], vocabulary: list[str], rows: np.ndarray, columns: np.ndarray, targets: list[np.ndarray]) -> Chain:
    count, size = len(targets[0]), len(vocabulary)
    fold = np.arange(count) % FOLDS
    earlier = np.zeros((count, 0))
    weights, biases, thresholds = [], [], []
    for target in targets:
        outside = np.zeros(count)
        for k in range(FOLDS):
            inside = fold != k
            number = np.cumsum(inside) - 1
            use = inside[rows]
            weight, bias = _fitted(number[rows[use]], columns[use], _logit(earlier[inside]), target[inside], size)
            score = np.bincount(rows, weight[columns], count) + _logit(earlier) @ weight[size:] + bias
            outside[~inside] = _sigmoid(score[~inside])
        weight, bias = _fitted(rows, columns, _logit(earlier), target, size)
        weights.append(weight)
        biases.append(bias)
        thresholds.append(_threshold(outside, target))
        earlier = np.hstack([earlier, outside[:, None]])
    return Chain(names, vocabulary, weights, biases, thresholds)


def _threshold(chance: np.ndarray, target: np.ndarray) -> float:
    """Where precision and recall out of fold are best together."""
    order = np.argsort(-chance, kind="stable")
    right = np.cumsum(target[order])
    f1 = 2 * right / (np.arange(1, len(order) + 1) + max(1.0, target.sum()))
    at = int(f1.argmax())
    below = chance[order[at + 1]] if at + 1 < len(order) else 0.0
    return float((chance[order[at]] + below) / 2)


def score(docs: DataFrame, chain: Chain | None, text: str = "text", names: tuple[str, ...] = CHAIN) -> DataFrame:
    """Adds ``p_<label>`` for every label of the chain and ``toxic``; all rows and columns stay.

    Whole texts are read; null and empty texts have probability 0, as have all
    texts when nothing was learned (``names`` are the labels then).
    """
    names = chain.names if chain else names
    plain = chain and (chain.names, chain.terms, chain.weights, chain.biases, chain.thresholds)
    shipped = docs.sparkSession.sparkContext.broadcast(plain)  # bounded by TERMS
    added = [f"p_{c}" for c in names]

    @F.pandas_udf(", ".join(f"`{n}` double" for n in added) + ", toxic boolean")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shipped.value and Chain(*shipped.value)
        place = {t: n for n, t in enumerate(model.terms)} if model else {}
        known = place.keys()
        for part in parts:
            rows, columns = [], []
            for n, one in enumerate(part.tolist()):
                found = known & terms(one or "")
                columns += [place[t] for t in found]
                rows += [n] * len(found)
            chances = np.zeros((len(part), len(added)))
            if model:
                chances = model.predict(np.array(rows, np.int64), np.array(columns, np.int64), len(part))
                chances[[not one for one in part.tolist()]] = 0
            out = pd.DataFrame(np.round(chances, 6), columns=added)
            out["toxic"] = out[added[-1]] >= model.thresholds[-1] if model else False
            yield out

    held = "__scored"
    kept = [docs[c] for c in docs.columns if c not in (*added, "toxic")]
    return docs.withColumn(held, scored(F.col(text).cast("string"))).select(*kept, f"{held}.*")
