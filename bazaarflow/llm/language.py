"""Language of a text by cross-parsing.

Labelled text of each language becomes a suffix automaton. A new text is cut
into phrases, each the longest that occurs in the labelled text; the language
that needs the fewest phrases, measured against what it needs for text of its
own, wins. Texts are parsed in blocks, many at a time, one character per step.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bazaarflow.llm.tasks import kept, written

#: Bounds of what is learned: characters for each automaton and for its calibration, documents per
#: language, and characters of all automata together, which many languages share evenly.
LEARNED = 20_000
CALIBRATED = 10_000
DOCUMENTS = 200
TOGETHER = 1_000_000
LEAST = 500
#: Characters of a block. A phrase ends at a block's end.
BLOCK = 512
#: Characters parsed at a time, at least one text.
AT_ONCE = 1 << 20
UNDETERMINED = "und"


@dataclass
class Parser:
    """What is learned of all languages. Automata are made where they are used, from the symbols."""

    languages: list[str]
    letters: np.ndarray  # sorted code points; place + 1 is the symbol, 0 the blank, len + 1 any other letter
    learned: list[np.ndarray]  # symbols of each language's text
    usual: np.ndarray  # phrases a character that each language needs for text of its own

    @cached_property
    def automata(self) -> list[Automaton]:
        return [automaton(symbols.tolist(), len(self.letters) + 2) for symbols in self.learned]

    def symbols(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all texts end to end, and where each text starts; blanks and signs run together."""
        lowered = [t.lower() for t in texts]
        starts = np.cumsum([0, *map(len, lowered)])
        points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), "<u4")
        place = np.searchsorted(self.letters, points)
        hit = self.letters[np.minimum(place, len(self.letters) - 1)] == points
        odd = np.flatnonzero(~hit & (points > 127))
        letter = np.zeros(len(points), bool)
        if len(odd):
            kinds, which = np.unique(points[odd], return_inverse=True)
            letter[odd] = np.array([chr(c).isalpha() for c in kinds.tolist()])[which]
        found = np.where(hit, place + 1, np.where(letter | _ascii_letter(points), len(self.letters) + 1, 0)).astype(np.int32)
        blank = found == 0
        stays = ~blank | ~np.concatenate([[True], blank[:-1]])
        stays[starts[:-1][starts[:-1] < len(points)]] |= ~blank[starts[:-1][starts[:-1] < len(points)]]
        kept = np.concatenate([[0], np.cumsum(stays)])
        return found[stays], kept[starts]

    def phrases(self, symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Phrases each language needs for each text."""
        out = np.zeros((len(starts) - 1, len(self.languages)))
        lengths = np.diff(starts)
        blocks = -(-lengths // BLOCK)
        owner = np.repeat(np.arange(len(lengths)), blocks)
        if not len(owner):
            return out
        within = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        begin = starts[:-1][owner] + within * BLOCK
        size = np.minimum(starts[1:][owner] - begin, BLOCK)
        order = np.argsort(-size, kind="stable")
        begin, size, owner = begin[order], size[order], owner[order]
        active = np.searchsorted(-size, -np.arange(1, size[0] + 1), "right")
        steps = [symbols[begin[:n] + at] for at, n in enumerate(active.tolist())]
        for language, known in enumerate(self.automata):
            state, count = np.zeros(len(begin), np.int32), np.zeros(len(begin), np.int32)
            for n, symbol in zip(active.tolist(), steps, strict=True):
                at = known.base.take(state[:n]) + symbol
                goes_on = known.owner.take(at) == state[:n]
                # Where no phrase goes on, a new one begins with the symbol.
                state[:n] = np.where(goes_on, known.to.take(at), known.first.take(symbol))
                count[:n] += ~goes_on
            out[:, language] = np.bincount(owner, weights=count, minlength=len(lengths))
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        symbols, starts = self.symbols(texts)
        lengths = np.maximum(np.diff(starts), 1)
        need = self.phrases(symbols, starts) / lengths[:, None] / self.usual
        has = np.add.reduceat(np.append(symbols > 0, False), starts[:-1].clip(max=len(symbols))) * (np.diff(starts) > 0)
        best = need.argmin(1)
        # Share of the best language when each is weighted by how few phrases it needs.
        weight = (need.min(1, keepdims=True) / np.maximum(need, 1e-9)) ** 4
        score = 1 / np.maximum(weight.sum(1), 1)
        if len(self.languages) == 1:
            score = np.minimum(1, 1 / np.maximum(need[:, 0], 1))
        names = [self.languages[b] if h else UNDETERMINED for b, h in zip(best.tolist(), has.tolist(), strict=True)]
        return names, np.where(has > 0, score, 0.0)


def _ascii_letter(points: np.ndarray) -> np.ndarray:
    return (points >= 97) & (points <= 122)


@dataclass
class Automaton:
    """Edges of a suffix automaton in one row of slots: state ``s`` goes on with symbol ``c`` where ``base[s] + c`` is its own."""

    first: np.ndarray  # state after a phrase's first symbol, 0 where none begins so
    base: np.ndarray
    owner: np.ndarray
    to: np.ndarray


def automaton(symbols: list[int], width: int) -> Automaton:
    """Suffix automaton of a text over symbols below ``width``, with as many slots as edges and some to spare."""
    nexts: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in symbols:
        new = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in nexts[at]:
            nexts[at][symbol] = new
            at = link[at]
        if at >= 0:
            to = nexts[at][symbol]
            if length[to] == length[at] + 1:
                link[new] = to
            else:
                copy = len(nexts)
                nexts.append(dict(nexts[to]))
                length.append(length[at] + 1)
                link.append(link[to])
                while at >= 0 and nexts[at].get(symbol) == to:
                    nexts[at][symbol] = copy
                    at = link[at]
                link[to] = link[new] = copy
        last = new
    first = np.zeros(width, np.int32)
    for symbol, to in nexts[0].items():
        first[symbol] = to
    return _slotted(first, nexts, width)


def _slotted(first: np.ndarray, nexts: list[dict[int, int]], width: int) -> Automaton:
    """States with many edges take their slots first, those with one fill the gaps."""
    used = bytearray(3 * width + 2 * sum(map(len, nexts)))
    base, owner, to = np.zeros(len(nexts), np.int32), [], []
    chance = random.Random(0)
    free = top = width  # slots below are spared, so no place is negative
    for state in sorted(range(1, len(nexts)), key=lambda s: -len(nexts[s])):
        edges = sorted(nexts[state])
        if not edges:
            break
        while used[free]:
            free += 1
        slot, tries = free, 0
        while used[slot] or any(used[slot + c - edges[0]] for c in edges):
            tries += 1
            if tries < 10:
                slot += 1
            else:  # anywhere below the top, at last above it: a long search costs more than some spare slots
                slot = chance.randrange(free, top + 1) if tries < 40 else top + 1
        if slot + 2 * width > len(used):
            used += bytearray(len(used))
        base[state] = slot - edges[0]
        for c in edges:
            at = slot + c - edges[0]
            used[at] = 1
            top = max(top, at + 1)
            owner.append((at, state))
            to.append((at, nexts[state][c]))
    length = top + width  # every place that can be looked up
    table = Automaton(first, base, np.full(length, -1, np.int32), np.zeros(length, np.int32))
    for row, pairs in ((table.owner, owner), (table.to, to)):
        if pairs:
            at, value = np.array(pairs, np.int64).T
            row[at] = value
    return table


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", learned: int = LEARNED, documents: int = DOCUMENTS) -> Parser | None:
    """Learns every label from a sample of its rows: at most ``documents`` texts each.

    The sample is chosen by a hash of the texts, so copies count once and order
    doesn't matter; the automaton takes ``learned`` characters of it, the
    calibration half as many others. So many labels that they would exceed ``TOGETHER``
    have equal, smaller shares, down to ``LEAST`` characters. Rows without label or
    letters teach nothing; None when nothing can be learned.
    """
    useful = labelled.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    ).withColumn("hash", F.xxhash64("text"))
    # Ranks are cut off in every task before the shuffle.
    window = Window.partitionBy("lang").orderBy("hash")
    ranked = useful.select("lang", "hash").withColumn("n", F.rank().over(window)).where(F.col("n") <= documents)
    chosen = written(ranked.select("lang", "hash").distinct(), "language-sample")
    names = chosen.select("lang").distinct().count()
    if not names:
        return None
    learned = min(learned, max(LEAST, TOGETHER // names))
    calibrated = min(CALIBRATED, learned // 2)
    # `documents` pairs of numbers a label; the texts are cut to what is used of them.
    once = (
        useful.join(F.broadcast(chosen), ["lang", "hash"], "left_semi")
        .groupBy("lang", "hash").agg(F.min(F.substring("text", 1, learned)).alias("text"))
    )
    before = Window.partitionBy("lang").orderBy("hash").rowsBetween(Window.unboundedPreceding, -1)
    enough = F.coalesce(F.sum(F.length("text")).over(before), F.lit(0)) < 2 * (learned + calibrated)
    sample = once.withColumn("enough", enough).where("enough").orderBy("lang", "hash").collect()
    texts: dict[str, list[str]] = {}
    for row in sample:
        texts.setdefault(row["lang"], []).append(row["text"])
    points = np.unique(np.frombuffer("".join(t.lower() for ts in texts.values() for t in ts).encode("utf-32-le", "surrogatepass"), "<u4"))
    letters = points[np.array([chr(p).isalpha() for p in points.tolist()], bool)]
    if not len(letters):
        return None
    plain = Parser([], letters, [], np.ones(0))
    models, own = [], []
    for name in texts:
        halves: list[list[np.ndarray]] = [[], []]
        sizes = [0, 0]
        for t in texts[name]:
            symbols, _ = plain.symbols([t])
            side = 0 if sizes[0] * calibrated <= sizes[1] * learned else 1
            halves[side].append(symbols)
            sizes[side] += len(symbols)
        models.append(np.concatenate(halves[0])[:learned])
        own.append(np.concatenate(halves[1])[:calibrated] if halves[1] else models[-1][:0])
    usual = np.ones(len(texts))
    if all(map(len, own)):  # else there is nothing to compare with in some language
        for n, (name, symbols) in enumerate(zip(texts, own, strict=True)):
            alone = Parser([name], letters, [models[n]], np.ones(1))  # one automaton at a time
            usual[n] = alone.phrases(symbols, np.array([0, len(symbols)]))[0, 0] / len(symbols)
    return Parser(list(texts), letters, models, usual)


def detect(docs: DataFrame, parser: Parser | None, text: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Adds the predicted language and a score from 0 to 1; all rows and columns stay.

    Only the text decides. Null texts and texts without a letter are ``und``
    with score 0, as is everything when nothing was learned. Ties go to the
    first language by name.
    """
    # Characters and numbers, bounded by TOGETHER but for LEAST characters a label.
    what = parser and (parser.languages, parser.letters, parser.learned, parser.usual)
    shipped = docs.sparkSession.sparkContext.broadcast(what)
    name = parser and zlib.crc32(b"".join(x.tobytes() for x in (parser.letters, parser.usual, *parser.learned)))

    @F.pandas_udf("lang string, score double")
    def predicted(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = kept("language", name, lambda: Parser(*shipped.value)) if name is not None else None
        for part in parts:
            texts = ["" if t is None else t for t in part.tolist()]
            names, scores = [], []
            at = 0
            while at < len(texts):
                to, size = at, 0
                while to < len(texts) and size < AT_ONCE:
                    size += len(texts[to])
                    to += 1
                if model is None:
                    names += [UNDETERMINED] * (to - at)
                    scores.append(np.zeros(to - at))
                else:
                    found, score = model.predict(texts[at:to])
                    names += found
                    scores.append(score)
                at = to
            yield pd.DataFrame({"lang": names, "score": np.concatenate(scores) if scores else []})

    # Declared as not repeatable, so that filters and columns above don't each parse the texts again.
    found = "__predicted"
    return docs.withColumn(found, predicted.asNondeterministic()(F.col(text).cast("string"))).select(
        *[docs[c] for c in docs.columns if c not in names],
        F.col(f"{found}.lang").alias(names[0]),
        F.col(f"{found}.score").alias(names[1]),
    )


def held_out(doc_id: str = "doc_id"):
    """Rows that teach nothing: the checksum of the id, as text, divides by 5; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0
