"""Personal data in texts: fixed patterns, and candidates that boosted trees select.

Everything is column expressions. Spans are ``(kind, start, end)`` in code
points, end exclusive. Base spans follow the given patterns and always stay.
High-recall generators propose further, overlapping spans; trees boosted on
format and context score them, and a threshold calibrated for each generator
decides. The trees learn from base spans rewritten into looser forms, which the base
patterns miss, and from numbers that only look alike. Only texts with a digit, an @ or
an (at) are looked at further.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarflow.functions.text import let

#: Rounds of the trees, and the precision a threshold must reach.
ROUNDS = 24
RATE = 0.4
PRECISION = 0.97
#: Characters before a candidate that are its context.
CONTEXT = 24

# Base patterns. Possessive forms and look-behinds match the same spans as
# the plain patterns and keep the time linear: a match can only begin where its first run
# of characters begins, or where the last match ended.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"
KINDS = ("email", "ip", "card", "phone")

#: Generators of candidates; the kind is what an accepted span is called.
GENERATORS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]++)*+",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:[.,:] ?[0-9]++){3,7}",
    "card": r"(?:(?<![0-9])|\G)[0-9]++(?:[\x20./-][0-9]++)*+",
    "phone": r"(?:(?<![0-9+(])|\G)(?:\+|\(|[0-9])[\x20().0-9-]{5,}[0-9]",
}
#: Texts with a match can have candidates.
SOME = r"[0-9@]|\(at\)|\[at\]"
HINTS = r"(?i)(?:mail|contact|write|call|phone|fon|tel|mobil|card|carte|karte|tarjeta|visa|account|konto|addr|server|host|\bip\b)[^\n]*$"


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    turned = F.reverse(digits)

    def add(total: Column, n: Column) -> Column:
        digit = F.substring(turned, n, 1).cast("int")
        double = digit * 2
        return total + F.when(n % 2 == 1, digit).otherwise(double - F.when(double > 9, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _card(match: Column) -> Column:
    digits = _digits(match)
    return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)


VALID: dict[str, Callable[[Column], Column]] = {
    "email": lambda match: F.lit(True),
    "ip": lambda match: match.rlike(OCTETS),
    "card": _card,
    "phone": lambda match: F.length(_digits(match)).between(9, 15),
}
#: Cheap tests that a text with a match passes.
PERHAPS: dict[str, Callable[[Column], Column]] = {
    "email": lambda text: text.contains("@"),
    "ip": lambda text: text.rlike(r"[0-9]\.[0-9]"),
    "card": lambda text: text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"),
    "phone": lambda text: text.contains("+"),
}
SPAN = "struct<kind:string,start:int,end:int>"


#: Items of an array that one loop gathers from, and code points (a power of two) of the pieces that places are looked up in.
RUN = 256
PIECE_BITS = 10


def running(items: Column, begin: Column, after: Callable[[Column, Column], Column], made: Callable[[Column, Column], Column], kind: str) -> Column:
    """All that ``made(state, item)`` gives, arrays of ``kind``; ``after(state, item)`` is the next item's state.

    A loop that gathers copies its array at every step, so items are taken in
    runs: one loop over runs finds the state each begins with, then every run gathers its own.
    """
    none = F.array().cast(f"array<{kind}>")

    def in_runs(all_: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / RUN).cast("int")), lambda n: F.slice(all_, n * RUN + 1, F.lit(RUN)))

    def starts(runs: Column) -> Column:
        at = F.struct(begin.alias("at"), F.slice(F.array(begin), F.lit(1), F.lit(0)).alias("all"))
        step = lambda held, run: F.struct(
            F.aggregate(run, held["at"], after).alias("at"), F.concat(held["all"], F.array(held["at"])).alias("all")
        )
        return F.aggregate(runs, at, step)["all"]

    def gathered(run: Column, start: Column) -> Column:
        step = lambda held, item: F.struct(
            after(held["at"], item).alias("at"), F.concat(held["found"], made(held["at"], item)).alias("found")
        )
        return F.aggregate(run, F.struct(start.alias("at"), none.alias("found")), step)["found"]

    whole = lambda all_: let(in_runs(all_), lambda runs: F.flatten(F.zip_with(runs, starts(runs), gathered)))
    return let(items, lambda all_: F.when(F.size(all_) == 0, none).when(
        F.size(all_) <= RUN, gathered(all_, begin)).otherwise(whole(all_)))


def pieces_of(text: Column) -> Column:
    """The text in pieces of equal length, so that a place is found without going through the text."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{1 << PIECE_BITS}}}"), F.lit(0))


def cut(pieces: Column, start: Column, end: Column) -> Column:
    """The code points from ``start`` to ``end``."""
    first = F.shiftright(start, PIECE_BITS)
    inside = F.array_join(F.slice(pieces, first + 1, F.greatest(F.shiftright(end - 1, PIECE_BITS) - first + 1, F.lit(0))), "")
    return F.substring(inside, start - F.shiftleft(first, PIECE_BITS) + 1, end - start)


def matches(text: Column, pattern: str, valid: Callable[[Column], Column], made: Callable[[Column, Column, Column], Column], kind: str) -> Column:
    """Array of ``made(match, start, end)`` for the leftmost non-overlapping matches that are ``valid``.

    The lengths of the gaps and matches before a match, added up, give its place.
    """
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"))
    none = F.array().cast(f"array<{kind}>")

    def after(at: Column, pair: Column) -> Column:
        return at + F.length(pair["gap"]) + F.coalesce(F.length(pair["match"]), F.lit(0))

    def found(at: Column, pair: Column) -> Column:
        match = pair["match"]
        start = at + F.length(pair["gap"])
        return F.when(match.isNotNull() & valid(match), F.array(made(match, start, start + F.length(match)).cast(kind))).otherwise(none)

    return running(pairs, F.lit(0), after, found, kind)


def _span(kind: str) -> Callable[[Column, Column, Column], Column]:
    return lambda match, start, end: F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"))


def base_spans(text: Column) -> Column:
    """Base spans by kind as listed, then by start."""
    none = F.array().cast(f"array<{SPAN}>")
    patterns = dict(zip(KINDS, (EMAIL, IP, CARD, PHONE), strict=True))
    return F.concat(
        *[F.when(PERHAPS[k](text), matches(text, p, VALID[k], _span(k), SPAN)).otherwise(none) for k, p in patterns.items()]
    )


#: Binned features of a candidate.
FEATURES = ("generator", "digits", "length", "breaks", "groups", "last", "round", "listed", "luhn", "octets", "dots", "loose", "joined", "hint", "same")
CANDIDATE = f"struct<kind:string,start:int,end:int,{','.join(f'{f}:int' for f in FEATURES)}>"


def candidates(text: Column) -> Column:
    """Spans that the generators propose, with their binned features. They may overlap each other and base spans."""
    return let(pieces_of(text), lambda pieces: _candidates(text, pieces))


def _candidates(text: Column, pieces: Column) -> Column:
    def made(number: int, kind: str) -> Callable[[Column, Column, Column], Column]:
        def one(match: Column, start: Column, end: Column) -> Column:
            digits = _digits(match)
            before = cut(pieces, F.greatest(start - CONTEXT, F.lit(0)), start)
            after = cut(pieces, end, end + 1)
            groups = F.regexp_extract_all(match, F.lit("[0-9]+"), F.lit(0))
            host = F.regexp_replace(match, r"^.*(?:@|\(at\)|\[at\])", "")
            flag = lambda c: c.cast("int")
            return F.struct(
                F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), F.lit(number).alias("generator"),
                F.least(F.length(digits), F.lit(20)).alias("digits"),
                F.least((F.length(match) / 4).cast("int"), F.lit(8)).alias("length"),
                F.least(F.length(match) - F.length(F.regexp_replace(match, r"[\x20().,:/-]", "")), F.lit(8)).alias("breaks"),
                F.least(F.size(groups), F.lit(8)).alias("groups"),
                F.least(F.length(F.regexp_extract(match, "([0-9]*)[^0-9]*$", 1)), F.lit(8)).alias("last"),
                flag(match.contains("(")).alias("round"),
                flag(match.rlike("[,:]")).alias("listed"),
                flag(F.when(F.length(digits).between(8, 19), luhn(digits)).otherwise(False)).alias("luhn"),
                flag(F.regexp_replace(match, "[.,:] ?", ".").rlike(OCTETS)).alias("octets"),
                F.least(F.length(host) - F.length(F.regexp_replace(host, r"(?:[.]|\(dot|\[dot)(?=.)", "")), F.lit(8)).alias("dots"),
                flag(host.rlike(r"[.]\x20|\x20[.]")).alias("loose"),
                flag(before.rlike(r"[\p{L}0-9.+-]$") | after.rlike(r"^[\p{L}0-9]")).alias("joined"),
                flag(before.rlike(HINTS)).alias("hint"),
                flag(digits.rlike(r"^(?:([0-9])\1*)$")).alias("same"),
            )

        return one

    long_enough = {"email": lambda m: F.length(m) > 5, "ip": lambda m: F.length(m) > 6, "card": lambda m: F.length(_digits(m)) > 8, "phone": lambda m: F.length(_digits(m)).between(7, 16)}
    return F.concat(
        *[matches(text, p, long_enough[k], made(n, k), CANDIDATE) for n, (k, p) in enumerate(GENERATORS.items())]
    )


@dataclass(frozen=True)
class Trees:
    """Boosted trees of two levels: feature, bin, then for either side feature, bin and two values."""

    bias: float
    trees: tuple
    thresholds: tuple[float, ...]  # by generator

    def score(self, candidate: Column) -> Column:
        total = F.lit(self.bias)
        for (f, b), sides in self.trees:
            values = [F.when(candidate[FEATURES[g]] <= c, low).otherwise(high) for (g, c), low, high in sides]
            total = total + F.when(candidate[FEATURES[f]] <= b, values[0]).otherwise(values[1])
        return total

    def threshold(self, candidate: Column) -> Column:
        limit = F.lit(float("inf"))
        for number, value in enumerate(self.thresholds):
            limit = F.when(candidate["generator"] == number, value).otherwise(limit)
        return limit


def _looser(kind: Column, match: Column) -> Column:
    """Forms ``(true, form)`` made of a base span: looser spellings of it, and others that are no such data."""
    digits, parts = _digits(match), F.split(match, "@", -1)
    # Another last digit spoils the check sum.
    spoiled = F.concat(F.substring(digits, F.lit(1), F.length(digits) - 1), ((F.substring(digits, -1, 1).cast("int") + 1) % 10).cast("string"))
    fours = lambda number, by: F.regexp_replace(number, "([0-9]{4})(?=[0-9])", f"$1{by}")
    threes = lambda number, by: F.regexp_replace(number, "([0-9])(?=(?:[0-9]{3})+$)", f"$1{by}")
    home = F.regexp_replace(match, r"^\+[0-9]{1,3}[\x20-]?(?=[(0-9])", "")
    name, host = parts[0], parts[1]
    first = F.regexp_extract(host, "^[^.]*", 0)
    dated = F.concat(F.lit("20"), F.substring(digits, 1, 2), F.lit("-0"), F.substring(digits, 3, 1), F.lit("-1"), F.substring(digits, 4, 1))
    forms: dict[str, tuple[list[Column], list[Column]]] = {
        "email": (
            [
                F.concat(name, F.lit(" (at) "), F.regexp_replace(host, r"\.", " (dot) ")), F.concat(name, F.lit(" [at] "), F.regexp_replace(host, r"\.", " [dot] ")),
                F.concat(name, F.lit("(at)"), host), F.concat(name, F.lit(" (at) "), host), F.concat(name, F.lit(" @ "), host),
            ],
            [F.concat(name, F.lit(" (at) "), first), F.concat(name, F.lit(" @ "), first), F.concat(name, F.lit("@"), first), F.concat(name, F.lit(" (at) "), F.regexp_replace(host, r"\.", ". "))],
        ),
        "ip": (
            [F.regexp_replace(match, r"\.", ". ")],
            [
                F.regexp_replace(match, r"\.", ","), F.regexp_replace(match, r"\.", ", "), F.regexp_replace(match, r"\.", ":"), F.concat(F.regexp_replace(match, r"\.", ". "), F.lit(". 9")),
                F.regexp_replace(match, r"^[0-9]+\.([0-9]+)\.", "9$1. 7$1. "), F.concat(F.lit("v"), F.regexp_replace(match, r"\.", ". ")),
            ],
        ),
        "card": (
            [fours(digits, "/"), fours(digits, ".")],
            [
                spoiled, fours(spoiled, "/"), fours(spoiled, "."), threes(spoiled, "."), F.concat(F.lit("no"), fours(digits, "/")),
                *[F.substring(digits, 1, n) for n in (9, 10, 12)], *[threes(F.substring(digits, 1, n), by) for n in (9, 10, 12) for by in (" ", ".")],
            ],
        ),
        "phone": (
            [F.substring(match, 2, 64), home, F.regexp_replace(F.regexp_replace(home, r"[()]", ""), r"\x20", "-"), F.concat(F.lit("0"), F.regexp_replace(home, r"[()]", ""))],
            [
                digits, *[F.substring(digits, 1, n) for n in (7, 8, 9)], *[threes(F.substring(digits, 1, n), by) for n in (7, 9, 10) for by in (" ", ".")], fours(digits, " "), fours(F.substring(digits, 1, 8), "-"),
                dated, F.concat(dated, F.lit(" 1"), F.substring(digits, -1, 1)), F.concat(F.lit("1"), F.substring(digits, 4, 1), F.lit(".0"), F.substring(digits, 3, 1), F.lit(".20"), F.substring(digits, 1, 2)),
                F.concat(F.lit("no"), home),
            ],
        ),
    }
    out = F.array().cast("array<struct<true:boolean,form:string>>")
    for k, (yes, no) in forms.items():
        # A phone number without any break is a plain number.
        fit = [F.when(y.rlike(r"[0-9][\x20().-]+[0-9]") if k == "phone" else F.lit(True), y) for y in yes]
        made = F.array(*[F.struct(F.lit(t).alias("true"), f.alias("form")) for t, fs in ((True, fit), (False, no)) for f in fs])
        out = F.when(kind == k, F.filter(made, lambda f: f["form"].isNotNull())).otherwise(out)
    return out


def train(docs: DataFrame, text: str = "text") -> Trees | None:
    """Learns which candidates look like personal data.

    Base spans are rewritten into looser forms where they stand. A candidate that
    is exactly such a form counts as data of its kind; candidates of other kinds
    there, and all in forms that only look alike, as none. Candidates elsewhere have no label and
    are left out. All documents are used. Base spans with equal surroundings are rewritten once,
    and equal feature values are counted together by Spark, so what
    is fitted is a table of counts. None when there is nothing to learn from.
    """
    texts = docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    texts = texts.where(F.col("text").rlike("[0-9@]"))
    spans = texts.select("text", F.explode(base_spans(F.col("text"))).alias("s"))
    near = spans.select(
        F.col("s.kind").alias("kind"), F.expr("substring(text, s.start + 1, s.end - s.start)").alias("match"),
        F.expr(f"substring(text, greatest(s.start - {CONTEXT}, 0) + 1, least(s.start, {CONTEXT}))").alias("before"), F.expr("substring(text, s.end + 1, 8)").alias("after"),
    )
    near = near.groupBy("kind", "match", "before", "after").agg(F.count(F.lit(1)).alias("n"))
    # Few bytes, but much work for each: adaptive execution would put them into one task.
    near = near.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    near = near.withColumn("fits", F.xxhash64("match", F.lit(1)) % 2 == 0).withColumn("f", F.explode(_looser(F.col("kind"), F.col("match"))))
    start = F.length("before")
    made = near.select(
        "kind", "fits", "n", F.col("f.true").alias("true"), start.alias("start"), (start + F.length("f.form")).alias("end"),
        F.explode(candidates(F.concat("before", "f.form", "after"))).alias("c"),
    )
    own = F.col("c.kind") == F.col("kind")
    exact = own & (F.col("c.start") == F.col("start")) & (F.col("c.end") == F.col("end"))
    within = (F.col("c.start") < F.col("end")) & (F.col("start") < F.col("c.end"))
    # Where a candidate of the kind takes in more or less than the form, nothing is known of it.
    seen = made.where(within & (~F.col("true") | exact | ~own))
    true = F.col("true") & exact
    counts = (
        seen.groupBy("fits", *[F.col(f"c.{f}").alias(f) for f in FEATURES])
        .agg(F.sum(F.when(true, F.col("n")).otherwise(0)).alias("yes"), F.sum("n").alias("all"))
        .collect()  # one row per combination of bins
    )
    counts.sort(key=str)  # sums of floats depend on their order
    if not counts:
        return None
    values = np.array([[r[f] for f in FEATURES] for r in counts])
    yes, every_, fits = np.array([r["yes"] for r in counts], float), np.array([r["all"] for r in counts], float), np.array([r["fits"] for r in counts])
    return _boosted(values, yes, every_, fits)


def _boosted(values: np.ndarray, yes: np.ndarray, all_: np.ndarray, fits: np.ndarray) -> Trees | None:
    weight, target = np.where(fits, all_, 0), np.where(fits, yes, 0)
    if not target.sum() or target.sum() == weight.sum():
        return None
    bias = float(np.log(target.sum() / (weight.sum() - target.sum())))
    score = np.full(len(yes), bias)
    splits = [(f, int(b)) for f in range(values.shape[1]) for b in np.unique(values[:, f])[:-1]]
    if not splits:
        return None
    sides = np.array([values[:, f] <= b for f, b in splits])

    def best(gradient: np.ndarray, curve: np.ndarray) -> tuple[int, float, float]:
        g, h = sides @ gradient, sides @ curve
        rest_g, rest_h = gradient.sum() - g, curve.sum() - h
        gain = g * g / (h + 1) + rest_g * rest_g / (rest_h + 1)
        n = int(gain.argmax())
        return n, float(RATE * g[n] / (h[n] + 1)), float(RATE * rest_g[n] / (rest_h[n] + 1))

    trees = []
    for _ in range(ROUNDS):
        chance = 1 / (1 + np.exp(-score))
        gradient, curve = target - weight * chance, weight * chance * (1 - chance)
        n, _, _ = best(gradient, curve)
        below = []
        for side in (sides[n], ~sides[n]):
            m, low, high = best(gradient * side, curve * side)
            below.append((splits[m], low, high))
            score = score + side * np.where(sides[m], low, high)
        trees.append((splits[n], tuple(below)))
    # The lowest score above which enough of the held-back candidates are true, by generator.
    limits = []
    for number in range(len(GENERATORS)):
        own = ~fits & (values[:, 0] == number)
        limit = float("inf")
        for at in np.unique(score[own])[::-1].tolist():
            above = own & (score >= at)
            if yes[above].sum() < PRECISION * all_[above].sum():
                break
            limit = at
        limits.append(limit - 1e-9)
    return Trees(bias, tuple(trees), tuple(limits))


_EVENT = f"struct<start:int,candidate:int,end:int,one:{CANDIDATE}>"


def _beside(found: Column, base: Column) -> Column:
    """Candidates that overlap no base span: one pass forwards and one backwards over all of them by their starts."""
    bases = F.transform(base, lambda b: F.struct(b["start"], F.lit(0), b["end"], F.lit(None)).cast(_EVENT))
    ones = F.transform(found, lambda c: F.struct(c["start"], F.lit(1), c["end"], c).cast(_EVENT))
    none = F.array().cast(f"array<{_EVENT}>")
    is_one = lambda e: e["candidate"] == 1
    # Forwards: base spans end before a candidate starts; at the same start they come first.
    forward = running(
        F.sort_array(F.concat(bases, ones)), F.lit(0),
        lambda at, e: F.when(is_one(e), at).otherwise(F.greatest(at, e["end"])),
        lambda at, e: F.when(is_one(e) & (e["start"] < at), none).otherwise(F.array(e)), _EVENT,
    )
    # Backwards: no base span starts before a candidate ends.
    return running(
        F.reverse(forward), F.lit(2**31 - 1),
        lambda at, e: F.when(is_one(e), at).otherwise(F.least(at, e["start"])),
        lambda at, e: F.when(is_one(e) & (e["end"] <= at), F.array(e["one"])).otherwise(F.array().cast(f"array<{CANDIDATE}>")), CANDIDATE,
    )


def _taken(text: Column, base: Column, trees: Trees) -> Column:
    """Candidates over their threshold that overlap no base span."""
    beside = let(candidates(text), lambda found: F.when((F.size(base) == 0) | (F.size(found) == 0), found).otherwise(_beside(found, base)))
    scored = F.transform(
        beside,
        lambda c: F.struct(
            c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"), trees.score(c).alias("score"), trees.threshold(c).alias("limit")
        ),
    )
    return F.filter(scored, lambda c: c["score"] >= c["limit"])


def _best(taken: Column) -> Column:
    """Of overlapping spans the best, then the first, stays.

    Spans of one generator don't overlap, so by their starts a span overlaps only the
    last one of every other generator before it. Each such pair names its loser.
    """
    by_start = F.sort_array(F.transform(taken, lambda c: F.struct(c["start"], c["end"], c["kind"], c["score"])))
    place = "struct<start:int,end:int,score:double>"
    key = lambda kind, c: F.concat_ws(":", kind, c["start"].cast("string"), c["end"].cast("string"))
    rank = lambda kind, c: F.struct(-c["score"], c["start"], c["end"], kind)

    def after(last: Column, c: Column) -> Column:
        own = F.struct(c["start"], c["end"], c["score"]).cast(place)
        return F.struct(*[F.when(c["kind"] == k, own).otherwise(last[k]).alias(k) for k in GENERATORS])

    def losers(last: Column, c: Column) -> Column:
        pairs = [
            F.when(
                (c["kind"] != k) & (last[k]["end"] > c["start"]),
                F.when(rank(F.lit(k), last[k]) < rank(c["kind"], c), key(c["kind"], c)).otherwise(key(F.lit(k), last[k])),
            )
            for k in GENERATORS
        ]
        return F.array_compact(F.array(*pairs))

    begin = F.struct(*[F.lit(None).cast(place).alias(k) for k in GENERATORS])

    def stay(all_: Column) -> Column:
        names = F.transform(all_, lambda c: key(c["kind"], c))
        left = F.array_except(names, running(all_, begin, after, losers, "string"))
        return F.transform(left, lambda name: let(
            F.split(name, ":"), lambda part: F.struct(part[0], part[1].cast("int"), part[2].cast("int")).cast(SPAN)))

    return let(by_start, stay)


def with_spans(docs: DataFrame, trees: Trees | None, text: str = "text") -> DataFrame:
    """Adds ``base_spans`` and ``added_spans``; all rows and columns stay.

    Null texts count as empty; texts without digit, @ or (at) have no spans.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    none = F.array().cast(f"array<{SPAN}>")
    some = whole.rlike(SOME)
    found = docs.withColumn("base_spans", F.when(some, base_spans(whole)).otherwise(none))
    if trees is None:
        return found.withColumn("added_spans", none)
    # A column of its own is worked out once, however often the next one uses it.
    taken = F.when(some, _taken(whole, F.col("base_spans"), trees))
    best = F.coalesce(_best(F.col("__taken")), none)
    return found.withColumn("__taken", taken).withColumn("added_spans", best).drop("__taken")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` by kind as listed, then by start."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(F.array_position(kinds, s["kind"]).alias("k"), s["start"], s["end"], s["kind"])))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""

    def put_together(pieces: Column, ordered: Column) -> Column:
        def put(at: Column, s: Column) -> Column:
            named = F.concat(cut(pieces, at, s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
            return F.when(s["start"] >= at, F.array(named)).otherwise(F.array().cast("array<string>"))

        parts = running(ordered, F.lit(0), lambda at, s: F.greatest(at, s["end"]), put, "string")
        rest = cut(pieces, F.array_max(F.transform(ordered, lambda s: s["end"])), F.length(text))
        return F.concat(F.array_join(parts, ""), rest)

    by_start = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"])))
    whole = let(pieces_of(text), lambda pieces: let(by_start, lambda ordered: put_together(pieces, ordered)))
    return F.when(F.size(spans) == 0, text).otherwise(whole)


def redact(docs: DataFrame, text: str = "text", trees: Trees | None = None) -> DataFrame:
    """The documents with personal data replaced in ``text``; null texts stay null."""
    found = with_spans(docs, trees, text)
    spans = F.concat("base_spans", "added_spans")
    return found.withColumn(text, redacted(F.col(text), spans)).drop("base_spans", "added_spans")
