"""Self-join of texts on the Jaccard similarity of their word shingles.

Two sets that are similar enough differ in at most H shingles. The universe of
shingles is cut by a hash into more than H segments, so similar sets agree in
some segment; where a segment counts double, its sets with one shingle left out
are indexed too, and it may differ in one. Sizes fall into bands, each with a
partition of its own, chosen by its cost. Sets that share an entry of the index
are compared exactly: first with one set of the entry, then, where an entry's sets are
still in several components, with those that also share one of their rarest shingles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bazaarflow.llm.components import components
from bazaarflow.llm.tasks import batches, forget, give_back, in_small_batches, join_classes, let_go, row_numbers, slices, utf8, written

#: Bytes of text hashed at a time, index entries held by a task, documents on one side of a comparison.
AT_ONCE = 256 << 10
ENTRIES = 400_000
SIDE = 256
#: Rows of cells that get their texts in one round: so many, or so many for every text.
ROUND, PER_TEXT = 100_000, 2
#: Shingles are counted by so many bits of their hash at most, in pieces of so many bits; places held by a task.
PLACES, PIECE = 24, 18
COUNTED = 1_000_000
#: Rows of two numbers that are broadcast.
SMALL = 250_000
#: For the cost of a partition: the chance that unrelated texts share a shingle, and the price of a comparison in index entries.
SHARED = 0.001
COMPARED = 30.0
#: Width of a band in steps of the largest ratio of similar sizes.
WIDE = 2
#: How many short segments are spared, in deviations above their mean, and the part of all sets that has more.
SPARED = ((1.0, 0.16), (2.0, 0.023), (2.5, 0.0062), (3.0, 0.0014))


def _random(count: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**64, count, np.uint64) | np.uint64(1)


_BYTES, _FACTORS = _random(256, 1), _random(8, 2)
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_BLANK = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted 64-bit hashes of each text's different shingles.

    ASCII capitals count as small letters and words end at ASCII blanks. A text
    with fewer words is one shingle, a text without words an empty set.
    """
    if not texts:
        return []
    data = np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)
    blank = _BLANK[data]
    begin = np.flatnonzero(~blank[1:] & blank[:-1]) + 1
    if not len(begin):
        return [np.zeros(0, np.uint64)] * len(texts)
    end = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1
    length = end - begin
    at = np.arange(len(data)) - np.repeat(np.concatenate([[0], begin]), np.diff(np.concatenate([[0], begin, [len(data)]])))
    power = np.cumprod(np.full(int(length.max()) + 1, _FACTORS[0], np.uint64))
    value = np.where(blank, np.uint64(0), _BYTES[_LOWER[data]] * power[np.minimum(at, len(power) - 1)])
    word = _mixed(np.add.reduceat(value, begin) + length.astype(np.uint64))
    starts = np.cumsum([1, *(len(t) + 1 for t in texts)])
    first = np.searchsorted(begin, starts)
    shingle = np.full(max(0, len(word) - words + 1), np.uint64(words), np.uint64)
    for n in range(words):
        shingle = _mixed(shingle * _FACTORS[1] + word[n : n + len(shingle)])
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(shingle[a : b - words + 1]))
        elif b > a:
            out.append(np.array([xxhash.xxh3_64_intdigest(word[a:b].tobytes())], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _in_parts(texts: list[bytes], words: int) -> Iterator[np.ndarray]:
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and size < AT_ONCE:
            size += len(texts[to])
            to += 1
        yield from shingle_sets(texts[at:to], words)
        at = to


def _digest(shingles: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes()))))


@dataclass(frozen=True)
class Partition:
    """How the sets of one band and of the band below are cut.

    ``single`` segments must agree, ``double`` ones may differ in one shingle.
    Single segments of at most ``short`` shingles are left out of the index
    where a set has no more than ``spare`` of them: there are so many segments
    that similar sets agree in more than ``spare``.
    """

    single: int
    double: int
    short: int
    spare: int


def partition(differ: int, size: float, count: float) -> Partition:
    """Cheapest cut for ``count`` sets of about ``size`` shingles that differ in at most ``differ``."""
    best, least = None, math.inf
    for double in sorted({0, (differ + 1) // 4, (differ + 1) // 2, (differ + 2) // 2}):
        for short, (deviations, beyond) in product((-1, 0, 1, 2), SPARED):
            spare = 0
            for _ in range(60):
                single = max(0, differ + 1 + spare - 2 * double)
                if single + double == 0:
                    break
                odds = [_poisson(size / (single + double), j) for j in range(int(8 * size / (single + double)) + 8)]
                few = single * sum(odds[: short + 1])
                needed = math.ceil(few + deviations * math.sqrt(few)) + 1 if short >= 0 and single else 0
                if needed <= spare or needed > size:
                    break
                spare = needed
            if single + double == 0 or needed > spare:
                continue  # ever more segments would be short
            agree = [p * p * SHARED**j for j, p in enumerate(odds)]
            agrees = single * (sum(agree[short + 1 :]) + beyond**2 * sum(agree[: short + 1]))
            agrees += double * sum(p * p * (j + 1) ** 2 * SHARED ** max(0, j - 1) for j, p in enumerate(odds))
            cost = count * (single + double * (1 + size / (single + double))) + count * count / 2 * agrees * COMPARED
            if cost < least:
                best, least = Partition(single, double, short, spare), cost
    return best


def _poisson(mean: float, j: int) -> float:
    return math.exp(-mean + j * math.log(mean) - math.lgamma(j + 1)) if mean > 0 else float(j == 0)


@dataclass
class Bands:
    """Bands of sizes: similar sets lie in one band or in neighbouring ones."""

    above: int  # similarity as a fraction above / below
    below: int
    counts: dict[int, int]  # sets by ``step`` of their size

    def __post_init__(self):
        self.starts = [1]
        self.cut = lru_cache(None)(self._cut)

    def highest(self, size: int) -> int:
        """Largest size that a similar set can have."""
        return size * self.below // self.above

    def last(self, band: int) -> int:
        """Largest size of a band, which is so wide that few sets are near its end."""
        size = self.starts[band]
        for _ in range(WIDE):
            size = self.highest(size)
        return size

    def band(self, size: int) -> int:
        while self.starts[-1] <= size:
            self.starts.append(self.last(len(self.starts) - 1) + 1)
        return int(np.searchsorted(self.starts, size, "right")) - 1

    def differ(self, sizes: int) -> int:
        """In how many shingles similar sets of so many together can differ."""
        return sizes * (self.below - self.above) // (self.below + self.above)

    def _cut(self, band: int) -> Partition | None:
        """The cut for pairs whose larger set lies in the band; None where only equal sets are similar."""
        low, high = self.starts[band], self.last(band)
        differ = self.differ(2 * high)
        if differ == 0:
            return None
        steps = range(step(self.starts[max(0, band - 1)]), step(high) + 1)
        return partition(differ, (low + high) / 2, sum(self.counts.get(s, 0) for s in steps))

    def entries(self, shingles: np.ndarray) -> Iterator[np.ndarray]:
        """Index entries of a set: for pairs in its band and for pairs with the band above.

        Of the segments only as many are indexed, from the first on, as the
        set's own size asks for: a similar set has all that the smaller of both needs.
        """
        size = len(shingles)
        highest = self.highest(size)
        band = self.band(size)
        self.band(highest + 1)
        for of in (band, band + 1):
            if highest < self.starts[of]:
                continue
            cut = self.cut(of)
            if cut is not None:
                yield _entries(shingles, cut, of, self.differ(size + min(highest, self.last(of))))


def profile(shingles: np.ndarray) -> bytes:
    """Numbers of shingles by a hash, at most 255 each, in about a quarter as many places as there are shingles."""
    bits = max(4, min(13, int(math.log2(max(1, len(shingles)))) - 2))
    places = (_mixed(shingles ^ _FACTORS[6]) >> np.uint64(64 - bits)).astype(np.int64)
    return np.minimum(np.bincount(places, minlength=1 << bits), 255).astype(np.uint8).tobytes()


def _folded(profiles: list[bytes]) -> np.ndarray:
    """Profiles as rows with as many places as the shortest has."""
    width = min(map(len, profiles))
    return np.array([np.frombuffer(p, np.uint8).reshape(width, -1).sum(1) for p in profiles], np.int32)


def step(size: int) -> int:
    return int(math.log(size) * 20)


def _entries(shingles: np.ndarray, cut: Partition, band: int, differ: int) -> np.ndarray:
    segments = cut.double + cut.single
    place = ((_mixed(shingles ^ _FACTORS[2]) >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)
    value = _mixed(shingles + _FACTORS[3])
    count = np.bincount(place, minlength=segments)
    order = np.argsort(place, kind="stable")
    running = np.concatenate([[np.uint64(0)], np.cumsum(value[order])])
    ends = np.cumsum(count)
    sums = running[ends] - running[ends - count]
    # Double segments come first, then single ones, until the set's own need is met.
    need = differ + 1 + cut.spare
    double = min(cut.double, (need + 1) // 2)
    number = np.arange(segments)
    indexed = (number < double) | ((number >= cut.double) & (number < cut.double + max(0, need - 2 * double)))
    if cut.short >= 0:
        short = indexed & (count <= cut.short) & (number >= cut.double)
        if short.sum() <= cut.spare:
            indexed &= ~short
    kinds, content = number[indexed], sums[indexed]
    if double:
        doubled = np.flatnonzero(place < double)
        kinds = np.concatenate([kinds, place[doubled]])
        content = np.concatenate([content, sums[place[doubled]] - value[doubled]])
    return _mixed(content + _mixed(kinds.astype(np.uint64) * _FACTORS[4] + np.uint64(band * int(_FACTORS[5]) % 2**64)))


@in_small_batches
def similar_components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, above: int = 90, below: int = 100
) -> DataFrame:
    """One row per document row with its component of similar documents.

    Documents link when ``below * intersection >= above * union`` of their sets of
    different ``words``-word shingles. ``component_id`` is the smallest id reachable over
    links, the own one included; ``kept`` marks one row of each component, that
    with the smallest id. Texts that are null, empty or blank have no shingles
    and link with nothing. Null ids come last. Repeated rows and equal texts
    are one class and are compared once. Other columns are ignored; an empty
    table gives an empty result. ``same_text`` is a hash of the whole text.

    Shingles and whole sets are told apart by 64-bit hashes.
    """
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("same_text"),
        F.col(text).cast("string").alias("text"),
    )

    def measured(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()  # what earlier tasks of the worker needed
        numbers = row_numbers()
        for part in (few for whole in parts for few in slices(whole)):
            sets = _in_parts(utf8(part.column("text")), words)
            found = [(len(s), _digest(s) if len(s) else None, profile(s) if len(s) else None) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), part.column("same_text"), pa.array([next(numbers) for _ in found], pa.int64()),
                    pa.array([n for n, _, _ in found], pa.int64()), pa.array([d for _, d, _ in found], pa.int64()), pa.array([p for _, _, p in found], pa.binary()),
                ],
                ["doc_id", "same_text", "row", "n_shingles", "digest", "profile"],
            )

    sets = written(rows.mapInArrow(measured, "doc_id long, same_text long, row long, n_shingles long, digest long, profile binary"), "set-sizes")
    filled = sets.where(F.col("digest").isNotNull())
    # One count for every twentieth of an e-fold in size.
    steps = filled.groupBy(F.floor(F.log("n_shingles") * 20).cast("int").alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()
    counts = {r["step"]: r["n"] for r in steps}

    shared = _shared_entries(rows, words, above, below, counts)
    let_go(docs.sparkSession)
    pairs = written(shared.where(F.col("digest") != F.col("pivot")).select("digest", "pivot").distinct(), "pairs")
    nodes = pairs.select("digest").union(pairs.select("pivot")).distinct()
    # Equal sets become one row per task before they meet.
    profiles = written(
        filled.select("digest", "n_shingles", "profile").dropDuplicates(["digest"]).join(nodes, "digest", "left_semi"), "profiles"
    )
    let_go(docs.sparkSession)
    texts = _texts_of(rows, filled, nodes, words)

    first = _compared(_stars(_possible(pairs, profiles, above, below)), texts, words, above, below)
    forget(pairs)
    roots = components(first)
    unsettled = _unsettled(shared, roots)
    forget(shared)
    left = _left_over(unsettled, texts, counts, words, above, below)
    second = _compared(_possible_in(left, profiles, above, below), texts, words, above, below)
    for table in (unsettled, left, profiles, texts):
        forget(table)
    if not second.isEmpty():
        roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(second))

    # Each class takes its smallest row first, so that hot classes meet as one row per task.
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    classes = filled.groupBy("digest").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("size"))
    named = classes.join(roots.withColumnRenamed("node", "digest"), "digest", "left").select(
        "digest", "first", "size", F.coalesce("root", "digest").alias("root")
    )
    named = written(named, "set-classes")
    chosen = named.groupBy("root").agg(F.min("first").alias("chosen"), F.count(F.lit(1)).alias("sets"))
    labels = written(join_classes(named.select("digest", "size", "root"), written(chosen, "set-roots"), ["root"], "sets").select("digest", "size", "chosen"), "set-labels")
    labelled = join_classes(filled, labels, ["digest"], "size").select(
        "doc_id", "n_shingles", F.col("chosen.doc_id").alias("component_id"), (F.col("row") == F.col("chosen.row")).alias("kept"), "same_text"
    )
    alone = sets.where(F.col("digest").isNull()).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"), "same_text")
    return labelled.union(alone)


def _shared_entries(rows: DataFrame, words: int, above: int, below: int, counts: dict[int, int]) -> DataFrame:
    """Index entries that several sets have: entry, digest and a set to compare with first.

    A task keeps one row per entry open, that of its smallest digest, and ties
    its other sets to that one, so an entry that many sets share spreads.
    """

    def indexed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        bands = Bands(above, below, counts)
        held: list[tuple[np.ndarray, int]] = []
        seen: set[int] = set()
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            entry = np.concatenate([e for e, _ in held]).view(np.int64)
            digest = np.repeat(np.array([d for _, d in held], np.int64), [len(e) for e, _ in held])
            order = np.lexsort((digest, entry))
            entry, digest = entry[order], digest[order]
            new = np.concatenate([[True], entry[1:] != entry[:-1]])
            near = digest[new][np.cumsum(new) - 1]
            table = pa.table({"entry": entry, "digest": digest, "near": pa.array(near, mask=near == digest)})
            yield from table.to_batches(65_536)

        for part in (few for whole in parts for few in slices(whole)):
            for shingles in _in_parts(utf8(part.column("text")), words):
                if not len(shingles) or (digest := _digest(shingles)) in seen:
                    continue
                seen.add(digest)
                for entries in bands.entries(shingles):
                    held.append((entries, digest))
                    size += len(entries)
                if size > ENTRIES:
                    yield from flush()
                    held.clear()
                    seen.clear()
                    size = 0
        if held:
            yield from flush()

    index = rows.select("text").mapInArrow(indexed, "entry long, digest long, near long")
    window = Window.partitionBy("entry", "near")
    least, most = F.min("digest").over(window), F.max("digest").over(window)
    met = index.select("entry", "digest", "near", least.alias("least"), most.alias("most"))
    # Rows that are tied stay, and open ones that met another. An open one that others are tied to is their pivot.
    tied = met.where(F.col("near").isNotNull() | (F.col("least") != F.col("most")))
    return written(tied.select("entry", "digest", F.coalesce("near", "least").alias("pivot")), "shared-entries")


def _texts_of(rows: DataFrame, filled: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """One packed text for each of the given sets."""
    # Equal sets become one row per task before they meet.
    one = filled.groupBy("digest").agg(F.min(F.struct("doc_id", "same_text")).alias("one")).join(nodes, "digest", "left_semi")
    wanted = written(one.select(F.col("one.doc_id").alias("w_id"), F.col("one.same_text").alias("w_text")).distinct(), "set-wanted")
    # Few of them go to the texts; else both sides are shuffled.
    wanted = F.broadcast(wanted) if wanted.count() <= SMALL else wanted
    found = rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["w_id"]) & (rows["same_text"] == wanted["w_text"]), "left_semi")

    def packed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        pack = zstandard.ZstdCompressor(level=1).compress
        for part in (few for whole in parts for few in slices(whole)):
            texts = utf8(part.column("text"))
            digests = [_digest(s) if len(s) else None for s in _in_parts(texts, words)]
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.int64()), pa.array(map(pack, texts), pa.binary())], ["digest", "body"])

    bodies = found.select("text").mapInArrow(packed, "digest long, body binary").where(F.col("digest").isNotNull())
    return written(bodies.dropDuplicates(["digest"]), "set-texts")


def _can_link(one: int, other: int, apart: np.ndarray | int, above: int, below: int):
    """Whether sets of these sizes that differ in at least ``apart`` shingles can be similar."""
    return apart * (below + above) <= (one + other) * (below - above)


def _possible(pairs: DataFrame, profiles: DataFrame, above: int, below: int) -> DataFrame:
    """Pairs whose profiles don't rule out a link: sets differ in no fewer shingles than their profiles do."""
    # Sizes alone rule out many, before any profile is sent.
    sizes = profiles.select("digest", F.col("n_shingles").alias("n1"))
    sized = pairs.join(sizes, "digest").join(sizes.select(F.col("digest").alias("pivot"), F.col("n1").alias("n2")), "pivot")
    fits = written(sized.where(F.least("n1", "n2") * below >= F.greatest("n1", "n2") * above), "fitting-pairs")
    let_go(pairs.sparkSession)
    one = profiles.select("digest", F.col("profile").alias("p1"))
    other = profiles.select(F.col("digest").alias("pivot"), F.col("profile").alias("p2"))
    both = fits.join(one, "digest").join(other, "pivot")

    def possible(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        for part in parts:
            n1, n2 = (part.column(n).to_numpy() for n in ("n1", "n2"))
            p1, p2 = (part.column(n).to_pylist() for n in ("p1", "p2"))
            keep = np.zeros(part.num_rows, bool)
            # Pairs of profiles with the same widths are looked at together.
            widths = np.array([(len(a), len(b)) for a, b in zip(p1, p2, strict=True)], np.int64).reshape(-1, 2)
            for wide, narrow in np.unique(widths, axis=0).tolist():
                at = np.flatnonzero((widths == (wide, narrow)).all(1))
                for some in np.array_split(at, -(-len(at) * max(wide, narrow) // AT_ONCE)):
                    a, b = (np.frombuffer(b"".join([p[n] for n in some.tolist()]), np.uint8).reshape(len(some), -1) for p in (p1, p2))
                    width = min(wide, narrow)
                    a, b = (x.reshape(len(some), width, -1).sum(2, dtype=np.int32) for x in (a, b))
                    keep[some] = _can_link(n1[some], n2[some], np.abs(a - b).sum(1), above, below)
            yield part.select(["digest", "pivot"]).filter(pa.array(keep))

    return written(both.select("digest", "pivot", "n1", "n2", "p1", "p2").mapInArrow(possible, "digest long, pivot long"), "possible-pairs")


def _possible_in(cells: DataFrame, profiles: DataFrame, above: int, below: int) -> DataFrame:
    """Comparisons that profiles leave possible between different components of a cell.

    ``rest`` is at least what a set can have in common with others of its cell (without it: all). A cell falls into
    parts between which no pair is possible. A part with no more pairs than rows gives these
    pairs, of other parts the rows stay, so the result is no larger than the cells are. Pairs, and parts with
    the same sets, are compared once, however many entries they share.
    """
    let_go(profiles.sparkSession)
    rows = cells.join(profiles, "digest").repartition("cell").sortWithinPartitions("cell", "digest")

    def found(held: list[tuple]) -> Iterator[tuple]:
        _, digests, sides, roots, sizes, profiles_, rests = zip(*held, strict=True)
        matrix, sizes, roots, rests = _folded(profiles_), np.array(sizes), np.array(roots), np.array(rests)
        right = np.array([n for n, side in enumerate(sides) if side & 2], np.int64)
        group = np.arange(len(held))
        links: dict[int, np.ndarray] = {}
        for n in (n for n, side in enumerate(sides) if side & 1):
            both = np.minimum(rests[n], rests[right])
            others = right[(both * (above + below) >= above * (sizes[n] + sizes[right])) & (roots[right] != roots[n])]
            apart = np.abs(matrix[others] - matrix[n]).sum(1)
            others = others[_can_link(sizes[n], sizes[others], apart, above, below)]
            if len(others):
                links[n] = others
                met = group[np.append(others, n)]
                group[np.isin(group, met)] = met.min()
        members: dict[int, list[int]] = {}
        for n, part in enumerate(group.tolist()):
            members.setdefault(part, []).append(n)
        for some in (some for some in members.values() if len(some) > 1):
            pairs = set()
            if sum(len(links.get(n, ())) for n in some) <= 2 * len(some):  # side 3 has a pair twice
                pairs = {(max(digests[n], digests[m]), min(digests[n], digests[m])) for n in some for m in links.get(n, ())}
            if 0 < len(pairs) <= len(some):
                for digest, pivot in pairs:
                    yield None, digest, None, None, pivot
            else:
                cell = _digest(np.array([[digests[n], sides[n]] for n in some], np.int64))
                for n in some:
                    yield cell, *held[n][1:4], None

    def possible(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()

        def stay() -> Iterator[tuple]:
            held: list[tuple] = []
            for part in parts:
                for row in zip(*(part.column(n).to_pylist() for n in ("cell", "digest", "side", "root", "n_shingles", "profile", "rest")), strict=True):
                    if held and row[0] != held[-1][0]:
                        yield from found(held)
                        held = []
                    held.append(row)
            if held:
                yield from found(held)

        return batches({"cell": pa.int64(), "digest": pa.int64(), "side": pa.int32(), "root": pa.int64(), "pivot": pa.int64()}, stay())

    rest = F.col("rest").cast("long") if "rest" in cells.columns else F.col("n_shingles")
    chosen = rows.select("cell", "digest", "side", "root", "n_shingles", "profile", rest.alias("rest"))
    left = written(chosen.mapInArrow(possible, "cell long, digest long, side int, root long, pivot long"), "possible-cells")
    pairs = written(left.where(F.col("pivot").isNotNull()).select("digest", "pivot").distinct(), "left-pairs")
    return left.where(F.col("pivot").isNull()).drop("pivot").dropDuplicates(["cell", "digest"]).union(_stars(pairs))


def _stars(pairs: DataFrame) -> DataFrame:
    """Comparisons of sets with their pivots; a pivot of many sets is copied to several cells."""
    many = pairs.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / SIDE).cast("int").alias("cells"))
    part = F.pmod(F.xxhash64("digest", F.lit(1)), F.col("cells")).cast("int")
    others = pairs.join(many, "pivot").select(F.xxhash64("pivot", part).alias("cell"), "digest", F.lit(2).alias("side"), F.lit(None).cast("long").alias("root"))
    pivots = many.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("cells") - 1))).select(
        F.xxhash64("pivot", "part").alias("cell"), F.col("pivot").alias("digest"), F.lit(1).alias("side"), F.lit(None).cast("long").alias("root")
    )
    return others.union(pivots)


def _unsettled(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """Sets, with their components, of the entries that have more than two sets and several components."""
    let_go(shared.sparkSession)
    named = F.broadcast(roots) if roots.count() <= SMALL else roots
    # The set with an entry's other sets tied to it, directly or not, is a pivot of them.
    tied = shared.where(F.col("digest") != F.col("pivot"))
    for of, root in (("digest", "root1"), ("pivot", "root2")):
        tied = tied.join(named.select(F.col("node").alias(of), F.col("root").alias(root)), of, "left").withColumn(root, F.coalesce(root, of))
    # A pair alone was compared already.
    groups = tied.groupBy("entry").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("root1") != F.col("root2")).alias("several"))
    entries = written(groups.where((F.col("n") > 1) & F.col("several")).select("entry"), "unsettled-entries")
    rows = tied.join(F.broadcast(entries) if entries.count() <= SMALL else entries, "entry", "left_semi")
    sets = rows.select("digest", F.col("root1").alias("root")).union(rows.select("pivot", "root2"))
    sets = written(sets.distinct(), "unsettled-sets")
    forget(entries)
    return sets


def _left_over(unsettled: DataFrame, texts: DataFrame, counts: dict[int, int], words: int, above: int, below: int) -> DataFrame:
    """Comparisons between components, of sets that share one of their rarest shingles, all sets with all others in blocks.

    All shingles have one order, by how many of the sets have them, as far as that was counted. Similar sets
    have at least ``above / below`` of the larger one's shingles in common, so the first that both have is among the first
    of either, and neither has fewer than these shingles from there on.
    """
    let_go(texts.sparkSession)
    open_ = texts.join(F.broadcast(unsettled) if unsettled.count() <= SMALL else unsettled, "digest")
    shingles = sum(n * math.exp((s + 1) / 20) for s, n in counts.items())
    bits = min(PLACES, max(8, math.ceil(math.log2(shingles + 1))))
    shipped = texts.sparkSession.sparkContext.broadcast(_frequencies(open_.select("body"), words, bits))  # 2 ** PLACES bytes at most

    def rarest(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        known = np.frombuffer(shipped.value, np.uint8)
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            sets = [len(few) for few, *_ in held]
            columns = [np.concatenate([h[0] for h in held]).view(np.int64), np.repeat(np.array([h[1:4] for h in held], np.int64), sets, 0), np.concatenate([h[4] for h in held])]
            return pa.table({"entry": columns[0], **{n: columns[1][:, k] for k, n in enumerate(("digest", "root", "size"))}, "rest": columns[2]})

        total = 0
        for part, some in _unpacked(parts, words):
            for digest, root, found in zip(part.column("digest").to_pylist(), part.column("root").to_pylist(), some, strict=True):
                size = len(found)
                often = known[found >> np.uint64(64 - bits)]
                first = np.argsort(often, kind="stable")[: size - -(-above * size // below) + 1]
                rest = size - np.arange(len(first))
                shared = often[first] > 1  # else no other set has it
                held.append((found[first[shared]], digest, root, size, rest[shared]))
                total += int(shared.sum())
            if total > ENTRIES // 4:
                yield from flush().to_batches(65_536)
                held.clear()
                total = 0
        if held:
            yield from flush().to_batches(65_536)

    index = open_.select("digest", "root", "body").mapInArrow(rarest, "entry long, digest long, root long, size long, rest long")
    index = index.repartition("entry")  # what the windows need is worked out behind the shuffle
    window = Window.partitionBy("entry")
    # What a set could have in common with one of no shingles, times ``above + below``, less its own part of what is needed.
    spare = F.col("rest") * (above + below) - F.col("size") * above
    bounds = {"least": F.min("root"), "most": F.max("root"), "smallest": F.min("size"), "largest": F.max(spare)}
    met = index.select("entry", "digest", "root", "rest", "size", *[x.over(window).alias(n) for n, x in bounds.items()])
    fits = (F.col("least") != F.col("most")) & (spare >= F.col("smallest") * above) & (F.col("largest") >= F.col("size") * above)
    members = written(met.where(fits).select("entry", "digest", "root", "rest"), "left-entries")
    shipped.destroy()
    let_go(texts.sparkSession)
    groups = members.groupBy("entry").agg(
        F.count(F.lit(1)).alias("n"), F.min("root").alias("least"), F.max("root").alias("most"), F.sum("rest").alias("rest"),
        F.sum(F.shiftright(F.xxhash64("digest"), 24)).alias("who"), F.sum(F.shiftright(F.xxhash64("digest", F.lit(1)), 24)).alias("who2"),
    )
    # Of shingles with the same sets the first one is enough.
    kept = groups.where(F.col("least") != F.col("most")).groupBy("n", "who", "who2").agg(F.max_by("entry", "rest").alias("entry"))
    blocks = F.ceil(F.col("n") / SIDE).cast("int")
    rows = members.join(kept.select("entry", blocks.alias("blocks")), "entry")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("digest", F.lit(2)), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    side = F.when(F.col("own") == F.col("other"), 3).when(F.col("own") < F.col("other"), 1).otherwise(2)
    cell = F.xxhash64("entry", F.least("own", "other"), F.greatest("own", "other"))
    cells = written(rows.select(cell.alias("cell"), "digest", side.alias("side"), "root", "rest"), "left-cells")
    forget(members)
    return cells


def _unpacked(parts: Iterator[pa.RecordBatch], words: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Rows a few at a time, and the sets of their packed texts."""
    unpack = zstandard.ZstdDecompressor().decompress
    for part in (few for whole in parts for few in slices(whole, 64)):
        yield part, list(_in_parts([unpack(body) for body in part.column("body").to_pylist()], words))


def _frequencies(texts: DataFrame, words: int, bits: int) -> bytes:
    """For each value of the first ``bits`` of a shingle's hash a number that grows with how many sets have such shingles: 0 none, 1 one.

    Tasks send the gaps between their sorted places, a byte each; the driver gets a byte for a place.
    """
    width = min(bits, PIECE)

    def counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        pack = zstandard.ZstdCompressor(level=1).compress
        held: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            places = np.sort(np.concatenate(held))
            ends = np.searchsorted(places, np.arange((1 << bits - width) + 1) << width)
            there = np.flatnonzero(ends[1:] > ends[:-1])
            packed = [pack(_gaps(places[ends[n] : ends[n + 1]] - (n << width))) for n in there.tolist()]
            return pa.record_batch([pa.array(there, pa.int32()), pa.array(packed, pa.binary())], names=["piece", "gaps"])

        size = 0
        for _, sets in _unpacked(parts, words):
            for shingles in sets:
                held.append((shingles >> np.uint64(64 - bits)).astype(np.int64))
                size += len(shingles)
            if size > COUNTED:
                yield out()
                held.clear()
                size = 0
        if held:
            yield out()

    def added(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, unpack = zstandard.ZstdCompressor(level=1).compress, zstandard.ZstdDecompressor().decompress

        def rows() -> Iterator[tuple[int, bytes]]:
            piece, total = None, np.zeros(0, np.int64)
            for part in parts:
                for n, gaps in zip(part.column("piece").to_pylist(), part.column("gaps").to_pylist(), strict=True):
                    if n != piece:
                        if piece is not None:
                            yield piece, pack(_steps(total))
                        piece, total = n, np.zeros(1 << width, np.int64)
                    total += np.bincount(_places(unpack(gaps)), minlength=1 << width)
            if piece is not None:
                yield piece, pack(_steps(total))

        return batches({"piece": pa.int32(), "steps": pa.binary()}, rows(), 8)

    dealt = texts.mapInArrow(counted, "piece int, gaps binary").repartition("piece").sortWithinPartitions("piece")
    found = np.zeros((1 << bits - width, 1 << width), np.uint8)
    unpack = zstandard.ZstdDecompressor().decompress
    for piece, steps in dealt.mapInArrow(added, "piece int, steps binary").collect():
        found[piece] = np.frombuffer(unpack(bytes(steps)), np.uint8)
    return found.tobytes()


def _gaps(places: np.ndarray) -> bytes:
    """Sorted numbers as the bytes of what each adds to the one before; 255 adds that much to the next."""
    gaps = np.diff(places, prepend=0)
    out = np.full(len(gaps) + int((gaps // 255).sum()), 255, np.uint8)
    out[np.cumsum(gaps // 255 + 1) - 1] = gaps % 255
    return out.tobytes()


def _places(gaps: bytes) -> np.ndarray:
    found = np.frombuffer(gaps, np.uint8)
    return np.cumsum(found, dtype=np.int64)[found < 255]


def _steps(counts: np.ndarray) -> bytes:
    """Counts as bytes in their order: 0, 1, and beyond that in steps of a tenth of a doubling."""
    return np.where(counts > 0, np.minimum(10 * np.log2(np.maximum(counts, 1)) + 1, 255), 0).astype(np.uint8).tobytes()


def _compared(cells: DataFrame, texts: DataFrame, words: int, above: int, below: int) -> DataFrame:
    """Links ``(a, b)`` between the two sides of every cell (side 3: among themselves), enough to connect what links connect.

    Sets that ``root`` knows as connected are not compared again. A text goes to every cell of its set, so
    cells with many more rows than there are texts take turns: no more than ``PER_TEXT`` copies of all texts lie on the disks at once.
    """
    cells = written(cells, "cells")
    rounds = max(1, -(-cells.count() // max(ROUND, PER_TEXT * texts.count())))
    turn = F.pmod(F.xxhash64("cell", F.lit(3)), F.lit(rounds))
    links = reduce(DataFrame.union, [_compared_at_once(cells.where(turn == n), texts, words, above, below) for n in range(rounds)])
    forget(cells)
    return links


def _compared_at_once(cells: DataFrame, texts: DataFrame, words: int, above: int, below: int) -> DataFrame:
    let_go(texts.sparkSession)
    # Few rows go to the texts; else both sides are shuffled.
    cells = F.broadcast(cells) if cells.count() <= SMALL else cells
    rows = texts.join(cells, "digest").repartition("cell").sortWithinPartitions("cell", "digest").select("cell", "digest", "side", "root", "body")

    def links(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        unpack = zstandard.ZstdDecompressor().decompress
        held: list[tuple] = []

        def found() -> Iterator[tuple[int, int]]:
            sets = list(_in_parts([row[4] for row in held], words))
            begin = 0
            for at in range(1, len(held) + 1):
                if at == len(held) or held[at][0] != held[begin][0]:
                    yield from _links(held[begin:at], sets[begin:at], above, below)
                    begin = at

        def out() -> pa.RecordBatch:
            linked = list(found())
            return pa.record_batch([pa.array([a for a, _ in linked], pa.int64()), pa.array([b for _, b in linked], pa.int64())], names=["a", "b"])

        size = 0
        for part in parts:
            for cell, digest, side, root, body in zip(*(part.column(n).to_pylist() for n in ("cell", "digest", "side", "root", "body")), strict=True):
                if held and size > AT_ONCE and cell != held[-1][0]:
                    yield out()
                    held.clear()
                    size = 0
                text = unpack(body)
                size += len(text)
                held.append((cell, digest, side, root, text))
        if held:
            yield out()

    return written(rows.mapInArrow(links, "a long, b long"), "set-links")


def _links(rows: list[tuple], sets: list[np.ndarray], above: int, below: int) -> Iterator[tuple[int, int]]:
    left = [n for n, row in enumerate(rows) if row[2] & 1]
    right = [n for n, row in enumerate(rows) if row[2] & 2]
    sizes = np.array([len(s) for s in sets])
    if len(left) * len(right) <= 64:
        both = np.array([[len(np.intersect1d(sets[a], sets[b], True)) for b in right] for a in left]).reshape(len(left), len(right))
    else:
        both = _intersections([sets[n] for n in left], [sets[n] for n in right])
    union = sizes[left][:, None] + sizes[right][None, :] - both
    # Components known before are one to begin with.
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = x = parent.get(parent[x], parent[x])
        return x

    name = [row[1] if row[3] is None else row[3] for row in rows]
    for a, b in zip(*np.nonzero(below * both >= above * union), strict=True):
        x, y = left[a], right[b]
        one, two = top(name[x]), top(name[y])
        if one != two:
            parent[max(one, two)] = min(one, two)
            yield rows[x][1], rows[y][1]


def _intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, as products of incidence matrices over slices of the shingles."""
    values, place = np.unique(np.concatenate(left + right), return_inverse=True)
    often = np.bincount(place) > 1
    column = np.where(often, np.cumsum(often) - 1, -1)[place]
    row = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in left + right])
    out = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    width = 2048
    for start in range(0, int(often.sum()), width):
        a, b = np.searchsorted(column, [start, start + width])
        part = np.zeros((len(left) + len(right), width), np.float32)
        part[row[a:b], column[a:b] - start] = 1
        out += part[: len(left)] @ part[len(left) :].T
    return out.astype(np.int64)
