"""How quality filters interact: what each removes, alone and in every order.

Every filter marks the rows that fail it with one bit. The marks of a row are
added up, rows are counted per combination of bits, and all orders of the
filters are played through on those counts, not on the rows.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bazaarflow.llm.tasks import written

BLANKS = " \t\n\x0b\x0c\r"
#: Filters on the text alone, in the order of their letters; the copies' letter follows.
WORDS, VARIETY, CAPITALS, SIGNS = 200, 50, 3, "[#$%&*|]"
LETTERS = "ABCDE"
#: Rows with one hash that go to one task, and hashes that are broadcast.
HOT = 1_000
SMALL = 250_000


def own_failures(text: Column) -> list[Column]:
    """Conditions that a text fails by itself: few words, few different ones, many capitals, odd signs."""
    body = F.btrim(text, F.lit(BLANKS))
    words = F.split(body, r"[\x20\x09-\x0D]+")
    n = F.when(body == "", 0).otherwise(F.size(words))
    different = F.when(body == "", 0).otherwise(F.size(F.array_distinct(words)))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return [n < WORDS, 100 * different < VARIETY * n, 100 * capitals > CAPITALS * F.length(text), text.rlike(SIGNS)]


def later_copies(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose text a row with a smaller id has.

    ``docs`` has ``doc_id``, ``text`` and ``hash``, a hash of the text. A null id
    is neither smaller nor larger. Only rows whose hash occurs under several ids
    are compared; the other side has one row per different text, repeated
    for every ``HOT`` rows of a frequent hash, which are dealt over as many tasks.
    """
    known = docs.where(F.col("doc_id").isNotNull())
    several = F.min("doc_id") < F.max("doc_id")
    repeated = written(
        known.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), several.alias("several"))
        .where("several").select("hash", F.ceil(F.col("n") / HOT).alias("parts")),
        "repeated-hashes",
    )
    few = repeated.count() <= SMALL
    candidates = known.join(F.broadcast(repeated) if few else repeated, "hash")
    # Tasks reduce copies to the smallest id before the shuffle.
    firsts = candidates.groupBy("hash", "parts", "text").agg(F.min("doc_id").alias("first"))
    firsts = firsts.select("hash", "text", "first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part_no"))
    dealt = candidates.withColumn("part_no", F.pmod(F.xxhash64("doc_id"), F.col("parts")))
    a, b = dealt.alias("a"), firsts.alias("b")
    smaller = (
        (F.col("a.hash") == F.col("b.hash")) & (F.col("a.part_no") == F.col("b.part_no"))
        & (F.col("a.text") == F.col("b.text")) & (F.col("b.first") < F.col("a.doc_id"))
    )
    return a.join(b, smaller, "left_semi").select(docs.columns)


def failed_filters(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """Rows counted (``n``) by ``doc_id``, ``part`` and text, with the bits of the filters they fail (``failed``).

    Null texts and null parts count as empty. Repeated rows are copies of each
    other, but without a smaller id none of them is a later copy. An empty table
    gives no rows; other columns are ignored.
    """
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    ).withColumn("hash", F.xxhash64("text"))
    own = sum((F.when(fails, 1 << n).otherwise(0) for n, fails in enumerate(own_failures(F.col("text")))), F.lit(0))
    # The digest tells rows with one id but different texts apart.
    key = ["doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest")]
    marks = rows.select(*key, own.alias("failed"), F.lit(1).cast("long").alias("n"))
    copies = later_copies(rows).select(*key, F.lit(1 << (len(LETTERS) - 1)).alias("failed"), F.lit(0).cast("long").alias("n"))
    marked = marks.unionByName(copies).groupBy("doc_id", "part", "digest")
    return marked.agg(F.bit_or("failed").alias("failed"), F.sum("n").alias("n")).drop("digest")


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds ``good`` and ``toxic``: whether any label of the id says so. Ids without labels are neither."""
    told = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    # Rows without an id have no labels; they would meet in one task of the join.
    found = rows.where(F.col("doc_id").isNotNull()).join(told, "doc_id", "left").na.fill(False, ["good", "toxic"])
    return found.unionByName(rows.where(F.col("doc_id").isNull()).withColumns({"good": F.lit(False), "toxic": F.lit(False)}))


def audit(counted: DataFrame, letters: str = LETTERS) -> DataFrame:
    """Counts per part for every order of the filters and every step of it.

    ``counted`` has ``part``, ``failed`` (bits in the order of ``letters``),
    ``good``, ``toxic`` and a count ``n``. It is reduced to one row per
    combination first, so the rows played through don't grow with the documents.
    """
    combined = counted.groupBy("part", "failed", "good", "toxic").agg(F.sum("n").alias("n"))
    bits = [F.when(F.col("failed").bitwiseAND(1 << n) != 0, F.lit(letter)) for n, letter in enumerate(letters)]
    orders = F.array(*[F.lit("".join(order)) for order in permutations(letters)])
    steps = (
        combined.select("part", "good", "toxic", "n", F.array_compact(F.array(*bits)).alias("fails"), F.explode(orders).alias("filter_order"))
        # The step at which a row goes; null where it stays.
        .withColumn("goes", F.array_min(F.transform("fails", lambda letter: F.position(letter, F.col("filter_order")))))
        .select("*", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step"))
        .withColumn("filter", F.substr("filter_order", F.col("step"), F.lit(1)))
    )
    fails = F.array_contains("fails", F.col("filter"))
    removed = F.coalesce(F.col("goes") == F.col("step"), F.lit(False))

    def rows(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0)).cast("long")

    counts = steps.groupBy("part", "filter_order", "step", "filter").agg(
        rows(F.col("goes").isNull() | (F.col("goes") > F.col("step"))).alias("kept"),
        rows(removed).alias("removed"),
        rows(fails & (F.col("goes") < F.col("step"))).alias("redundant"),
        rows(fails & (F.size("fails") == 1)).alias("unique_fails"),
        rows(removed & F.col("good")).alias("good_lost"),
        rows(removed & F.col("toxic")).alias("toxic_lost"),
    )
    # A filter stands at one step of every order, so this adds up all orders.
    over_orders = Window.partitionBy("part", "filter")
    return counts.withColumn("shapley", F.sum("removed").over(over_orders).cast("long")).drop("filter")
