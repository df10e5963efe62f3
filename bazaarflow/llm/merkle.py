"""Merkle manifest of a table: one digest per row, group and table, with proofs.

Rows are numbered within their group. The number, written in base ``FAN``, says
where a leaf hangs: its digits are grouped away one after the other, which nests
the children of a node in its row. That is done in blocks of ``FAN ** DIGITS``
leaves, so no row grows beyond a block; the nodes of all blocks are the leaves of
the next round. On the way back each nested row meets the path of its top and
is exploded level by level into leaves with their siblings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bazaarflow.llm.tasks import written

FAN = 3
DIGITS = 6
#: Rows of the table of offsets that are broadcast.
SMALL = 100_000
_ROW_BITS = (1 << 33) - 1  # row part of monotonically_increasing_id
_PATH = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_of(*values: Column) -> Column:
    """Digest of values in order: ``-`` for null, else the count of UTF-8 bytes, a colon and the value."""

    def told(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return digest(*[told(v) for v in values])


def folded(path: Column, leaf: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(path, leaf, lambda node, run: digest(run["before"], node, run["after"]))


def siblings_digest(path: Column) -> Column:
    """One digest of all siblings, from the leaf's to the root's, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda run: F.concat(run["before"], run["after"])), ""), 256)


def manifest(leaves: DataFrame, group: str, order: list[str], leaf: str, fan: int = FAN, digits: int = DIGITS) -> DataFrame:
    """Adds ``subroot`` (of the group), ``root`` and ``path``, the siblings on the way from leaf to root.

    Leaves of a group ascend by ``order``, then by digest, nulls first; while a
    level has several nodes, every ``fan`` consecutive ones, fewer in the last
    run, become the digest of their digests. Groups, ascending bytewise with null
    first, are joined up alike. ``path`` lists for every level the siblings' digests
    before and after the node, as text. All columns of ``leaves`` stay, names of
    their own included; equal rows become leaves of their own; an empty table
    gives no rows.
    """
    rows = leaves.select(
        # Null comes first; the names of all other groups follow in order.
        F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0")).alias("group"),
        F.struct(*[F.col(f"`{name}`") for name in order]).alias("order"),
        F.col(leaf).alias("digest"),
        F.struct(*[F.col(f"`{name}`") for name in leaves.columns]).alias("carried"),
    )
    # Written once, as the numbers below must see the same rows; the tie parts equal ones.
    rows = written(rows.withColumn("tie", F.monotonically_increasing_id()), "merkle-leaves")
    rounds, tops = _rolled(_numbered(rows, ["group", "order.*", "digest", "tie"], fan), fan, digits)
    sources = tops.select(F.lit("").alias("group"), F.col("group").alias("order"), "digest", F.struct("group").alias("carried"), F.lit(0).cast("long").alias("tie"))
    upper, root = _rolled(_numbered(written(sources, "merkle-groups"), ["group", "order"], fan), fan, digits)

    start = root.select("group", F.col("rank").alias("block"), F.array().cast(_PATH).alias("path"), F.struct(F.col("digest").alias("root")).alias("top"))
    groups = _proved(upper, start, digits, fan)
    paths = groups.select(
        F.col("carried.group").alias("group"), F.lit(0).cast("long").alias("block"), "path",
        F.struct(F.col("digest").alias("subroot"), "top.root").alias("top"),
    )
    found = _proved(rounds, paths, digits, fan)
    return found.select("carried.*", F.col("top.subroot").alias("subroot"), F.col("top.root").alias("root"), "path")


def _numbered(rows: DataFrame, order: list[str], fan: int) -> DataFrame:
    """Adds the rank in the group, from 0, and the height of the group's tree.

    Rows are dealt by ranges of the whole order, so a large group has many
    tasks. Only one count per task and group is brought together.
    """
    keys: list[Column] = []
    for name in order:
        if name.endswith(".*"):
            keys += [F.col(f"{name[:-1]}`{f}`").asc_nulls_first() for f in rows.schema[name[:-2]].dataType.names]
        else:
            keys.append(F.col(name).asc_nulls_first())
    ordered = written(
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select(
            "group", "digest", "carried", F.spark_partition_id().alias("task"),
            F.monotonically_increasing_id().bitwiseAND(_ROW_BITS).alias("at"),
        ),
        "merkle-order",
    )
    per_task = ordered.groupBy("group", "task").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    all_tasks = Window.partitionBy("group")
    earlier = all_tasks.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    begins = written(
        per_task.select(
            "group", "task", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
            _height(F.sum("n").over(all_tasks), fan).alias("height"),
        ),
        "merkle-begins",
    )
    # One row per task and group in it.
    begins = F.broadcast(begins) if begins.count() <= SMALL else begins
    return ordered.join(begins, ["group", "task"]).select("group", (F.col("at") + F.col("shift")).alias("rank"), "height", "digest", "carried")


def _height(leaves: Column, fan: int) -> Column:
    """Levels above so many leaves: the digits of the last rank."""
    return F.when(leaves > 1, F.length(F.conv((leaves - 1).cast("string"), 10, fan))).otherwise(0)


def _rolled(nodes: DataFrame, fan: int, digits: int) -> tuple[list[DataFrame], DataFrame]:
    """Rounds of nested blocks from the bottom up, and one row per group with its top digest."""
    rounds = []
    while True:
        nested = written(_nested(nodes, fan, digits), f"merkle-round-{len(rounds)}")
        rounds.append(nested)
        nodes = nested.select("group", F.col("block").alias("rank"), (F.col("height") - digits).alias("height"), "digest", F.lit(None).cast("int").alias("carried"))
        if (nodes.agg(F.max("height")).first()[0] or 0) <= 0:
            return rounds, nodes


def _nested(nodes: DataFrame, fan: int, digits: int) -> DataFrame:
    """One row per block, its nodes nested by their digits. A group whose top is reached goes up unchanged."""
    names = [f"digit{n}" for n in range(digits)]
    ranked = nodes.select(
        "group", "height", F.expr(f"rank div {fan**digits}").alias("block"),
        *[F.expr(f"rank div {fan**n} % {fan}").cast("tinyint").alias(name) for n, name in enumerate(names)],
        "digest", F.col("carried").alias("kids"),
    ).repartition("group", "block")  # the one shuffle: all digits of a block are grouped away in its task
    for level, name in enumerate(names):
        children = F.sort_array(F.collect_list(F.struct(name, "digest", "kids")), asc=True)
        grouped = ranked.groupBy("group", "height", "block", *reversed(names[level + 1 :])).agg(children.alias("kids"))
        run = F.array_join(F.col("kids.digest"), "")
        ranked = grouped.withColumn("digest", F.when(F.col("height") > level, F.sha2(run, 256)).otherwise(F.col("kids")[0]["digest"]))
    return ranked


def _proved(rounds: list[DataFrame], paths: DataFrame, digits: int, fan: int) -> DataFrame:
    """Leaves of the lowest round with their paths. ``paths`` has the path of each group's top."""
    for number in reversed(range(len(rounds))):
        nested = rounds[number].select("group", "block", "height", "kids", F.lit(None).cast(_PATH).alias("path"), F.lit(None).cast(paths.schema["top"].dataType).alias("top"))
        arriving = paths.select(
            "group", "block", F.lit(None).cast("int").alias("height"), F.lit(None).cast(nested.schema["kids"].dataType).alias("kids"), "path", "top"
        )
        met = nested.unionByName(arriving).groupBy("group", "block").agg(
            *[F.first(name, ignorenulls=True).alias(name) for name in ("height", "kids", "path", "top")]
        )
        nodes = met.withColumnRenamed("block", "rank")
        for level in reversed(range(digits)):
            nodes = _opened(nodes, level, fan)
        paths = nodes.select("group", F.col("rank").alias("block"), "path", "top", "digest", F.col("kids").alias("carried"))
        if number:
            paths = written(paths.drop("digest", "carried"), "merkle-paths")
    return paths


def _opened(nodes: DataFrame, level: int, fan: int) -> DataFrame:
    """The children of every node, each with its siblings added to the path."""
    digests = F.col("kids.digest")

    def child(kid: Column, place: Column) -> Column:
        return F.struct(
            kid.alias("kid"), place.alias("place"),
            F.array_join(F.slice(digests, F.lit(1), place), "").alias("before"),
            F.array_join(F.slice(digests, place + 2, F.lit(fan)), "").alias("after"),
        )

    each = nodes.select("group", "rank", "height", "path", "top", F.explode(F.transform("kids", child)).alias("one"))
    longer = F.concat(F.array(F.struct("one.before", "one.after")), "path")
    return each.select(
        "group", (F.col("rank") * fan + F.col("one.place")).alias("rank"), "height",
        F.when(F.col("height") > level, longer).otherwise(F.col("path")).alias("path"), "top",
        F.col("one.kid.digest").alias("digest"), F.col("one.kid.kids").alias("kids"),
    )
