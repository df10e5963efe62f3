"""Counts of a batch and of the stored listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarflow.functions.text import label
from bazaarflow.operators.dedup import drop_known, first_per_key
from bazaarflow.schema import ALL_LABEL, DEFAULT_CEILING, KEY, PREVIEW_ROWS


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def batch_counts(batch: DataFrame, target: DataFrame, key: str = KEY) -> DataFrame:
    """Rows in all, without a key, new, and already stored.

    Rows are counted per key before the join, so a hot key is one row there.
    """
    per_key = batch.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    stored = target.select(key).where(F.col(key).isNotNull()).distinct()
    flagged = per_key.join(stored.withColumn("stored", F.lit(True)), key, "left")
    has_key = F.col(key).isNotNull()
    fresh = has_key & F.col("stored").isNull()

    def rows(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    return flagged.agg(
        rows(F.lit(True)).alias("total"),
        rows(~has_key).alias("rejected"),
        rows(fresh).alias("new"),
        rows(has_key & F.col("stored").isNotNull()).alias("duplicates"),
    )


def category_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("category").agg(F.count(F.lit(1)).alias("rows"))


def feed_counts(found: DataFrame, target: DataFrame, key: str = KEY) -> DataFrame:
    """Per source and category: rows found, and rows that are really new."""
    fresh = drop_known(first_per_key(found, key), target, key)
    both = found.select("source", "category", F.lit(0).alias("is_new")).unionByName(
        fresh.select("source", "category", F.lit(1).alias("is_new"))
    )
    return both.groupBy("source", "category").agg(
        F.count_if(F.col("is_new") == 0).alias("found"),
        F.count_if(F.col("is_new") == 1).alias("new"),
    )


#: Size of a sketch: 2 ** SKETCH_BITS registers, a standard error of about 1.04 / 2 ** (SKETCH_BITS / 2).
SKETCH_BITS = 14


def key_sketch(batch: DataFrame, key: str = KEY, by: list[str] | None = None) -> DataFrame:
    """One sketch of the batch's distinct keys (per group); ``distinct_estimate`` unites those of many batches."""
    return batch.groupBy(*(by or [])).agg(F.hll_sketch_agg(key, SKETCH_BITS).alias("sketch"))


def distinct_estimate(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """About how many distinct keys all sketches saw together, without going back to the rows."""
    united = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
    return sketches.groupBy(*(by or [])).agg(united.alias("keys"))


def facet(df: DataFrame, column: str, all_label: str = ALL_LABEL) -> DataFrame:
    """Distinct values in ascending order, after the entry that means "any"."""
    values = df.select(F.col(column).alias("value")).distinct()
    everything = df.sparkSession.range(1).select(F.lit(all_label).alias("value"), F.lit(0).alias("_at"))
    return (
        everything.unionByName(values.withColumn("_at", F.lit(1)))
        .orderBy("_at", "value")
        .select("value")
    )


def price_ceiling(df: DataFrame) -> DataFrame:
    """Highest price, or a fixed budget when none is above zero; and row count.

    Prices are whole by construction, so the maximum needs no rounding.
    """
    top = F.max("price_num")
    return df.agg(
        F.when(top > 0, top).otherwise(F.lit(DEFAULT_CEILING)).alias("ceiling"),
        F.count(F.lit(1)).alias("rows"),
    )


def preview(df: DataFrame, order: list[str], rows: int = PREVIEW_ROWS, size: int | None = None) -> DataFrame:
    """A few rows of the telling columns; ``size`` cuts long titles."""
    title = label(F.col("title"), size) if size else F.col("title")
    return (
        df.orderBy(*order).limit(rows).select("category", title.alias("title"), "price_text", "location")
    )
