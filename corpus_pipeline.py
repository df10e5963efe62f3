"""Documents to packed training sequences: the stages of the corpus pipeline.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept. It
begins by letting go of what the one before needed.
Rows of one stage's decisions are found again by id and a hash of the whole
text, so a repeated id with another text is another document.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarflow.llm import language, packing, pii, set_join
from bazaarflow.llm.exact_index import exact_copies
from bazaarflow.llm.tasks import let_go, written
from bazaarflow.sources.tables import table

#: Near copies share this part, above / below, of their shingles of so many words.
WORDS, ABOVE, BELOW = 5, 80, 100
#: Rows of two numbers that are broadcast.
SMALL = 250_000


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a language: null texts and texts without a letter.

    Learns from the labelled documents that are not held out. Documents that lack a label get the
    language found; short or mixed texts have their nearest one and stay. An empty table stays empty.
    """
    let_go(spark)
    parser = language.train(docs.where(~language.held_out()))
    found = language.detect(docs, parser, names=("__lang", "__score"))
    # Without labels nothing can be told, then letters alone decide.
    known = F.when(F.col("__lang") != language.UNDETERMINED, F.col("__lang"))
    spoken = known.isNotNull() if parser else F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    label = F.coalesce(F.col("lang"), known).cast(docs.schema["lang"].dataType)
    return found.where(spoken).withColumn("lang", label).select(docs.columns)


def one_of_equal_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one of every class of equal texts, as the exact index decides."""
    let_go(spark)
    return _kept(docs, exact_copies(docs))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of every component of similar ones."""
    let_go(spark)
    return _kept(docs, set_join.similar_components(docs, words=WORDS, above=ABOVE, below=BELOW))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in all texts; ``n_chars`` follows the text."""
    let_go(spark)
    out = pii.redact(docs, trees=pii.train(docs))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their places in sequences."""
    let_go(spark)
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(packing.token_pieces(docs, vocabulary)).drop("row")


def _kept(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id and text were decided to stay; of repeated rows one.

    Only ids and hashes of what goes, or is there several times, are brought to the texts:
    to where they lie as long as these are few.
    """
    number = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    told = decided.groupBy(number.alias("__id"), F.col("same_text").alias("__same"))
    told = told.agg(F.max("kept").alias("__stays"), F.count(F.lit(1)).alias("__n"))
    special = written(told.where(~F.col("__stays") | (F.col("__n") > 1)), "decided")
    if special.count() <= SMALL:
        special = F.broadcast(special)
    key = ["__id", "__same"]
    keyed = docs.withColumn("__id", number).withColumn("__same", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    plain = keyed.join(special.select(*key), key, "left_anti").select(docs.columns)
    # Tasks keep one of equal rows before the shuffle.
    repeated = keyed.join(special.where("__stays").select(*key), key, "left_semi").dropDuplicates(key)
    return plain.unionByName(repeated.select(docs.columns))


STAGES = [
    ("language", languages),
    ("exact", one_of_equal_texts),
    ("near", one_of_near_copies),
    ("personal", without_personal_data),
    ("packing", sequences),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
