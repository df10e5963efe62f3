"""Feeds of several micro-batches as queries: bounded memory, polls, kept facets, other spellings of keys.

Tables are written as several files that a stream takes one at a time, stops
half-way and resumes, so every query here meets state left by earlier batches.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarflow.functions.text import decode_entities
from bazaarflow.operators import counts, dedup, parse
from bazaarflow.operators.kept import KeptFacets
from bazaarflow.plans import example_listings as example
from bazaarflow.plans.checked import FIELDS, FILLED, PRICE, checked, over_listings
from bazaarflow.plans.feeds import store_feed_by_state, store_feed_counted, store_merged_feeds
from bazaarflow.schema import FEED_A, FEED_B, KEY, LISTING_FIELDS
from bazaarflow.sources.polled import polls, store_fetch
from bazaarflow.sources.scratch import working_folder
from bazaarflow.sources.streams import open_files
from bazaarflow.sources.tables import table
from bazaarflow.streaming.committed import CommittedTarget
from bazaarflow.streaming.insert import state_settings
from bazaarflow.streaming.seen import stream_dedup_counted
from bazaarflow.streaming.targets import LakeTarget

#: Batches that a table is dealt into, by listing number, and the rows of a file of a batch.
FILES = 6
ROWS_PER_FILE = 125_000
#: State partitions of the streams whose seen keys are bounded: each runs a Python worker in every batch, and few parts have keys.
COUNTED_PARTITIONS = 8


class Batches:
    """All listings in ``FILES`` batches; the second half is written after the stream stopped once.

    Every batch is the same number of files, which grows with the table, so that no task writes or reads a whole one.
    ``each`` may change a batch before it is written.
    """

    def __init__(self, spark: SparkSession, folder: str, rows: DataFrame | None = None, each: Callable[[DataFrame], DataFrame] = lambda part: part):
        self.spark, self.rows, self.each = spark, example.listings(spark, folder) if rows is None else rows, each
        self.place, self.schema = working_folder(spark, "batches"), self.rows.schema
        self.written = 0
        self.pieces = max(1, -(-self.rows.count() // (FILES * ROWS_PER_FILE)))

    def write(self, batches: int) -> None:
        for _ in range(batches):
            part = self.each(self.rows.where(F.col("listing_no") % FILES == self.written))
            dealt = part.coalesce(1) if self.pieces == 1 else part.repartition(self.pieces)
            dealt.write.mode("append").parquet(self.place)
            self.written += 1
            # A batch with few rows has fewer files; empty ones keep the next batch out of it.
            for _ in range(self.written * self.pieces - len(self.spark.read.schema(self.schema).parquet(self.place).inputFiles())):
                self.spark.createDataFrame([], self.schema).coalesce(1).write.mode("append").parquet(self.place)

    def stream(self) -> DataFrame:
        return open_files(self.spark, self.place, self.schema, files_per_batch=self.pieces)

    def run(self, start) -> None:
        """``start`` a query over the stream twice, with half of the batches each time."""
        for _ in range(2):
            self.write(FILES // 2)
            start(self.stream()).awaitTermination()


@contextmanager
def _rocksdb(spark: SparkSession, partitions: int | None = None):
    """The settings of stateful streams, for as long as a stream runs; the session's partitions unless some are given."""
    settings = {k: v for k, v in state_settings(partitions or 1).items() if partitions or "stateStore" in k}
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _to_files(stream: DataFrame, place: str):
    writer = stream.writeStream.format("parquet").option("path", f"{place}/out").option("checkpointLocation", f"{place}/checkpoint")
    return writer.trigger(availableNow=True).start()


def _out(spark: SparkSession, place: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{place}/out")


# A key's number decides its part of the state, in both engines.
_PARTS, _LIMIT, _KEEP = 4, 100, 40
_NUMBER = "cast(substring(url, 19) as bigint)"


def _counted_sql(keep: int) -> str:
    left = f"list_slice(seen || fresh, {-keep}, -1)" if keep else "cast([] as varchar[])"
    return over_listings(
        "select b as file, url, listing_no from (select b, unnest(fresh) as url from run) join firsts using (b, url)",
        f"rows_of as (select *, listing_no % {FILES} as b, {_NUMBER} % {_PARTS} as part from listings)",
        "firsts as (select b, url, min(listing_no) as listing_no from rows_of group by b, url)",
        "keys as (select b, part, list(distinct url order by url) as urls from rows_of group by b, part)",
        # The keys that each part of the state holds, batch by batch.
        f"""run as (with recursive r(b, part, seen, fresh) as (
          select -1, part, cast([] as varchar[]), cast([] as varchar[]) from range({_PARTS}) p(part)
          union all
          select b, part, case when len(seen) + len(fresh) <= {_LIMIT} then seen || fresh else {left} end, fresh
          from (select r.b + 1 as b, r.part as part, seen, list_filter(coalesce(urls, []), lambda u: not list_contains(seen, u)) as fresh
            from r left join (select b - 1 as before, part, urls from keys) k on k.part = r.part and k.before = r.b) where b < {FILES})
          select b, part, fresh from r)""",
    )


def _counted(spark: SparkSession, folder: str, keep: int) -> DataFrame:
    batches, place = Batches(spark, folder), working_folder(spark, "counted")
    with _rocksdb(spark, COUNTED_PARTITIONS):
        def once(stream: DataFrame) -> DataFrame:
            narrow = stream.select("url", "listing_no")
            return stream_dedup_counted(narrow, limit=_LIMIT, keep=keep, part=F.expr(f"{_NUMBER} % {_PARTS}"), order=["listing_no"])

        batches.run(lambda stream: _to_files(once(stream), place))
    passed = _out(spark, place, "url string, listing_no long")
    return passed.select((F.col("listing_no") % FILES).alias("file"), "url", "listing_no")


@checked(_counted_sql(_KEEP))
def stream_dedup_counted_newest(spark, folder):
    """Seen keys bounded by count: above the limit the newest ones stay."""
    return _counted(spark, folder, _KEEP)


@checked(_counted_sql(0))
def stream_dedup_counted_cleared(spark, folder):
    """The same, but all seen keys are forgotten above the limit."""
    return _counted(spark, folder, 0)


@checked("select page_id, url, length(html) as size, 2 as times from pages where page_id % 3 > 0 union all select page_id, url, length(html), 3 from pages where page_id % 3 = 0")
def poll_pages(spark, folder):
    """Six polls of all pages, some of which repeat pages, over two runs of one query: every fetch once."""
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    place = working_folder(spark, "polls")
    # Polls 0 and 3 bring the third parts of the pages that 1, 4 and 2, 5 lack; 3 of six bring the first third.
    wanted = [F.col("page_id") % 3 == 0, F.col("page_id") % 3 == 1, F.col("page_id") % 3 == 2, F.lit(True), F.col("page_id") % 3 == 0, F.lit(False)]
    for first in (0, 3):
        for poll in range(first, first + 3):
            store_fetch(pages.where(wanted[poll]), place, poll)
        stream = polls(spark, place, pages.schema, progress=f"{place}-progress/polls.json", polls_per_batch=1)
        writer = stream.writeStream.format("parquet").option("path", f"{place}-out").option("checkpointLocation", f"{place}-checkpoint")
        query = writer.trigger(processingTime="0 seconds").start()
        query.processAllAvailable()
        query.stop()
    read = spark.read.schema(pages.schema).parquet(f"{place}-out")
    return read.groupBy("page_id", "url", F.length("html").alias("size")).agg(F.count(F.lit(1)).cast("int").alias("times"))


_SERVED_BY_BATCH = (
    f"filled as (select scraped_at, listing_no, listing_no % {FILES} as b, {FILLED}, {PRICE} as price_num from listings)",
    f"""windows as (select * from (select n.b as batch, f.* exclude (b),
      row_number() over (partition by n.b order by scraped_at desc, listing_no) as place
      from range({FILES}) n(b) join filled f on f.b <= n.b) where place <= 2000)""",
)


def _kept(spark: SparkSession, folder: str) -> KeptFacets:
    batches, kept = Batches(spark, folder), KeptFacets(working_folder(spark, "kept"), tie_break=("listing_no",))
    place = working_folder(spark, "kept-checkpoint")

    def start(stream: DataFrame):
        writer = stream.writeStream.foreachBatch(kept.update).option("checkpointLocation", place)
        return writer.trigger(availableNow=True).start()

    batches.run(start)
    return kept


@checked(
    over_listings(
        "select batch, 'category' as kind, category as value, count(*) as rows, max(price_num) as top_price from windows group by all "
        "union all select batch, 'location', location, count(*), max(price_num) from windows group by all",
        *_SERVED_BY_BATCH,
    )
)
def kept_facets(spark, folder):
    """The facets of the newest rows after every batch, from the kept window, against a recount."""
    kept = _kept(spark, folder)
    found = None
    for batch in range(FILES):
        window = kept.window(spark, batch)
        for kind in ("category", "location"):
            one = window.groupBy(F.col(kind).alias("value")).agg(F.count(F.lit(1)).alias("rows"), F.max("price_num").alias("top_price"))
            one = one.select(F.lit(batch).cast("long").alias("batch"), F.lit(kind).alias("kind"), "value", "rows", "top_price")
            found = one if found is None else found.unionByName(one)
    return found


@checked(
    over_listings(
        "select n.b as batch, category, count(*) as rows, max(price_num) as top_price "
        f"from range({FILES}) n(b) join filled f on f.b <= n.b group by all",
        _SERVED_BY_BATCH[0],
    )
)
def kept_totals(spark, folder):
    """Rows and highest price per category of all rows, added up from partials after every batch."""
    kept = _kept(spark, folder)
    found = [kept.totals(spark, b).select(F.lit(b).cast("long").alias("batch"), "category", "rows", "top_price") for b in range(FILES)]
    out = found[0]
    for one in found[1:]:
        out = out.unionByName(one)
    return out


@checked("select doc_id, text from documents where text is not null")
def entities(spark, folder):
    """Whole texts with their signs and letters written as references of every kind, decoded again."""
    docs = table(spark, folder, "documents").where("text is not null")
    told = F.replace("text", F.lit("&"), F.lit("&amp;"))
    for sign, reference in (("é", "&eacute;"), ("ü", "&#252;"), ("ß", "&#xDF;"), ("ñ", "&#Xf1;"), ("<", "&LT;"), ("ö", "&ouml;"), ("$", "&dollar;")):
        told = F.replace(told, F.lit(sign), F.lit(reference))
    # Old names need no semicolon, unless one follows in the text.
    told = F.regexp_replace(told, "ó(?!;)", "&oacute")
    return docs.select("doc_id", decode_entities(told).alias("text"))


# --- keys under another collation ---------------------------------------------------

_CASES = "case when listing_no % 3 = 0 then upper(url) when listing_no % 3 = 1 then replace(url, 'example', 'Example') else url end"
_SPELT = f"spelt as (select listing_no, scraped_at, {_CASES} as url from listings)"


def _spelt(spark: SparkSession, folder: str) -> DataFrame:
    return example.listings(spark, folder).select("listing_no", "scraped_at", F.expr(_CASES).alias("url"))


@checked(
    over_listings(
        "select listing_no, scraped_at, url from (select *, row_number() over (partition by lower(url) order by scraped_at, listing_no) as n from spelt) where n = 1",
        _SPELT,
    )
)
def first_per_key_ci(spark, folder):
    """One row of each address in any letter case."""
    return dedup.first_per_collated_key(_spelt(spark, folder), order=["scraped_at", "listing_no"])


@checked(
    over_listings(
        f"select listing_no, scraped_at, url from spelt where lower(url) not in (select lower(url) from listings where scraped_at < {example.STORED_BEFORE})",
        _SPELT,
    )
)
def drop_known_ci(spark, folder):
    """Rows whose address is stored in no letter case."""
    return dedup.drop_known_collated(_spelt(spark, folder), example.stored_part(example.listings(spark, folder)))


@checked(over_listings("select distinct lower(url) as url from spelt", _SPELT))
def stream_dedup_ci(spark, folder):
    """The same along a stream of several batches."""
    batches, place = Batches(spark, folder, _spelt(spark, folder)), working_folder(spark, "dedup")
    batches.run(lambda stream: _to_files(dedup.stream_dedup_collated(stream.select("url")), place))
    return _out(spark, place, "url string").select(F.lower("url").alias("url"))


@checked(over_listings("select count(distinct url) as keys, true as close from listings"))
def distinct_over_batches(spark, folder):
    """Distinct addresses over batches: sketches united on reading, beside the exact count."""
    rows = example.listings(spark, folder)
    sketches = counts.key_sketch(rows, by=["category"])
    about = counts.distinct_estimate(sketches).select(F.col("keys").alias("about"))
    exact = dedup.distinct_keys(rows, KEY).agg(F.count(KEY).alias("keys"))
    both = exact.withColumn("about", F.lit(None).cast("long")).unionByName(about, allowMissingColumns=True)
    both = both.agg(F.max("keys").alias("keys"), F.max("about").alias("about"))
    # Over three standard errors of the sketches.
    return both.select("keys", (F.abs(F.col("about") - F.col("keys")) <= F.greatest(F.col("keys") * 0.03, F.lit(1))).alias("close"))


# --- feeds over several batches -------------------------------------------------------

# The batch of a key's first row stores it: the earliest of that batch's rows.
_FIRST_BATCH = (
    f"final as (select {FIELDS} from (select *, row_number() over (partition by url order by listing_no % {FILES}, scraped_at, "
    "source, category, subcategory, title, price_text, location, image_url, date_text) as n from listings) where n = 1)"
)


@checked(over_listings(f"select {FIELDS} from final", _FIRST_BATCH))
def stream_feed_batches(spark, folder):
    """Messages of both feeds over six batches and a restart: the first batch that has a key stores it, in whole rows."""
    batches = Batches(spark, folder)
    target = LakeTarget(working_folder(spark, "target")).create(spark)
    place = working_folder(spark, "checkpoint")
    is_a = F.col("source") == example.SITE_A.tag

    def start(stream: DataFrame):
        raw_a = parse.to_messages(stream.where(is_a), FEED_A)
        raw_b = parse.to_messages(stream.where(~is_a), FEED_B)
        return store_merged_feeds(raw_a, raw_b, target, place, every=None)

    batches.run(start)
    return target.read(spark).select(*LISTING_FIELDS)


@checked(over_listings(f"select {FIELDS} from final", _FIRST_BATCH))
def stream_state_batches(spark, folder):
    """Seen keys in state over six batches and a restart; copies inside a batch are dropped before, so the survivor is fixed."""
    rest = [name for name in LISTING_FIELDS if name not in (KEY, "scraped_at")]
    order = [F.asc_nulls_last(name) for name in ("scraped_at", *rest)]
    batches = Batches(spark, folder, each=lambda part: dedup.first_per_key(part, KEY, order))
    target = LakeTarget(working_folder(spark, "target")).create(spark)
    place = working_folder(spark, "checkpoint")
    with _rocksdb(spark):
        batches.run(lambda stream: store_feed_by_state(
            parse.to_messages(stream, FEED_A), FEED_A, target, place, every=None, other_writers=False))
    return target.read(spark).select(*LISTING_FIELDS)


@checked(over_listings(f"select {FIELDS} from final", _FIRST_BATCH))
def stream_counted_feed(spark, folder):
    """A feed whose seen-set forgets, into a store: what passes again is found there, so the rows are the same."""
    batches = Batches(spark, folder)
    target = CommittedTarget(working_folder(spark, "store"), buckets=8).create(spark)
    place = working_folder(spark, "checkpoint")
    with _rocksdb(spark, COUNTED_PARTITIONS):
        batches.run(lambda stream: store_feed_counted(
            parse.to_messages(stream, FEED_A), FEED_A, target, place, every=None, limit=50, keep=10, parts=4))
    return target.read(spark).select(*LISTING_FIELDS)

