"""Listings, messages, payloads and pages made from the order tables.

``SQL_VIEW`` is the same view for another SQL engine; the two are checked
against each other by the query ``listings``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarflow.operators.parse import to_messages
from bazaarflow.schema import FEED_A, Site
from bazaarflow.sources.tables import table, table_stream

SITE_A = Site("Site A", "https://a.example/fr")
SITE_B = Site("siteb", "https://b.example")
AS_OF = "1999-06-15 12:00:00"
FILES_PER_BATCH = 500  # bounds a micro-batch where a table has many files
STORED_BEFORE = 820454400  # 1996-01-01: older listings count as stored already

_SPARK_DAYS = "unix_date(cast(o_orderdate as date))"
_OTHER_DAYS = "(cast(o_orderdate as date) - date '1970-01-01')"

# Portable expressions; only the day number differs between the engines.
_COLUMNS = {
    "source": "case when o_orderkey % 2 = 0 then 'Site A' else 'siteb' end",
    "category": "case when o_orderkey % 19 = 0 then null else o_orderpriority end",
    "subcategory": "c_mktsegment",
    "title": "concat(c_name, ' ', o_orderstatus)",
    "price_text": """case when o_orderkey % 23 = 0 then null
        when o_orderkey % 17 = 0 then 'N/A'
        when o_orderkey % 13 = 0 then ''
        when o_orderkey % 11 = 0 then '0'
        else concat(cast(cast(floor(o_totalprice / 1000) as bigint) as string), ' ',
                    lpad(cast(cast(floor(o_totalprice) as bigint) % 1000 as string), 3, '0'), ' DH')
        end""",
    "location": "case when o_orderkey % 29 = 0 then null else n_name end",
    # Five orders share three addresses, at every table size.
    "url": "concat('https://x.example/', cast(cast(floor(o_orderkey * 0.6e0) as bigint) as string))",
    "image_url": """case when o_orderkey % 7 = 0 then null when o_orderkey % 5 = 0 then 'N/A'
        else concat('/img/', cast(o_orderkey as string)) end""",
    "date_text": "cast(cast(o_orderdate as date) as string)",
    "scraped_at": """cast({days} as bigint) * 86400 + hour(o_orderdate) * 3600
        + minute(o_orderdate) * 60 + cast(second(o_orderdate) as bigint)""",
    "listing_no": "o_orderkey",
    "posted": """case when o_orderkey % 31 = 0 then concat('Aujourd', chr(39), 'hui 10:30')
        when o_orderkey % 37 = 0 then 'Hier 09:00'
        when o_orderkey % 41 = 0 then 'sans date'
        when o_orderkey % 43 = 0 then '31 Fév 1999'
        when o_orderkey % 47 = 0 then concat(cast(day(o_orderdate) as string), ' Juillet ',
                                             cast(year(o_orderdate) as string))
        else concat(cast(day(o_orderdate) as string), ' ',
            case month(o_orderdate) when 1 then 'Jan' when 2 then 'Fév' when 3 then 'Mar'
                when 4 then 'Avr' when 5 then 'Mai' when 6 then 'Juin' when 7 then 'Juil'
                when 8 then 'Aoû' when 9 then 'Sep' when 10 then 'Oct' when 11 then 'Nov'
                else 'Déc' end, ' ', cast(year(o_orderdate) as string)) end""",
}
SQL_VIEW = (
    "listings as (select "
    + ", ".join(f"{sql.format(days=_OTHER_DAYS)} as {name}" for name, sql in _COLUMNS.items())
    + " from orders join customer on o_custkey = c_custkey"
    " join nation on c_nationkey = n_nationkey)"
)


def _from_orders(orders: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    nation = table(spark, folder, "nation")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.select(
        *[F.expr(sql.format(days=_SPARK_DAYS)).alias(name) for name, sql in _COLUMNS.items()]
    )


def listings(spark: SparkSession, folder: str) -> DataFrame:
    return _from_orders(table(spark, folder, "orders"), spark, folder)


def listings_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The orders as a stream, the other two tables as they are."""
    orders = table_stream(spark, folder, "orders", files_per_batch=FILES_PER_BATCH)
    return _from_orders(orders, spark, folder)


def stored_part(df: DataFrame) -> DataFrame:
    return df.where(F.col("scraped_at") < STORED_BEFORE)


def with_hot_url(df: DataFrame) -> DataFrame:
    """A third of all rows under one address."""
    hot = F.col("listing_no") % 3 == 0
    return df.withColumn("url", F.when(hot, F.lit("https://x.example/hot")).otherwise(F.col("url")))


def spoiled_messages(df: DataFrame) -> DataFrame:
    """Messages without address where the location lacks, unreadable where the category does."""
    keyless = df.withColumn("url", F.when(F.col("location").isNotNull(), F.col("url")))
    text = F.col("value").cast("string")
    cut = F.when(text.contains('"category":null'), F.concat(F.lit("cut "), text)).otherwise(text)
    return to_messages(keyless, FEED_A).select(cut.alias("value"))


# --- site A payloads -----------------------------------------------------------

ADS_PER_PAYLOAD = 50


def payloads(df: DataFrame) -> DataFrame:
    """One JSON payload per 50 consecutive listings, with a section per segment.

    Listing numbers are unique, so no group exceeds 50 rows.
    """
    number = F.col("listing_no")
    ad = F.struct(
        F.when(number % 37 != 0, number.cast("string")).alias("adId"),
        F.when(number % 43 != 0, F.floor(number / 5).cast("string")).alias("listId"),
        F.col("title").alias("title"),
        F.col("date_text").alias("listTime"),
        F.when(F.col("category").isNotNull(), F.struct(F.col("category").alias("name"))).alias("category"),
        F.struct(F.col("price_text").alias("withCurrency")).alias("price"),
        F.struct(F.struct(F.col("location").alias("name")).alias("city")).alias("location"),
        F.when(
            F.col("image_url").isNotNull(),
            F.struct(F.struct(F.struct(F.col("image_url").alias("standard")).alias("paths")).alias("defaultImage")),
        ).alias("media"),
    )
    title = F.when(F.col("subcategory") != "HOUSEHOLD", F.col("subcategory"))
    ads = df.select(
        F.floor(number / ADS_PER_PAYLOAD).alias("payload_no"),
        title.alias("section_title"), "scraped_at", ad.alias("ad"),
    )
    # One shuffle serves both groupings.
    section = (
        ads.repartition("payload_no")
        .groupBy("payload_no", "section_title")
        .agg(F.collect_list("ad").alias("ads"), F.max("scraped_at").alias("scraped_at"))
    )
    gathered = section.groupBy("payload_no").agg(
        F.collect_list(F.struct(F.col("section_title").alias("title"), "ads")).alias("sections"),
        F.max("scraped_at").alias("scraped_at"),
    )
    body = F.struct(F.struct(F.struct("sections").alias("getListingSections")).alias("data"))
    return gathered.select("payload_no", F.to_json(body).alias("payload"), "scraped_at")


# --- site B pages ----------------------------------------------------------------

ITEMS_PER_PAGE = 25


def with_bad_parts(made: DataFrame) -> DataFrame:
    """Payloads with a text as first ad of every section, and a text and a number before the sections."""
    ads = F.replace(F.col("payload"), F.lit('"ads":['), F.lit('"ads":["oops",'))
    return made.withColumn("payload", F.replace(ads, F.lit('"sections":['), F.lit('"sections":["oops",7,')))


def item_pages(df: DataFrame, nested: bool = True) -> DataFrame:
    """One HTML page per 25 consecutive listings.

    Some items are ad slots or lack a date, link, title, price or picture.
    ``nested`` puts a list into every item.
    """
    number = F.col("listing_no")
    empty = F.lit("")

    def element(condition, before: str, value, after: str):
        return F.coalesce(F.when(condition, F.concat(F.lit(before), value, F.lit(after))), empty)

    href = (
        F.when(F.col("price_text") == "N/A", empty)
        .when(number % 2 == 0, F.concat(F.lit("ad/"), number.cast("string"), F.lit(".html")))
        .otherwise(F.col("url"))
    )
    heading = F.concat(F.lit("<h3> "), F.col("title"), F.lit(" &amp; <b>Co</b></h3>"))
    title = F.when(F.coalesce(F.col("price_text"), F.lit("-")) != "", heading).otherwise(empty)
    source = (
        F.when(F.col("image_url") == "N/A", empty)
        .when(number % 3 == 0, F.lit(' data-original="pics/icon-no-photo.png"'))
        .otherwise(F.concat(F.lit(' data-original="pics'), F.col("image_url"), F.lit('"')))
    )
    link = F.concat(F.lit('<a class="go" href="'), href, F.lit('">'), title, F.lit("</a>"))
    item = F.concat(
        F.when(number % 10 == 0, F.lit('<li class="holder adslistingpos">')).otherwise(F.lit("<li>")),
        F.lit('<ul class="tags"><li>neuf</li><li>pro</li></ul>' if nested else ""),
        element(F.col("category").isNotNull(), '<span class="date">', F.col("posted"), "</span>"),
        F.when(F.col("location").isNotNull(), link).otherwise(empty),
        element(F.col("price_text").isNotNull(), '<div class="price big">\n ', F.col("price_text"), " </div>"),
        element(number % 8 != 0, '<span class="location">', F.col("location"), "</span>"),
        element(F.col("subcategory") != "HOUSEHOLD", '<em class="views">', F.col("subcategory"), "</em>"),
        element(F.col("image_url").isNotNull(), '<img class="lazy"', source, ">"),
        F.lit("</li>\n"),
    )
    page = F.floor(number / ITEMS_PER_PAGE).alias("page_no")
    pages = df.select(page, F.struct("listing_no", item.alias("html")).alias("item"), "scraped_at")
    body = F.array_join(F.transform(F.array_sort("items"), lambda i: i["html"]), "")
    head = (
        "<html><head><script>var t=\"<ul class='cars-list'><li>no</li></ul>\";</script></head>"
        '<body><ul class="nav"><li><a href="/">Home</a></li></ul><!-- <ul class="cars-list"> -->'
        '<ul class="wide cars-list">'
    )
    category = F.element_at(
        F.array(F.lit("Autos"), F.lit("Logement"), F.lit("Audio")),
        (F.col("page_no") % 3 + 1).cast("int"),
    )
    # Listing numbers are unique, so no page exceeds 25 items.
    return (
        pages.groupBy("page_no")
        .agg(F.collect_list("item").alias("items"), F.max("scraped_at").alias("scraped_at"))
        .select(
            "page_no",
            category.alias("category"),
            F.concat(F.lit(head), body, F.lit("</ul></body></html>")).alias("html"),
            "scraped_at",
        )
    )
