"""Every operator as a query over whole tables, with SQL for comparison."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarflow.functions.text import badge, label, shown_date, shown_image, shown_price
from bazaarflow.functions.urls import resolve_image, resolve_url
from bazaarflow.operators import clean, counts, dedup, flatten, html_items, parse, serve
from bazaarflow.plans import example_listings as example
from bazaarflow.plans.example_listings import AS_OF, SITE_A, SITE_B, SQL_VIEW, STORED_BEFORE
from bazaarflow.plans.feeds import merged_feeds, page_messages, payload_messages
from bazaarflow.plans.screen import result_cards, side_bar, snapshot
from bazaarflow.schema import FEED_A, FEED_B, FULL_MONTHS, LISTING_FIELDS, MONTHS
from bazaarflow.sources import tables
from bazaarflow.sources.tables import table


@dataclass(frozen=True)
class Checked:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


CHECKED: dict[str, Checked] = {}
FIELDS = ", ".join(LISTING_FIELDS)
NUMBERED = [*LISTING_FIELDS, "listing_no"]
NUMBERED_SQL = ", ".join(NUMBERED)


def checked(sql: str | None, name: str | None = None):
    """Register a query under its function name."""

    def keep(run):
        CHECKED[name or run.__name__] = Checked(run, sql)
        return run

    return keep


def over_listings(sql: str, *more: str) -> str:
    return f"with {', '.join([SQL_VIEW, *more])} {sql}"


# --- SQL forms of the expressions ---------------------------------------------

PRICE = "coalesce(try_cast(regexp_replace(price_text, '[^0-9]', '', 'g') as double), 0)"
SOURCE_KEY = "replace(lower(coalesce(source, 'None')), ' ', '')"
FILLED = "coalesce(category, 'Divers') as category, coalesce(location, 'Maroc') as location"
SERVED = (
    f"served as (select source, subcategory, title, price_text, url, image_url, date_text, "
    f"scraped_at, listing_no, {FILLED}, {PRICE} as price_num, {SOURCE_KEY} as source_clean "
    "from listings order by scraped_at desc, listing_no limit 2000)"
)
SERVED_COLUMNS = (
    "source, category, subcategory, title, price_text, location, url, image_url, date_text, "
    "scraped_at, listing_no, price_num, source_clean"
)
FIRST = (
    f"firsts as (select {NUMBERED_SQL} from (select *, row_number() over (partition by url "
    "order by scraped_at, listing_no) as n from listings) where n = 1)"
)
STORED = f"stored as (select * from listings where scraped_at < {STORED_BEFORE})"


def _month_sql(names: dict[str, int], word: str) -> str:
    cases = " ".join(f"when '{name}' then {number}" for name, number in names.items())
    return f"case {word} {cases} else 1 end"


def recent_sql(text: str, strict: bool) -> str:
    pattern = r"([0-9]{1,2})\s+([\pL\d_]+)\s+([0-9]{4})"
    names = MONTHS if strict else {**MONTHS, **FULL_MONTHS}
    part = [f"regexp_extract({text}, '{pattern}', {n})" for n in range(4)]
    date = (
        f"try_strptime(concat({part[3]}, '-', {_month_sql(names, part[2])}, '-', {part[1]}), "
        "'%Y-%m-%d')"
    )
    marks = " or ".join(
        f"contains({text}, {mark})"
        for mark in ("concat('Aujourd', chr(39), 'hui')", "'cnt-today'", "'Hier'", "'Yesterday'")
    )
    return (
        f"({marks} or coalesce({date} >= timestamp '{AS_OF}' - interval 3 days, false))"
    )


def _listings(spark: SparkSession, folder: str) -> DataFrame:
    return example.listings(spark, folder)


def _served(spark: SparkSession, folder: str) -> DataFrame:
    return snapshot(_listings(spark, folder).drop("posted"), tie_break=["listing_no"])


# --- cleaning -----------------------------------------------------------------


@checked(over_listings(f"select {NUMBERED_SQL}, posted from listings"))
def listings(spark, folder):
    return _listings(spark, folder)


@checked(over_listings(f"select {FILLED}, listing_no from listings"))
def fill_defaults(spark, folder):
    return clean.fill_defaults(_listings(spark, folder)).select("category", "location", "listing_no")


@checked(over_listings(f"select listing_no, price_text, {PRICE} as price_num from listings"))
def price_number(spark, folder):
    return clean.with_price_number(_listings(spark, folder)).select("listing_no", "price_text", "price_num")


@checked(over_listings(f"select listing_no, source, {SOURCE_KEY} as source_clean from listings"))
def source_key(spark, folder):
    return clean.with_source_key(_listings(spark, folder)).select("listing_no", "source", "source_clean")


@checked(over_listings("select listing_no, cast(floor(scraped_at + 0.75) as bigint) as scraped_at from listings"))
def unify_time(spark, folder):
    fractional = _listings(spark, folder).select(
        "listing_no", (F.col("scraped_at") + F.lit(0.75).cast("double")).alias("timestamp")
    )
    return parse.unify_time(fractional, "timestamp")


def _recent(spark, folder, strict):
    found = clean.recent_only(_listings(spark, folder), "posted", AS_OF, strict)
    return found.select("listing_no", "posted")


@checked(over_listings(f"select listing_no, posted from listings where {recent_sql('posted', False)}"))
def recent_only(spark, folder):
    return _recent(spark, folder, strict=False)


@checked(over_listings(f"select listing_no, posted from listings where {recent_sql('posted', True)}"))
def recent_only_strict(spark, folder):
    return _recent(spark, folder, strict=True)


DOCUMENT_LIMITS = {"text": 2000, "source": 4}


@checked("select doc_id from documents where length(text) <= 2000 and (source is null or length(source) <= 4)")
def valid_lengths(spark, folder):
    return clean.valid_lengths(table(spark, folder, "documents"), DOCUMENT_LIMITS).select("doc_id")


@checked(
    "select doc_id, concat_ws(',', case when length(text) > 2000 then 'text' end, "
    "case when length(source) > 4 then 'source' end) as too_long from documents "
    "where length(text) > 2000 or length(source) > 4"
)
def invalid_lengths(spark, folder):
    found = clean.invalid_lengths(table(spark, folder, "documents"), DOCUMENT_LIMITS)
    return found.select("doc_id", F.array_join("too_long", ",").alias("too_long"))


# --- messages -----------------------------------------------------------------


@checked("select event_id, cast(json_extract(props, '$.k') as bigint) as k from events")
def parse_event_json(spark, folder):
    return parse.parse_fields(table(spark, folder, "events").select("event_id", "props"), "props", "k bigint")


@checked(over_listings(f"select {FIELDS} from listings"))
def parse_messages(spark, folder):
    sent = parse.to_messages(_listings(spark, folder), FEED_A)
    return parse.accepted(parse.parse_messages(sent, FEED_A))


@checked(
    over_listings(
        "select url, title as titre, price_text as prix, location as localisation, "
        "subcategory as sous_categorie, scraped_at as timestamp_scraped from listings"
    )
)
def to_messages(spark, folder):
    fields = "url string, titre string, prix string, localisation string, sous_categorie string, timestamp_scraped bigint"
    sent = parse.to_messages(_listings(spark, folder), FEED_A)
    return sent.select(F.from_json(F.col("value").cast("string"), fields).alias("data")).select("data.*")


@checked(
    over_listings(
        "select case when category is null then 'unreadable message' else 'no key' end as reason, "
        "count(*) as rows from listings where category is null or location is null group by 1"
    )
)
def rejected_messages(spark, folder):
    """Messages broken on purpose: cut short, or without their address."""
    sent = example.spoiled_messages(_listings(spark, folder))
    found = parse.rejected(parse.parse_messages(sent, FEED_A))
    return found.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


@checked(over_listings(f"select {FIELDS} from listings"))
def merged_messages(spark, folder):
    """Two feeds with different time fields, back in one frame."""
    df = _listings(spark, folder)
    site_a = parse.to_messages(df.where(F.col("source") == SITE_A.tag), FEED_A)
    site_b = parse.to_messages(df.where(F.col("source") == SITE_B.tag), FEED_B)
    return parse.accepted(merged_feeds(site_a, site_b))


# --- nested payloads ----------------------------------------------------------

_CHUNK = f"cast(floor(listing_no / {example.ADS_PER_PAYLOAD}) as bigint)"
_FLAT = (
    f"flat as (select 'Site A' as source, coalesce(category, 'N/A') as category, "
    "case when subcategory = 'HOUSEHOLD' then 'Unknown' else subcategory end as subcategory, "
    "title, coalesce(price_text, 'N/A') as price_text, coalesce(location, 'N/A') as location, "
    "concat('https://a.example/fr/', case when listing_no % 43 = 0 then '' else "
    "cast(cast(floor(listing_no / 5) as bigint) as string) end, '/', cast(listing_no as string)) as url, "
    "coalesce(image_url, 'N/A') as image_url, date_text, "
    f"max(scraped_at) over (partition by {_CHUNK}) as scraped_at, listing_no from listings)"
)


@checked(over_listings(f"select {FIELDS} from flat where listing_no % 37 <> 0", _FLAT))
def flatten_sections(spark, folder):
    return flatten.flatten_sections(
        example.payloads(_listings(spark, folder)), SITE_A, scraped_at="scraped_at"
    )


@checked(over_listings(f"select {FIELDS} from flat where listing_no % 37 <> 0", _FLAT))
def flatten_sections_strict(spark, folder):
    return flatten.flatten_sections(
        example.payloads(_listings(spark, folder)), SITE_A, scraped_at="scraped_at", strict=True
    )


@checked(
    over_listings(
        f"select {_CHUNK} as payload_no, case when subcategory = 'HOUSEHOLD' then 'Unknown' "
        "else subcategory end as subcategory, count(*) as ads from listings group by 1, 2"
    )
)
def ads_per_section(spark, folder):
    made = example.payloads(_listings(spark, folder)).drop("scraped_at")
    return flatten.ads_per_section(made)


@checked(
    over_listings(f"select distinct {_CHUNK} as payload_no from listings where {_CHUNK} % 4 = 0")
)
def unreadable_payloads(spark, folder):
    """Every fourth payload is cut short at its start."""
    made = example.payloads(_listings(spark, folder))
    cut = F.when(F.col("payload_no") % 4 == 0, F.concat(F.lit("]"), "payload")).otherwise(F.col("payload"))
    return flatten.unreadable_payloads(made.withColumn("payload", cut)).select("payload_no")


@checked(over_listings(f"select {FIELDS} from flat where listing_no % 37 <> 0", _FLAT))
def flatten_bad_ads(spark, folder):
    """A text before the first ad of every section, and a text and a number among the sections: all others survive."""
    made = example.with_bad_parts(example.payloads(_listings(spark, folder)))
    return flatten.flatten_sections(made, SITE_A, scraped_at="scraped_at")


@checked(
    over_listings(
        f"select payload_no, reason, count(*) as parts from (select distinct {_CHUNK} as payload_no, subcategory, "
        f"'ad is no object' as reason from listings union all select distinct {_CHUNK}, n, 'section is no object' "
        f"from listings, (values ('a'), ('b')) v(n)) group by 1, 2"
    )
)
def rejected_payload_parts(spark, folder):
    made = example.with_bad_parts(example.payloads(_listings(spark, folder))).drop("scraped_at")
    return flatten.rejected_parts(made).groupBy("payload_no", "reason").agg(F.count(F.lit(1)).alias("parts"))


@checked(over_listings(f"select {FIELDS} from flat where listing_no % 37 <> 0", _FLAT))
def payload_feed(spark, folder):
    """Payloads to messages to listings."""
    made = example.payloads(_listings(spark, folder))
    sent = payload_messages(made, SITE_A, scraped_at="scraped_at")
    return parse.accepted(parse.parse_messages(sent, FEED_A))


# --- HTML pages ---------------------------------------------------------------

_PAGE = f"cast(floor(listing_no / {example.ITEMS_PER_PAGE}) as bigint)"
_PAGE_CATEGORY = f"case {_PAGE} % 3 when 0 then 'Autos' when 1 then 'Logement' else 'Audio' end"
_ITEMS = (
    f"items as (select 'siteb' as source, {_PAGE_CATEGORY} as category, "
    f"case when subcategory = 'HOUSEHOLD' then {_PAGE_CATEGORY} else subcategory end as subcategory, "
    "case when price_text = '' then 'N/A' else concat(title, ' &Co') end as title, "
    "coalesce(price_text, 'N/A') as price_text, "
    "case when listing_no % 8 = 0 then 'N/A' else location end as location, "
    "case when price_text = 'N/A' then '' when listing_no % 2 = 0 then "
    "concat('https://b.example/ad/', cast(listing_no as string), '.html') else url end as url, "
    "case when image_url is null then 'N/A' when image_url = 'N/A' then '' "
    "when listing_no % 3 = 0 then 'N/A' else concat('https://b.example/pics', image_url) end as image_url, "
    f"posted as date_text, max(scraped_at) over (partition by {_PAGE}) as scraped_at, listing_no, "
    "category as date_given, location as link_given from listings)"
)
_KEPT = "date_given is not null and link_given is not null and listing_no % 10 <> 0"


def _site_items(spark, folder, nested, reader, strict):
    made = example.item_pages(_listings(spark, folder), nested)
    return html_items.extract_items(
        made, SITE_B, reader=reader, as_of=AS_OF, strict_months=strict, scraped_at="scraped_at"
    )


@checked(over_listings(f"select {FIELDS} from items where {_KEPT} and {recent_sql('date_text', False)}", _ITEMS))
def extract_site_items(spark, folder):
    """Items that hold lists themselves: needs the element tree."""
    return _site_items(spark, folder, nested=True, reader="tolerant", strict=False)


@checked(over_listings(f"select {FIELDS} from items where {_KEPT} and {recent_sql('date_text', True)}", _ITEMS))
def extract_site_items_native(spark, folder):
    """Flat items by expressions only."""
    return _site_items(spark, folder, nested=False, reader="native", strict=True)


@checked(over_listings(f"select {FIELDS} from items where {_KEPT} and {recent_sql('date_text', False)}", _ITEMS))
def page_feed(spark, folder):
    """Pages to messages to listings."""
    made = example.item_pages(_listings(spark, folder))
    sent = page_messages(made, SITE_B, as_of=AS_OF, scraped_at="scraped_at")
    return parse.accepted(parse.parse_messages(sent, FEED_B))


NAV = html_items.ItemSpec(list_class=None, title_tag=None)
_LINK = '(?is)<li><a href="([^"]*)">(.*?)</a></li>'
_LINKS = (
    f"found as (select page_id, regexp_extract_all(html, '{_LINK}', 1) as hrefs, "
    f"regexp_extract_all(html, '{_LINK}', 2) as texts from pages), "
    "links as (select page_id, cast(n - 1 as bigint) as item_no, hrefs[n] as href, texts[n] as title "
    "from (select *, unnest(range(1, len(hrefs) + 1)) as n from found))"
)
_LINK_SQL = (
    f"with {_LINKS} select page_id, item_no, title, href, case when href = '' or starts_with(href, 'http') "
    "then href else concat('https://b.example/', href) end as url from links"
)


def _page_links(spark, folder, reader):
    pages = table(spark, folder, "pages").select("page_id", "html")
    items = html_items.with_mandatory(html_items.read_items(pages, NAV, reader=reader), date=False)
    return items.select(
        "page_id", "item_no", "title", "href", resolve_url(F.col("href"), SITE_B.base_url).alias("url")
    )


@checked(_LINK_SQL)
def extract_items(spark, folder):
    return _page_links(spark, folder, "tolerant")


@checked(_LINK_SQL)
def extract_broken_pages(spark, folder):
    """Sections of word processors before every page's body are comments."""
    html = F.concat(F.lit("<![foo bar]><![if !x]>"), F.replace(F.col("html"), F.lit("<body>"), F.lit("<body><![endif]>")))
    pages = table(spark, folder, "pages").select("page_id", html.alias("html"))
    items = html_items.with_mandatory(html_items.read_items(pages, NAV), date=False)
    return items.select("page_id", "item_no", "title", "href", resolve_url(F.col("href"), SITE_B.base_url).alias("url"))


@checked(_LINK_SQL)
def extract_items_native(spark, folder):
    return _page_links(spark, folder, "native")


def _entities_sql(text: str) -> str:
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        text = f"replace({text}, '{entity}', '{char}')"
    return text


def _tag_sql(pattern: str) -> str:
    return f"trim({_entities_sql(f'regexp_extract(html, {chr(39)}{pattern}{chr(39)}, 1)')})"


@checked(
    f"select page_id, {_tag_sql('(?s)<title>(.*?)</title>')} as title, "
    f"{_tag_sql('(?s)<h1>(.*?)</h1>')} as heading, "
    "regexp_extract(html, '<html lang=\"([^\"]*)\"', 1) as lang, "
    f"{_tag_sql('(?s)<div class=.ad.>(.*?)</div>')} as ad_text, url as views from pages"
)
def extract_page_fields(spark, folder):
    """Element text, attribute, text by class, and the fallback to a column."""
    html = F.col("html")
    return table(spark, folder, "pages").select(
        "page_id",
        html_items.page_field(html, "title").alias("title"),
        html_items.page_field(html, "h1").alias("heading"),
        html_items.page_attribute(html, "html", "lang").alias("lang"),
        html_items.page_class_text(html, "ad", F.lit("N/A")).alias("ad_text"),
        html_items.page_class_text(html, "views", F.col("url")).alias("views"),
    )


@checked(
    over_listings(
        f"select {_PAGE} as page_no, listing_no % {example.ITEMS_PER_PAGE} as item_no from listings "
        "where listing_no % 10 <> 0"
    )
)
def drop_ad_slots(spark, folder):
    made = example.item_pages(_listings(spark, folder)).select("page_no", "html")
    return html_items.drop_ad_slots(html_items.read_items(made)).select("page_no", "item_no")


@checked(
    over_listings(
        f"select {_PAGE} as page_no, listing_no % {example.ITEMS_PER_PAGE} as item_no from listings "
        "where category is not null and location is not null"
    )
)
def with_mandatory(spark, folder):
    """Items that have both a date and a link, ad slots included."""
    made = example.item_pages(_listings(spark, folder)).select("page_no", "html")
    return html_items.with_mandatory(html_items.read_items(made)).select("page_no", "item_no")


@checked(
    "select page_id, case when starts_with(url, 'https://m.') then 'mobile' else 'desktop' end as category, "
    "length(html) as size from pages where starts_with(url, 'https://')"
)
def category_pages(spark, folder):
    """Pages of two address families in one scan."""
    stored = table(spark, folder, "pages").withColumnRenamed("url", "page_url")
    labelled = tables.pages(stored, {"mobile": "https://m.", "desktop": "https://"})
    return labelled.select("page_id", "category", F.length("html").cast("long").alias("size"))


@checked(
    over_listings(
        "select listing_no, case when href = '' or starts_with(href, 'http') then href "
        "else concat('https://b.example/', href) end as url from (select listing_no, "
        "case when price_text = '' then '' when listing_no % 2 = 0 then substr(url, 19) else url end as href "
        "from listings)"
    )
)
def resolve_links(spark, folder):
    """Absolute, relative and empty addresses."""
    href = (
        F.when(F.col("price_text") == "", F.lit(""))
        .when(F.col("listing_no") % 2 == 0, F.expr("substr(url, 19)"))
        .otherwise(F.col("url"))
    )
    return _listings(spark, folder).select("listing_no", resolve_url(href, SITE_B.base_url).alias("url"))


@checked(
    over_listings(
        "select listing_no, case when category is null then 'N/A' when image_url is null then '' "
        "when listing_no % 3 = 0 then 'N/A' else concat('https://b.example/', image_url) end as image_url "
        "from listings"
    )
)
def resolve_images(spark, folder):
    src = F.when(
        F.col("image_url").isNotNull() & (F.col("listing_no") % 3 == 0), F.lit("icon-no-photo.png")
    ).otherwise(F.col("image_url"))
    image = resolve_image(F.col("category").isNotNull(), src, SITE_B.base_url)
    return _listings(spark, folder).select("listing_no", image.alias("image_url"))


# --- one row per key ----------------------------------------------------------


def _firsts(df: DataFrame, key: str = "url") -> DataFrame:
    return dedup.first_per_key(df, key, [F.asc_nulls_last("scraped_at"), F.asc("listing_no")])


@checked(over_listings(f"select {NUMBERED_SQL} from firsts", FIRST))
def first_per_key(spark, folder):
    return _firsts(_listings(spark, folder)).select(*NUMBERED)


@checked(
    over_listings(
        "select url, listing_no, scraped_at from (select *, row_number() over (partition by url "
        "order by scraped_at, listing_no) as n from hot) where n = 1",
        "hot as (select listing_no, scraped_at, case when listing_no % 3 = 0 then "
        "'https://x.example/hot' else url end as url from listings)",
    )
)
def first_per_hot_key(spark, folder):
    """A third of the rows share one key."""
    hot = example.with_hot_url(_listings(spark, folder))
    return _firsts(hot).select("url", "listing_no", "scraped_at")


@checked(
    "select doc_id, lang, n_chars from (select *, row_number() over (partition by text order by doc_id) as n "
    "from documents) where n = 1"
)
def first_per_text(spark, folder):
    """Whole texts as keys, by digest, so that no text is shuffled."""
    documents = table(spark, folder, "documents").select(
        "doc_id", "lang", "n_chars", F.sha2("text", 256).alias("digest")
    )
    return dedup.first_per_key(documents, "digest", [F.asc("doc_id")]).select("doc_id", "lang", "n_chars")


@checked(over_listings("select distinct url from listings where url in (select url from stored)", STORED))
def known_keys(spark, folder):
    df = _listings(spark, folder)
    return dedup.known_keys(df, example.stored_part(df))


@checked(
    over_listings(
        f"select {NUMBERED_SQL} from listings l where url is not null and not exists "
        "(select 1 from stored s where s.url = l.url)",
        STORED,
    )
)
def drop_known(spark, folder):
    df = _listings(spark, folder)
    return dedup.drop_known(df, example.stored_part(df)).select(*NUMBERED)


@checked(
    over_listings(
        "select listing_no, url from hot where url not in (select url from hot where scraped_at < "
        f"{STORED_BEFORE})",
        "hot as (select listing_no, scraped_at, case when listing_no % 3 = 0 and scraped_at >= "
        f"{STORED_BEFORE} then 'https://x.example/hot' else url end as url from listings)",
    )
)
def drop_known_hot(spark, folder):
    """A new key on nearly a third of the rows, spread over eight tasks."""
    fresh_third = (F.col("listing_no") % 3 == 0) & (F.col("scraped_at") >= STORED_BEFORE)
    hot = _listings(spark, folder).withColumn(
        "url", F.when(fresh_third, F.lit("https://x.example/hot")).otherwise(F.col("url"))
    )
    return dedup.drop_known(hot, example.stored_part(hot), salts=8).select("listing_no", "url")


@checked(over_listings("select url from listings where url is not null except select url from stored", STORED))
def new_keys(spark, folder):
    df = _listings(spark, folder)
    return dedup.new_keys(df, example.stored_part(df))


@checked(over_listings("select distinct url from listings"))
def distinct_keys(spark, folder):
    return dedup.distinct_keys(_listings(spark, folder))


@checked(over_listings(f"select {NUMBERED_SQL} from listings"))
def merged_feeds_rows(spark, folder):
    """Union of two halves, the second with time as fractional seconds."""
    df = _listings(spark, folder).select(*NUMBERED)
    second = df.where(F.col("source") != SITE_A.tag).withColumn("timestamp", F.col("scraped_at") + F.lit(0.5))
    whole = parse.unify_time(second.drop("scraped_at"), "timestamp")
    return dedup.merged(df.where(F.col("source") == SITE_A.tag), whole)


# --- counts -------------------------------------------------------------------


@checked(
    over_listings(
        "select count(*) as total, count(*) filter (where url is null) as rejected, "
        "count(*) filter (where url is not null and url not in (select url from stored)) as new, "
        "count(*) filter (where url in (select url from stored)) as duplicates from listings",
        STORED,
    )
)
def batch_counts(spark, folder):
    df = _listings(spark, folder)
    return counts.batch_counts(df, example.stored_part(df))


@checked(over_listings("select count(*) as rows from listings"))
def row_count(spark, folder):
    return counts.row_count(_listings(spark, folder))


@checked(over_listings("select category, count(*) as rows from listings group by category"))
def category_counts(spark, folder):
    return counts.category_counts(_listings(spark, folder))


@checked(
    over_listings(
        "select l.source, l.category, count(*) as found, count(f.listing_no) as new from listings l "
        "left join (select * from firsts where url not in (select url from stored)) f "
        "on f.listing_no = l.listing_no group by l.source, l.category",
        FIRST.replace("listing_no) as n", "source, category nulls last, subcategory, title, listing_no) as n"),
        STORED,
    )
)
def feed_counts(spark, folder):
    df = _listings(spark, folder).select("source", "category", "subcategory", "title", "url", "scraped_at", "listing_no")
    return counts.feed_counts(df, example.stored_part(df))


@checked(over_listings("select 'Toutes' as value union all select distinct coalesce(category, 'Divers') from listings"))
def facet_category(spark, folder):
    return counts.facet(clean.fill_defaults(_listings(spark, folder)), "category")


@checked(over_listings("select 'Toutes' as value union all select distinct coalesce(location, 'Maroc') from listings"))
def facet_location(spark, folder):
    return counts.facet(clean.fill_defaults(_listings(spark, folder)), "location")


@checked(
    over_listings(
        f"select case when max({PRICE}) > 0 then max({PRICE}) else 100000 end as ceiling, "
        "count(*) as rows from listings"
    )
)
def price_ceiling(spark, folder):
    return counts.price_ceiling(clean.with_price_number(_listings(spark, folder)))


@checked(
    over_listings(
        "select category, substr(title, 1, 12) as title, price_text, location from listings "
        "order by scraped_at desc, listing_no limit 5"
    )
)
def preview(spark, folder):
    order = [F.desc("scraped_at"), F.asc("listing_no")]
    return counts.preview(_listings(spark, folder), order, size=12)


# --- the search screen --------------------------------------------------------


@checked(over_listings(f"select {NUMBERED_SQL} from listings order by scraped_at desc, listing_no limit 2000"))
def latest(spark, folder):
    return serve.latest(_listings(spark, folder).select(*NUMBERED), tie_break=["listing_no"])


@checked(
    "select o_orderkey, o_custkey, o_totalprice, o_orderpriority from orders "
    "order by o_orderdate desc, o_orderkey limit 2000"
)
def latest_of_table(spark, folder):
    orders = table(spark, folder, "orders")
    newest = serve.latest_of_table(orders, tie_break=["o_orderkey"], time="o_orderdate")
    return newest.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")


@checked(over_listings(f"select {SERVED_COLUMNS} from served", SERVED), "snapshot")
def served_snapshot(spark, folder):
    return _served(spark, folder)


def _search(name: str, condition: str, **criteria) -> None:
    def run(spark, folder):
        return serve.search(_served(spark, folder), **criteria)

    checked(over_listings(f"select {SERVED_COLUMNS} from served where {condition}", SERVED), name)(run)


_search("search_category", "category = '2-HIGH'", category="2-HIGH")
_search("search_location", "location = 'Maroc'", location="Maroc")
_search(
    "search_sources", "regexp_matches(lower(source), 'site a|autre')", sources=["site a", "autre"]
)
_search("search_sources_mixed_case", "regexp_matches(lower(source), 'site a|autre')", sources=["Site A", "AUTRE"])
_search("search_budget", "price_num <= 150000", budget=150000)
_search("search_keyword", "regexp_matches(title, '(?i)CUSTOMER#0+[1-4].* [fo]$')", keyword="CUSTOMER#0+[1-4].* [fo]$")
_search("search_literal", "contains(lower(title), '0 o')", keyword="0 O", literal=True)
_search("search_nothing", "true")
CRITERIA = {
    "category": "2-HIGH", "sources": ["site a", "siteb"], "budget": 300000.0, "keyword": "customer.*[of]$",
}
_ALL = (
    "category = '2-HIGH' and regexp_matches(lower(source), 'site a|siteb') and price_num <= 300000 "
    "and regexp_matches(title, '(?i)customer.*[of]$')"
)
_search("search_all", _ALL, **CRITERIA)


@checked(
    over_listings(
        "select cast(place as bigint) as place, cast(place % 3 as bigint) as slot, "
        "case when coalesce(image_url, '') in ('', 'N/A') then "
        "'https://via.placeholder.com/400x250?text=Image+Indisponible' else image_url end as image, "
        "case when contains(lower(source), 'site a') then 'first' else 'second' end as badge, source, title, "
        "case when price_text in ('N/A', '', '0') then 'Prix non spécifié' else price_text end as price, "
        "location, substr(date_text, 1, 10) as date, url from (select *, row_number() over "
        f"(order by scraped_at desc, listing_no) - 1 as place from served where {_ALL})",
        SERVED,
    )
)
def cards(spark, folder):
    df = _listings(spark, folder)
    return result_cards(df, "site a", "first", "second", ["listing_no"], **CRITERIA)


@checked(
    over_listings(
        "select cast(place as bigint) as place, cast(place % 3 as bigint) as slot, source, title, location, url "
        "from (select *, row_number() over (order by scraped_at desc, listing_no) - 1 as place from served)",
        SERVED.replace("limit 2000", "limit 3000"),
    )
)
def cards_3000(spark, folder):
    """A larger snapshot is numbered whole."""
    found = result_cards(_listings(spark, folder), "site a", "first", "second", ["listing_no"], rows=3000)
    return found.select("place", "slot", "source", "title", "location", "url")


@checked(over_listings("select 'Toutes' as value union all select distinct category from served", SERVED))
def screen_categories(spark, folder):
    return side_bar(snapshot(_listings(spark, folder), tie_break=["listing_no"]))["categories"]


@checked(over_listings("select 'Toutes' as value union all select distinct location from served", SERVED))
def screen_locations(spark, folder):
    return side_bar(snapshot(_listings(spark, folder), tie_break=["listing_no"]))["locations"]


@checked(
    over_listings(
        "select case when max(price_num) > 0 then max(price_num) else 100000 end as ceiling, count(*) as rows from served",
        SERVED,
    )
)
def screen_ceiling(spark, folder):
    return side_bar(snapshot(_listings(spark, folder), tie_break=["listing_no"]))["ceiling"]


@checked(
    over_listings(
        "select listing_no, case when coalesce(image_url, '') in ('', 'N/A') then "
        "'https://via.placeholder.com/400x250?text=Image+Indisponible' else image_url end as image, "
        "case when contains(lower(source), 'site a') then 'first' else 'second' end as badge, "
        "case when price_text in ('N/A', '', '0') then 'Prix non spécifié' else price_text end as price, "
        "substr(date_text, 1, 10) as date, substr(title, 1, 10) as label from listings"
    )
)
def shown_values(spark, folder):
    """Display rules on every listing."""
    return _listings(spark, folder).select(
        "listing_no",
        shown_image(F.col("image_url")).alias("image"),
        badge(F.col("source"), "site a", "first", "second").alias("badge"),
        shown_price(F.col("price_text")).alias("price"),
        shown_date(F.col("date_text")).alias("date"),
        label(F.col("title"), 10).alias("label"),
    )


@checked(
    "select doc_id, lang from documents where regexp_matches(text, '(?i)\\bénergie|été|the') and length(text) > 0"
)
def keyword_in_documents(spark, folder):
    """The keyword filter over whole texts, accents and letter case ignored."""
    documents = table(spark, folder, "documents").withColumn("title", F.col("text"))
    return serve.by_keyword(documents, r"\bénergie|été|the").select("doc_id", "lang")
