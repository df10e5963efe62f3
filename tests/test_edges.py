"""Edge cases on small literal frames."""

import json
import random

import pytest
from pyspark.sql import functions as F

from bazaarflow.functions.dates import is_recent
from bazaarflow.functions.text import price_number, shown_image, shown_price, source_key
from bazaarflow.functions.urls import resolve_image, resolve_url
from bazaarflow.operators import clean, counts, dedup, flatten, html_items, page_tree, parse, serve
from bazaarflow.plans import example_listings
from bazaarflow.schema import FEED_A, FEED_B, LISTING_FIELDS, Site
from bazaarflow.sources.streams import topic_options
from bazaarflow.sources.tables import pages as category_pages

SITE = Site("tag", "base")


def values(df, column):
    return [row[column] for row in df.collect()]


def listing_rows(spark, *rows):
    """Listings from dicts, other fields NULL."""
    schema = "n int, " + ", ".join(
        f"{name} {'bigint' if name == 'scraped_at' else 'string'}" for name in LISTING_FIELDS
    )
    full = [[n, *[row.get(name) for name in LISTING_FIELDS]] for n, row in enumerate(rows)]
    return spark.createDataFrame(full, schema)


@pytest.mark.parametrize(
    "text, number",
    [
        ("1 500 DH", 1500.0), ("N/A", 0.0), ("", 0.0), (None, 0.0), ("1.500,50 DH", 150050.0),
        ("12345678901234567890 DH", 1.2345678901234567e19),
    ],
)
def test_price_number(spark, text, number):
    df = spark.createDataFrame([(text,)], "p string")
    assert df.select(price_number(F.col("p"))).first()[0] == number


def test_source_key(spark):
    df = spark.createDataFrame([("Site A",), (None,)], "s string")
    assert values(df.select(source_key(F.col("s")).alias("k")), "k") == ["sitea", "none"]


def test_unreadable_messages_are_set_aside(spark):
    raw = spark.createDataFrame(
        [("nope",), ('[{"url":"a"}]',), ('{"url":"u","timestamp_scraped":1.5}',), (None,),
         ('{"titre":"t"}',), ('{"url":"v","prix":12,"autre":1}',)],
        "value string",
    )
    parsed = parse.parse_messages(raw, FEED_A)
    good = {row.url: row for row in parse.accepted(parsed).collect()}
    assert set(good) == {"u", "v"}
    assert good["u"].scraped_at is None and good["v"].price_text == "12"
    reasons = {row.raw: row.reason for row in parse.rejected(parsed).collect()}
    assert reasons == {
        "nope": "unreadable message", '[{"url":"a"}]': "unreadable message",
        None: "empty message", '{"titre":"t"}': "no key",
    }
    flagged = parsed.where("broken is not null and url is not null")
    assert values(flagged, "url") == ["u"]


def test_fractional_time_is_cut_off(spark):
    raw = spark.createDataFrame(
        [('{"url":"a","timestamp":1.99}',), ('{"url":"b","timestamp":NaN}',)], "value string"
    )
    found = {r.url: r.scraped_at for r in parse.parse_messages(raw, FEED_B).collect()}
    assert found == {"a": 1, "b": None}


def test_messages_carry_nulls(spark):
    df = listing_rows(spark, {"url": "u", "scraped_at": 5, "title": "é"})
    sent = json.loads(bytes(parse.to_messages(df).first().value))
    assert sent["url"] == "u" and sent["titre"] == "é" and sent["timestamp_scraped"] == 5
    assert sent["prix"] is None and len(sent) == 10


@pytest.mark.parametrize(
    "href, url",
    [("", ""), ("http://a", "http://a"), ("x/y", "base/x/y"), ("/x", "base//x"), (None, None)],
)
def test_resolve_url(spark, href, url):
    df = spark.createDataFrame([(href,)], "h string")
    assert df.select(resolve_url(F.col("h"), "base")).first()[0] == url


@pytest.mark.parametrize(
    "present, src, image",
    [
        (False, None, "N/A"), (True, None, ""), (True, "p/icon-no-photo.png", "N/A"),
        (True, "i/1.jpg", "base/i/1.jpg"), (True, "https://c/1.jpg", "https://c/1.jpg"),
        (True, "https://c/icon-no-photo.jpg", "https://c/icon-no-photo.jpg"),
    ],
)
def test_resolve_image(spark, present, src, image):
    df = spark.createDataFrame([(present, src)], "p boolean, s string")
    assert df.select(resolve_image(F.col("p"), F.col("s"), "base")).first()[0] == image


@pytest.mark.parametrize(
    "text, strict, kept",
    [
        ("15 Juin 1999", True, True), ("14 Juin 1999", True, True), ("13 Juin 1999", True, True),
        ("12 Juin 1999", True, False), ('<b class="cnt-today">10:00</b>', True, True),
        ("Hier 10:00", True, True), ("Aujourd'hui", True, True), ("Yesterday", True, True),
        ("31 Fév 2024", True, False), ("10 Juillet 1999", True, False), ("10 Juillet 1999", False, True),
        ("15 Déc 1999", True, True), ("sans date", True, False), (None, True, False),
        ("vers 1 Mai 1999 ou 1 Mai 2001", True, False), ("", True, False),
    ],
)
def test_recent(spark, text, strict, kept):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(is_recent(F.col("t"), "1999-06-15 12:00:00", strict=strict)).first()[0] is kept


def test_recent_without_a_clock_uses_now(spark):
    df = spark.createDataFrame([("1 Jan 2999",), ("1 Jan 1999",)], "t string")
    assert values(clean.recent_only(df, "t"), "t") == ["1 Jan 2999"]


def payload(**ad):
    return json.dumps({"data": {"getListingSections": {"sections": [{"title": "S", "ads": [ad]}]}}})


FULL_AD = {
    "adId": 7, "listId": 3, "title": "T", "listTime": "2024-01-01", "category": {"name": "C"},
    "price": {"withCurrency": "1 DH"}, "location": {"city": {"name": "V"}},
    "media": {"defaultImage": {"paths": {"standard": "i"}}},
}


def flat(spark, *payloads, strict=False):
    df = spark.createDataFrame([(p,) for p in payloads], "payload string")
    return flatten.flatten_sections(df, Site("a", "b"), strict=strict).collect()


@pytest.mark.parametrize("strict", [False, True])
def test_full_ad(spark, strict):
    row = flat(spark, payload(**FULL_AD), strict=strict)[0]
    assert row.url == "b/3/7" and row.category == "C" and row.price_text == "1 DH"
    assert row.location == "V" and row.image_url == "i" and row.subcategory == "S"
    assert row.scraped_at is not None and row.date_text == "2024-01-01"


@pytest.mark.parametrize("strict", [False, True])
def test_absent_levels_give_no_rows(spark, strict):
    empty = ["{}", '{"data":{}}', '{"data":{"getListingSections":{"sections":[{"title":"x","ads":[]}]}}}', "bad"]
    assert flat(spark, *empty, strict=strict) == []


@pytest.mark.parametrize("strict", [False, True])
def test_ads_without_id_are_left_out(spark, strict):
    ads = [dict(FULL_AD, adId=value) for value in (None, "", 0)] + [{"title": "x"}]
    assert flat(spark, *[payload(**ad) for ad in ads], strict=strict) == []


@pytest.mark.parametrize("strict", [False, True])
def test_defaults_of_absent_fields(spark, strict):
    row = flat(spark, payload(adId="1"), strict=strict)[0]
    assert row.url == "b//1" and row.title == "N/A" and row.category == "N/A"
    assert (row.price_text, row.location, row.image_url) == ("N/A", "N/A", "N/A")
    assert row.date_text is not None
    untitled = '{"data":{"getListingSections":{"sections":[{"ads":[{"adId":"1"}]}]}}}'
    assert flat(spark, untitled, strict=strict)[0].subcategory == "Unknown"


def test_nulls_in_payloads(spark):
    nulls = {
        "title": dict(FULL_AD, title=None), "price": dict(FULL_AD, price=None),
        "category": dict(FULL_AD, category=None), "city": dict(FULL_AD, location={"city": None}),
        "paths": dict(FULL_AD, media={"defaultImage": {"paths": None}}),
        "list": dict(FULL_AD, listId=None),
    }
    plain = {name: flat(spark, payload(**ad)) for name, ad in nulls.items()}
    strict = {name: flat(spark, payload(**ad), strict=True) for name, ad in nulls.items()}
    assert plain["title"][0].title == "N/A" and strict["title"][0].title is None
    assert plain["price"][0].price_text == strict["price"][0].price_text == "N/A"
    assert plain["category"][0].category == "N/A" and strict["category"] == []
    assert plain["city"][0].location == "N/A" and strict["city"] == []
    assert plain["paths"][0].image_url == "N/A" and strict["paths"] == []
    assert plain["list"][0].url == "b//7" and strict["list"][0].url == "b/None/7"
    text_zero = payload(**dict(FULL_AD, adId="0"))
    assert flat(spark, text_zero) == [] and len(flat(spark, text_zero, strict=True)) == 1


def test_unreadable_payloads(spark):
    df = spark.createDataFrame([("bad",), ("{}",), (None,)], "payload string")
    assert values(flatten.unreadable_payloads(df), "payload") == ["bad", None]


PAGE = """<html><head><script>"<ul class='cars-list'><li>x</li></ul>"</script></head><body>
<ul class="cars-list">
 <li class="x adslistingpos"><a href="ad"><h3>Ad</h3></a><span class="date">Hier</span></li>
 <li><a href="c/1.html"><h3> Un <b>titre</b> &eacute;t&eacute; </h3></a><span class="date"> Hier </span>
  <span class="price">45 000 DH</span><span class="location">Rabat</span><em class="views">Voitures</em>
  <img class="lazy" data-original="images/1.jpg"></li>
 <li><a href="http://z/2"></a><p class="small date">10 Juin 1999</p></li>
 <li><a href="old"><h3>Old</h3></a><span class="date">1 Jan 1990</span></li>
 <li><a href="nodate"><h3>None</h3></a></li>
 <li><span class="date">Hier</span>no link</li>
 <li><a>bare</a><span class="date cnt-today">10:00</span><img class="lazy"></li>
</ul><ul class="other"><li><a href="o"><h3>O</h3></a><span class="date">Hier</span></li></ul></body></html>"""


@pytest.mark.parametrize("reader", ["tolerant", "native"])
def test_extract_items(spark, reader):
    df = spark.createDataFrame([("Autos", PAGE), ("Autos", None), ("Autos", "")], "category string, html string")
    rows = html_items.extract_items(df, SITE, reader=reader, as_of="1999-06-12 12:00:00").collect()
    found = {row.url: row for row in rows}
    assert set(found) == {"base/c/1.html", "http://z/2", ""}
    first = found["base/c/1.html"]
    assert first.title == "Untitreété" and first.price_text == "45 000 DH"
    assert first.location == "Rabat" and first.subcategory == "Voitures"
    assert first.image_url == "base/images/1.jpg" and first.date_text == "Hier"
    second = found["http://z/2"]
    assert (second.title, second.price_text, second.location) == ("N/A", "N/A", "N/A")
    assert second.subcategory == "Autos" and second.image_url == "N/A"
    assert found[""].image_url == "" and found[""].title == "N/A"


def test_readers_give_the_same_fields(spark):
    df = spark.createDataFrame([(1, PAGE)], "page int, html string")
    tolerant = html_items.read_items(df).orderBy("item_no").collect()
    native = html_items.read_items(df, reader="native").orderBy("item_no").collect()
    for one, other in zip(tolerant, native, strict=True):
        assert [c for c in one.classes if c] == [c for c in other.classes if c]
        for name in set(html_items.RAW_FIELDS) - {"classes"}:
            assert one[name] == other[name], name


def test_nested_and_unclosed_markup(spark):
    page = (
        '<ul class="cars-list"><li><ul><li>in</li></ul><a href="1"><h3>A</h3></a>'
        '<span class="date">Hier</span></li><li><br/><a href="2"><h3>B<!-- no --></h3>'
        '<span class="date">Hier</ul><p>after'
    )
    df = spark.createDataFrame([("c", page)], "category string, html string")
    rows = html_items.extract_items(df, SITE).collect()
    assert {(r.url, r.title) for r in rows} == {("base/1", "A"), ("base/2", "B")}


def test_kept_columns_pass_untouched(spark):
    df = spark.createDataFrame([(1, None, PAGE), (2, 2**60 + 1, PAGE)], "p int, big bigint, html string")
    big = {row.p: row.big for row in html_items.read_items(df).collect()}
    assert big == {1: None, 2: 2**60 + 1}


def test_category_pages(spark):
    df = spark.createDataFrame([("s/a/1", "x"), ("s/b/1", "y"), ("s/c/1", "z")], "page_url string, html string")
    found = category_pages(df, {"L'auto": "s/a", "Immo": "s/b"})
    assert {(r.category, r.html) for r in found.collect()} == {("L'auto", "x"), ("Immo", "y")}


def test_fill_defaults(spark):
    df = listing_rows(spark, {}, {"location": "N/A", "category": "N/A"})
    rows = clean.fill_defaults(df).orderBy("n").collect()
    assert [(r.location, r.category) for r in rows] == [("Maroc", "Divers"), ("N/A", "N/A")]


def test_lengths(spark):
    rows = [{"price_text": "x" * 51}, {"url": "u" * 769}, {"url": "é" * 768, "price_text": "p" * 50}]
    df = listing_rows(spark, *rows)
    assert values(clean.valid_lengths(df), "n") == [2]
    assert {r.n: r.too_long for r in clean.invalid_lengths(df).collect()} == {0: ["price_text"], 1: ["url"]}


def test_first_per_key(spark):
    df = listing_rows(
        spark, {"url": "a", "scraped_at": 2}, {"url": "a", "scraped_at": 1}, {"url": "a"},
        {"url": None, "scraped_at": 1}, {"url": None, "scraped_at": 1, "title": "t"}, {"url": "b"},
    )
    once = dedup.first_per_key(df)
    assert sorted(values(once, "n")) == [1, 3, 5]
    assert sorted(values(dedup.first_per_key(once), "n")) == [1, 3, 5]


@pytest.mark.parametrize("stored", [[], ["a", None]])
def test_drop_known_never_passes_a_missing_key(spark, stored):
    batch = listing_rows(spark, {"url": "a"}, {"url": "b"}, {"url": None})
    target = spark.createDataFrame([(u,) for u in stored], "url string")
    expected = [1] if stored else [0, 1]
    assert sorted(values(dedup.drop_known(batch, target), "n")) == expected
    assert sorted(values(dedup.known_keys(batch, target), "url")) == ([] if not stored else ["a"])
    counted = counts.batch_counts(batch, target).first()
    assert (counted.total, counted.rejected, counted.new, counted.duplicates) == (
        3, 1, len(expected), 2 - len(expected)
    )


def test_counts_of_nothing(spark):
    nothing = listing_rows(spark, {"url": "a"}).where("false")
    row = counts.batch_counts(nothing, nothing).first()
    assert (row.total, row.rejected, row.new, row.duplicates) == (0, 0, 0, 0)
    assert counts.price_ceiling(clean.with_price_number(nothing)).first().ceiling == 100000


def test_price_ceiling_without_prices(spark):
    df = clean.with_price_number(listing_rows(spark, {"price_text": "N/A"}))
    assert counts.price_ceiling(df).first().ceiling == 100000


def test_facet_order(spark):
    df = listing_rows(spark, {"category": "b"}, {"category": "É"}, {"category": "a"}, {"category": "a"})
    assert values(counts.facet(df, "category"), "value") == ["Toutes", "a", "b", "É"]


def test_search_sources(spark):
    df = listing_rows(spark, {"source": "Site A.com"}, {"source": None}, {"source": "other"})
    assert values(serve.by_sources(df, []), "n") == [0, 1, 2]
    assert values(serve.by_sources(df, ["site a", "x"]), "n") == [0]


def test_search_keyword(spark):
    df = listing_rows(spark, {"title": "MULTIMÉDIA"}, {"title": None}, {"title": "C++ été"})
    assert values(serve.by_keyword(df, "multimédia"), "n") == [0]
    assert values(serve.by_keyword(df, ""), "n") == [0, 1, 2]
    assert values(serve.by_keyword(df, "c++", literal=True), "n") == [2]
    assert values(serve.by_keyword(df, r"\bÉté\b"), "n") == [2]


def test_search_budget(spark):
    df = clean.with_price_number(listing_rows(spark, {"price_text": ""}, {"price_text": "500"}, {"price_text": "501"}))
    assert values(serve.by_budget(df, 500), "n") == [0, 1]


def test_search_without_criteria_is_identity(spark):
    df = listing_rows(spark, {"url": "a"}, {})
    assert serve.search(df) is df


def test_latest_puts_missing_time_last(spark):
    df = listing_rows(spark, {"scraped_at": None}, {"scraped_at": 1}, {"scraped_at": 3, "url": "b"}, {"scraped_at": 3, "url": "a"})
    assert values(serve.latest(df), "n") == [3, 2, 1, 0]
    assert values(serve.latest(df, 2), "n") == [3, 2]


@pytest.mark.parametrize("size", [1, 2, 3, 4, 9])
def test_latest_of_table(spark, tmp_path, size):
    rows = [{"scraped_at": t, "url": u} for t, u in [(None, "n"), (1, "a"), (3, "c"), (3, "b")]]
    listing_rows(spark, *rows).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    found = serve.latest_of_table(stored, size)
    assert values(found, "n") == values(serve.latest(stored, size), "n")
    pushed = "GreaterThanOrEqual(scraped_at" in found._jdf.queryExecution().toString()
    assert pushed == (size <= 3)


def test_salted_drop_known(spark):
    batch = listing_rows(spark, *[{"url": u} for u in ["a", "a", "b", "b", "c", None]]).repartition(4)
    target = spark.createDataFrame([("a",), ("a",), (None,)], "url string")
    assert sorted(values(dedup.drop_known(batch, target, salts=3), "n")) == [2, 3, 4]


def test_unmatched_end_tags(spark):
    page = '</div></ul><ul class="cars-list"></p><li><a href="1"><h3>A</h3></div></a></li></ul>'
    df = spark.createDataFrame([(page,)], "html string")
    assert [(r.item_no, r.title, r.href) for r in html_items.read_items(df).collect()] == [(0, "A", "1")]


def test_very_deep_page(spark):
    page = "<div>" * 50000 + '<ul class="cars-list"><li><a href="1">x' + "</p>" * 50000
    df = spark.createDataFrame([(page,)], "html string")
    assert values(html_items.read_items(df), "href") == ["1"]


def test_cards(spark):
    df = listing_rows(spark, *[{"url": str(n), "scraped_at": n, "source": "The TAG"} for n in range(5)], {"url": "x"})
    rows = serve.cards(df, "tag", "one", "two").orderBy("place").collect()
    assert [r.slot for r in rows] == [0, 1, 2, 0, 1, 2]
    assert [r.url for r in rows] == ["4", "3", "2", "1", "0", "x"]
    assert rows[0].badge == "one" and rows[5].badge == "two"


def test_shown_values(spark):
    df = spark.createDataFrame([("0",), ("",), ("N/A",), ("5 DH",), (None,)], "v string")
    assert values(df.select(shown_price(F.col("v")).alias("p")), "p") == ["Prix non spécifié"] * 3 + ["5 DH", None]
    images = values(df.select(shown_image(F.col("v")).alias("p")), "p")
    assert images[0] == "0" and images[3] == "5 DH" and images[1] == images[2] == images[4]


def test_topic_options():
    options = topic_options("h:1", "t", "earliest", max_offsets=10, min_partitions=64)
    assert options == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest",
        "failOnDataLoss": "false", "maxOffsetsPerTrigger": "10", "minPartitions": "64",
    }


def _tree(node):
    """The tree in values, each piece of text by itself."""
    inner = [c if isinstance(c, str) else ("comment", c.text) if isinstance(c, page_tree.Comment) else _tree(c) for c in node.children]
    return node.tag, list(node.attributes.items()), node.classes, inner


def test_plain_pages_give_the_parser_s_tree():
    """Pages of odd and plain pieces, against the library's parser; plain ones never meet it."""
    rng = random.Random(3)
    pieces = [
        "<ul>", "</ul>", "<li class=\"a b\">", "</li>", "<li>", "<br>", "<br/>", "<img class=\"lazy\" src=\"x\" />", "<p id=\"a&amp;b\">", "<p id=\"a&lt;b\">", "<a href=\"\">", "<a href>", "<a href=x>",
        "</a>", "</p>", "</b >", "<B>", "</B>", "<!-- c -->", "<!---->", "<!-->", "<!--a--->", "<!-- a-b -->", "<!DOCTYPE html>", "<!x>", "<?p?>", "<![if x]>", "a", " b ", "&amp;", "&am", "&notit;", "&", "é", "<", ">", "\"",
        "\n", "<script>", "</script>", "<script>var t=\"<ul><li>no</li></ul>\";</script>", "<script>a<!-- </script>", "<style>p{}</style>", "</style>", "</SCRIPT>", "<title>t &amp; u</title>", "<title>", "</title>", "<textarea>", "</textarea>",
        "<a href=\"x\"title=\"y\">", "<a\nclass=\"c\"\t>", "<a class=\"c\" class=\"d\">", "<div/>", "<div>", "</div>", "<x-y>", "<h3> T</h3>", "</", "</>", "<script src=\"s\"></script>", "<style/>", "<p id=\"a>b\">", "\r\n", "\x00",
    ]
    plain = 0
    for n in range(6000):
        html = "".join(rng.choices(pieces, k=rng.randint(0, 3 + n % 9)))
        fast = page_tree._read_plain(html)
        builder = page_tree._Builder()
        builder.feed(html)
        builder.close()
        plain += fast is not None
        assert fast is None or _tree(fast) == _tree(builder.root), html
    assert plain > 500


def test_site_pages_are_plain(spark, folder):
    """The pages that the queries read need no general parser, whose time decides the largest runs."""
    made = example_listings.item_pages(example_listings.listings(spark, folder)).limit(5).collect()
    assert made and all(page_tree._read_plain(r.html) is not None for r in made)
