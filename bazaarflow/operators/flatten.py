"""Nested section payloads to one row per ad."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarflow.functions.text import text_or
from bazaarflow.functions.urls import listing_url
from bazaarflow.schema import LISTING_FIELDS, MISSING, UNKNOWN_SECTION, Site

# Only the fields that are read: from_json skips everything else. Sections and
# ads stay texts until each is read alone, so a bad one costs only itself.
PAYLOAD_SCHEMA = "data struct<getListingSections: struct<sections: array<string>>>"
SECTION_SCHEMA = "title string, ads array<string>"
AD_SCHEMA = """
  adId string, listId string, title string, listTime string,
  category struct<name: string>,
  price struct<withCurrency: string>,
  location struct<city: struct<name: string>>,
  media struct<defaultImage: struct<paths: struct<standard: string>>>
"""
_SECTIONS = "data.getListingSections.sections"


def _sections(payloads: DataFrame, payload: str) -> DataFrame:
    kept = [name for name in payloads.columns if name != payload]
    body = F.from_json(payload, PAYLOAD_SCHEMA)
    parsed = payloads.select(*kept, F.col(payload).alias("_payload"), F.inline(F.array(F.struct(body.alias("_body")))))
    return parsed.select(*kept, "_payload", F.posexplode_outer(f"_body.{_SECTIONS}").alias("section_no", "_section"))


def sections(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per section, its ads as texts; the other columns of the payload row are kept."""
    kept = [name for name in payloads.columns if name != payload]
    found = _sections(payloads, payload).where(_is_object(F.col("_section")))
    return found.select(*kept, F.from_json("_section", SECTION_SCHEMA).alias("section"))


def _is_object(text: Column) -> Column:
    return F.coalesce(F.ltrim(text).startswith("{"), F.lit(False))


def unreadable_payloads(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """Payloads that are not JSON at all."""
    return payloads.where(F.try_parse_json(F.col(payload)).isNull())


def rejected_parts(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """What of the payloads gives no listing, down to the ad, with the reason and the text.

    Payloads that are no JSON or have no list of sections, sections that are no
    object or whose ads are no list, and ads that are no object. ``section_no`` and ``ad_no`` count
    from 0 and are null above their level. The other columns of the payload row are kept.
    """
    kept = [name for name in payloads.columns if name != payload]
    found = _sections(payloads, payload).withColumn("_read", F.from_json("_section", SECTION_SCHEMA))
    none = F.lit(None).cast("int")
    whole = found.where(F.col("section_no").isNull())
    listed = F.expr(f"try_variant_get(try_parse_json(_payload), '$.{_SECTIONS}', 'array<variant>')").isNotNull()
    reason = F.when(F.try_parse_json("_payload").isNull(), "not JSON").otherwise("no list of sections")
    # An empty list of sections is nothing bad.
    whole = whole.where(~F.coalesce(listed, F.lit(False))).select(*kept, none.alias("section_no"), none.alias("ad_no"), reason.alias("reason"), F.col("_payload").alias("record"))
    inner = found.where(F.col("section_no").isNotNull())
    has_ads = F.expr("variant_get(try_parse_json(_section), '$.ads', 'variant')").isNotNull()
    reason = F.when(~_is_object(F.col("_section")), "section is no object").when(F.col("_read.ads").isNull() & has_ads, "ads are no list")
    parts = inner.select(*kept, "section_no", none.alias("ad_no"), reason.alias("reason"), F.col("_section").alias("record")).where("reason is not null")
    ads = inner.where(_is_object(F.col("_section"))).select(*kept, "section_no", F.posexplode("_read.ads").alias("ad_no", "record"))
    bad = ads.where(~_is_object(F.col("record"))).select(*kept, "section_no", "ad_no", F.lit("ad is no object").alias("reason"), "record")
    return whole.unionByName(parts).unionByName(bad)


def ads_per_section(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    kept = [name for name in payloads.columns if name != payload]
    return sections(payloads, payload).select(
        *kept,
        text_or(F.col("section.title"), UNKNOWN_SECTION).alias("subcategory"),
        F.coalesce(F.size("section.ads"), F.lit(0)).cast("long").alias("ads"),
    )


def _has_id(ad_id: Column) -> Column:
    return ad_id.isNotNull() & ~ad_id.isin("", "0")


def flatten_sections(
    payloads: DataFrame,
    site: Site,
    payload: str = "payload",
    scraped_at: str | None = None,
    strict: bool = False,
) -> DataFrame:
    """One listing per ad that has an id.

    ``scraped_at`` names a column with the fetch time (default: now). With
    ``strict`` a JSON null differs from an absent field: only absent ones take
    the default, and an ad whose category, city or image paths are null is
    left out. Otherwise both take the default and the ad stays.
    """
    stamped = payloads.select(
        F.col(payload).alias("_payload"),
        (F.col(scraped_at) if scraped_at else F.unix_timestamp()).alias("scraped_at"),
    )
    ads = _strict_ads(stamped) if strict else _plain_ads(stamped)
    return ads.select(
        F.lit(site.tag).alias("source"),
        "category", "subcategory", "title", "price_text", "location",
        listing_url(site.base_url, F.col("list_id"), F.col("ad_id")).alias("url"),
        "image_url", "date_text", "scraped_at",
    ).select(*LISTING_FIELDS)


def _plain_ads(stamped: DataFrame) -> DataFrame:
    ads = (
        sections(stamped, "_payload")
        .select(
            "scraped_at",
            text_or(F.col("section.title"), UNKNOWN_SECTION).alias("subcategory"),
            F.explode("section.ads").alias("_ad"),
        )
        .where(_is_object(F.col("_ad")))
        # A generator, so that the filter on the id doesn't read the ad again.
        .select("scraped_at", "subcategory", F.inline(F.array(F.struct(F.from_json("_ad", AD_SCHEMA).alias("ad")))))
        .where(_has_id(F.col("ad.adId")))
    )
    return ads.select(
        "scraped_at",
        "subcategory",
        F.col("ad.adId").alias("ad_id"),
        F.col("ad.listId").alias("list_id"),
        text_or(F.col("ad.title"), MISSING).alias("title"),
        text_or(F.col("ad.category.name"), MISSING).alias("category"),
        text_or(F.col("ad.price.withCurrency"), MISSING).alias("price_text"),
        text_or(F.col("ad.location.city.name"), MISSING).alias("location"),
        text_or(F.col("ad.media.defaultImage.paths.standard"), MISSING).alias("image_url"),
        text_or(F.col("ad.listTime"), _now_text()).alias("date_text"),
    )


def _now_text() -> Column:
    return F.date_format(F.localtimestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


# --- strict form: VARIANT tells a null from an absent field -----------------


def _member(parent: str, path: str) -> Column:
    return F.expr(f"try_variant_get({parent}, '$.{path}', 'variant')")


def _absent(parent: str, path: str) -> Column:
    return _member(parent, path).isNull()


def _is_null(parent: str, path: str) -> Column:
    return F.coalesce(F.is_variant_null(_member(parent, path)), F.lit(False))


def _is_plain(parent: str, path: str) -> Column:
    """A text or number where an object belongs."""
    kind = F.schema_of_variant(_member(parent, path))
    return F.coalesce(~_is_null(parent, path) & ~kind.startswith("OBJECT"), F.lit(False))


def _strict_text(parent: str, path: str, default: Column | str) -> Column:
    """The field as text; the default when absent; NULL when it is null."""
    fallback = default if isinstance(default, Column) else F.lit(default)
    text = F.expr(f"try_variant_get({parent}, '$.{path}', 'string')")
    return F.when(_absent(parent, path), fallback).otherwise(text)


def _strict_ads(stamped: DataFrame) -> DataFrame:
    path = f"$.{_SECTIONS}"
    found = (
        stamped.select("scraped_at", F.try_parse_json(F.col("_payload")).alias("_body"))
        .select(
            "scraped_at",
            F.explode(F.expr(f"try_variant_get(_body, '{path}', 'array<variant>')")).alias("section"),
        )
        .select(
            "scraped_at",
            _strict_text("section", "title", UNKNOWN_SECTION).alias("subcategory"),
            F.explode(F.expr("try_variant_get(section, '$.ads', 'array<variant>')")).alias("ad"),
        )
    )
    unusable = (
        _is_null("ad", "category")
        | _is_null("ad", "location.city")
        | _is_null("ad", "media.defaultImage.paths")
        | _is_plain("ad", "category")
        | _is_plain("ad", "price")
        | _is_plain("ad", "location")
    )
    list_id = F.when(_is_null("ad", "listId"), F.lit("None")).otherwise(
        _strict_text("ad", "listId", "")
    )
    ad_id = _strict_text("ad", "adId", "")
    zero = (ad_id == "0") & (F.schema_of_variant(_member("ad", "adId")) != "STRING")
    has_id = ad_id.isNotNull() & (ad_id != "") & ~zero
    return found.where(has_id & ~unusable).select(
        "scraped_at",
        "subcategory",
        ad_id.alias("ad_id"),
        list_id.alias("list_id"),
        _strict_text("ad", "title", MISSING).alias("title"),
        _strict_text("ad", "category.name", MISSING).alias("category"),
        _strict_text("ad", "price.withCurrency", MISSING).alias("price_text"),
        _strict_text("ad", "location.city.name", MISSING).alias("location"),
        _strict_text("ad", "media.defaultImage.paths.standard", MISSING).alias("image_url"),
        _strict_text("ad", "listTime", _now_text()).alias("date_text"),
    )
