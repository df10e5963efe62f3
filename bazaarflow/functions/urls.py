"""Link expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bazaarflow.schema import MISSING, NO_PHOTO_MARK


def listing_url(base_url: str, list_id: Column, ad_id: Column) -> Column:
    return F.concat_ws("/", F.lit(base_url), F.coalesce(list_id, F.lit("")), ad_id)


def resolve_url(href: Column, base_url: str) -> Column:
    """Relative links get the base in front; empty and absolute ones stay."""
    absolute = (href == "") | href.startswith("http")
    return F.when(absolute, href).otherwise(F.concat(F.lit(base_url + "/"), href))


def resolve_image(tag_present: Column, src: Column, base_url: str) -> Column:
    """No tag: missing. No attribute: empty. Placeholder picture: missing."""
    src = F.coalesce(src, F.lit(""))
    return (
        F.when(~tag_present, F.lit(MISSING))
        .when((src == "") | src.startswith("http"), src)
        .when(src.contains(NO_PHOTO_MARK), F.lit(MISSING))
        .otherwise(F.concat(F.lit(base_url + "/"), src))
    )
