"""Canonical listing schema, wire names, limits and fixed values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

TEXT_FIELDS = [
    "source", "category", "subcategory", "title", "price_text",
    "location", "url", "image_url", "date_text",
]
KEY = "url"
TIME = "scraped_at"
LISTING_FIELDS = TEXT_FIELDS + [TIME]

LISTING = T.StructType(
    [T.StructField(name, T.StringType()) for name in TEXT_FIELDS]
    + [T.StructField(TIME, T.LongType())]
)

# --- Fixed values: names in messages and in the relational target ----------
WIRE_NAMES = {
    "source": "source",
    "category": "category",
    "subcategory": "sous_categorie",
    "title": "titre",
    "price_text": "prix",
    "location": "localisation",
    "url": "url",
    "image_url": "image_url",
    "date_text": "date_text",
    "scraped_at": "timestamp_scraped",
}

# --- Fixed values: length limits of the target (characters) ----------------
MAX_LENGTHS = {
    "source": 50,
    "category": 100,
    "subcategory": 100,
    "price_text": 50,
    "location": 100,
    "url": 768,
    "date_text": 100,
}

# --- Fixed values: markers, defaults and labels ----------------------------
MISSING = "N/A"
UNKNOWN_SECTION = "Unknown"
DEFAULT_LOCATION = "Maroc"
DEFAULT_CATEGORY = "Divers"
ALL_LABEL = "Toutes"
NO_PRICE_LABEL = "Prix non spécifié"
NO_IMAGE_URL = "https://via.placeholder.com/400x250?text=Image+Indisponible"
NO_PHOTO_MARK = "icon-no-photo"
AD_SLOT_CLASS = "adslistingpos"
RECENT_MARKS = ["Aujourd'hui", "cnt-today", "Hier", "Yesterday"]
RECENT_DAYS = 3
SNAPSHOT_ROWS = 2000
DEFAULT_CEILING = 100000.0
GRID_COLUMNS = 3
PREVIEW_ROWS = 5

# --- Fixed values: short French month names; other words count as month 1 --
MONTHS = {
    "Jan": 1, "Fév": 2, "Mar": 3, "Avr": 4, "Mai": 5, "Juin": 6,
    "Juil": 7, "Aoû": 8, "Sep": 9, "Oct": 10, "Nov": 11, "Déc": 12,
}
# Full French month names, understood unless strict mode is asked for.
FULL_MONTHS = {
    "Janvier": 1, "Février": 2, "Mars": 3, "Avril": 4, "Juillet": 7,
    "Août": 8, "Septembre": 9, "Octobre": 10, "Novembre": 11, "Décembre": 12,
}


@dataclass(frozen=True)
class Feed:
    """One message feed: its name and how its messages carry ingest time."""

    name: str
    time_field: str
    time_type: T.DataType

    @property
    def message_schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(WIRE_NAMES[name], T.StringType()) for name in TEXT_FIELDS]
            + [T.StructField(self.time_field, self.time_type)]
        )


# The two message shapes differ only in the ingest-time field.
FEED_A = Feed("site_a", "timestamp_scraped", T.LongType())
FEED_B = Feed("site_b", "timestamp", T.DoubleType())


@dataclass(frozen=True)
class Site:
    """Tag written to ``source`` and the address that relative links hang on."""

    tag: str
    base_url: str
