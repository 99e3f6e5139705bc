"""Explicit schemas; nothing is inferred from files."""

from __future__ import annotations

from pyspark.sql import types as T

PAGE = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)

RESULT_PAGE = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("search_query", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)

LOOKUP_PAGE = T.StructType(
    [
        T.StructField("lookup_id", T.LongType()),
        T.StructField("lookup_query", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)

# One place, as a column set. The same fields under their document names follow.
PLACE = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("phone", T.StringType()),
        T.StructField("emails", T.ArrayType(T.StringType())),
        T.StructField("has_website", T.BooleanType()),
        T.StructField("place_id", T.StringType()),
        T.StructField("is_active", T.BooleanType()),
    ]
)
DOCUMENT_NAMES = {"has_website": "hasWebsite", "place_id": "placeId", "is_active": "isActive"}

DOCUMENT_PLACE = T.StructType(
    [T.StructField(DOCUMENT_NAMES.get(f.name, f.name), f.dataType) for f in PLACE.fields]
)

DOCUMENT = T.StructType(
    [
        T.StructField("scrapedAt", T.TimestampType()),
        T.StructField("query", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("totalFound", T.LongType()),
        T.StructField("lastUpdated", T.TimestampType()),
        T.StructField("results", T.ArrayType(DOCUMENT_PLACE)),
    ]
)

# What the lead stream writes: first sightings, leads and rejected ones, and quarantined pages.
STREAM_ROW = T.StructType(
    [T.StructField("page_id", T.LongType()), T.StructField("name_key", T.StringType())]
    + PLACE.fields
    + [
        T.StructField("url", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("seen_at", T.TimestampType()),
        T.StructField("run", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("kind", T.StringType()),
    ]
)

# What a store of results holds: places and one row about each run.
STORE_PLACE = T.StructType([*PLACE.fields, T.StructField("run_id", T.LongType())])
STORE_RUN = T.StructType(
    [
        T.StructField("scraped_at", T.TimestampType()),
        T.StructField("query", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("total_found", T.LongType()),
        T.StructField("run_id", T.LongType()),
    ]
)
