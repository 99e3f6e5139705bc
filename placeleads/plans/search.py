"""Search plans: which texts to search for, made of locations and categories.

Everything is an array expression on the row of a location, so a plan needs no join
and no shuffle, whatever the number of locations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeleads.constants import (
    AREA_SUFFIXES,
    CATCH_ALL_QUERY,
    CATEGORIES,
    DIRECTIONS,
    MAX_AREA_SEARCHES,
    NEARBY,
)
from placeleads.functions.text import web_trim


def location_area(location: Column) -> Column:
    """First comma part of a location."""
    return web_trim(F.get(F.split(location, ","), F.lit(0)))


def location_country(location: Column) -> Column:
    """The other comma parts, trimmed; empty if there are none."""
    parts = F.transform(F.split(location, ","), web_trim)
    return F.array_join(F.slice(parts, F.lit(2), F.size(parts)), ", ")


def _country_end(location: Column) -> Column:
    country = location_country(location)
    return F.when(country != "", F.concat(F.lit(", "), country)).otherwise("")


def sub_locations(location: Column) -> Column:
    """The location itself, then its directions, area kinds and surroundings."""
    area, end = location_area(location), _country_end(location)
    return F.array(
        location,
        *(F.concat(F.lit(f"{d} "), area, end) for d in DIRECTIONS),
        *(F.concat(area, F.lit(f" {s}"), end) for s in AREA_SUFFIXES),
        F.concat(F.lit(f"{NEARBY} "), area, end),
    )


def zone_locations(location: Column, zones: int = 10) -> Column:
    """The location itself, then its numbered districts, zones and areas."""
    area, end = location_area(location), _country_end(location)

    if zones < 1:
        return F.array(location)

    def numbered(kind: str, i: Column) -> Column:
        return F.concat(area, F.lit(f" {kind} "), i.cast("string"), end)

    def numbers(last: int) -> Column:
        return F.sequence(F.lit(1), F.lit(last))

    pairs = F.transform(numbers(zones), lambda i: F.array(numbered("district", i), numbered("zone", i)))
    areas = F.transform(numbers(min(zones, MAX_AREA_SEARCHES)), lambda i: numbered("area", i))
    return F.concat(F.array(location), F.flatten(pairs), areas)


def search_texts(
    location: Column,
    *,
    include_directions: bool = True,
    include_districts: bool = True,
    include_zones: bool = False,
    zone_count: int = 5,
    categories: tuple[str, ...] | list[str] = CATEGORIES,
) -> Column:
    """Ordered distinct search texts of a location: every variant with every category.
    Either of the first two options brings in all of ``sub_locations``."""
    variants = [F.array(location)]
    if include_directions or include_districts:
        variants.append(sub_locations(location))
    if include_zones:
        variants.append(zone_locations(location, zone_count))
    kinds = F.array(*(F.lit(c) for c in categories)).cast("array<string>")
    texts = F.transform(
        F.array_distinct(F.concat(*variants)),
        lambda place: F.transform(kinds, lambda kind: F.concat(kind, F.lit(" in "), place)),
    )
    return F.array_distinct(F.flatten(texts))


def search_plan(locations: DataFrame, location: str = "location", **options) -> DataFrame:
    """One row per search of every location, numbered in search order."""
    return locations.select(
        "*",
        F.posexplode(search_texts(F.col(location), **options)).alias("query_seq", "search_query"),
    )


def category_dimension(
    df: DataFrame, categories: tuple[str, ...] | list[str] = CATEGORIES
) -> DataFrame:
    """Every row of ``df`` with every category, numbered."""
    kinds = F.array(*(F.lit(c) for c in categories))
    return df.select("*", F.posexplode(kinds).alias("cat_seq", "category"))


def search_text(query: Column, location: Column) -> Column:
    """Text of a single search; a blank query means any business."""
    asked = F.when(web_trim(query) != "", query).otherwise(CATCH_ALL_QUERY)
    return F.concat(asked, F.lit(" in "), location)


def plan_preview(
    locations: DataFrame, location: str = "location", shown: int = 5, **options
) -> DataFrame:
    """First searches of every plan, and how many more there are."""
    texts = F.col("_texts")
    return (
        locations.withColumn("_texts", search_texts(F.col(location), **options))
        .select(
            *locations.columns,
            F.greatest(F.size(texts) - shown, F.lit(0)).alias("more"),
            F.posexplode(F.slice(texts, 1, shown)).alias("query_seq", "search_query"),
        )
    )
