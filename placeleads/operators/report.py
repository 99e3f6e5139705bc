"""Counts for the user."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F


def contact_summary(places: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Places with a phone, with an email, and all of them."""
    return places.groupBy(*(by or [])).agg(
        F.count_if(F.col("phone") != "").alias("with_phone"),
        F.count_if(F.size("emails") > 0).alias("with_email"),
        F.count("*").alias("total"),
    )


def results_envelope(places: DataFrame, query: str, location: str) -> DataFrame:
    """One row about a run: when, what, where and how many."""
    return places.agg(F.count("*").alias("total_found")).select(
        F.current_timestamp().alias("scraped_at"),
        F.lit(query).alias("query"),
        F.lit(location).alias("location"),
        "total_found",
    )


def links_per_query(links: DataFrame, query: list[str]) -> DataFrame:
    """Distinct links found per search. A search with a third of all links is counted
    by (search, link) first, which spreads it over the reducers."""
    distinct = links.select(*query, "href").distinct()
    return distinct.groupBy(*query).agg(F.count("*").alias("places_found"))


def running_unique(rows: DataFrame, key: str, query: str, run: list[str]) -> DataFrame:
    """Distinct keys seen in a run up to and including each of its searches.

    Only counts meet in a window: the last one has one row per search of a run, and a
    run has as many searches as its plan. Rows without a key count as found only.
    """
    per_query = rows.groupBy(*run, query, key).agg(F.count("*").alias("found"))
    # One row per search and key is left, so no key is larger than the plan.
    by_key = Window.partitionBy(*run, key).orderBy(query)
    is_first = (F.row_number().over(by_key) == 1) & F.col("_has_key")
    counted = (
        per_query.withColumn("_has_key", F.col(key).isNotNull())
        .withColumn("_first", is_first)
        .groupBy(*run, query)
        .agg(F.sum("found").alias("found"), F.count_if("_first").alias("new_unique"))
    )
    so_far = Window.partitionBy(*run).orderBy(query).rowsBetween(Window.unboundedPreceding, 0)
    return counted.withColumn("total_unique", F.sum("new_unique").over(so_far))


def progress_counts(pages: DataFrame, leads: DataFrame, by: list[str]) -> DataFrame:
    """Pages processed and leads found, per search."""
    processed = pages.groupBy(*by).agg(
        F.count("*").alias("processed"), F.lit(0).cast("bigint").alias("found")
    )
    found = leads.groupBy(*by).agg(
        F.lit(0).cast("bigint").alias("processed"), F.count("*").alias("found")
    )
    return (
        processed.unionByName(found)
        .groupBy(*by)
        .agg(F.sum("processed").alias("processed"), F.sum("found").alias("found"))
    )


def observe_progress(df: DataFrame, name: str, **metrics) -> tuple[DataFrame, Observation]:
    """Counts rows (and any further aggregates) while ``df`` is computed for another
    purpose; read ``observation.get`` after the action."""
    observation = Observation(name)
    counted = df.observe(observation, F.count("*").alias("rows"), *(
        column.alias(alias) for alias, column in metrics.items()
    ))
    return counted, observation
