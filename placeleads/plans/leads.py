"""The two pipelines, from captured pages to leads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeleads.constants import PLACE_LINK_MARK, SITE_HOST
from placeleads.functions import url
from placeleads.operators.dedup import dedup_by_place, first_sightings, first_wins, slim
from placeleads.operators.enrich import enrich_emails, lookup_emails
from placeleads.operators.extract import links, place_records, readable_pages


def find_leads(
    pages: DataFrame,
    lookup_pages: DataFrame | None = None,
    *,
    order: list[str] | None = None,
    run: list[str] | None = None,
    lookup_options: dict | None = None,
    keys: tuple[str, ...] = ("name",),
    **extract_options,
) -> DataFrame:
    """Leads of one search whose place pages were captured in ``order``; with ``run``,
    of one search per value of these columns. Places are the same if they agree in ``keys``,
    without regard to case: ``("name", "address")`` keeps the branches of a chain apart."""
    order, run = order or ["page_id"], run or []
    only_names = keys == ("name",)
    places = place_records(readable_pages(pages), for_leads=only_names, **extract_options)
    first = first_sightings(places, order, run, keys).where("lead is not null")
    leads = first.select(*order, *run, "lead.*").select(*places.columns)
    return _with_emails(leads, lookup_pages, lookup_options)


def _with_emails(
    leads: DataFrame, lookup_pages: DataFrame | None, lookup_options: dict | None
) -> DataFrame:
    if lookup_pages is None:
        return leads
    return enrich_emails(leads, lookup_emails(lookup_pages, **(lookup_options or {})))


def searched_links(
    result_pages: DataFrame, plan: DataFrame, mark: str = PLACE_LINK_MARK
) -> DataFrame:
    """Links of captured result pages, with the number of their search.

    Links are read before the join, so the HTML is not shuffled. Both sides are narrow and
    shuffled; the adaptive skew join splits a search with very many links.
    """
    found = links(result_pages, mark)
    numbered = plan.select("location", "query_seq", "search_query")
    return found.join(numbered.hint("merge"), "search_query")


def first_link_sightings(searched: DataFrame, host: str = SITE_HOST) -> DataFrame:
    """Each place URL of a run where it was first seen. Later sightings lead to the
    same page, whose name is known by then, so they cannot add a place."""
    absolute = searched.withColumn("url", url.absolute_url(F.col("href"), host))
    return first_wins(
        absolute, ["location", "url"], ["query_seq", "page_id", "link_pos"]
    ).drop("href")


def find_leads_by_plan(
    plan: DataFrame,
    result_pages: DataFrame,
    pages: DataFrame,
    lookup_pages: DataFrame | None = None,
    *,
    mark: str = PLACE_LINK_MARK,
    host: str = SITE_HOST,
    lookup_options: dict | None = None,
    keys: tuple[str, ...] = ("name",),
    **extract_options,
) -> DataFrame:
    """Leads of a subdivided search: every location of the plan is a run of its own.
    ``keys`` as in ``find_leads``.

    A place page is joined to the links that led to it after it was reduced to its
    record, one per URL, or to its name if it cannot be a lead. On the other side a URL
    has at most one link per location. With very many locations that can be a hot key:
    both sides are shuffled for the join, so the adaptive skew join can split it.
    """
    narrow = result_pages.select("page_id", "search_query", "html")
    sightings = first_link_sightings(searched_links(narrow, plan, mark), host).select(
        "location", "query_seq", F.col("page_id").alias("result_page_id"), "link_pos", "url"
    )
    captured = pages.select("page_id", "url", "html")
    target = captured.withColumn("url", url.absolute_url(F.col("url"), host))
    addressed = readable_pages(target).withColumn("page_url", F.col("url"))
    records = place_records(addressed, for_leads=keys == ("name",), **extract_options)
    by_url = first_wins(slim(records, ["page_url", "page_id"], keys), ["page_url"], ["page_id"])
    linked = sightings.withColumn("_key", F.concat(F.lit("url "), F.col("url"))).drop("url")
    reached = by_url.withColumn("_key", F.concat(F.lit("url "), F.col("page_url"))).drop("page_url")
    visited = linked.join(reached, "_key").drop("_key")
    order = ["query_seq", "result_page_id", "link_pos"]
    first = first_wins(visited, ["location", "name_key"], order).where("lead is not null")
    leads = first.select("location", *order, "page_id", "lead.*")
    found = _with_emails(leads, lookup_pages, lookup_options)
    return dedup_by_place(found, order, ["location"]).drop("place_key")
