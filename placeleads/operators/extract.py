"""Captured pages to place records, and to links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeleads.constants import (
    CLOSED_PHRASES,
    PAGE_BLOCKED_DOMAINS,
    PLACE_LINK_MARK,
    SELECTORS,
    Selector,
)
from placeleads.functions import contact, html, url
from placeleads.functions.text import bind, contains_any
from placeleads.operators.dedup import is_lead

MALFORMED_URL = "malformed url"
MISSING_HTML = "missing html"


def quarantine_reason() -> Column:
    """Why no place can be read from a page; null if one can."""
    return F.when(~url.place_url_decodes(F.col("url")), MALFORMED_URL).when(
        F.col("html").isNull(), MISSING_HTML
    )


def readable_pages(pages: DataFrame) -> DataFrame:
    """Pages a place can be read from. The test needs only the URL and whether there
    is HTML, so it runs before anything is extracted."""
    return pages.where(url.place_url_decodes(F.col("url")) & F.col("html").isNotNull())


def quarantine(pages: DataFrame) -> DataFrame:
    """The other pages, with the reason, without their HTML.

    Two narrow scans instead of one wide one: the first leaves the HTML column alone,
    the second lets Parquet skip every row group without a missing one.
    """
    decodes = url.place_url_decodes(F.col("url"))
    malformed = pages.where(~decodes).withColumn("reason", F.lit(MALFORMED_URL)).drop("html")
    missing = pages.where(F.col("html").isNull() & decodes)
    return malformed.unionByName(missing.withColumn("reason", F.lit(MISSING_HTML)).drop("html"))


def place_records(
    pages: DataFrame,
    *,
    selectors: dict[str, tuple[Selector, ...]] = SELECTORS,
    closed_phrases: tuple[str, ...] = CLOSED_PHRASES,
    blocked_domains: tuple[str, ...] = PAGE_BLOCKED_DOMAINS,
    glue: str = "",
    for_leads: bool = False,
) -> DataFrame:
    """One place per page. Columns other than ``url`` and ``html`` are passed on.

    The steps are separate projections: each heavy text is computed once and read by
    the next step, and the HTML itself goes no further than this narrow stage.

    With ``for_leads``, a place that turns out to be no lead keeps its name only: the
    text of a page with a website is not read, nor are the address, phone and emails
    of a closed place. Use it where only leads are kept, after a dedup by name.
    """
    kept = [c for c in pages.columns if c not in ("url", "html")]
    markup, text = F.col("_markup"), F.col("_text")

    def needed(condition: Column, value: Column) -> Column:
        return F.when(condition, value) if for_leads else value

    step1 = pages.select(
        *kept,
        url.place_id(F.col("url")).alias("place_id"),
        html.page_markup(F.col("html")).alias("_markup"),
    )
    step2 = step1.select(
        "*",
        html.trimmed_element_text(markup, selectors["name"]).alias("name"),
        html.has_element(markup, selectors["website"]).alias("has_website"),
    )
    may_be_lead = ~F.col("has_website") & F.col("name").isNotNull()
    step3 = step2.select(
        "*", needed(may_be_lead, html.text_content(markup, glue)).alias("_text")
    )
    step4 = step3.select(
        "*", bind(F.lower(text), lambda t: ~contains_any(t, closed_phrases)).alias("is_active")
    )
    phone = F.coalesce(
        contact.extract_phone(html.element_text(markup, selectors["phone"])),
        contact.extract_phone(html.element_text(markup, selectors["panel"])),
    )
    address = html.trimmed_element_text(markup, selectors["address"])
    return step4.select(
        *kept,
        "name",
        needed(is_lead(), address).alias("address"),
        needed(is_lead(), phone).alias("phone"),
        needed(is_lead(), contact.extract_emails(text, blocked_domains)).alias("emails"),
        "has_website",
        "place_id",
        "is_active",
    )


def links(pages: DataFrame, mark: str = PLACE_LINK_MARK) -> DataFrame:
    """One row per distinct link of a page: ``link_pos`` and ``href``."""
    kept = [c for c in pages.columns if c not in ("url", "html")]
    found = html.page_links(html.page_markup(F.col("html")), mark)
    return pages.select(*kept, F.posexplode(found).alias("link_pos", "href"))
