"""Emails from captured lookup pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeleads.constants import LOOKUP_BLOCKED_DOMAINS, PREFERRED_DOMAIN
from placeleads.functions import contact, html
from placeleads.operators.dedup import first_wins


def lookup_emails(
    lookup_pages: DataFrame,
    *,
    blocked_domains: tuple[str, ...] = LOOKUP_BLOCKED_DOMAINS,
    preferred_domain: str = PREFERRED_DOMAIN,
) -> DataFrame:
    """The email of every lookup query, from its first captured page. The email is
    read where the page is scanned, so that no HTML is shuffled."""
    keys = ["lookup_id", "lookup_query"]
    found = contact.lookup_candidates(F.col("_text"), blocked_domains)
    emails = (
        lookup_texts(lookup_pages)
        .select(*keys, found.alias("_found"))
        .select(*keys, contact.preferred_email(F.col("_found"), preferred_domain).alias("lookup_email"))
    )
    return first_wins(emails, ["lookup_query"], ["lookup_id"]).drop("lookup_id")


def lookup_texts(lookup_pages: DataFrame) -> DataFrame:
    """The text of every lookup page in which emails are looked for, as ``_text``."""
    keys = ["lookup_id", "lookup_query"]
    markup = html.page_markup(F.col("html"), raw_text=False)
    return lookup_pages.select(*keys, markup.alias("_markup")).select(
        *keys, html.lookup_text(F.col("_markup")).alias("_text")
    )


def enrich_emails(leads: DataFrame, lookup_emails: DataFrame) -> DataFrame:
    """Gives every lead without an email the one of its lookup query, if there is one.

    All rows take part in the join, those with an email too: nulling their key would
    send them all to one reducer. For the same reason a row without a name gets a hash
    as its key. Names are distinct by now, hence so are, but for rare cases, the lookup
    queries; the other side holds one row per query. Still, a chain without a city may be
    a lead of very many runs. The keys are made after the last shuffle of both sides, so
    the join shuffles them anew and the adaptive skew join can split such a key.
    """
    columns = leads.columns
    query = F.concat(F.lit("query "), contact.lookup_query(F.col("name"), F.col("address")))
    stand_in = F.concat(F.lit("none "), F.xxhash64(*columns).cast("string"))
    keyed = leads.withColumn("_key", F.coalesce(query, stand_in))
    found = lookup_emails.select(
        F.concat(F.lit("query "), F.col("lookup_query")).alias("_key"), "lookup_email"
    )
    use = F.col("name").isNotNull() & (F.size("emails") == 0) & F.col("lookup_email").isNotNull()
    return (
        keyed.join(found, "_key", "left")
        .withColumn("emails", F.when(use, F.array("lookup_email")).otherwise(F.col("emails")))
        .select(*columns)
    )
