"""Searches and lookups that brought nothing, with the reason, in place of log lines.

A search or lookup whose capture failed costs its own results only. These reports name them, so
that they can be captured again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeleads.functions import contact
from placeleads.operators.extract import MISSING_HTML

NOT_CAPTURED = "not captured"


def _captured(pages: DataFrame, key: str) -> DataFrame:
    """Per key whether any of its pages has HTML; which columns has it is all that is read."""
    readable = F.max(F.col("html").isNotNull()).alias("_readable")
    return pages.where(F.col(key).isNotNull()).groupBy(key).agg(readable)


def _without(wanted: DataFrame, captured: DataFrame, key: str) -> DataFrame:
    reason = F.when(F.col("_readable").isNull(), NOT_CAPTURED).when(~F.col("_readable"), MISSING_HTML)
    joined = wanted.join(captured, key, "left").withColumn("reason", reason)
    return joined.where("reason is not null").drop("_readable")


def failed_searches(plan: DataFrame, result_pages: DataFrame) -> DataFrame:
    """The searches of a plan without a readable result page, with the ``reason``."""
    wanted = plan.select("location", "query_seq", "search_query")
    return _without(wanted, _captured(result_pages, "search_query"), "search_query").select(
        "location", "query_seq", "search_query", "reason"
    )


def failed_lookups(leads: DataFrame, lookup_pages: DataFrame) -> DataFrame:
    """The lookups that leads without an email needed and that have no readable page: each once,
    with the number of ``leads`` and the ``reason``. ``leads`` are those before enrichment."""
    query = contact.lookup_query(F.col("name"), F.col("address")).alias("lookup_query")
    needed = leads.where((F.size("emails") == 0) & F.col("name").isNotNull()).select(query)
    wanted = needed.groupBy("lookup_query").agg(F.count("*").alias("leads"))
    return _without(wanted, _captured(lookup_pages, "lookup_query"), "lookup_query").select(
        "lookup_query", "leads", "reason"
    )
