"""Phones, emails and the pieces of a lookup query."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from placeleads.constants import (
    EMAIL,
    EMAIL_LOCAL,
    LOOKUP_BLOCKED_DOMAINS,
    MIN_PHONE_DIGITS,
    PAGE_BLOCKED_DOMAINS,
    PHONE_PATTERNS,
    PREFERRED_DOMAIN,
)
from placeleads.functions.text import bind, if_not_empty, mentions_any, web_space, web_trim

_ENOUGH_DIGITS = rf"(?s)^(?:\D*+\d){{{MIN_PHONE_DIGITS}}}.*+\z"

# A match starts where a run of local-part characters starts, or right after the
# previous match. Same matches as the plain pattern, but a long run without an
# ``@`` is read once instead of once per character.
_EMAIL = (
    rf"(?:\G|(?<![{EMAIL_LOCAL}])){EMAIL}"
)


def extract_phone(text: Column, patterns: tuple[str, ...] = PHONE_PATTERNS) -> Column:
    """First match of the first pattern whose first match has enough digits, else null."""

    def try_all(bound: Column) -> Column:
        matches = (F.regexp_extract(bound, web_space(p), 0) for p in patterns)
        return F.coalesce(*(if_not_empty(F.regexp_extract(m, _ENOUGH_DIGITS, 0)) for m in matches))

    return bind(text, try_all)


def email_matches(text: Column) -> Column:
    """All email-like matches in order, duplicates kept; empty for null."""
    found = F.regexp_extract_all(text, F.lit(_EMAIL), F.lit(0))
    return F.when(F.contains(text, F.lit("@")), found).otherwise(
        F.array().cast("array<string>")
    )


def _drop_blocked(emails: Column, blocked: tuple[str, ...] | list[str]) -> Column:
    if not blocked:
        return emails
    return F.filter(emails, lambda e: ~mentions_any(F.lower(e), blocked))


def extract_emails(
    text: Column, blocked: tuple[str, ...] | list[str] = PAGE_BLOCKED_DOMAINS
) -> Column:
    """Distinct emails in order of first sight, without the blocked domains."""
    return F.array_distinct(_drop_blocked(email_matches(text), blocked))


def lookup_candidates(
    text: Column, blocked: tuple[str, ...] | list[str] = LOOKUP_BLOCKED_DOMAINS
) -> Column:
    """Emails of a lookup page without the blocked domains, duplicates kept."""
    return _drop_blocked(email_matches(text), blocked)


def preferred_email(candidates: Column, preferred: str = PREFERRED_DOMAIN) -> Column:
    """First candidate of the preferred mail host, else the first candidate, else null."""
    liked = F.filter(candidates, lambda e: F.contains(F.lower(e), F.lit(preferred)))
    return F.coalesce(F.get(liked, F.lit(0)), F.get(candidates, F.lit(0)))


def address_city(address: Column) -> Column:
    """Second-to-last comma part of an address; empty if there is none."""
    part = F.try_element_at(F.split(address, ","), F.lit(-2))
    return F.coalesce(web_trim(part), F.lit(""))


def lookup_query(name: Column, address: Column) -> Column:
    return F.concat(name, F.lit(" "), address_city(address), F.lit(" email"))
