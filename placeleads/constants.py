"""Fixed values. They must stay as they are for results to agree; every one is a
default of a keyword argument somewhere, so callers can pass their own."""

from __future__ import annotations

from dataclasses import dataclass

# Establishment categories, in search order.
CATEGORIES = (
    "restaurants",
    "bars",
    "pubs",
    "cafes",
    "coffee shops",
    "bistros",
    "taverns",
    "diners",
    "eateries",
    "tapas bars",
    "wine bars",
    "cocktail bars",
    "breweries",
    "food trucks",
    "pizzerias",
    "fast food",
    "takeaway",
    "bakeries",
    "ice cream shops",
    "juice bars",
)

# Words put before and after an area name, in search order.
DIRECTIONS = ("North", "South", "East", "West", "Central")
AREA_SUFFIXES = (
    "downtown",
    "old town",
    "city center",
    "historic center",
    "business district",
    "commercial area",
    "industrial area",
    "residential area",
    "suburbs",
    "outskirts",
)
NEARBY = "near"
MAX_AREA_SEARCHES = 5
CATCH_ALL_QUERY = "businesses"

# Phrases that mark a closed place (compared in lower case).
CLOSED_PHRASES = (
    "permanently closed",
    "cerrado permanentemente",
    "temporarily closed",
    "cerrado temporalmente",
    "business has closed",
    "no longer in business",
    "this place is closed",
)

# Mail domains dropped from page text, and from lookup text.
PAGE_BLOCKED_DOMAINS = ("example.com", "google.com", "gstatic.com", "googleapis.com")
LOOKUP_BLOCKED_DOMAINS = (
    "example.com",
    "google.com",
    "gstatic.com",
    "googleapis.com",
    "schema.org",
    "w3.org",
    "facebook.com",
    "twitter.com",
    "duckduckgo.com",
    "bing.com",
    "yahoo.com",
    "microsoft.com",
    "apple.com",
    "amazon.com",
    "instagram.com",
    "linkedin.com",
    "youtube.com",
    "whatsapp.com",
    "tripadvisor.com",
)
PREFERRED_DOMAIN = "gmail.com"

# Host put before relative links, and the mark of a place link.
SITE_HOST = "https://www.google.com"
PLACE_LINK_MARK = "/maps/place/"

# Phone patterns in order of trial, and the digits a phone needs.
# ``\s`` stands for the whitespace of the web (see functions.text.WEB_SPACE).
PHONE_PATTERNS = (
    r"\+?\d{1,4}[-.\s]?\(?\d{1,4}\)?[-.\s]?\d{1,4}[-.\s]?\d{1,9}",
    r"\(\d{3}\)\s*\d{3}[-.\s]?\d{4}",
    r"\d{3}[-.\s]\d{3}[-.\s]\d{4}",
)
MIN_PHONE_DIGITS = 7

# An email address, and the character class of its local part.
EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
EMAIL_LOCAL = r"a-zA-Z0-9._%+-"


@dataclass(frozen=True)
class Selector:
    """Picks elements by tag name, by one attribute, or by both."""

    tag: str | None = None
    attr: str | None = None
    value: str | None = None
    prefix: bool = False


# Which elements hold which field; the first present one is used.
SELECTORS = {
    "name": (Selector("h1"),),
    "address": (
        Selector("button", "data-item-id", "address"),
        Selector(None, "data-tooltip", "Copy address"),
    ),
    "phone": (
        Selector("button", "data-item-id", "phone:", prefix=True),
        Selector(None, "data-tooltip", "Copy phone number"),
    ),
    "website": (
        Selector("a", "data-item-id", "authority"),
        Selector(None, "data-tooltip", "Open website"),
    ),
    "panel": (Selector(None, "role", "main"),),
}

# The list of results of a search, of which the first present one is used, its items
# and its links, as selectors with steps.
RESULT_SELECTORS = {
    "container": (
        'div[role="feed"]',
        'div[aria-label*="Results"]',
        "div.section-layout",
        '#pane div[role="region"]',
    ),
    "item": ('div[role="feed"] > div > div[jsaction]',),
    "link": ('a[href*="/maps/place/"]',),
}
