"""Links and place ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from placeleads.constants import SITE_HOST
from placeleads.functions.text import if_not_empty

# Percent escapes that form whole UTF-8 sequences; anything else cannot be decoded.
_CONT = "%[89ab][0-9a-f]"
_WELL_FORMED = (
    "(?i)^(?:[^%]++"
    "|%[0-7][0-9a-f]"
    f"|%(?:c[2-9a-f]|d[0-9a-f]){_CONT}"
    f"|%e0%[ab][0-9a-f]{_CONT}"
    f"|%(?:e[1-9a-c]|e[ef]){_CONT}{_CONT}"
    f"|%ed%[89][0-9a-f]{_CONT}"
    f"|%f0%[9ab][0-9a-f]{_CONT}{_CONT}"
    f"|%f[1-3]{_CONT}{_CONT}{_CONT}"
    f"|%f4%8[0-9a-f]{_CONT}{_CONT}"
    r")*+\z"
)

# Characters that a URL component keeps but ``url_encode`` escapes.
_KEPT_IN_COMPONENT = {"+": "%20", "%21": "!", "%27": "'", "%28": "(", "%29": ")", "%7E": "~"}


def _place_segment(url: Column) -> Column:
    return F.regexp_extract(url, "place/([^/]+)", 1)


def place_url_decodes(url: Column) -> Column:
    """False if the place part of the URL holds escapes that cannot be decoded."""
    return F.coalesce(F.rlike(_place_segment(url), F.lit(_WELL_FORMED)), F.lit(True))


def place_id(url: Column) -> Column:
    """Decoded URL segment after ``place/``, up to the first slash; null if there is none."""
    escaped = F.replace(_place_segment(url), F.lit("+"), F.lit("%2B"))
    return if_not_empty(F.regexp_extract(F.try_url_decode(escaped), "^[^/]*", 0))


def absolute_url(link: Column, host: str = SITE_HOST) -> Column:
    return F.when(F.startswith(link, F.lit("http")), link).otherwise(F.concat(F.lit(host), link))


def url_component(text: Column) -> Column:
    """Percent-encodes a text for use inside a query string."""
    encoded = F.url_encode(text)
    for escape, char in _KEPT_IN_COMPONENT.items():
        encoded = F.replace(encoded, F.lit(escape), F.lit(char))
    return encoded
