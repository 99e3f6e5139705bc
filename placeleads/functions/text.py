"""Text rules shared by all extractors."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as web pages see it: Java's ``\s`` knows only the ASCII part of it.
WEB_SPACE = (
    r"\t-\r \x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"
)

# The look-ahead gets over most characters at once; the look-behind makes a long inner
# run of spaces cost one visit, not one per space.
_EDGE_SPACE = rf"^[{WEB_SPACE}]++|(?![!-~])(?<![{WEB_SPACE}])[{WEB_SPACE}]++\z"


def web_space(pattern: str) -> str:
    """Widens every ``\\s`` of a pattern, in a class or not, to the whitespace of the web."""
    wide, in_class = [], False
    for part in re.findall(r"(?s)\\.|.", pattern):
        if part == r"\s":
            part = WEB_SPACE if in_class else f"[{WEB_SPACE}]"
        elif part in "[]":
            in_class = part == "["
        wide.append(part)
    return "".join(wide)


def web_trim(text: Column) -> Column:
    return F.regexp_replace(text, _EDGE_SPACE, "")


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it,
    and only when the result is asked for. Written out, a value that is mentioned
    twice may be computed twice."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def if_not_empty(text: Column, use: Callable[[Column], Column] | None = None) -> Column:
    """``use(text)``, or the text itself; null if it is empty or null. Binds the text."""
    kept = F.call_function("filter", F.array(text), F.expr("t -> t <> ''"))
    return F.get(F.transform(kept, use) if use else kept, F.lit(0))


def contains_any(text: Column, parts: tuple[str, ...] | list[str]) -> Column:
    """True if the text contains one of the literal parts; stops at the first hit. For
    long texts: a search for a literal is much quicker than one for a pattern."""
    return reduce(or_, (F.contains(text, F.lit(part)) for part in parts), F.lit(False))


def mentions_any(text: Column, parts: tuple[str, ...] | list[str]) -> Column:
    """The same for short texts and many parts, as one small expression."""
    return F.rlike(text, F.lit("|".join(map(re.escape, parts)))) if parts else F.lit(False)
