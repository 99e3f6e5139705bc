"""Reading HTML with regular expressions that run in the JVM.

A page is first turned into *markup* (``page_markup``): comments are gone, the text
of script-like elements stands as plain text, and character references are decoded.
Characters that would then look like markup are masked by Unicode noncharacters, so
that every later pattern may take ``<``, ``>`` and quotes at face value; ``unmask``
brings them back at the very end.

All loops over groups are possessive. The regex engine runs those as plain loops, so
a page with a megabyte-long tag costs time in proportion to its length and cannot
overflow the stack of a task.
"""

from __future__ import annotations

import re
import html.entities
import json
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from placeleads.constants import PLACE_LINK_MARK, Selector
from placeleads.functions import select
from placeleads.functions.text import bind, contains_any, if_not_empty, web_trim

# Elements whose content a browser takes as raw text, and one whose content it keeps
# out of the page.
_RAW = "(?i:script|style|noscript|iframe|noembed|noframes|xmp|template)"
# Elements that start a new line when a page is shown.
_BLOCK = (
    "(?i:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer"
    "|form|h[1-6]|header|hr|li|main|nav|ol|option|p|pre|section|table|td|th|tr|ul)"
)
# Elements without content.
_VOID = "(?i:area|base|br|col|embed|hr|img|input|link|meta|source|track|wbr)"

_NAME_END = r"(?=[\s/>])"
_QUOTED = r"""(?:"[^"]*+"|'[^']*+')"""
_ATTRS = rf"(?:[^>=]++|=\s*+{_QUOTED}?+)*+"
_TAG_END = r"(?:>|\z)"
_TAG = rf"<(?:/?[a-zA-Z]{_ATTRS}|[!?/][^>]*+){_TAG_END}"
_BLOCK_TAG = rf"</?{_BLOCK}{_NAME_END}{_ATTRS}{_TAG_END}"

_COMMENT = r"<!--(?:-?>|.*?(?:--!?>|\z))"
_RAW_OPEN = rf"<({_RAW}){_NAME_END}{_ATTRS}{_TAG_END}"
_RAW_ELEMENT = rf"{_RAW_OPEN}(.*?)(?:</(?i:\1){_NAME_END}{_ATTRS}{_TAG_END}|\z)"

# The body starts after its tag, or failing that after the head, or after the title.
_BEFORE_BODY = (
    rf"(?is)^(?:.*?<body{_NAME_END}{_ATTRS}{_TAG_END}"
    rf"|.*?</head{_NAME_END}[^>]*+{_TAG_END}|.*?</title{_NAME_END}[^>]*+{_TAG_END})"
)

_MARKUP_CHARS = "<>\"'"
_MASKS = "\ufdd0\ufdd1\ufdd2\ufdd3"
_TO_MASKS = str.maketrans(_MARKUP_CHARS, _MASKS)

# Names that work without a closing semicolon, as the HTML standard lists them.
_BARE_NAMES = "|".join(sorted(n for n in html.entities.html5 if not n.endswith(";")))
_REFERENCE = (
    r"&(?:#[0-9]++;?+|#[xX][0-9a-fA-F]++;?+|[a-zA-Z][a-zA-Z0-9]{1,31};"
    rf"|(?:{_BARE_NAMES})(?![=a-zA-Z0-9;]))"
)
_REFERENCE_NUMBER = r"(?i)^&#x?0*+([0-9a-f]{1,7});?\z"
_REPLACEMENT_CHAR = "\ufffd"
# Numbers 128 to 159 mean Windows-1252 characters.
_C1 = "".join(map(chr, range(128, 160)))
_WINDOWS = "".join(bytes([ord(c)]).decode("cp1252", errors="ignore") or c for c in _C1)

# One alternative per kind of token; the last two cover everything in between.
_TOKEN = (
    rf"(?s){_COMMENT}|{_RAW_ELEMENT}|{_REFERENCE}"
    rf"|(?:[^<&]++|<(?!!--|{_RAW}{_NAME_END}))++|."
)


def _named_chars() -> dict[str, str]:
    """Character of every reference with a name, the frequent names first."""
    first = ["amp;", "nbsp;", "quot;", "lt;", "gt;", "apos;"]
    first += [f"{n};" for n in html.entities.name2codepoint]
    names = dict.fromkeys(first) | dict.fromkeys(n for n in html.entities.html5 if n[-1] == ";")
    return {n[:-1]: html.entities.html5[n].translate(_TO_MASKS) for n in names}


def _numbered_char(token: Column) -> Column:
    digits = F.regexp_extract(token, _REFERENCE_NUMBER, 1)
    code = F.when(F.rlike(token, F.lit("^&#[xX]")), F.conv(digits, 16, 10)).otherwise(digits)

    def char(number: Column) -> Column:
        code_point = number.try_cast("bigint")
        is_char = code_point.between(1, 0xD7FF) | code_point.between(0xE000, 0x10FFFF)
        decoded = F.decode(F.unhex(F.lpad(F.hex(code_point), 8, "0")), "UTF-32")
        return F.when(is_char, F.translate(decoded, _C1 + _MARKUP_CHARS, _WINDOWS + _MASKS))

    return F.coalesce(if_not_empty(code, char), F.lit(_REPLACEMENT_CHAR))


def _decoded_reference(token: Column) -> Column:
    chars = F.from_json(F.lit(json.dumps(_named_chars())), "map<string,string>")
    named = F.coalesce(chars[F.regexp_extract(token, "[a-zA-Z0-9]+", 0)], token)
    return F.when(F.startswith(token, F.lit("&#")), _numbered_char(token)).otherwise(named)


def page_markup(page: Column, raw_text: bool = True) -> Column:
    """Markup of a page; ``raw_text=False`` leaves out the text of script-like elements."""
    raw_element = rf"(?s)^{_RAW_ELEMENT}"

    def render(token: Column) -> Column:
        # Tests read the start of a token only: most tokens are long runs of plain HTML.
        start = F.substring(token, 1, 12)
        raw = F.translate(F.regexp_extract(token, raw_element, 2), "<", _MASKS[0])
        return (
            F.when(F.startswith(token, F.lit("&")) & (token != "&"), _decoded_reference(token))
            .when(F.rlike(start, F.lit(f"^<(?:!--|(?i:template){_NAME_END})")), F.lit(""))
            .when(F.rlike(start, F.lit(f"^<{_RAW}{_NAME_END}")), raw if raw_text else F.lit(""))
            .otherwise(token)
        )

    tokens = F.regexp_extract_all(page, F.lit(_TOKEN), F.lit(0))
    return F.array_join(F.transform(tokens, render), "")


def unmask(text: Column) -> Column:
    return F.translate(text, _MASKS, _MARKUP_CHARS)


def _unmask_long(text: Column) -> Column:
    """The same where looking for the masks first pays: a translation that changes
    nothing costs much more than a search that finds nothing."""
    return bind(text, lambda t: F.when(contains_any(t, _MASKS), unmask(t)).otherwise(t))


def strip_tags(markup: Column, glue: str = "") -> Column:
    return F.regexp_replace(markup, _TAG, glue)


def body_markup(markup: Column) -> Column:
    return F.regexp_replace(markup, _BEFORE_BODY, "")


def text_content(markup: Column, glue: str = "") -> Column:
    """All text below the body, with ``glue`` where a tag was."""
    return _unmask_long(strip_tags(body_markup(markup), glue))


def visible_text(markup: Column) -> Column:
    """Text below the body as shown, a new line where a block starts or ends."""
    lines = F.regexp_replace(body_markup(markup), _BLOCK_TAG, "\n")
    return _unmask_long(strip_tags(lines))


def _attribute(name: str) -> str:
    return rf"[\s/](?i:{re.escape(name)})\s*+=\s*+"


def _up_to(attribute: str) -> str:
    """Everything in a tag before an attribute; quoted values are not looked into. Ends
    where another tag seems to start, so many tags without an end take linear time."""
    return rf"(?:(?!{attribute})(?:=\s*+{_QUOTED}|[^<>]))*+"


def _open_tag(selector: Selector) -> str:
    """Pattern of the opening tag; group 1 is the tag name."""
    name = f"(?i:{re.escape(selector.tag)})" if selector.tag else "[a-zA-Z][a-zA-Z0-9:-]*+"
    if selector.attr is None:
        return rf"<({name}){_NAME_END}{_ATTRS}{_TAG_END}"
    more = {'"': '[^"]*+', "'": "[^']*+", "": r"[^\s>]*+"} if selector.prefix else {}
    value = "|".join(
        rf"{q}{re.escape(selector.value)}{more.get(q, '')}{q}" + (r"(?=[\s>])" if q == "" else "")
        for q in ('"', "'", "")
    )
    attribute = rf"{_attribute(selector.attr)}(?:{value})"
    return rf"<({name})(?=[\s/]){_up_to(attribute)}{attribute}{_ATTRS}{_TAG_END}"


def _if_mentioned(markup: Column, selector: Selector, use: Column) -> Column:
    """``use``, unless the attribute value is nowhere in the markup: a search for a
    literal is much cheaper than one for a pattern."""
    if selector.value is None:
        return use
    return F.when(F.contains(markup, F.lit(selector.value)), use)


def has_element(markup: Column, selectors: tuple[Selector | str, ...]) -> Column:
    """True if any selector finds an element."""

    def has(s: Selector | str) -> Column:
        if isinstance(s, str):
            return F.size(select.elements(markup, s)) > 0
        return _if_mentioned(markup, s, F.rlike(markup, F.lit(_open_tag(s))))

    found = map(has, selectors)
    return reduce(or_, (F.coalesce(f, F.lit(False)) for f in found))


# Counts the pieces of a page up to the one that closes the first tag.
_START = "struct(0 as depth, 0 as used)"
_STEP = """(done, piece) -> if(done.used > 0 and done.depth = 0, done, struct(
    done.depth + case when piece.texts <> '' then 0 when piece.slashes = '/' then -1 else 1 end
        as depth,
    done.used + 1 as used))"""


def _element_by_depth(markup: Column, selector: Selector) -> Column:
    """Element from its opening tag to the end tag that balances it, without the tags
    of its own name in between."""

    def cut(rest: Column) -> Column:
        name = F.lower(F.regexp_extract(rest, "^<([^\\s/>]+)", 1))
        same_tag = F.concat(
            F.lit("(?is)<(/?)"),
            name,
            F.lit(rf"{_NAME_END}{_ATTRS}{_TAG_END}|((?:[^<]++|<(?!/?"),
            name,
            F.lit(rf"{_NAME_END}))++)"),
        )
        slashes = F.regexp_extract_all(rest, same_tag, F.lit(1))

        def join(texts: Column) -> Column:
            pieces = F.arrays_zip(slashes.alias("slashes"), texts.alias("texts"))
            used = F.call_function("aggregate", pieces, F.expr(_START), F.expr(_STEP))["used"]
            return F.array_join(F.slice(texts, F.lit(1), used), "")

        inner = bind(F.regexp_extract_all(rest, same_tag, F.lit(2)), join)
        return F.when(F.rlike(name, F.lit(rf"^{_VOID}$")), F.lit("")).otherwise(inner)

    rest = F.regexp_extract(markup, rf"(?s){_open_tag(selector)}.*+", 0)
    return if_not_empty(_if_mentioned(markup, selector, rest), cut)


def _element(markup: Column, selector: Selector | str) -> Column:
    """The first element a selector finds, with its tags; null if there is none. A text is a
    selector with steps (``functions.select``)."""
    if isinstance(selector, str):
        return F.get(select.elements(markup, selector), F.lit(0))["inner"]
    if selector.tag is None:
        return _element_by_depth(markup, selector)
    # Elements picked by tag name do not nest: the next tag of the kind ends them.
    same = "h[1-6]" if selector.tag in ("h1", "h2", "h3", "h4", "h5", "h6") else selector.tag
    end = rf"(?=(?i:</?{same}){_NAME_END}|\z)"
    element = F.regexp_extract(markup, rf"(?s){_open_tag(selector)}.*?{end}", 0)
    return if_not_empty(_if_mentioned(markup, selector, element))


def element_text(markup: Column, selectors: tuple[Selector | str, ...]) -> Column:
    """Text content of the element found by the first selector that finds one; null
    if none does."""
    return unmask(strip_tags(F.coalesce(*(_element(markup, s) for s in selectors))))


def trimmed_element_text(markup: Column, selectors: tuple[Selector, ...]) -> Column:
    return if_not_empty(web_trim(element_text(markup, selectors)))


def hrefs(markup: Column) -> Column:
    """Targets of all links, in page order, duplicates kept."""
    href = _attribute("href")
    value = rf"({_QUOTED}|[^\s\"'>]++)"
    link = rf"<(?i:a)(?=[\s/]){_up_to(href)}{href}{value}"
    found = F.regexp_extract_all(markup, F.lit(link), F.lit(1))
    return F.transform(found, lambda v: unmask(F.regexp_replace(v, "^[\"']|[\"']\\z", "")))


def page_links(markup: Column, mark: str = PLACE_LINK_MARK) -> Column:
    """Distinct link targets that contain ``mark``, in page order."""
    return F.array_distinct(F.filter(hrefs(markup), lambda v: F.contains(v, F.lit(mark))))


def lookup_text(markup: Column) -> Column:
    """Visible text followed by every link target that may hold a mail address. Takes
    markup without raw text."""
    mails = F.filter(
        hrefs(markup),
        lambda v: F.contains(v, F.lit("mailto:")) | F.contains(v, F.lit("@")),
    )
    return F.array_join(F.concat(F.array(visible_text(markup)), mails), " ")
