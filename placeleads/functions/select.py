"""Elements by selector: tags, ids, classes, attributes, children and descendants.

A selector is compiled to one pattern per step, which a tag matches or not. The page is then read
once: a fold over its tags keeps the stack of open elements, each with the steps that lead to
it. Elements whose end tag may be left out (``</p>``, ``</li>``, ``</td>`` and the like) end where
HTML says they do; an end tag without a start is passed over. All of it is built-in functions.
Works on the markup of ``html.page_markup``, in which texts hold no ``<``.

Supported: ``tag``, ``*``, ``#id``, ``.class``, ``[name]``, ``[name="value"]`` with ``=``, ``^=``,
``$=``, ``*=`` and ``~=``, any of them together, and between steps a blank (descendant) or ``>``
(child). Alternatives in order are a sequence of selectors, not a comma.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from placeleads.functions.text import bind, if_not_empty

_SPACE = r"[\t\n\f\r ]"
_VALUE = r"\"[^\"]*+\"|'[^']*+'|[^\s\"'>]++"
_ATTRIBUTES = rf"(?:[^>\"'=]++|={_SPACE}*+(?:{_VALUE})|[\"'=])*+"
_TAGS = rf"(?s)(</?[a-zA-Z](?:[^\s/>]*+)(?:[\s/]{_ATTRIBUTES})?>)([^<]*+(?:<(?!/?[a-zA-Z])[^<]*+)*+)"

# Elements without content, and which open elements a start tag ends, if
# none of the second list was opened since.
VOID = "area base br col embed hr img input link meta source track wbr".split()
_BLOCKS = (
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hr main menu nav ol p pre section table ul"
).split()
IMPLIED_ENDS = {
    "li": ("li", "ul ol menu"),
    "dt": ("dt dd", "dl"),
    "dd": ("dt dd", "dl"),
    "option": ("option", "select datalist"),
    "optgroup": ("option optgroup", "select"),
    "td": ("td th", "tr table"),
    "th": ("td th", "tr table"),
    "tr": ("tr", "table"),
    "thead": ("thead tbody tfoot", "table"),
    "tbody": ("thead tbody tfoot", "table"),
    "tfoot": ("thead tbody tfoot", "table"),
    **dict.fromkeys(_BLOCKS, ("p", "button table td th caption")),
}

_STEP = re.compile(
    r"\s*(?P<child>>)?\s*(?P<tag>[a-zA-Z][\w-]*|\*)?(?P<more>(?:[#.][\w-]+|\[[^\]]+\])*)"
)
_PART = re.compile(
    r"(?P<kind>[#.])(?P<word>[\w-]+)|\[\s*(?P<name>[\w:-]+)\s*(?:(?P<op>[*^$~]?=)\s*"
    r"(?:\"(?P<a>[^\"]*)\"|'(?P<b>[^']*)'|(?P<c>[^\]\s]+))\s*)?\]"
)


def compile_selector(selector: str) -> list[tuple[str, bool]]:
    """Per step the pattern of its tags, and whether it must be a child of the step before."""
    steps, at, text = [], 0, selector.strip()
    while at < len(text):
        step = _STEP.match(text, at)
        if step is None or step.end() == at or not (step["tag"] or step["more"]):
            raise ValueError(f"not a selector: {selector!r}")
        parts = [_attribute_pattern(p) for p in _PART.finditer(step["more"])]
        tag = "[a-z][^\\s/>]*+" if step["tag"] in (None, "*") else re.escape(step["tag"].lower())
        steps.append((rf"(?is)^<{tag}(?=[\s/>])" + "".join(parts), bool(step["child"])))
        at = step.end()
    if not steps or steps[0][1]:
        raise ValueError(f"not a selector: {selector!r}")
    return steps


def _attribute_pattern(part: re.Match) -> str:
    """Looks ahead for an attribute; quoted values are not looked into."""
    name, op = part["name"], part["op"]
    value = next((part[k] for k in ("a", "b", "c") if part[k] is not None), None)
    if part["kind"]:
        name, op = ("id", "=") if part["kind"] == "#" else ("class", "~=")
        value = part["word"]
    at = rf"[\s/]{re.escape(name)}"
    before = rf"(?:(?!{at}{_SPACE}*+[=\s/>])(?:={_SPACE}*+(?:{_VALUE})|[^>]))*+"
    if op is None:
        return rf"(?={before}{at}{_SPACE}*+[=\s/>])"
    exact = f"(?-i:{re.escape(value)})"

    def inside(other: str) -> str:
        some = rf"{other}*"
        return {
            "=": exact,
            "^=": exact + some,
            "$=": some + exact,
            "*=": some + exact + some,
            "~=": rf"(?:{some}{_SPACE})?{exact}(?:{_SPACE}{some})?",
        }[op]

    quoted = rf"\"{inside('[^\"]')}\"|'{inside(chr(91) + chr(94) + chr(39) + chr(93))}'"
    return rf"(?={before}{at}{_SPACE}*+={_SPACE}*+(?:{quoted}|{inside('[^\\s\"' + chr(39) + '>]')}(?=[\s>])))"


# Elements nested deeper, as only hostile pages have them, count as empty; browsers do alike.
DEEPEST = 512
_OPEN = "array<struct<name:string,steps:int,above:int,at:int>>"
_DONE = "array<struct<at:int,stop:int>>"


def _longer(done: Column, more: Column) -> Column:
    return F.when(F.size(more) > 0, F.concat(done, more)).otherwise(done)


def _names(names: str) -> Column:
    return F.array(*map(F.lit, names.split()))


def _fold(tags: Column, steps: list[tuple[str, bool]]) -> Column:
    """Places of the elements found: the tag that opens each and the one that ends it."""
    last = 1 << (len(steps) - 1)
    ends = F.create_map(*(x for n, (e, _) in IMPLIED_ENDS.items() for x in (F.lit(n), _names(e))))
    bars = F.create_map(*(x for n, (_, b) in IMPLIED_ENDS.items() for x in (F.lit(n), _names(b))))
    first = sum(1 << i for i, _ in enumerate(steps) if i == 0)
    child = sum(1 << i for i, (_, c) in enumerate(steps) if i and c)
    below = sum(1 << i for i, (_, c) in enumerate(steps) if i and not c)

    def top_of(stack: Column, names: Column) -> Column:
        """Number, from the top, of the innermost element with one of the names; 0 if none."""
        hits = F.filter(
            F.transform(stack, lambda e, i: F.when(F.array_contains(names, e["name"]), i + 1)),
            lambda n: n.isNotNull(),
        )
        return F.coalesce(F.get(hits, F.lit(0)), F.lit(0))

    def without(state: Column, count: Column, stop: Column) -> Column:
        """The state without the ``count`` innermost elements."""
        gone = F.filter(F.slice(state["stack"], F.lit(1), count), lambda e: e["steps"].bitwiseAND(last) != 0)
        found = F.transform(gone, lambda e: F.struct(e["at"].alias("at"), stop.alias("stop")))
        rest = F.slice(state["stack"], count + 1, F.size(state["stack"]))
        return F.struct(rest.alias("stack"), _longer(state["done"], found).alias("done"))

    def opened(state: Column, tag: Column) -> Column:
        """With the element of a start tag, which is over at once if it has no content."""
        parent = F.get(state["stack"], F.lit(0))
        own, above = F.coalesce(parent["steps"], F.lit(0)), F.coalesce(parent["above"], F.lit(0))
        allowed = (
            F.shiftleft(own, 1).bitwiseAND(child).bitwiseOR(F.shiftleft(above, 1).bitwiseAND(below))
        ).bitwiseOR(F.lit(first))
        matched = tag["steps"].bitwiseAND(allowed)
        entry = F.struct(
            tag["name"].alias("name"), matched.alias("steps"),
            above.bitwiseOR(matched).alias("above"), tag["at"].alias("at"),
        )
        alone = F.struct(tag["at"].alias("at"), tag["at"].alias("stop"))
        hit = F.when(matched.bitwiseAND(last) != 0, F.array(alone)).otherwise(F.array().cast(_DONE))
        return F.when(
            tag["void"] | (F.size(state["stack"]) >= DEEPEST),
            F.struct(state["stack"].alias("stack"), _longer(state["done"], hit).alias("done")),
        ).otherwise(
            F.struct(F.concat(F.array(entry), state["stack"]).alias("stack"), state["done"].alias("done"))
        )

    def step(state: Column, tag: Column) -> Column:
        def start(stack: Column) -> Column:
            there = F.coalesce(ends[tag["name"]], _names("-"))
            over, bar = top_of(stack, there), top_of(stack, F.coalesce(bars[tag["name"]], _names("-")))
            over = F.when((bar == 0) | (over < bar), over).otherwise(0)
            return bind(over, lambda n: bind(without(state, n, tag["at"]), lambda s: opened(s, tag)))

        end = bind(top_of(state["stack"], F.array(tag["name"])), lambda n: without(state, n, tag["at"]))
        return F.when(tag["closing"], end).otherwise(start(state["stack"]))

    empty = F.struct(F.array().cast(_OPEN).alias("stack"), F.array().cast(_DONE).alias("done"))
    size = F.size(tags)
    return F.array_sort(
        F.aggregate(tags, empty, step, lambda s: without(s, F.size(s["stack"]), size)["done"])
    )


def elements(markup: Column, selector: str) -> Column:
    """All elements that a selector finds, in page order: the start ``tag``, the markup ``inner``
    between its tags, and the ``text`` of that without tags."""
    steps = compile_selector(selector)

    def read(whole: Column, texts: Column) -> Column:
        def tag(t: Column, i: Column) -> Column:
            name = F.lower(F.regexp_extract(t, r"^</?([^\s/>]+)", 1))
            closing = F.startswith(t, F.lit("</"))
            hits = [F.when(F.rlike(t, F.lit(p)), 1 << n).otherwise(0) for n, (p, _) in enumerate(steps)]
            return F.struct(
                name.alias("name"), closing.alias("closing"), i.alias("at"),
                reduce(add, hits).alias("steps"),
                F.rlike(name, F.lit(f"^(?:{'|'.join(VOID)})$")).alias("void"),
            )

        def cut(place: Column) -> Column:
            a, count = place["at"], place["stop"] - place["at"]
            between = F.zip_with(
                F.slice(whole, a + 2, count - 1), F.slice(texts, a + 2, count - 1), lambda x, y: F.concat(x, y)
            )
            inner = F.concat(F.get(texts, a), F.array_join(between, ""))
            return F.struct(
                F.get(whole, a).alias("tag"),
                F.when(count > 0, inner).otherwise("").alias("inner"),
                F.array_join(F.slice(texts, a + 1, count), "").alias("text"),
            )

        return F.transform(bind(F.transform(whole, tag), lambda tags: _fold(tags, steps)), cut)

    return bind(
        F.regexp_extract_all(markup, F.lit(_TAGS), F.lit(1)),
        lambda whole: bind(
            F.regexp_extract_all(markup, F.lit(_TAGS), F.lit(2)), lambda texts: read(whole, texts)
        ),
    )


def first_element(markup: Column, selectors: tuple[str, ...]) -> Column:
    """The first element of the first selector that finds any; null if none does."""
    return F.coalesce(*(F.get(elements(markup, s), F.lit(0)) for s in selectors))


def attribute(tag: Column, name: str) -> Column:
    """The value of an attribute of a start tag, null without it."""
    pattern = rf"(?is)^<[^\s/>]++(?:(?![\s/]{re.escape(name)}{_SPACE}*+=)(?:={_SPACE}*+(?:{_VALUE})|[^>]))*+[\s/]{re.escape(name)}{_SPACE}*+={_SPACE}*+({_VALUE})"
    value = F.regexp_extract(tag, pattern, 1)
    return if_not_empty(value, lambda v: F.regexp_replace(v, "^[\"']|[\"']$", ""))
