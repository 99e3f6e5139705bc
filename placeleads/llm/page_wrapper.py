"""Main text of web pages by wrapper induction.

Pages of one host are made from one template, or from one per layout. Each page is parsed into
a tree of its elements. The pages of a host are one group; those with the same paths of element
names down to depth ``UPPER`` are a group too, and those with the same paths at all depths. In
each group the page with the smallest id that has a text that may be template is the
reference; the trees of the group's pages are aligned with it by simple tree matching, which
finds the largest mapping that keeps parents and order. Groups often share a reference, and a
page is aligned once with each of its references; each group judges by its own pages. A place of the reference whose text is the same in most pages that
have it is template; a place whose text varies is a slot, and slots are content. Menus,
adverts and the like vary too, so the roles that elements declare (name, class, id, role)
also make an element and what is in it template. If a page has an article, or else a main
element, only what is in it is content.

Pages with equal content count once in a group, so copies of an article do not become
one. Inside an article only short texts can be template.

The steps: parse each page into a compact tree; join the trees with their references
and align; count, per group and place, aligned and equal texts; list the template places of
each page; extract. HTML is shuffled only for pages that have template places outside
elements with a declared role.

Defined results: a null or empty page has an empty text and is no reference. Pages without a URL, or without a
host in it, share one host, and so one group, but groups of layouts as well. Rows with the same id on the same host are one page for the
template. Unclosed and stray tags are read as browsers do in the common cases (paragraphs and
list items end where the next begins).
"""

from __future__ import annotations

import html
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placeleads.llm.common import add_columns, cut_lineage, split_by_key

MIN_PAGES = 4  # aligned pages that a place needs to be judged
SHARE = 60  # percent of them with equal text that make it template
SHORT = 200  # characters of a text that can be template inside an article
UPPER = 4  # depth of the element names that tell layouts apart; the body's children are at 3
MAX_CELLS = 1 << 18  # of an alignment table that is kept; longer lists are aligned in linear space

# Elements by role.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp".split())
SKIPPED = frozenset(
    "head script style noscript template nav footer aside form button select textarea input "
    "iframe object svg canvas menu dialog".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
ROLE_WORDS = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies disqus footer header menu modal nav navbar navigation newsletter notice "
    "pagination popup promo related share sharing sidebar social sponsor sponsored subscribe "
    "toolbar complementary contentinfo search dialog".split()
)
# An element's start ends these open elements first.
ENDS = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr",),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}
SCOPE = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*+)(>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"(?i)(?<![^\s\"'/])(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)")
_NAME = re.compile(r"[a-z0-9]+")


class Node:
    __slots__ = ("tag", "role", "parts", "inside")

    def __init__(self, tag: str, role: bool, inside: bool):
        self.tag = tag
        self.role = role  # declares itself as something else than content
        self.parts: list = []  # texts and nodes in order
        self.inside = inside  # in an article


def parse(page: str | None) -> Node:
    """Tree of a page; texts are raw."""
    root = Node("", False, False)
    stack = [root]
    opened: Counter[str] = Counter()  # open elements by name
    page = page or ""
    at = 0
    for m in _find_tags(page):
        start, stop, closing, tag, attributes = m
        if start > at:
            stack[-1].parts.append(page[at:start])
        at = stop
        if tag is None:
            continue
        if closing:
            if opened[tag]:
                _cut(stack, opened, next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag))
            continue
        if tag in BLOCKS:
            _close(stack, opened, ("p",), ("table", "td", "th", "button"))
        if tag in ENDS:
            _close(stack, opened, ENDS[tag], SCOPE.get(tag, ()))
        top = stack[-1]
        node = Node(tag, _has_role(tag, attributes, top.inside), top.inside or tag == "article")
        top.parts.append(node)
        if tag not in VOID:
            stack.append(node)
            opened[tag] += 1
    if at < len(page):
        stack[-1].parts.append(page[at:])
    return root


def _cut(stack: list[Node], opened: Counter, at: int) -> None:
    opened.subtract(n.tag for n in stack[at:])
    del stack[at:]


def _close(stack: list[Node], opened: Counter, tags: tuple, scope: tuple) -> None:
    """Ends the innermost open element of these names, unless a scope is further in."""
    if not any(opened[t] for t in tags):
        return
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in tags:
            _cut(stack, opened, i)
            return
        if stack[i].tag in scope:
            return


def _find_tags(page: str):
    """Start, end, whether closing, name and attributes of each tag; the name is none for
    comments and the like. What is in raw elements is passed over."""
    at = 0
    while True:
        m = _TAG.search(page, at)
        if not m:
            return
        at = m.end()
        tag = m[2].lower() if m[2] else None
        yield m.start(), at, m[1] == "/", tag, m[3] or ""
        if tag in RAW and m[1] != "/":
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.IGNORECASE).search(page, at)
            at = end.start() if end else len(page)


def _has_role(tag: str, attributes: str, inside: bool) -> bool:
    if tag in SKIPPED or (tag == "header" and not inside):
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    for name, value in _ATTRIBUTE.findall(attributes):
        words = _NAME.findall(value.lower())
        if name.lower() == "role":
            if words and words[0] in ROLE_WORDS:
                return True
        elif ROLE_WORDS.intersection(words) and not (tag == "header" or "article" in words):
            return True
    return False


def _own_text(node: Node) -> str:
    raw = " ".join(p for p in node.parts if isinstance(p, str))
    return " ".join(html.unescape(raw).split())


def skeleton(root: Node) -> tuple[list[tuple[int, str, int, bool]], int]:
    """The elements without a declared role, in page order: depth, name, hash of the own text
    (0: none) and whether that may be template; and a hash of the page's whole content."""
    rows: list[tuple[int, str, int, bool]] = []
    whole = xxhash.xxh3_64()
    todo = [(root, 0)]
    while todo:
        node, depth = todo.pop()
        text = _own_text(node)
        key = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1 if text else 0
        whole.update(text.encode("utf-8", "surrogatepass") + b"\n")
        rows.append((depth, node.tag, key, not node.inside or len(text) <= SHORT))
        todo += [(p, depth + 1) for p in reversed(node.parts) if isinstance(p, Node) and not p.role]
    return rows, whole.intdigest() >> 1


def layouts(rows: list) -> tuple[int, int]:
    """Hashes of the paths of element names that a skeleton has: down to ``UPPER``, and all.
    How often a path occurs does not count, so lists of any length are alike."""
    path: list[int] = []
    upper: set[int] = set()
    every: set[int] = set()
    for depth, tag, *_ in rows:
        del path[depth:]
        above = path[-1] if path else 0
        path.append(xxhash.xxh3_64_intdigest(f"{above}/{tag}".encode("utf-8", "surrogatepass")))
        every.add(path[-1])
        if depth <= UPPER:
            upper.add(path[-1])
    return sum(upper) & (1 << 63) - 1, sum(every) & (1 << 63) - 1


def _shape(rows: list) -> tuple[list[list[int]], list[int], list[int]]:
    """Children, subtree sizes and shape hashes of the elements of a skeleton."""
    children: list[list[int]] = [[] for _ in rows]
    stack: list[int] = []
    for i, (depth, *_) in enumerate(rows):
        del stack[depth:]
        if stack:
            children[stack[-1]].append(i)
        stack.append(i)
    size, shape = [1] * len(rows), [0] * len(rows)
    for i in range(len(rows) - 1, -1, -1):
        size[i] += sum(size[c] for c in children[i])
        shape[i] = hash((rows[i][1], *(shape[c] for c in children[i])))
    return children, size, shape


def match(a: list, b: list) -> list[tuple[int, int]]:
    """Simple tree matching: the pairs of the largest mapping of two skeletons that keeps
    names, parents and order. Equal subtrees at the ends of two lists of children belong to
    some largest mapping, so only what is between goes into a table."""
    ca, size_a, shape_a = _shape(a)
    cb, _, shape_b = _shape(b)
    weights: dict[tuple[int, int], int] = {}

    def split(x: int, y: int):
        left, right = ca[x], cb[y]
        head = 0
        while head < min(len(left), len(right)) and shape_a[left[head]] == shape_b[right[head]]:
            head += 1
        tail = 0
        most = min(len(left), len(right)) - head
        while tail < most and shape_a[left[-1 - tail]] == shape_b[right[-1 - tail]]:
            tail += 1
        ends = [*zip(left[:head], right[:head], strict=True)]
        ends += zip(left[len(left) - tail :], right[len(right) - tail :], strict=True)
        return ends, left[head : len(left) - tail], right[head : len(right) - tail]

    def table(left: list, right: list) -> list[list[int]]:
        rows = [[0] * (len(right) + 1)]
        for x in left:
            above, row = rows[-1], [0]
            for j, y in enumerate(right):
                best = max(row[j], above[j + 1])
                if a[x][1] == b[y][1]:
                    best = max(best, above[j] + weight(x, y))
                row.append(best)
            rows.append(row)
        return rows

    def last_row(left: list, right: list) -> np.ndarray:
        """Last row of the table, a row at a time; weights are taken per pair of shapes."""
        kinds: dict[int, list[int]] = {}
        for j, y in enumerate(right):
            kinds.setdefault(shape_b[y], []).append(j)
        per_shape: dict[int, np.ndarray] = {}
        row = np.zeros(len(right) + 1, np.int64)
        for x in left:
            weighed = per_shape.get(shape_a[x])
            if weighed is None:
                weighed = np.zeros(len(right), np.int64)
                for places in kinds.values():
                    if a[x][1] == b[right[places[0]]][1]:
                        weighed[places] = weight(x, right[places[0]])
                if len(per_shape) * len(right) < MAX_CELLS:
                    per_shape[shape_a[x]] = weighed
            row[1:] = np.maximum(row[1:], row[:-1] + weighed)
            np.maximum.accumulate(row, out=row)
        return row

    def long_pairs(left: list, right: list) -> list[tuple[int, int]]:
        """Pairs of the largest mapping of two lists in linear space (Hirschberg)."""
        pairs, parts = [], [(left, right)]
        while parts:
            p, q = parts.pop()
            if not p or not q:
                continue
            if len(p) == 1:
                best, y = max(((weight(p[0], y), -y) for y in q if a[p[0]][1] == b[y][1]), default=(0, 0))
                if best:
                    pairs.append((p[0], -y))
                continue
            half = len(p) // 2
            rest = last_row(p[half:][::-1], q[::-1])[::-1]
            cut = int(np.argmax(last_row(p[:half], q) + rest))
            parts += [(p[:half], q[:cut]), (p[half:], q[cut:])]
        return pairs

    def weight(x: int, y: int) -> int:
        if shape_a[x] == shape_b[y]:
            return size_a[x]
        got = weights.get((x, y))
        if got is None:
            ends, left, right = split(x, y)
            got = 1 + sum(size_a[p] for p, _ in ends)
            if len(left) * len(right) > MAX_CELLS:
                got += int(last_row(left, right)[-1])
            elif left and right:
                got += table(left, right)[-1][-1]
            weights[(x, y)] = got
        return got

    found: list[tuple[int, int]] = []
    todo = [(0, 0)] if a and b and a[0][1] == b[0][1] else []
    while todo:
        x, y = todo.pop()
        found.append((x, y))
        ends, left, right = split(x, y)
        todo += ends
        if not left or not right:
            continue
        if len(left) * len(right) > MAX_CELLS:
            todo += long_pairs(left, right)
            continue
        rows = table(left, right)
        i, j = len(left), len(right)
        while i and j:
            if rows[i][j] == rows[i - 1][j]:
                i -= 1
            elif rows[i][j] == rows[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                todo.append((left[i], right[j]))
    return found


def blocks(root: Node, template: frozenset[int]) -> list[str]:
    """Texts of the content blocks in page order. Elements in ``template`` (by their number
    in the skeleton) lose their own text."""
    numbers: dict[int, int] = {}
    mains = {"article": [], "main": []}
    todo = [root]
    while todo:
        node = todo.pop()
        numbers[id(node)] = len(numbers)
        if node.tag in mains:
            mains[node.tag].append(node)
        todo += [p for p in reversed(node.parts) if isinstance(p, Node) and not p.role]
    tops = mains["article"] or mains["main"] or [root]
    found: list[str] = []
    inline: list[str] = []

    def end_block():
        text = " ".join(html.unescape("".join(inline)).split())
        if text:
            found.append(text)
        inline.clear()

    seen: set[int] = set()
    for top in tops:
        work: list = [top]
        while work:
            item = work.pop()
            if item is None:
                end_block()
                continue
            if isinstance(item, tuple):
                inline.append(item[0])
                continue
            if id(item) in seen or item.role:
                continue
            seen.add(id(item))
            own = numbers[id(item)] not in template
            parts = [
                p if isinstance(p, Node) else (p if own else " ",) for p in reversed(item.parts)
            ]
            if item.tag == "br":
                inline.append(" ")
            elif item.tag in BLOCKS or not item.tag:
                end_block()
                work.append(None)
            work += parts
        end_block()
    return found


def _host(url: str):
    return F.coalesce(
        F.lower(F.regexp_extract(F.col(f"`{url}`"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)),
        F.lit(""),
    )


_ROW = pa.struct([("depth", pa.int32()), ("tag", pa.string()), ("text", pa.int64()), ("may", pa.bool_())])
_GROUP = pa.struct([("group", pa.int64()), ("counted", pa.bool_())])
_GROUPS = "array<struct<group:bigint,counted:boolean>>"
_TREE = "array<struct<depth:int,tag:string,text:bigint,may:boolean>>"


def _trees(pages: DataFrame) -> DataFrame:
    """Compact tree, content and layout hashes per page, and whether it can be a reference."""

    def add(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        trees, wholes, kinds, full = [], [], [], []
        for page in batch.column("html"):
            rows, whole = skeleton(parse(page.as_py()))
            trees.append([dict(zip(("depth", "tag", "text", "may"), r, strict=True)) for r in rows])
            wholes.append(whole)
            kinds.append(layouts(rows))
            full.append(any(text and may for _, _, text, may in rows))
        return {
            "tree": pa.array(trees, pa.list_(_ROW)),
            "content": pa.array(wholes, pa.int64()),
            "upper": pa.array([k[0] for k in kinds], pa.int64()),
            "every": pa.array([k[1] for k in kinds], pa.int64()),
            "full": pa.array(full, pa.bool_()),
        }

    added = f"tree {_TREE};content bigint;upper bigint;every bigint;full boolean"
    return add_columns(pages, add, added)


def _aligned(joined: DataFrame) -> DataFrame:
    """Places of the reference that a page has: the element there, and whether the texts are
    equal. Only places where the reference has a text that may be template."""

    def run(batches):
        for batch in batches:
            out, shapes = [], {}
            for page, ref, groups, tree, reference in zip(
                *(batch.column(c).to_pylist() for c in ("key", "ref", "groups", "tree", "reference")),
                strict=True,
            ):
                mine = [(r["depth"], r["tag"], r["text"], r["may"]) for r in tree]
                if ref not in shapes:
                    shapes = {ref: [(r["depth"], r["tag"], r["text"], r["may"]) for r in reference]}
                model = shapes[ref]
                for x, y in match(mine, model):
                    if model[y][2] and model[y][3]:
                        equal = mine[x][2] == model[y][2] and mine[x][3]
                        out.append((page, groups, x, y, equal))
            columns = list(zip(*out, strict=True)) if out else [[] for _ in range(5)]
            kinds = (pa.int64(), pa.list_(_GROUP), pa.int32(), pa.int32(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["key", "groups", "node", "place", "equal"],
            )

    schema = f"key bigint, groups {_GROUPS}, node int, place int, equal boolean"
    return joined.mapInArrow(run, schema)


def _each_once(trees: DataFrame) -> DataFrame:
    """One row per key: equal rows of the table are one page, however many there are. Only
    trees of repeated keys are shuffled."""
    again = cut_lineage(
        trees.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "repeated-pages"
    )
    return trees.join(again, "key", "left_anti").unionByName(
        trees.join(again, "key", "left_semi").dropDuplicates(["key"])
    )


def template_places(pages: DataFrame) -> DataFrame:
    """``(key, template)``: per page the numbers of its template elements, for pages that
    have any. ``pages`` has ``key``, ``page``, ``host`` and ``html``."""
    trees = cut_lineage(_each_once(cut_lineage(_trees(pages).drop("html"), "trees")), "single-trees")
    # The first page of a content per group; the smallest key of the layouts within.
    firsts = trees.groupBy("host", "content", "upper", "every").agg(F.min("key").alias("first_every"))
    same = Window.partitionBy("host", "content")
    firsts = firsts.select(
        "*",
        F.min("first_every").over(same).alias("first_host"),
        F.min("first_every").over(same.partitionBy("host", "content", "upper")).alias("first_upper"),
    )

    def group(name: str, *parts):
        counted = F.col("key") == F.col(f"first_{name}")
        return F.struct(F.xxhash64(F.lit(name), *parts).alias("group"), counted.alias("counted"))

    groups = F.array(
        group("host", "host"), group("upper", "host", "upper"), group("every", "host", "upper", "every")
    )
    marked = trees.join(
        cut_lineage(firsts, "contents"), ["host", "content", "upper", "every"]
    ).select("key", "page", "tree", "full", groups.alias("groups"))
    members = marked.select("key", "page", "full", F.inline("groups").alias("group", "counted"))
    # In a group of fewer pages no place can be judged.
    chosen = cut_lineage(
        members.groupBy("group")
        .agg(
            F.min(F.when(F.col("full"), F.struct("page", "key"))).alias("r"),
            F.count_if("counted").alias("n"),
            F.count("*").alias("rows"),
        )
        .where(F.col("r").isNotNull() & (F.col("n") >= MIN_PAGES))
        .select("group", F.col("r.key").alias("ref"), "rows")
        # Groups with the same reference lie one in the other: of equal size, they are one.
        .groupBy("ref", "rows")
        .agg(F.min("group").alias("group"))
        .select("group", "ref"),
        "references",
    )
    references = cut_lineage(
        trees.join(chosen.select(F.col("ref").alias("key")).distinct(), "key")
        .groupBy("key")
        .agg(F.first("tree").alias("reference"))
        .withColumnRenamed("key", "ref"),
        "reference-trees",
    )
    own = (
        members.join(chosen, "group")
        .groupBy("key", "ref")
        .agg(F.collect_set(F.struct("group", "counted")).alias("groups"))
    )
    marked = marked.select("key", "tree").join(cut_lineage(own, "page-references"), "key")
    places = cut_lineage(_aligned(marked.join(references, "ref")), "aligned")
    constant = (
        places.select("place", "equal", F.inline("groups").alias("group", "counted"))
        .where("counted")
        .groupBy("group", "place")
        .agg(F.count("*").alias("n"), F.count_if("equal").alias("equal"))
        .where((F.col("n") >= MIN_PAGES) & (F.col("equal") * 100 >= F.col("n") * SHARE))
        .select("group", "place")
    )
    constant = cut_lineage(constant, "template")
    found = (
        places.where("equal")
        .select("key", "node", "place", F.inline("groups").alias("group", "counted"))
        .join(constant, ["group", "place"])
    )
    return found.groupBy("key").agg(F.collect_set("node").alias("template"))


def extract_text(
    df: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html"
) -> DataFrame:
    """``(page_id, url, text)`` for every row; blocks are joined by an empty line."""
    rows = df.select(
        F.xxhash64(F.col(f"`{page_id}`").cast("long"), f"`{url}`", f"`{page}`").alias("key"),
        F.col(f"`{page_id}`").cast("long").alias("page"),
        F.col(f"`{url}`").alias("url"),
        _host(url).alias("host"),
        F.col(f"`{page}`").alias("html"),
    )
    template = cut_lineage(template_places(rows.drop("url")), "page-templates")
    some, rest = split_by_key(rows, "key", template)
    some = some.join(template, "key", "left").select("page", "url", "html", "template")
    rest = rest.select("page", "url", "html", F.lit(None).cast("array<int>").alias("template"))

    def add(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        both = zip(
            batch.column("html").to_pylist(), batch.column("template").to_pylist(), strict=True
        )
        texts = ["\n\n".join(blocks(parse(h), frozenset(t or ()))) for h, t in both]
        return {"text": pa.array(texts, pa.string())}

    done = add_columns(some, add, "text string").unionByName(add_columns(rest, add, "text string"))
    return done.select(F.col("page").alias("page_id"), "url", "text")
