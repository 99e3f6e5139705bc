import random
import time

import pytest
from pyspark.sql import functions as F

from placeleads.constants import RESULT_SELECTORS
from placeleads.functions import html, select

TAGS = ["div", "span", "b", "section"]


def build(rng, depth=0):
    """A random element as a tree, and its markup."""
    name, attrs = rng.choice(TAGS), {}
    for key, values in (("id", "xy"), ("class", ["a", "b", "a b", "ab"]), ("role", ["feed", "x feed", "feeder"])):
        if rng.random() < 0.4:
            attrs[key] = rng.choice(values)
    quote = rng.choice("\"'")
    written = "".join(f" {k}={quote}{v}{quote}" for k, v in attrs.items())
    kids = [build(rng, depth + 1) for _ in range(rng.randrange(4))] if depth < 4 else []
    text = rng.choice(["", "t", "x y"])
    inner = text + "".join(k["markup"] for k in kids)
    markup = f"<{name}{written}>{inner}</{name}>"
    return {"name": name, "attrs": attrs, "kids": kids, "inner": inner, "markup": markup}


def step_fits(node, step):
    tag, key, op, value = step
    if tag and node["name"] != tag:
        return False
    if key is None:
        return True
    have = node["attrs"].get(key)
    if have is None:
        return False
    value = value or ""
    return {
        None: True, "=": have == value, "^=": have.startswith(value), "$=": have.endswith(value),
        "*=": value in have, "~=": value in have.split(),
    }[op]


def walk(node, steps, ancestors=()):
    """Elements that the steps find, in page order."""

    def fits(chain, i):
        if not step_fits(chain[-1], steps[i][0]):
            return False
        if i == 0:
            return True
        if steps[i][1]:
            return len(chain) > 1 and fits(chain[:-1], i - 1)
        return any(fits(chain[:k], i - 1) for k in range(1, len(chain)))

    chain = (*ancestors, node)
    found = [node["inner"]] if fits(chain, len(steps) - 1) else []
    for kid in node["kids"]:
        found += walk(kid, steps, chain)
    return found


def random_selector(rng):
    steps, text = [], ""
    for i in range(rng.randrange(1, 4)):
        child = bool(i) and rng.random() < 0.5
        tag = rng.choice([*TAGS, None])
        key, op, value = rng.choice(
            [(None, None, None), ("id", "=", "x"), ("class", "~=", "a"), ("role", None, None), ("role", "=", "feed"),
             ("role", "*=", "fee"), ("role", "^=", "feed"), ("role", "$=", "feed"), ("class", "=", "a b")]
        )
        written = ""
        if (key, op) == ("id", "="):
            written = f"#{value}"
        elif op == "~=":
            written = f".{value}"
        elif key:
            written = f"[{key}{op or ''}" + (f'"{value}"]' if op else "]")
        steps.append(((tag, key, op, value), child))
        text += (" > " if child else " " * bool(i)) + (tag or ("*" if not written else "")) + written
    return text, steps


def test_selectors_find_what_a_walk_of_the_tree_finds(spark):
    rng = random.Random(6)
    trees = [build(rng) for _ in range(60)]
    df = spark.createDataFrame([(i, t["markup"]) for i, t in enumerate(trees)], "i int, m string").cache()
    hits = 0
    for _ in range(25):
        text, steps = random_selector(rng)
        got = df.select("i", F.transform(select.elements(F.col("m"), text), lambda e: e["inner"]).alias("e"))
        for row in got.collect():
            expected = walk(trees[row["i"]], steps)
            hits += len(expected)
            assert row["e"] == expected, (text, trees[row["i"]]["markup"])
    assert hits > 100


@pytest.mark.parametrize(
    "page,selector,expected",
    [
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "li", ["a", "bc", "c", "d"]),
        ("<p>a<p>b<div>c</div>d", "p", ["a", "b"]),
        ("<table><tr><td>1<td>2<table><tr><td>3</table><tr><td>4</table>", "td", ["1", "23", "3", "4"]),
        ("<dl><dt>a<dd>b<dt>c</dl>e", "dd", ["b"]),
        ("<select><option>a<option>b</select>c", "option", ["a", "b"]),
        ("a<br>b<img src=x>c", "img", [""]),
        ("<div>a</p></span>b</div>c", "div", ["ab"]),
        ("<div>never closed <b>x", "div > b", ["x"]),
        ('<div title="<div id=x>">t</div>', "#x", []),
        ("<DIV ROLE=feed>t</DIV>", "div[role='feed']", ["t"]),
        ("", "div", []),
        (None, "div", None),
    ],
)
def test_implied_and_stray_tags(spark, page, selector, expected):
    df = spark.createDataFrame([(page,)], "h string").select(html.page_markup(F.col("h")).alias("m"))
    got = df.select(F.transform(select.elements(F.col("m"), selector), lambda e: e["text"]).alias("e")).first()["e"]
    assert got == expected


def test_the_first_container_present_is_used(spark):
    pages = [
        '<div class="section-layout">A</div><div role="feed">B</div>',
        '<div class="x section-layout">A</div><div aria-label="The Results">C</div>',
        '<div id="pane"><b><div role="region">D</div></b></div>',
        "<div>none</div>",
    ]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, m string")
    text = html.element_text(F.col("m"), RESULT_SELECTORS["container"])
    assert [r["t"] for r in df.select("i", text.alias("t")).orderBy("i").collect()] == ["B", "C", "D", None]


@pytest.mark.parametrize("selector", ["", "> a", "a,b", "a[", "a >", "a:first-child"])
def test_what_is_no_selector_is_refused(selector):
    with pytest.raises(ValueError):
        select.compile_selector(selector)


def test_hostile_pages_end(spark):
    pages = ["<div>" * 20_000, "<p " + "a" * 500_000, "<li>" * 20_000, "</div>" * 20_000, "<a " + 'x="' * 50_000]
    df = spark.createDataFrame([(p,) for p in pages], "m string").repartition(5)
    started = time.time()
    df.select(F.size(select.elements(F.col("m"), "div > div[x]")).alias("n")).collect()
    assert time.time() - started < 60
