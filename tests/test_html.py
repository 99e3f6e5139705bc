import html as stdlib_html
import html.parser
import random
import time

import pytest
from pyspark.sql import functions as F

from placeleads.constants import SELECTORS, Selector
from placeleads.functions import html as h

VOID = {"br", "img", "input"}


class Reader(html.parser.HTMLParser):
    """Text of a well-formed body, and of the first element with an attribute."""

    def __init__(self, attr=None):
        super().__init__(convert_charrefs=True)
        self.attr, self.text, self.picked, self.depth, self.links = attr, "", None, 0, []

    def handle_starttag(self, tag, attrs):
        if tag == "a" and dict(attrs).get("href") is not None:
            self.links.append(dict(attrs)["href"])
        if tag in VOID:
            return
        if self.depth:
            self.depth += 1
        elif self.picked is None and self.attr in attrs:
            self.depth, self.picked = 1, ""

    def handle_endtag(self, tag):
        self.depth -= bool(self.depth)

    def handle_data(self, data):
        self.text += data
        if self.depth:
            self.picked += data


def random_body(rng, depth=0):
    """Well-formed HTML with everything that misleads simple patterns."""
    parts = []
    for _ in range(rng.randint(0, 5)):
        kind = rng.randint(0, 9)
        if kind <= 2:
            parts.append(rng.choice(["text ", "a &amp; b", "&lt;b&gt;", "5 > 4", "&#233;&#x20AC;", "'\" "]))
        elif kind == 3:
            parts.append(rng.choice(["<!-- <div> -->", "<br>", "<img alt='>'>", "<!---->", "&eacute;"]))
        elif kind == 4:
            parts.append('<script>var a = "</div><p>" + 1 &amp;&amp; 2;</script>')
        elif kind == 5:
            parts.append(rng.choice(['<a href="/x?a=1&amp;b=2">l</a>', "<a title='href=no' href=/y>l</a>"]))
        elif depth < 4:
            tag = rng.choice(["div", "DIV", "span", "p", "section"])
            attr = rng.choice(["", ' class="a>b"', ' role="main"', " role='main' x=1", ' ROLE = "main"', " title='role=\"main\"'"])
            parts.append(f"<{tag}{attr}>{random_body(rng, depth + 1)}</{tag}>")
    return "".join(parts)


@pytest.fixture(scope="module")
def bodies():
    rng = random.Random(3)
    return [random_body(rng) for _ in range(2000)]


def test_text_content_equals_a_parser(many, bodies):
    def expected(body):
        reader = Reader()
        reader.feed(body)
        reader.close()
        return reader.text

    pages = [f"<html><head><title>no</title></head><body x='>'>{b}</body></html>" for b in bodies]
    assert many(lambda t: h.text_content(h.page_markup(t)), pages) == [expected(b) for b in bodies]


def test_panel_text_equals_a_parser(many, bodies):
    def expected(body):
        reader = Reader(("role", "main"))
        reader.feed(body)
        reader.close()
        return reader.picked

    found = many(lambda t: h.element_text(h.page_markup(t), SELECTORS["panel"]), bodies)
    assert found == [expected(b) for b in bodies]


def test_links_equal_a_parser(many, bodies):
    def expected(body):
        reader = Reader()
        reader.feed(body)
        reader.close()
        return reader.links

    found = many(lambda t: h.hrefs(h.page_markup(t)), bodies)
    assert found == [expected(b) for b in bodies]


def test_character_references(many):
    names = [f"&{n}" for n in html.entities.html5]
    numbers = [f"&#{n};" for n in (0, 9, 38, 60, 128, 150, 159, 233, 8364, 55296, 128512, 1114112)]
    hexes = ["&#x41;", "&#X1F600;", "&#x26", "&#00065;", "&#99999999999;", "&#xFFFFFFFFFF;"]
    other = ["&nope;", "&", "&&amp;", "&amp;lt;", "&#;", "&#x;", "a&b", "&amp;&lt;&gt;&quot;&apos;"]
    texts = names + numbers + hexes + other
    found = many(lambda t: h.text_content(h.page_markup(t)), texts)
    for text, value in zip(texts, found):
        if text in ("&#x;", "&#;"):
            assert value == text
        else:
            assert value == stdlib_html.unescape(text), text


def test_bare_names_stop_at_letters_and_equals_signs(one):
    links = one(lambda t: h.hrefs(h.page_markup(t)), '<a href="/x?a=1&copy=2&amp=3&lt">x</a>')
    assert links == ["/x?a=1&copy=2&amp=3<"]


@pytest.mark.parametrize(
    "page, name",
    [
        ("<h1> Bar &amp; Co </h1>", "Bar & Co"),
        ("<H1 class='a>b'><b>Bar</b>\n Co</H1>", "Bar\n Co"),
        ("<!-- <h1>no</h1> --><script>'<h1>no</h1>'</script><h1>yes</h1>", "yes"),
        ("<template><h1>no</h1></template><h1>yes</h1>", "yes"),
        ("<h1>a</h1><h1>b</h1>", "a"),
        ("<h1>  ﻿</h1><h1>b</h1>", None),
        ("<h1>open", "open"),
        ("<h10>no</h10>", None),
    ],
)
def test_name(one, page, name):
    assert one(lambda t: h.trimmed_element_text(h.page_markup(t), SELECTORS["name"]), page) == name


@pytest.mark.parametrize(
    "page, text",
    [
        ('<button data-item-id="address">A</button><i data-tooltip="Copy address">B</i>', "A"),
        ('<i data-tooltip="Copy address">B</i><button data-item-id="address">A</button>', "A"),
        ('<i data-tooltip="Copy address"><i>B</i>C</i>', "BC"),
        ('<button data-item-id="address"></button><i data-tooltip="Copy address">B</i>', ""),
        ('<button data-item-id="other">A</button>', None),
        ('<button title="data-item-id=x" x=\'>\' data-item-id=address>A</button>', "A"),
        ('<button title=\' data-item-id="address"\'>A</button>', None),
        ('<input data-tooltip="Copy address"> text', ""),
    ],
)
def test_fallback_goes_by_presence(one, page, text):
    assert one(lambda t: h.element_text(h.page_markup(t), SELECTORS["address"]), page) == text


def test_prefix_selector(one):
    page = '<button data-item-id="phone:tel:+34"><div>+34 912</div></button>'
    assert one(lambda t: h.element_text(h.page_markup(t), SELECTORS["phone"]), page) == "+34 912"


@pytest.mark.parametrize(
    "page, found",
    [
        ('<a href="x" data-item-id="authority">', True),
        ('<span data-tooltip="Open website">', True),
        ('<a data-item-id="authority2">', False),
        ('<!-- <a data-item-id="authority"> -->', False),
        ("authority, Open website", False),
    ],
)
def test_website(one, page, found):
    assert one(lambda t: h.has_element(h.page_markup(t), SELECTORS["website"]), page) is found


def test_text_without_a_body_tag(one):
    assert one(lambda t: h.text_content(h.page_markup(t)), "<head><title>t</title></head>x<i>y</i>") == "xy"
    assert one(lambda t: h.text_content(h.page_markup(t)), "<title>t</title>x") == "x"
    assert one(lambda t: h.text_content(h.page_markup(t)), "x") == "x"
    assert one(lambda t: h.text_content(h.page_markup(t)), None) is None


def test_visible_text_breaks_lines_at_blocks_and_drops_scripts(one):
    page = "<body><p>a@b.com</p><p>c<b>d</b></p><script>x</script><style>y</style>e<br>f</body>"
    found = one(lambda t: h.visible_text(h.page_markup(t, raw_text=False)), page)
    assert found.split() == ["a@b.com", "cd", "e", "f"]


def test_lookup_text_adds_links_that_may_hold_mail(one):
    page = '<body>t<a href="mailto:a@b.es">m</a><a href="/x">n</a><a href="//h/@c">o</a></body>'
    found = one(lambda t: h.lookup_text(h.page_markup(t, raw_text=False)), page)
    assert found.endswith("tmno\n mailto:a@b.es //h/@c") or found.endswith("tmno mailto:a@b.es //h/@c")


@pytest.mark.parametrize(
    "page",
    [
        "<div " + "a" * 1_000_000 + ">x",
        "<div " + "a=b " * 250_000 + ">x",
        "<div " + "a='b' " * 200_000 + ">x",
        "<a" * 500_000,
        "<" * 1_000_000,
        "&" * 1_000_000,
        "<!--" * 250_000,
        "<script>" * 120_000,
        "<div>" * 200_000,
        "<div role='main'>" * 60_000,
        " " * 1_000_000 + "x",
    ],
)
def test_hostile_pages_neither_overflow_nor_hang(spark, page):
    markup = h.page_markup(F.col("t"))
    df = spark.createDataFrame([(page,)], "t string").select(markup.alias("m"))
    m = F.col("m")
    started = time.time()
    df.select(
        h.text_content(m),
        h.hrefs(m),
        h.trimmed_element_text(m, SELECTORS["name"]),
        h.element_text(m, SELECTORS["panel"]),
        h.element_text(m, (Selector("div", "role", "x"),)),
        h.has_element(m, SELECTORS["website"]),
    ).collect()
    assert time.time() - started < 60


@pytest.mark.parametrize("tag", ["<a ", "<button ", "<div ", '<a data-item-id="x" ', "<a href"])
def test_many_tags_without_an_end_take_linear_time(spark, tag):
    page = tag * (1_000_000 // len(tag)) + " authority"
    df = spark.createDataFrame([(page,)], "m string")
    started = time.time()
    df.select(h.hrefs(F.col("m")), h.has_element(F.col("m"), SELECTORS["website"])).collect()
    assert time.time() - started < 20


def test_selector_values_are_literal(spark):
    df = spark.createDataFrame([('<a data-id="a.b(c">x</a>',), ('<a data-id="aXb(c">x</a>',)], "m string")
    found = h.has_element(F.col("m"), (Selector("a", "data-id", "a.b(c"),))
    assert [r[0] for r in df.select(found).collect()] == [True, False]
