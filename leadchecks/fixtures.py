"""Captured pages derived from the customer table.

No given table holds place pages, so these make one page per customer. The SQL is
plain enough for Spark and DuckDB to run the very same text; ``{customer}`` and
``{nation}`` name the tables. See FIXTURES.md for what each part is there to try.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from placeleads.constants import CATEGORIES

# Schemas of the given tables that the derived ones and the queries read.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}

# Rows of a table that one task makes pages of; to read a page takes some 0.1 ms.
ROWS_PER_TASK = 10_000

# A second run over other, partly equal places: ids 0, 1, 3, 4, 6, 7, ...
SECOND_RUN_ID = "cast(floor(c_custkey * 3 / 2) as bigint)"

_CATEGORY = " ".join(
    ["case n % 20"] + [f"when {i} then '{c}'" for i, c in enumerate(CATEGORIES)] + ["end"]
)


def _k(n: str) -> str:
    return f"cast(floor({n} / 3) as bigint)"


def _url(n: str) -> str:
    k = _k(n)
    path = f"concat('/maps/place/Place+', {k}, '%C3%B3/@', {n})"
    return (
        f"case when {n} % 13 = 12 then concat('/maps/search/', {n}) "
        f"when {n} % 9 = 8 then concat('/maps/place/bad%ZZ', {k}) "
        f"when {n} % 9 = 7 then concat('https://maps.example.org', {path}) "
        f"else {path} end"
    )


def _base(id_expr: str) -> str:
    return (
        f"(select {id_expr} as n, {_k(id_expr)} as k, c_mktsegment as seg, n_name as nat "
        "from {customer} join {nation} on c_nationkey = n_nationkey)"
    )


_NAME = "case when n % 11 = 10 then '' when n % 2 = 0 then concat('Place ', k) else concat('PLACE ', k) end"
_ADDRESS = (
    "case when n % 8 = 7 then '' "
    "when n % 8 = 6 then concat('Calle ', n) else concat('Calle ', n, ', ', seg, ', ', nat) end"
)
_CITY = "case when n % 8 >= 6 then '' else seg end"


def place_pages_sql(id_expr: str = "c_custkey") -> str:
    """page_id, location, query_seq, search_query, url, html."""
    address = (
        "case when n % 8 = 7 then '' else concat('<div class=\"row\"><div>"
        f"<button data-item-id=\"address\">', {_ADDRESS}, '</button></div></div>') end"
    )
    phone = (
        "case n % 4 when 0 then concat('<button data-item-id=\"phone:tel\">+34 912 345 ', "
        "lpad(concat('', n % 1000), 3, '0'), '</button>') "
        "when 1 then concat('<span data-tooltip=\"Copy phone number\">(555) 123-', "
        "lpad(concat('', n % 10000), 4, '0'), '</span>') "
        "when 2 then concat('<p>call 912 345 ', lpad(concat('', n % 1000), 3, '0'), '</p>') else '' end"
    )
    website = (
        "case n % 5 when 0 then '<a data-item-id=\"authority\" href=\"https://w.test\">Website</a>' "
        "when 1 then '<span data-tooltip=\"Open website\"></span>' else '' end"
    )
    closed = (
        "case n % 7 when 0 then '<span>Permanently CLOSED</span>' "
        "when 1 then '<span>Cerrado temporalmente</span>' else '' end"
    )
    email = (
        "case n % 6 when 0 then concat('<p>info', n, '@gmail.com </p>') "
        "when 1 then concat('<p>x', n, '@example.com </p>') else '' end"
    )
    return (
        "select n as page_id, nat as location, cast(n % 20 as int) as query_seq, "
        f"concat({_CATEGORY}, ' in ', nat) as search_query, {_url('n')} as url, "
        "concat('<html><body><script>var t=\"</p>\";</script><div role=\"main\"><h1> ', "
        f"{_NAME}, ' </h1>', {address}, {phone}, {website}, {closed}, {email}, "
        f"'</div></body></html>') as html from {_base(id_expr)} as base"
    )


def lookup_pages_sql() -> str:
    """lookup_id, lookup_query, html: a page for every other customer's lookup query,
    for the rest a page that belongs to no place."""
    return (
        "select n as lookup_id, "
        f"case when n % 2 = 0 then concat({_NAME}, ' ', {_CITY}, ' email') "
        "else concat('Unlisted ', n, ' email') end as lookup_query, "
        "concat('<html><body><script>var m=\"s@gmail.com\";</script>', case "
        "when n % 4 = 0 then concat('<p>biz', n, '@shop.test</p><div>x</div>"
        "<a href=\"mailto:owner', n, '@gmail.com\">m</a>') "
        "when n % 4 = 2 then concat('<p>sales', n, '@facebook.com</p><p>biz', n, '@shop.test</p>') "
        "else '<p>no contact listed</p>' end, '</body></html>') as html "
        f"from {_base('c_custkey')} as base"
    )


def result_pages_sql() -> str:
    """page_id, search_query, html: one captured piece of a result list per customer,
    with a link to its place, once more the same, one to another place and one to
    something else."""
    variant = (
        "case n % 3 when 0 then nat when 1 then concat('North ', nat) "
        "else concat(nat, ' downtown') end"
    )
    half = "cast(floor(n / 2) as bigint)"
    return (
        f"select n as page_id, concat({_CATEGORY}, ' in ', {variant}) as search_query, "
        f"concat('<html><body><div role=\"feed\"><a href=\"', {_url('n')}, '\">a</a><a href=\"', "
        f"{_url('n')}, '\">b</a><a class=\"x\" href=\"', {_url(half)}, '\">c</a>"
        "<a href=\"/about\">d</a></div></body></html>') as html "
        f"from {_base('c_custkey')} as base"
    )


def feed_pages_sql() -> str:
    """page_id, html: a result list in one of four containers, with an item, something that looks
    like one, and end tags left out."""
    open_tag = (
        "case c_custkey % 4 when 0 then '<div role=\"feed\">' "
        "when 1 then '<div class=\"wide section-layout\">' "
        "when 2 then '<div aria-label=\"All Results here\">' "
        "else '<div id=pane><span><div role=\"region\">' end"
    )
    n = "cast(c_custkey as string)"
    return (
        f"select c_custkey as page_id, concat('<p title=\"<div role=feed>\">Head', {open_tag}, "
        f"'<div><div jsaction=\"go\"><a href=\"/maps/place/', {n}, '\">Place ', {n}, '</a><p>First ', {n}, "
        f"'<p>Second ', {n}, '<ul><li>a', {n}, '<li>b', {n}, '</ul></div></div><div><span>"
        "<div jsaction=\"go\">no item</div></span></div></div><i>Foot</i>') as html from {customer}"
    )


def locations_sql() -> str:
    """s_suppkey, location: a town per supplier, with or without country and continent."""
    return (
        "select s_suppkey, case s_suppkey % 3 when 0 then s_name "
        "when 1 then concat(s_name, ', ', n_name) "
        "else concat(s_name, ' ,', n_name, ',  ', r_name) end as location "
        "from {supplier} join {nation} on s_nationkey = n_nationkey "
        "join {region} on n_regionkey = r_regionkey"
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("supplier", "nation", "region")
    return spark.sql(locations_sql(), **{name: table(spark, sf_dir, name) for name in names})


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers, dealt evenly over as many tasks as there are rows for.

    Pages are made of them, and read, in the tasks that the rows are in. A file of one row group is one task to
    a scan, however many pages its narrow rows become. The rows are counted from the files'
    descriptions.
    """
    rows = table(spark, sf_dir, "customer")
    tasks = -(-rows.count() // ROWS_PER_TASK)
    return rows.repartition(tasks) if tasks > 1 else rows


def _derive(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    customer = _customers(spark, sf_dir)
    return spark.sql(sql, customer=customer, nation=table(spark, sf_dir, "nation"))


def place_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, place_pages_sql())


def second_run_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, place_pages_sql(SECOND_RUN_ID))


def lookup_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, lookup_pages_sql())


def feed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(feed_pages_sql(), customer=_customers(spark, sf_dir))


def result_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, result_pages_sql())
