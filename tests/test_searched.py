import re

import pytest
from pyspark.sql import functions as F

from placeleads.plans.leads import searched_links
from placeleads.sources.searched import read_searched_pages, write_result_pages

PLAN = "location string, query_seq int, search_query string"


def result_page(i, text):
    return (i, text, f'<a href="/maps/place/p{i}">x</a>')


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("searched"))
    rows = [result_page(i, f"cafe in town {i % 200}") for i in range(1000)]
    rows += [result_page(2000 + i, text) for i, text in enumerate([None, "", None])]
    pages = spark.createDataFrame(rows, "page_id long, search_query string, html string")
    write_result_pages(pages, path, parts=50)
    return path, pages


def plan_of(spark, texts):
    return spark.createDataFrame([("town", i, t) for i, t in enumerate(texts)], PLAN)


@pytest.mark.parametrize("texts", [["cafe in town 7", "cafe in town 150", None], ["", "nowhere"], [], [None]])
def test_the_links_of_a_plan_are_the_same(spark, layout, texts):
    path, pages = layout
    plan = plan_of(spark, texts)
    read = read_searched_pages(spark, path, plan)
    assert read.columns == pages.columns
    got, want = (sorted(map(repr, searched_links(p, plan).collect())) for p in (read, pages))
    assert got == want


def test_only_the_parts_of_the_plan_are_read(spark, layout):
    path, _ = layout
    read = read_searched_pages(spark, path, plan_of(spark, ["cafe in town 7", "cafe in town 150"]))
    files = read.select(F.input_file_name()).distinct().collect()
    assert 1 <= len({re.search(r"part=(\d+)/", f[0])[1] for f in files}) <= 2
    assert 10 <= read.count() < 200
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*part", plan)


def test_a_layout_keeps_its_parts_and_takes_more_pages(spark, tmp_path):
    path = str(tmp_path)
    with pytest.raises(ValueError, match="no result pages"):
        read_searched_pages(spark, path, plan_of(spark, []))
    schema = "extra int, page_id long, search_query string, html string, part string"
    for i, parts in enumerate((4, 9)):
        one = spark.createDataFrame([(0, *result_page(i, "bar in town"), "p")], schema)
        write_result_pages(one, path, parts)
    read = read_searched_pages(spark, path, plan_of(spark, ["bar in town"]))
    assert sorted(r["page_id"] for r in read.collect()) == [0, 1]


def test_a_search_with_most_pages_is_dealt_to_several_files(spark, tmp_path):
    pages = spark.range(20_000).selectExpr(
        "id as page_id", "if(id % 3 = 0, concat('s', id), 'hot') as search_query",
        "concat_ws('', transform(sequence(1, 20), i -> md5(concat(id, ' ', i)))) as html",
    )
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m"}
    before = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        write_result_pages(pages, str(tmp_path), parts=8)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    read = read_searched_pages(spark, str(tmp_path), plan_of(spark, ["hot"]))
    hot = read.where("search_query = 'hot'")
    assert hot.select(F.input_file_name()).distinct().count() > 2
    assert hot.count() == sum(i % 3 != 0 for i in range(20_000))
