import random

import pytest
from pyspark.sql import functions as F

from leadchecks import fixtures
from leadchecks.queries import ALL
from placeleads.operators import enrich, extract, report
from placeleads.operators.dedup import place_key
from placeleads.plans import leads as pipelines
from placeleads.plans import search

SF_DIR = "/root/testdata/sf0.001"


def page(name="Bar", extra="", url="/maps/place/x/1"):
    return (url, f"<html><body><div role='main'><h1>{name}</h1>{extra}</div></body></html>")


def pages(spark, *rows):
    return spark.createDataFrame(
        [(i, *row) for i, row in enumerate(rows)], "page_id long, url string, html string"
    )


def test_record_defaults(spark):
    found = extract.place_records(pages(spark, ("/maps/search/x", "<body></body>"))).first()
    assert found.asDict() == {
        "page_id": 0,
        "name": None,
        "address": None,
        "phone": None,
        "emails": [],
        "has_website": False,
        "place_id": None,
        "is_active": True,
    }


def test_record_parameters(spark):
    one = pages(spark, page(extra="<p>a@shop.test</p><p>Shut down</p>"))
    assert extract.place_records(one).first()["emails"] == ["Bara@shop.testShut"]
    found = extract.place_records(
        one, glue=" ", closed_phrases=("shut down",), blocked_domains=("shop.test",)
    ).first()
    assert found["emails"] == [] and found["is_active"] is False


@pytest.mark.parametrize(
    "phrase, active",
    [("PERMANENTLY closed", False), ("Cerrado <b>temporalmente</b>", False), ("open", True)],
)
def test_closed(spark, phrase, active):
    assert extract.place_records(pages(spark, page(extra=phrase))).first()["is_active"] is active


def test_phone_falls_back_to_the_panel(spark):
    rows = (
        page(extra='<button data-item-id="phone:x">+34 912 345 678</button> 600 000 000'),
        page(extra='<button data-item-id="phone:x">none</button><div> 600 000 000</div>'),
        page(extra='<button data-item-id="phone:x">12</button>'),
    )
    found = extract.place_records(pages(spark, *rows)).orderBy("page_id").collect()
    assert [r["phone"] for r in found] == ["+34 912 345 678", "600 000 000", None]


def test_quarantine_splits_the_pages(spark):
    bad = pages(spark, page(), page(url="/maps/place/%ZZ"), ("/maps/place/x", None))
    good = extract.readable_pages(bad)
    assert [r["page_id"] for r in good.collect()] == [0]
    reasons = {r["page_id"]: r["reason"] for r in extract.quarantine(bad).collect()}
    assert reasons == {1: "malformed url", 2: "missing html"}


def test_rejected_places_are_shuffled_without_their_fields(spark):
    found = pipelines.find_leads(
        pages(spark, page(extra='<a data-item-id="authority">w</a>'), page(), page("Pub"))
    )
    assert [(r["page_id"], r["name"], r["is_active"]) for r in found.collect()] == [(2, "Pub", True)]


def test_name_of_a_quarantined_page_is_not_seen(spark):
    found = pipelines.find_leads(pages(spark, page(url="/maps/place/%ZZ"), page()))
    assert [r["page_id"] for r in found.collect()] == [1]


def test_enrichment_takes_the_first_page_of_a_lookup(spark):
    leads = spark.createDataFrame(
        [("Bar", "a, Rome, Italy", []), ("Pub", None, []), ("Cafe", None, ["own@x.es"])],
        "name string, address string, emails array<string>",
    )
    lookups = spark.createDataFrame(
        [
            (3, "Bar Rome email", "<p>late@x.es</p>"),
            (2, "Bar Rome email", "<p>first@x.es</p>"),
            (1, "Pub  email", "<p>x@facebook.com</p>"),
            (4, "Pub  email", "<p>second@x.es</p>"),
            (5, "Cafe  email", "<p>other@x.es</p>"),
        ],
        "lookup_id long, lookup_query string, html string",
    )
    found = enrich.enrich_emails(leads, enrich.lookup_emails(lookups)).collect()
    assert {r["name"]: r["emails"] for r in found} == {
        "Bar": ["first@x.es"],
        "Pub": [],
        "Cafe": ["own@x.es"],
    }


def test_running_unique_equals_a_loop(spark):
    rng = random.Random(6)
    rows = [
        (rng.choice("ab"), rng.randint(0, 9), rng.choice(["hot", "hot", None, *map(str, range(40))]))
        for _ in range(800)
    ]
    df = spark.createDataFrame(rows, "run string, query int, key string")
    expected = []
    for run in "ab":
        seen = set()
        for query in sorted({q for r, q, _ in rows if r == run}):
            keys = [k for r, q, k in rows if (r, q) == (run, query)]
            new = {k for k in keys if k is not None} - seen
            seen |= new
            expected.append((run, query, len(keys), len(new), len(seen)))
    found = report.running_unique(df, "key", "query", ["run"]).orderBy("run", "query").collect()
    assert [tuple(r) for r in found] == expected


def test_contact_summary(spark):
    df = spark.createDataFrame(
        [("1", ["a"]), (None, []), ("", ["a", "b"]), ("2", [])], "phone string, emails array<string>"
    )
    assert tuple(report.contact_summary(df).first()) == (2, 2, 4)


def test_observed_progress(spark):
    df, counts = report.observe_progress(
        spark.range(100), "progress-test", even=F.count_if(F.col("id") % 2 == 0)
    )
    df.write.format("noop").mode("overwrite").save()
    assert counts.get == {"rows": 100, "even": 50}


def test_planned_leads_equal_a_loop(spark):
    """The subdivided search by hand: searches in order, links in page order, names
    checked once per location, places kept once."""
    plan = ALL["search_plan"](spark, SF_DIR)  # only its columns are used below
    assert {"location", "query_seq", "search_query"} <= set(plan.columns)
    nations = spark.read.parquet(f"{SF_DIR}/nation.parquet")
    plan = search.search_plan(nations.select(F.col("n_name").alias("location")))
    result_pages = fixtures.result_pages(spark, SF_DIR)
    place_pages = fixtures.place_pages(spark, SF_DIR).select("page_id", "url", "html")
    records = extract.place_records(extract.readable_pages(place_pages).withColumn("u", F.col("url")))
    by_url = {}
    for row in records.orderBy("page_id").collect():
        host = "" if row["u"].startswith("http") else "https://www.google.com"
        by_url.setdefault(host + row["u"], row)
    links = {}
    for row in extract.links(result_pages).orderBy("page_id", "link_pos").collect():
        links.setdefault(row["search_query"], []).append(row["href"])
    expected = set()
    for location in {r["location"] for r in plan.select("location").distinct().collect()}:
        seen, kept = set(), {}
        queries = plan.where(F.col("location") == location).orderBy("query_seq").collect()
        for query in queries:
            for href in links.get(query["search_query"], []):
                url = href if href.startswith("http") else "https://www.google.com" + href
                row = by_url.get(url)
                if row is None or row["name"] is None or row["name"].lower() in seen:
                    continue
                seen.add(row["name"].lower())
                if not row["has_website"] and row["is_active"]:
                    kept.setdefault(row["place_id"] or row["name"].lower(), row["page_id"])
        expected |= {(location, page_id) for page_id in kept.values()}
    found = pipelines.find_leads_by_plan(plan, result_pages, place_pages)
    assert {(r["location"], r["page_id"]) for r in found.collect()} == expected and expected


def test_a_plan_is_joined_by_merging_narrow_rows(spark, plan_of):
    nations = spark.read.parquet(f"{SF_DIR}/nation.parquet")
    plan = search.search_plan(nations.select(F.col("n_name").alias("location")))
    joined = pipelines.searched_links(fixtures.result_pages(spark, SF_DIR), plan)
    assert "SortMergeJoin [search_query" in plan_of(joined)


def test_no_query_makes_pairs(spark, plan_of):
    for name in ("leads", "subdivided_leads", "merge_results", "search_plan", "progress_counts"):
        plan = plan_of(ALL[name](spark, SF_DIR))
        assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_scans_read_only_what_is_used(spark, plan_of):
    plan = plan_of(ALL["quarantine"](spark, SF_DIR))
    assert "c_acctbal" not in plan and "c_name" not in plan
    plan = plan_of(extract.quarantine(spark.read.parquet(f"{SF_DIR}/pages.parquet")))
    malformed, missing = plan.split("FileScan")[1:]
    assert "ReadSchema: struct<page_id:bigint,url:string>" in malformed
    assert "PushedFilters: [IsNull(html)" in missing
    pages_df = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    plan = plan_of(extract.readable_pages(pages_df))
    assert "PushedFilters: [IsNotNull(html)" in plan
    keyed = pages_df.select(place_key(F.col("url"), F.col("url")).alias("k"))
    assert "ReadSchema: struct<url:string>" in plan_of(keyed)
