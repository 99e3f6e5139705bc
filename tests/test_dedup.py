import random

from pyspark.sql import functions as F

from leadchecks import fixtures
from placeleads.operators import dedup
from placeleads.operators.extract import place_records, readable_pages
from placeleads.plans.leads import find_leads

SF_DIR = "/root/testdata/sf0.001"


def test_first_wins_equals_a_loop(spark):
    rng = random.Random(4)
    # One key holds a third of the rows, one row in ten has no key.
    rows = []
    for i in range(5000):
        key = "hot" if rng.random() < 0.33 else rng.choice([None, *map(str, range(400))])
        rows.append((i, key, rng.random()))
    rng.shuffle(rows)
    first = {}
    for i, key, value in sorted(rows):
        if key is not None:
            first.setdefault(key, (i, key, value))
    df = spark.createDataFrame(rows, "i int, k string, v double").repartition(7)
    assert {tuple(r) for r in dedup.first_wins(df, ["k"], ["i"]).collect()} == set(first.values())


def test_hot_keys_are_cut_before_the_shuffle(spark, plan_of):
    plan = plan_of(dedup.first_wins(spark.range(10).withColumn("k", F.col("id") % 3), ["k"], ["id"]))
    below_exchange = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in below_exchange and "Partial" in below_exchange


def test_html_is_not_shuffled_and_markup_is_computed_once(spark, plan_of):
    plan = plan_of(find_leads(fixtures.place_pages(spark, SF_DIR)))
    above_shuffle, below_shuffle = plan.split("Exchange", 1)
    assert "_markup" not in above_shuffle and "html" not in above_shuffle
    assert plan.count("AS _markup") == 1
    # No filter on extracted fields is pushed below the window.
    filters = [line for line in below_shuffle.splitlines() if "+- Filter" in line]
    assert not any(field in line for line in filters for field in ("name#", "_markup", "<h1"))


def test_fields_for_leads_are_those_of_full_records(spark):
    pages = readable_pages(fixtures.place_pages(spark, SF_DIR))
    full = dedup.leads_only(place_records(pages))
    quick = dedup.leads_only(place_records(pages, for_leads=True))
    assert sorted(map(str, quick.collect())) == sorted(map(str, full.collect()))
    hidden = place_records(pages, for_leads=True).where("has_website or name is null")
    assert hidden.where("phone is not null or address is not null").count() == 0


def test_first_sighting_with_a_website_hides_later_ones(spark):
    rows = [
        (1, "Bar", True, True),
        (2, "BAR", False, True),
        (3, "Pub", False, True),
        (4, "pub", False, True),
        (5, None, False, True),
        (6, "Closed", False, False),
    ]
    schema = "page_id int, name string, has_website boolean, is_active boolean"
    places = spark.createDataFrame(rows, schema)
    leads = dedup.leads_only(dedup.dedup_by_name(places, ["page_id"]))
    assert [r["page_id"] for r in leads.collect()] == [3]
    # The other order of the two steps would be wrong.
    swapped = dedup.dedup_by_name(dedup.leads_only(places), ["page_id"])
    assert sorted(r["page_id"] for r in swapped.collect()) == [2, 3]


def test_dedup_is_per_run(spark):
    rows = [(1, "a", "Bar"), (2, "b", "bar"), (3, "a", "BAR")]
    places = spark.createDataFrame(rows, "page_id int, location string, name string")
    kept = dedup.dedup_by_name(places, ["page_id"], ["location"]).collect()
    assert sorted(r["page_id"] for r in kept) == [1, 2]


def test_dedup_by_place_uses_the_id_then_the_name(spark):
    rows = [
        (1, "x", "A"),
        (2, "x", "B"),
        (3, None, "A"),
        (4, "", "a"),
        (5, None, None),
        (6, "a", "C"),  # an id that equals a name counts as the same key
    ]
    places = spark.createDataFrame(rows, "page_id int, place_id string, name string")
    kept = dedup.dedup_by_place(places, ["page_id"]).collect()
    assert sorted(r["page_id"] for r in kept) == [1, 3]


def test_result_does_not_depend_on_partitioning(spark):
    pages = fixtures.place_pages(spark, SF_DIR)
    results = [
        sorted(map(str, find_leads(pages.repartition(n)).collect())) for n in (1, 3, 8)
    ]
    assert results[0] == results[1] == results[2] and results[0]


def test_dedup_is_idempotent(spark):
    places = place_records(readable_pages(fixtures.place_pages(spark, SF_DIR)))
    once = dedup.dedup_by_name(places, ["page_id"]).drop("name_key")
    twice = dedup.dedup_by_name(once, ["page_id"]).drop("name_key")
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_filter_before_dedup_would_show_in_the_fixture(spark):
    places = place_records(readable_pages(fixtures.place_pages(spark, SF_DIR)))
    right = dedup.leads_only(dedup.dedup_by_name(places, ["page_id"])).count()
    wrong = dedup.dedup_by_name(dedup.leads_only(places), ["page_id"]).count()
    assert 0 < right < wrong
