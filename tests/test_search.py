import pytest
from pyspark.sql import functions as F

from placeleads.constants import CATEGORIES
from placeleads.plans import search


def plain_variants(location, zones=None):
    """Variants of a location, by hand."""
    parts = [p.strip() for p in location.split(",")]
    area, rest = parts[0], ", ".join(parts[1:])
    end = f", {rest}" if rest else ""
    if zones is None:
        before = ["North", "South", "East", "West", "Central"]
        after = ["downtown", "old town", "city center", "historic center", "business district"]
        after += ["commercial area", "industrial area", "residential area", "suburbs", "outskirts"]
        found = [f"{b} {area}{end}" for b in before] + [f"{area} {a}{end}" for a in after]
        return [location, *found, f"near {area}{end}"]
    found = [f"{area} {k} {i}{end}" for i in range(1, zones + 1) for k in ("district", "zone")]
    return [location, *found, *(f"{area} area {i}{end}" for i in range(1, min(zones, 5) + 1))]


LOCATIONS = ["Madrid, Spain", "Madrid", " Paris ,Île-de-France , France", "", "a,", ",b", "x,y,z"]


def test_sub_locations(many):
    assert many(search.sub_locations, LOCATIONS) == [plain_variants(t) for t in LOCATIONS]


@pytest.mark.parametrize("zones", [-1, 0, 1, 4, 5, 10])
def test_zone_locations(many, zones):
    found = many(lambda t: search.zone_locations(t, zones), LOCATIONS)
    assert found == [plain_variants(t, zones) for t in LOCATIONS]


@pytest.mark.parametrize(
    "options, size",
    [
        ({}, 340),
        ({"include_zones": True}, 640),
        ({"include_directions": False}, 340),
        ({"include_directions": False, "include_districts": False}, 20),
        ({"include_directions": False, "include_districts": False, "include_zones": True}, 320),
        ({"categories": ["bars", "pubs", "bars"]}, 34),
        ({"categories": []}, 0),
    ],
)
def test_plan_size_and_order(many, options, size):
    texts = many(lambda t: search.search_texts(t, **options), ["Madrid, Spain"])[0]
    assert len(texts) == len(set(texts)) == size
    variants = ["Madrid, Spain"]
    if options.get("include_directions", True) or options.get("include_districts", True):
        variants += plain_variants("Madrid, Spain")
    if options.get("include_zones"):
        variants += plain_variants("Madrid, Spain", 5)
    kinds = options.get("categories", CATEGORIES)
    assert texts == list(dict.fromkeys(f"{k} in {v}" for v in variants for k in kinds))


def test_plan_rows_are_numbered(spark):
    plan = search.search_plan(spark.createDataFrame([("Madrid",), ("Rome",)], "location string"))
    rows = plan.orderBy("location", "query_seq").collect()
    assert [r["query_seq"] for r in rows] == list(range(340)) * 2
    assert rows[0]["search_query"] == "restaurants in Madrid"


def test_plan_needs_no_shuffle(spark, plan_of):
    plan = search.search_plan(spark.range(5).select(F.col("id").cast("string").alias("location")))
    assert "Exchange" not in plan_of(plan) and "Join" not in plan_of(plan)


@pytest.mark.parametrize("options, more", [({}, 335), ({"categories": ["bars"]}, 12)])
def test_preview(spark, options, more):
    locations = spark.createDataFrame([("Madrid",)], "location string")
    rows = search.plan_preview(locations, **options).collect()
    assert [r["query_seq"] for r in rows] == [0, 1, 2, 3, 4]
    assert {r["more"] for r in rows} == {more}


def test_preview_of_a_short_plan(spark):
    locations = spark.createDataFrame([("Madrid",)], "location string")
    rows = search.plan_preview(
        locations, include_directions=False, include_districts=False, categories=["bars", "pubs"]
    ).collect()
    assert [r["search_query"] for r in rows] == ["bars in Madrid", "pubs in Madrid"]
    assert {r["more"] for r in rows} == {0}


@pytest.mark.parametrize(
    "query, text",
    [
        ("bars", "bars in Rome"),
        (" bars ", " bars  in Rome"),
        ("", "businesses in Rome"),
        ("   ", "businesses in Rome"),
        (None, "businesses in Rome"),
    ],
)
def test_search_text(one, query, text):
    assert one(lambda t: search.search_text(t, F.lit("Rome")), query) == text
