import random

import pytest
from pyspark.sql import functions as F

from placeleads.operators import enrich, merge

SCHEMA = "page_id int, place_id string, name string, emails array<string>"


def plain_merge(existing, new):
    ids = {r[1] for r in existing if r[1]}
    names = {r[2].lower() for r in existing if not r[1] and r[2]}

    def is_new(row):
        if row[1]:
            return row[1] not in ids
        return row[2].lower() not in names if row[2] else True

    return existing + [r for r in new if is_new(r)]


def random_rows(rng, start, size):
    rows = []
    for i in range(size):
        place = "hot" if rng.random() < 0.33 else rng.choice([None, "", *map(str, range(300))])
        name = rng.choice([None, "", "Bar", "BAR", *(f"N{j}" for j in range(200))])
        rows.append((start + i, place, name, [f"{i}@x.es"]))
    return rows


def test_merge_equals_a_loop(spark):
    rng = random.Random(5)
    existing, new = random_rows(rng, 0, 200), random_rows(rng, 1000, 2000)
    e, n = spark.createDataFrame(existing, SCHEMA), spark.createDataFrame(new, SCHEMA)
    found = sorted(r["page_id"] for r in merge.merge_results(e, n).collect())
    assert found == sorted(r[0] for r in plain_merge(existing, new))
    by_id, by_name = merge.new_by_id(n, e), merge.new_by_name(n, e)
    both = sorted(r["page_id"] for r in by_id.unionByName(by_name).collect())
    assert both == [i for i in found if i >= 1000]


def test_rows_without_a_key_are_all_kept_and_spread(spark):
    rows = [(i, None, None, []) for i in range(1000)]
    new = spark.createDataFrame(rows, SCHEMA)
    existing = spark.createDataFrame([(-1, None, None, []), (-2, "", "", [])], SCHEMA)
    assert merge.new_only(new, existing).count() == 1000
    spread = new.select(F.xxhash64(*new.columns) % 8).distinct().count()
    assert spread == 8 or spread == 15


def test_merging_a_result_with_itself_adds_nothing(spark):
    rows = [(1, "x", "A", []), (2, None, "B", []), (3, "x", "A", [])]
    places = spark.createDataFrame(rows, SCHEMA)
    assert merge.merge_results(places, places).count() == 3


def test_no_earlier_results(spark):
    new = spark.createDataFrame([(1, "x", "A", []), (2, "x", "A", [])], SCHEMA)
    assert merge.merge_results(None, new).count() == 2


def test_an_id_does_not_match_a_name(spark):
    existing = spark.createDataFrame([(1, None, "bar", []), (2, "pub", None, [])], SCHEMA)
    new = spark.createDataFrame([(3, "bar", None, []), (4, None, "pub", [])], SCHEMA)
    assert merge.new_only(new, existing).count() == 2


def test_existing_keys_are_combined_before_the_shuffle(spark, plan_of):
    rows = spark.range(100).selectExpr("id as page_id", "'x' as place_id", "'n' as name")
    plan = plan_of(merge.new_only(rows, rows))
    right = plan[plan.index("LeftAnti") :].split("Exchange")
    assert "HashAggregate" in right[-1] and "HashAggregate" in right[-2]


@pytest.fixture
def skewed(spark):
    """Thresholds low enough for the adaptive join to split a key of test data."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def test_a_hot_new_key_is_split(spark, plan_of, skewed):
    """The key that fills a third of the new rows."""
    key = "case when id % 3 = 0 then 'hot' else concat('k', id) end as place_id"
    new = spark.range(0, 60_000, 1, 12).selectExpr("id as page_id", key, "sha2('x' || id, 512) as name")
    existing = spark.range(1000).selectExpr("id as page_id", "concat('k', id) as place_id", "'n' as name")
    kept = merge.new_only(new, existing)
    kept.collect()
    assert "skew=true" in plan_of(kept).lower()
    assert kept.count() == 60_000 - sum(1 for i in range(1000) if i % 3)


def test_a_hot_lookup_query_is_split(spark, plan_of, skewed):
    """A chain without a city that is a lead of many runs."""
    name = "case when id % 3 = 0 then 'chain' else concat('n', id) end as name"
    leads = spark.range(0, 60_000, 1, 12).selectExpr(
        "id as page_id", name, "cast(null as string) as address",
        "cast(array() as array<string>) as emails", "sha2('x' || id, 512) as place_id",
    )
    pages = spark.createDataFrame(
        [(1, "chain  email", "<body>a@shop.test</body>"), (2, "chain  email", "<body>b@shop.test</body>")],
        "lookup_id long, lookup_query string, html string",
    )
    found = enrich.enrich_emails(leads, enrich.lookup_emails(pages))
    rows = found.collect()
    assert "skew=true" in plan_of(found).lower()
    assert sum(r["emails"] == ["a@shop.test"] for r in rows) == 20_000 and len(rows) == 60_000
