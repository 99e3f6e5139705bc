import json
import random

import pytest
from pyspark.sql import functions as F

from placeleads.operators.merge import merge_results, new_only_by_key
from placeleads.schema import PLACE
from placeleads.sources import results
from placeleads.sources.known_keys import KnownKeys
from placeleads.sources.published import PublishedTables
from placeleads.sources.workdir import new_work_dir

DOCUMENT = {
    "scrapedAt": "2025-03-02T08:15:30Z",
    "query": "bakeries",
    "location": "Lyon, France",
    "totalFound": 2,
    "results": [
        {
            "name": "Fournil des Quais",
            "address": "Quai Imaginaire 7, Lyon",
            "phone": "+33 400 000 123",
            "emails": ["quais@example.org"],
            "hasWebsite": False,
            "isActive": True,
            "placeId": "quais-7",
        },
        {"name": "Salon Vide", "emails": [], "hasWebsite": False, "isActive": True},
    ],
}


def place(name, place_id=None, phone=None, emails=()):
    return (name, None, phone, list(emails), False, place_id, True)


def places(spark, *rows):
    return spark.createDataFrame(list(rows), PLACE)


def test_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(DOCUMENT, indent=2))
    (tmp_path / "b.json").write_text('{"scrapedAt": "2025-03-0')
    documents = results.read_documents(spark, str(tmp_path))
    found = results.places_of_documents(documents).orderBy("name").collect()
    assert found[0].asDict() == {
        "name": "Fournil des Quais",
        "address": "Quai Imaginaire 7, Lyon",
        "phone": "+33 400 000 123",
        "emails": ["quais@example.org"],
        "has_website": False,
        "place_id": "quais-7",
        "is_active": True,
    }
    assert found[1]["place_id"] is None and len(found) == 2
    corrupt = results.corrupt_documents(documents).collect()
    assert [r["path"].endswith("b.json") for r in corrupt] == [True]
    assert results.corrupt_documents(documents).count() == 1
    valid = documents.where("query is not null").first()
    assert valid["scrapedAt"].isoformat() == "2025-03-02T08:15:30"
    assert valid["lastUpdated"] is None


def test_missing_document_is_empty(spark, tmp_path):
    documents = results.read_documents(spark, str(tmp_path / "none"))
    assert results.places_of_documents(documents).count() == 0
    assert results.read_store(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("fmt", ["parquet", "json", "orc"])
def test_places_round_trip(spark, tmp_path, fmt):
    rows = places(spark, place("A", "x", "1", ["a@b.es"]), place("B"), place(None))
    path = str(tmp_path / "out")
    for _ in range(2):  # the second write replaces the first
        results.write_places(rows, path, fmt)
    found = results.read_places(spark, path, fmt).select(*PLACE.fieldNames())
    assert sorted(map(str, found.collect())) == sorted(map(str, rows.collect()))


def test_json_lines_carry_document_names(spark, tmp_path):
    results.write_places(places(spark, place("A", "x")), str(tmp_path / "out"), "json")
    files = (tmp_path / "out").glob("part-*.json")
    line = json.loads("".join(f.read_text() for f in files))
    assert line["hasWebsite"] is False and line["placeId"] == "x" and line["isActive"] is True


def test_append_run_adds_only_what_is_new(spark, tmp_path):
    store = str(tmp_path / "store")
    results.append_run(spark, places(spark, place("A", "x"), place("B")), store, 0, "q", "l")
    again = places(spark, place("C", "x"), place("b"), place("D"), place("E", "y"))
    added = results.append_run(spark, again, store, 1, "q", "l")
    assert sorted(r["name"] for r in added.collect()) == ["D", "E"]
    totals = results.store_totals(spark, store).first()
    assert totals["total_found"] == 4 and totals["last_updated"] >= totals["scraped_at"]
    assert results.read_store(spark, store).count() == 4


def test_repeating_a_run_replaces_it(spark, tmp_path):
    store = str(tmp_path / "store")
    for _ in range(2):
        results.append_run(spark, places(spark, place("A", "x")), store, 0, "q", "l")
    assert results.read_store(spark, store).count() == 1
    assert results.store_totals(spark, store).first()["total_found"] == 1


def test_a_document_is_written_as_before_and_split_by_records(spark, tmp_path):
    odd = 'a "b"\n    }\n    {\n c, \\ é 漢 \u2028 </x>'
    rows = [place(odd, "x", "1", ["a@b.es", odd]), place(None), place("", "", None, [])]
    rows += [place(f"P{i}", str(i), None, ["m@n.es"] * (i % 3)) for i in range(400)]
    numbered = [(i, *r) for i, r in enumerate(rows)]
    schema = "seq long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in PLACE.fields)
    df = spark.createDataFrame(numbered, schema).repartition(5)
    path = tmp_path / "document"
    results.write_document(df, str(path), 'cafés & "bars"', "all", ["seq"])
    (file,) = path.glob("part-*")
    text = file.read_text()
    document = json.loads(text)
    assert document["query"] == 'cafés & "bars"' and document["totalFound"] == len(rows)
    assert [p["name"] for p in document["results"]] == [r[0] for r in rows]
    assert text.rstrip("\n") == json.dumps(document, indent=2, ensure_ascii=False)
    # The old reader and the new one agree; the new one splits the file.
    old = results.places_of_documents(results.read_documents(spark, str(path)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 4096)
    try:
        new = results.read_document_places(spark, str(path))
        parts = new.rdd.getNumPartitions()
        got = sorted(map(str, new.select(*PLACE.fieldNames()).collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert parts > 4
    assert got == sorted(map(str, old.select(*PLACE.fieldNames()).collect()))
    assert new.where("_corrupt is not null").count() == 0


def test_empty_and_damaged_documents_by_records(spark, tmp_path):
    empty = places(spark).withColumn("seq", F.lit(1))
    results.write_document(empty, str(tmp_path / "empty"), "q", "l", ["seq"])
    (file,) = (tmp_path / "empty").glob("part-*")
    assert json.loads(file.read_text())["results"] == []
    assert results.read_document_places(spark, str(tmp_path / "empty")).count() == 0
    assert results.read_document_places(spark, str(tmp_path / "none")).count() == 0
    whole = json.dumps({"query": "q", "results": [{"name": "A"}, {"name": "B"}]}, indent=2)
    (tmp_path / "bad.json").write_text(whole.replace('"name": "A"', '"name": "A'))
    found = results.read_document_places(spark, str(tmp_path / "bad.json")).collect()
    assert sorted((r["name"], r["_corrupt"] is None) for r in found if r["name"]) == [("B", True)]
    assert sum(r["_corrupt"] is not None for r in found) == 1


def random_places(rng, count):
    names = [None, "", "Bar", "BAR", "Casa", "b", "c"]
    return [place(rng.choice(names), rng.choice([None, "", "x", "y", "z", str(rng.randrange(30))])) for _ in range(count)]


def test_runs_equal_merging_everything_each_time(spark, tmp_path):
    rng, store, kept = random.Random(8), str(tmp_path / "store"), None
    for run in range(5):
        new = places(spark, *random_places(rng, 25), *[place("Hot", "hot")] * 40)
        results.append_run(spark, new, store, run, "q", "l", 4)
        kept = merge_results(kept, new)
        found = results.read_store(spark, store).select(*PLACE.fieldNames())
        assert sorted(map(str, found.collect())) == sorted(map(str, kept.collect()))
    assert [p.name for p in (tmp_path / "store").glob("keys-*")] == ["keys-4"]
    # Another session, which asks for another number of buckets, goes on with those there are.
    spark.sql(f"drop table {KnownKeys(spark, store, 9).name}")
    new = places(spark, place("Hot", "hot"), place("New", "n"))
    assert [r["name"] for r in results.append_run(spark, new, store, 9, "q", "l", 9).collect()] == ["New"]


def test_keys_of_failed_and_replaced_runs_do_not_count(spark, tmp_path, monkeypatch):
    store = str(tmp_path / "store")

    def fail(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(PublishedTables, "_log", fail)
        with pytest.raises(RuntimeError):
            results.append_run(spark, places(spark, place("A", "a")), store, 0, "q", "l", 4)
    assert results.read_store(spark, store).count() == 0
    results.append_run(spark, places(spark, place("B", "b")), store, 0, "q", "l", 4)
    results.append_run(spark, places(spark, place("C", "c")), store, 0, "q", "l", 4)
    new = places(spark, place("A", "a"), place("B", "b"), place("C", "c"))
    added = results.append_run(spark, new, store, 1, "q", "l", 4)
    assert sorted(r["name"] for r in added.collect()) == ["A", "B"]
    for run in (2, 3):
        results.append_run(spark, places(spark, place("D", "d")), store, run, "q", "l", 4)
    assert results.result_store(spark, store).compact() == 3
    added = results.append_run(spark, places(spark, place("A", "a"), place("E", "e")), store, 4, "q", "l", 4)
    assert [r["name"] for r in added.collect()] == ["E"]


def test_known_keys_are_not_shuffled(spark, tmp_path, plan_of):
    store = str(tmp_path / "store")
    results.append_run(spark, places(spark, *random_places(random.Random(2), 50)), store, 0, "q", "l", 6)
    keys = KnownKeys(spark, store, 6)
    commits = [c["commit"] for c in results.result_store(spark, store).first_commits()]
    new = places(spark, *random_places(random.Random(3), 50))
    for shuffles in (2, 50):  # fewer and more than buckets
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        try:
            plan = plan_of(new_only_by_key(new, keys.of(commits), 6)).split("\n")
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 4)
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        scan = next(i for i, line in enumerate(plan) if "Bucketed: true" in line)
        join = max(i for i, line in enumerate(plan[:scan]) if "SortMergeJoin" in line)
        # What is between the scan and the join it feeds: lines less deep, read upwards.
        depth, above = plan[scan].index("FileScan"), []
        for line in reversed(plan[join + 1 : scan]):
            own = len(line) - len(line.lstrip(" :+-*()0123456789"))
            if own < depth:
                depth, above = own, [*above, line]
        assert above and not any("Exchange" in line for line in above)


def test_work_dir_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    first, second = new_work_dir(spark, "t"), new_work_dir(spark, "t")
    assert first != second
    if shared:
        assert first.startswith(shared)


def test_work_dir_without_a_shared_folder():
    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext = Context()

        class conf:  # noqa: N801
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(ValueError):
        new_work_dir(Session(), "t")


def test_read_pages_formats(spark, tmp_path):
    from placeleads.sources import pages

    rows = spark.createDataFrame([(1, "u", "<h1>x</h1>")], "page_id long, url string, html string")
    for fmt in ("parquet", "json", "orc"):
        path = str(tmp_path / fmt)
        rows.write.format(fmt).save(path)
        found = pages.read_pages(spark, path, fmt)
        assert found.collect() == rows.collect()
    lookups = rows.select(F.col("page_id").alias("lookup_id"), F.col("url").alias("lookup_query"), "html")
    lookups.write.parquet(str(tmp_path / "l"))
    assert pages.read_lookup_pages(spark, str(tmp_path / "l")).count() == 1
    result_pages = rows.select("page_id", F.col("url").alias("search_query"), "html")
    result_pages.write.parquet(str(tmp_path / "r"))
    assert pages.read_result_pages(spark, str(tmp_path / "r")).first()["search_query"] == "u"
