import random

import pytest

from placeleads.schema import STORE_PLACE
from placeleads.sources.published import PublishedTables


def tables(spark, path, key=("run", "batch_id"), split=True):
    from pyspark.sql import types as T

    names = {"run": T.StringType(), "batch_id": T.LongType(), "run_id": T.LongType()}
    fields = [T.StructField("x", T.LongType()), T.StructField("part", T.StringType())]
    schema = T.StructType(fields + [T.StructField(k, names[k]) for k in key])
    return PublishedTables(spark, str(path), {"a": schema, "b": schema}, list(key), {"a": ["part"]} if split else {})


def rows(spark, values):
    return spark.createDataFrame([(v, "even" if v % 2 == 0 else "odd") for v in values], "x long, part string")


def seen(store, table="a"):
    return sorted(map(tuple, store.read(table).collect()))


def test_a_commit_replaces_the_one_of_its_key(spark, tmp_path):
    store = tables(spark, tmp_path)
    assert seen(store) == [] and store.commits() == []
    store.publish({"run": "r", "batch_id": 0}, {"a": rows(spark, [1, 2]), "b": rows(spark, [9])})
    store.publish({"run": "r", "batch_id": 1}, {"a": rows(spark, [3]), "b": lambda w: w["a"]})
    opened = store.read("a")
    store.publish({"run": "r", "batch_id": 1}, {"a": rows(spark, [4, 6]), "b": rows(spark, [])})
    expected = [(1, "odd", "r", 0), (2, "even", "r", 0)]
    assert sorted(map(tuple, opened.collect())) == [*expected, (3, "odd", "r", 1)]
    assert seen(store) == [*expected, (4, "even", "r", 1), (6, "even", "r", 1)]
    assert seen(store, "b") == [(9, "odd", "r", 0)]
    assert sorted(r["x"] for r in store.read_key("a", {"run": "r", "batch_id": 1}).collect()) == [4, 6]
    assert sorted(r["x"] for r in store.read_others("a", {"run": "r", "batch_id": 1}).collect()) == [1, 2]


def test_tables_of_a_commit_appear_together(spark, tmp_path):
    store = tables(spark, tmp_path)

    def fail(written):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        store.publish({"run": "r", "batch_id": 0}, {"a": rows(spark, [1]), "b": fail})
    assert seen(store) == [] and store.remove_replaced() == 1
    store.publish({"run": "r", "batch_id": 0}, {"a": rows(spark, [1]), "b": rows(spark, [2])})
    assert seen(store) == [(1, "odd", "r", 0)] and store.remove_replaced() == 0


@pytest.mark.parametrize("key", [("run", "batch_id"), ("run_id",)])
def test_compaction_keeps_rows_and_the_newest_commits(spark, tmp_path, key):
    rng, store = random.Random(len(key)), tables(spark, tmp_path, key, split=len(key) == 2)

    def values(owner, number):
        return {"run": owner, "batch_id": number} if len(key) == 2 else {"run_id": number}

    def add(owner, number):
        new = rows(spark, [rng.randrange(100) for _ in range(4)])
        store.publish(values(owner, number), {"a": new, "b": new})

    for number in range(4):
        add("r", number)
    if len(key) == 2:
        add("other", 7)
    before, opened = seen(store), store.read("a")
    assert store.compact() == 3
    assert seen(store) == before and sorted(map(tuple, opened.collect())) == before
    add("r", 3)  # the newest may be run again
    add("r", 4)
    before, both = seen(store), (seen(store, "a"), seen(store, "b"))
    assert store.compact() == 2  # the one of before and commit 3
    assert (seen(store, "a"), seen(store, "b")) == both
    assert store.remove_replaced() > 0
    assert seen(store) == before
    assert len(store.commits()) == len(key) + 1


def test_a_writer_reads_only_the_log_of_its_key(spark, tmp_path):
    store = tables(spark, tmp_path)
    store.publish({"run": "r", "batch_id": 0}, {"a": rows(spark, [1]), "b": rows(spark, [2])})
    for entry in (tmp_path / "log" / "run=r" / "batch_id=0").glob("*.json"):
        entry.write_text("not an entry")
    store.publish({"run": "r", "batch_id": 1}, {"a": rows(spark, [3]), "b": rows(spark, [4])})
    assert [r["x"] for r in store.read_key("a", {"run": "r", "batch_id": 1}).collect()] == [3]


def test_schemas_hold_the_key(spark, tmp_path):
    with pytest.raises(KeyError):
        PublishedTables(spark, str(tmp_path), {"places": STORE_PLACE}, ["batch_id"])
