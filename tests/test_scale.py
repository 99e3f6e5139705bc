"""Work is dealt over tasks by the number of rows, however the tables are laid out."""

import pytest
from pyspark.sql import functions as F

from leadchecks import fixtures, queries
from placeleads.sources import files

ROWS, AT_MOST = 25_000, 10_000


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Customers in one file of one row group, which is one task to a scan."""
    path = tmp_path_factory.mktemp("large")
    customers = spark.range(ROWS).selectExpr(
        "id as c_custkey", "concat('c', id) as c_name", "cast(id % 2 as int) as c_nationkey",
        "cast(id as double) as c_acctbal", "'BUILDING' as c_mktsegment",
    )
    customers.coalesce(1).write.parquet(f"{path}/customer.parquet")
    nations = spark.createDataFrame([(0, "SPAIN", 0), (1, "PERU", 0)], fixtures.SCHEMAS["nation"])
    nations.coalesce(1).write.parquet(f"{path}/nation.parquet")
    return str(path)


def rows_by_task(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


@pytest.mark.parametrize("name", ["place", "second_run", "lookup", "result", "feed"])
def test_pages_are_made_in_many_tasks(spark, folder, name):
    found = rows_by_task(getattr(fixtures, f"{name}_pages")(spark, folder))
    assert sum(found) == ROWS and max(found) <= AT_MOST


def test_few_customers_are_not_shuffled(spark, folder, plan_of, tmp_path):
    for name, rows in (("customer", 100), ("nation", 2)):
        fixtures.table(spark, folder, name).limit(rows).write.parquet(f"{tmp_path}/{name}.parquet")
    pages = fixtures.place_pages(spark, str(tmp_path))
    assert pages.count() == 100 and "RoundRobin" not in plan_of(pages)


def arrived_files(spark, folder, tmp_path, monkeypatch, query):
    """Rows by file that a query lets arrive for its streams; the streams are not run."""
    made, started = [], []

    def new_work_dir(spark, purpose):
        made.append(f"{tmp_path}/{len(made)}-{purpose}")
        return made[-1]

    def start(pages, *args, on_result=None, **options):
        started.append(options.get("keys"))
        if on_result:
            on_result(spark.createDataFrame([], "page_id long"), len(started))

    monkeypatch.setattr(queries, "new_work_dir", new_work_dir)
    monkeypatch.setattr(queries.streaming, "await_lead_stream", lambda query: None)
    monkeypatch.setattr(queries.streaming, "start_lead_stream", start)
    queries.ALL[query](spark, folder)
    paths = [p for p in made if p.endswith("-files")]
    pages = spark.read.schema("page_id long").parquet(*paths)
    files = [r["count"] for r in pages.groupBy(F.input_file_name()).count().collect()]
    return started, files


def test_slices_of_branches_arrive_from_many_tasks(spark, folder, tmp_path, monkeypatch):
    slices, files = arrived_files(spark, folder, tmp_path, monkeypatch, "stream_branches")
    assert slices == [("name", "address")] * queries.STREAM_SLICES
    assert sum(files) == ROWS and max(files) <= AT_MOST / queries.STREAM_SLICES * 1.1


def rows_given(spark, folder, tmp_path, monkeypatch, query):
    """Rows by task of the two runs that a query adds to a store; nothing is stored."""
    runs = []
    monkeypatch.setattr(queries, "new_work_dir", lambda spark, purpose: f"{tmp_path}/{purpose}")
    monkeypatch.setattr(queries.results, "append_run", lambda spark, new, *_: runs.append(rows_by_task(new)))
    queries.ALL[query](spark, folder)
    return runs


def test_runs_for_totals_come_from_many_tasks(spark, folder, tmp_path, monkeypatch):
    runs = rows_given(spark, folder, tmp_path, monkeypatch, "results_totals")
    assert [sum(r) > 2 * AT_MOST > 2 * max(r) for r in runs] == [True, True]


def test_runs_for_a_store_come_from_many_tasks(spark, folder, tmp_path, monkeypatch):
    runs = rows_given(spark, folder, tmp_path, monkeypatch, "results_store")
    assert [sum(r) > 2 * AT_MOST > 2 * max(r) for r in runs] == [True, True]


def test_both_sides_of_a_merge_come_from_many_tasks(spark, folder, monkeypatch):
    sides = []

    def merged(existing, new):
        sides.extend((rows_by_task(existing), rows_by_task(new)))
        return existing.unionByName(new)

    monkeypatch.setattr(queries.merge, "merge_results", merged)
    queries.merge_results(spark, folder)
    assert [sum(r) > 2 * AT_MOST > 2 * max(r) for r in sides] == [True, True]


def test_slices_for_hooks_arrive_from_many_tasks(spark, folder, tmp_path, monkeypatch):
    _, files = arrived_files(spark, folder, tmp_path, monkeypatch, "stream_hooks")
    assert sum(files) == ROWS and max(files) <= AT_MOST / queries.STREAM_SLICES * 1.1


def test_pages_to_resume_with_arrive_from_many_tasks(spark, folder, tmp_path, monkeypatch):
    started, files = arrived_files(spark, folder, tmp_path, monkeypatch, "stream_resume")
    # Half of the pages, then all.
    assert len(started) == 2 and sum(files) == ROWS // 2 + ROWS and max(files) <= AT_MOST


def test_no_task_reads_pages_of_several_files_for_a_folder(spark, tmp_path, monkeypatch):
    """Pages in several files, each large enough for a scan task of its own."""
    spark.range(0, 4200, 1, 3).selectExpr(
        "id as page_id", "concat('u', id) as url", "if(id % 11 = 0, null, concat('h', id)) as html"
    ).write.parquet(f"{tmp_path}/pages.parquet")
    monkeypatch.setattr(queries, "new_work_dir", lambda spark, purpose: f"{tmp_path}/{purpose}")
    spark.conf.set("spark.sql.files.openCostInBytes", "256m")
    try:
        found = queries.unreadable_files(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    bad = sorted((r["slice"], r["reason"]) for r in found if r["slice"] is not None)
    assert bad == [(n, files.NOT_PARQUET) for n in queries.BAD_SLICES]
    kept = sorted(r["page_id"] for r in found if r["slice"] is None)
    assert kept == [n for n in range(4200) if n % queries.FILE_SLICES not in queries.BAD_SLICES]
    for number in range(queries.FILE_SLICES):
        written = list((tmp_path / "unreadable-files").glob(f"slice?{number}/part-*"))
        assert len(written) == 3
