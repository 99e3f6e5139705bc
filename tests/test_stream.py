import shutil

import pytest

from leadchecks import fixtures
from placeleads.operators.enrich import lookup_emails
from placeleads.operators.extract import place_records, readable_pages
from placeleads.plans.leads import find_leads
from placeleads.schema import PLACE
from placeleads.sources.pages import stream_pages
from placeleads.sources.published import PublishedTables
from placeleads.streaming import leads as streaming

SF_DIR = "/root/testdata/sf0.001"


def keep(df):
    return sorted(map(str, df.select("page_id", *PLACE.fieldNames()).collect()))


@pytest.fixture
def place_pages(spark):
    return fixtures.place_pages(spark, SF_DIR).select("page_id", "url", "html")


def arrive(pages, path, low, high):
    pages.where(f"page_id >= {low} and page_id < {high}").coalesce(1).write.mode("append").parquet(path)


def test_stream_equals_batch(spark, tmp_path, place_pages):
    files, store = str(tmp_path / "files"), str(tmp_path / "store")
    for low in range(0, 150, 50):
        arrive(place_pages, files, low, low + 50)
    batches, progress = [], []
    query = streaming.start_lead_stream(
        stream_pages(spark, files, max_files=1),
        store,
        str(tmp_path / "checkpoint"),
        on_result=lambda leads, batch: batches.append((batch, leads.count())),
        on_progress=progress.append,
    )
    streaming.await_lead_stream(query)
    batch = find_leads(place_pages)
    assert keep(streaming.read_stream_leads(spark, store)) == keep(batch)
    assert [b for b, _ in batches] == [0, 1, 2]
    assert sum(n for _, n in batches) == batch.count()
    assert [p["processed"] for p in progress] == [50, 50, 50]
    assert sum(p["quarantined"] for p in progress) == streaming.read_quarantine(spark, store).count()
    assert [p["found"] for p in progress] == [n for _, n in batches]
    totals = streaming.stream_totals(spark, store).first()
    assert totals["total_found"] == batch.count() and totals["last_updated"] is not None
    quarantined = streaming.read_quarantine(spark, store)
    assert quarantined.count() == place_pages.where("url like '%\\%ZZ%'").count() > 0


def test_enriched_stream_equals_batch(spark, tmp_path, place_pages):
    files, store = str(tmp_path / "files"), str(tmp_path / "store")
    arrive(place_pages, files, 0, 150)
    lookups = fixtures.lookup_pages(spark, SF_DIR)
    streaming.start_lead_stream(
        stream_pages(spark, files), store, str(tmp_path / "checkpoint"), emails=lookup_emails(lookups)
    ).awaitTermination()
    assert keep(streaming.read_stream_leads(spark, store)) == keep(find_leads(place_pages, lookups))


def test_restart_goes_on_where_it_stopped(spark, tmp_path, place_pages):
    files, store = str(tmp_path / "files"), str(tmp_path / "store")

    def run():
        stream = stream_pages(spark, files)
        checkpoint = str(tmp_path / "checkpoint")
        streaming.start_lead_stream(stream, store, checkpoint).awaitTermination()

    arrive(place_pages, files, 0, 70)
    run()
    first = keep(streaming.read_stream_leads(spark, store))
    run()  # nothing new
    assert keep(streaming.read_stream_leads(spark, store)) == first
    arrive(place_pages, files, 70, 150)
    run()
    assert keep(streaming.read_stream_leads(spark, store)) == keep(find_leads(place_pages))


def test_another_checkpoint_goes_on_with_the_store(spark, tmp_path, place_pages):
    store = str(tmp_path / "store")
    for i, (low, high) in enumerate(((0, 70), (50, 150))):
        files = str(tmp_path / f"files{i}")
        arrive(place_pages, files, low, high)
        checkpoint = str(tmp_path / f"checkpoint{i}")
        streaming.start_lead_stream(stream_pages(spark, files), store, checkpoint).awaitTermination()
    assert keep(streaming.read_stream_leads(spark, store)) == keep(find_leads(place_pages))


def test_a_batch_that_failed_after_writing_is_not_doubled(spark, tmp_path, place_pages):
    files, store = str(tmp_path / "files"), str(tmp_path / "store")
    checkpoint = str(tmp_path / "checkpoint")
    arrive(place_pages, files, 0, 70)
    arrive(place_pages, files, 70, 150)

    def run(on_result):
        stream = stream_pages(spark, files, max_files=1)
        query = streaming.start_lead_stream(stream, store, checkpoint, on_result=on_result)
        query.awaitTermination()

    def lose_the_second(leads, batch):
        if batch == 1:
            raise RuntimeError("driver lost")

    with pytest.raises(Exception, match="driver lost"):
        run(lose_the_second)
    repeated = []
    run(lambda leads, batch: repeated.append(batch))
    assert repeated == [1]
    assert keep(streaming.read_stream_leads(spark, store)) == keep(find_leads(place_pages))


def test_rejected_names_are_remembered(spark, tmp_path):
    files, store = str(tmp_path / "files"), str(tmp_path / "store")
    site = '<a data-item-id="authority">w</a>'
    rows = [(1, "/maps/place/a", f"<h1>Bar</h1>{site}"), (2, "/maps/place/b", "<h1>BAR</h1>")]
    for row in rows:
        page = spark.createDataFrame([row], "page_id long, url string, html string")
        page.coalesce(1).write.mode("append").parquet(files)
    streaming.start_lead_stream(
        stream_pages(spark, files, max_files=1), store, str(tmp_path / "checkpoint")
    ).awaitTermination()
    assert streaming.read_stream_leads(spark, store).count() == 0
    assert streaming.read_sightings(spark, store).count() == 1


def test_html_does_not_reach_the_batch(spark, tmp_path, place_pages, monkeypatch):
    files, columns, plans = str(tmp_path / "files"), [], []
    arrive(place_pages, files, 0, 150)
    publish = PublishedTables.publish

    def look(tables, values, rows):
        columns.extend(rows["batches"].columns)
        plans.append(rows["batches"]._jdf.queryExecution().analyzed().toString())
        publish(tables, values, rows)

    monkeypatch.setattr(PublishedTables, "publish", look)
    stream = stream_pages(spark, files)
    checkpoint = str(tmp_path / "checkpoint")
    streaming.start_lead_stream(stream, str(tmp_path / "store"), checkpoint).awaitTermination()
    assert columns and "html" not in columns and "html" not in plans[0]


def test_a_batch_needs_nothing_of_earlier_ones(spark, tmp_path, place_pages):
    """Ten batches, each of which deletes what the ones before have written: names are kept in
    the state of the stream, so a batch reads no history, however long."""
    files, store = str(tmp_path / "files"), str(tmp_path / "store")
    for low in range(0, 150, 15):
        arrive(place_pages, files, low, low + 15)
    found = []

    def keep_and_forget(leads, batch):
        found.extend(map(str, leads.select("page_id", *PLACE.fieldNames()).collect()))
        for table in ("batches", "log"):
            for old in (tmp_path / "store" / table).glob("run=*/batch_id=*"):
                shutil.rmtree(old)

    stream = stream_pages(spark, files, max_files=1)
    query = streaming.start_lead_stream(
        stream, store, str(tmp_path / "checkpoint"), on_result=keep_and_forget
    )
    query.awaitTermination()
    assert sorted(found) == keep(find_leads(place_pages))
    reports = [p for p in query.recentProgress if streaming.observed_counts(p)]
    assert len(reports) == 10
    names = find_names(place_pages)
    state = [p.stateOperators[0] for p in reports]
    assert state[-1].numRowsTotal == names
    # A batch touches the names it brings, not those that are there.
    assert all(s.numRowsUpdated <= 15 for s in state)


def find_names(pages):
    places = place_records(readable_pages(pages))
    return places.where("name is not null").selectExpr("lower(name) n").distinct().count()


def test_progress_takes_no_job(spark, tmp_path, place_pages):
    """With or without progress a batch runs the same jobs."""
    jobs = []
    for turn, on_progress in enumerate((None, [].append)):
        files = str(tmp_path / f"files{turn}")
        arrive(place_pages, files, 0, 150)
        query = streaming.start_lead_stream(
            stream_pages(spark, files), str(tmp_path / f"store{turn}"),
            str(tmp_path / f"checkpoint{turn}"), on_progress=on_progress,
        )
        streaming.await_lead_stream(query)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(str(query.runId))))
    assert jobs[0] == jobs[1] > 0


def test_a_reader_sees_the_old_rows_while_a_batch_is_repeated(spark, tmp_path, place_pages, monkeypatch):
    files, store = str(tmp_path / "files"), str(tmp_path / "store")
    checkpoint = str(tmp_path / "checkpoint")
    arrive(place_pages, files, 0, 150)

    def run(on_result=None):
        stream = stream_pages(spark, files)
        streaming.start_lead_stream(stream, store, checkpoint, on_result=on_result).awaitTermination()

    def fail(*args):
        raise RuntimeError("driver lost")

    expected = keep(find_leads(place_pages))
    with pytest.raises(Exception, match="driver lost"):
        run(fail)  # published, but the stream has not noted the end of the batch
    opened = streaming.read_stream_leads(spark, store)
    assert keep(opened) == expected
    with monkeypatch.context() as patched:
        patched.setattr(PublishedTables, "_log", fail)
        with pytest.raises(Exception, match="driver lost"):
            run()  # all rows written a second time, not published
    assert keep(streaming.read_stream_leads(spark, store)) == expected
    assert streaming.stream_totals(spark, store).first()["total_found"] == len(expected)
    run()
    assert keep(opened) == expected  # a reader from before the repeated batch
    assert keep(streaming.read_stream_leads(spark, store)) == expected
    assert len(list((tmp_path / "store" / "batches").glob("run=*/batch_id=0/commit=*"))) == 3
    assert streaming.stream_store(spark, store).remove_replaced() == 2
    assert keep(streaming.read_stream_leads(spark, store)) == expected


def test_places_can_be_told_apart_by_more_than_the_name(spark, tmp_path):
    site, at = '<a data-item-id="authority">w</a>', '<button data-item-id="address">{}</button>'
    html = [site + at.format("A 1"), at.format("B 2"), at.format("b 2"), at.format("a 1"), ""]
    rows = [(i, f"/maps/place/{i}", f"<h1>{'Bar' if i % 2 else 'BAR'}</h1>{h}") for i, h in enumerate(html)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    arrive(pages, str(tmp_path / "files"), 0, 2)
    arrive(pages, str(tmp_path / "files"), 2, 9)
    store = str(tmp_path / "store")
    query = streaming.start_lead_stream(
        stream_pages(spark, str(tmp_path / "files"), max_files=1), store, str(tmp_path / "checkpoint"),
        keys=("name", "address"),
    )
    streaming.await_lead_stream(query)
    found = streaming.read_stream_leads(spark, store)
    assert sorted(r["page_id"] for r in found.collect()) == [1, 4]
    batch = find_leads(pages, keys=("name", "address"))
    assert keep(found) == keep(batch)
    assert find_leads(pages).count() == 0
