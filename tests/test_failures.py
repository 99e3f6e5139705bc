import pytest

from placeleads.operators import failures
from placeleads.schema import PAGE, PLACE
from placeleads.sources import files, pages

ROWS = 4000


@pytest.fixture
def folder(spark, tmp_path):
    for name in ("good", "cut", "flipped"):
        df = spark.range(ROWS).selectExpr("id as page_id", "concat('u', id) as url", "sha2(string(id), 256) as html")
        df.coalesce(1).write.parquet(str(tmp_path / name))
    spark.createDataFrame([], PAGE).coalesce(1).write.parquet(str(tmp_path / "none"))
    whole = next((tmp_path / "cut").glob("*.parquet"))
    whole.write_bytes(whole.read_bytes()[:-100])
    damaged = next((tmp_path / "flipped").glob("*.parquet"))
    data = bytearray(damaged.read_bytes())
    data[len(data) // 2 : len(data) // 2 + 4000] = b"\xff" * 4000
    damaged.write_bytes(bytes(data))
    for sums in tmp_path.glob("*/.*.crc"):
        sums.unlink()
    (tmp_path / "good" / "part-empty.parquet").write_bytes(b"")
    (tmp_path / "good" / "part-text.parquet").write_text("no Parquet " * 100)
    return tmp_path


def test_a_bad_file_does_not_end_the_job(spark, folder):
    with pytest.raises(Exception):
        pages.read_pages(spark, f"{folder}/*").selectExpr("max(html)").collect()
    intact = pages.read_pages(spark, f"{folder}/*", intact=True)
    assert ROWS <= intact.selectExpr("count(html) n").first()["n"] < 2 * ROWS


def test_files_with_missing_rows_are_named(spark, folder):
    found = {}
    for row in files.unreadable_files(spark, f"{folder}/*", PAGE).collect():
        place, name = row["path"].split("/")[-2:]
        found[name if place == "good" else place] = row.asDict()
    assert set(found) == {"part-text.parquet", "cut", "flipped"}
    assert found["part-text.parquet"]["reason"] == files.NOT_PARQUET
    assert found["cut"]["reason"] == files.NOT_PARQUET
    assert found["flipped"]["reason"] == files.DAMAGED
    assert found["flipped"]["promised"] == ROWS > found["flipped"]["read"]
    assert files.unreadable_files(spark, f"{folder}/none", PAGE).count() == 0


def test_an_intact_stream_goes_on(spark, folder):
    stream = pages.stream_pages(spark, f"{folder}/*", intact=True)
    query = stream.writeStream.format("memory").queryName("intact").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("intact").count() >= ROWS


def test_failed_searches_and_lookups(spark):
    plan = spark.createDataFrame([("x", i, f"q{i}") for i in range(4)], "location string, query_seq int, search_query string")
    captured = [(1, "q0", "<a>"), (2, "q0", None), (3, "q1", None), (4, None, "<a>"), (5, "q9", "<a>")]
    result_pages = spark.createDataFrame(captured, "page_id long, search_query string, html string")
    got = sorted(tuple(r) for r in failures.failed_searches(plan, result_pages).collect())
    assert got == [("x", 1, "q1", "missing html"), ("x", 2, "q2", "not captured"), ("x", 3, "q3", "not captured")]
    leads = spark.createDataFrame(
        [(n, "S 1, City, C", None, e, False, None, True) for n, e in
         [("A", []), ("A", []), ("B", ["b@c.de"]), ("C", []), ("D", []), (None, [])]], PLACE
    )
    looked = spark.createDataFrame([(1, "C City email", "x"), (2, "D City email", None)], "lookup_id long, lookup_query string, html string")
    got = sorted(tuple(r) for r in failures.failed_lookups(leads, looked).collect())
    assert got == [("A City email", 2, "not captured"), ("D City email", 1, "missing html")]
