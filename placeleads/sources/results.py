"""Results: documents of earlier tools, and our own append-only tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeleads.functions.text import bind
from placeleads.operators.merge import merge_key, new_only_by_key
from placeleads.operators.report import results_envelope
from placeleads.schema import (
    DOCUMENT,
    DOCUMENT_NAMES,
    DOCUMENT_PLACE,
    PLACE,
    STORE_PLACE,
    STORE_RUN,
)
from placeleads.sources.files import read_if_exists
from placeleads.sources.known_keys import KnownKeys
from placeleads.sources.published import PublishedTables
from placeleads.sources.workdir import delete, new_work_dir

_CORRUPT = "_corrupt"
KEY_BUCKETS = 64
# What stands before and after a record of an indented document.
_RECORD_START, _RECORD_END = "\n    {\n", "\n    }"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Result documents, one per file, with their ``path``, and with the text of those
    that are not valid JSON in ``_corrupt``. No document at the path gives no rows.

    A document is one JSON value over many lines, so a file is read by one task; many
    files are read in parallel. Large results belong in the tables below.
    """
    schema = T.StructType([*DOCUMENT.fields, T.StructField(_CORRUPT, T.StringType())])
    files = read_if_exists(spark, path, "value string", "text", wholetext=True)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    document = F.from_json("value", schema, options).alias("document")
    return files.select(F.input_file_name().alias("path"), document).select("path", "document.*")


def read_document_places(spark: SparkSession, path: str) -> DataFrame:
    """The places of result documents that are written with two blanks of indentation, of any size:
    with their ``path`` and the text of a record that is no valid place in ``_corrupt``.

    The line that ends a record is the end of a piece of text to Spark, so one file is split
    among tasks, and none holds more than a record. A text value cannot hold such a line, as
    JSON writes line ends in values as ``\\n``. For documents laid out otherwise, take
    ``read_documents``.
    """
    pieces = read_if_exists(spark, path, "value string", "text", lineSep=_RECORD_END)
    # The last piece of a file has no record, the first one has the head of the document before it.
    start = F.locate(_RECORD_START, F.col("value"))
    record = F.concat(F.substr("value", start + 1), F.lit(_RECORD_END))
    schema = T.StructType([*DOCUMENT_PLACE.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    places = pieces.where(start > 0).select(
        F.input_file_name().alias("path"), F.from_json(record, schema, options).alias("place")
    )
    return places.select("path", "place.*").withColumnsRenamed({v: k for k, v in DOCUMENT_NAMES.items()})


def write_document(
    places: DataFrame, path: str, query: str, location: str, order: list[str]
) -> None:
    """One result document, with two blanks of indentation, in a folder of its own: the places in
    ``order``, as earlier tools write them.

    Places become text, and are sorted, in parallel; one task only passes the lines on, since a
    document is one file. Large results belong in the tables below.
    """
    spark = places.sparkSession
    staged = new_work_dir(spark, "document")
    texts = places.select(*order, _record_text(places).alias("value")).orderBy(*order)
    # Numbers that rise from partition to partition, hence in the order of all.
    texts.select(F.monotonically_increasing_id().alias("row"), "value").write.parquet(staged)
    try:
        rows = spark.read.schema("row long, value string").parquet(staged)
        total, last = rows.agg(F.count("*"), F.max("row")).first()
        time = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")
        head = F.concat(
            F.lit('{\n  "scrapedAt": "'), time, F.lit('",\n  "query": '), _json(F.lit(query)),
            F.lit(',\n  "location": '), _json(F.lit(location)),
            F.lit(f',\n  "totalFound": {total},\n  "results": [' + ("" if total else "]\n}")),
        )
        ends = spark.range(2 if total else 1).select(
            (F.col("id") * 2).cast("int").alias("part"),
            F.lit(0).cast("long").alias("row"),
            F.when(F.col("id") == 0, head).otherwise("  ]\n}").alias("value"),
        )
        comma = F.when(F.col("row") < F.lit(last), ",").otherwise("")
        body = rows.select(F.lit(1).alias("part"), "row", F.concat("value", comma).alias("value"))
        lines = body.unionByName(ends).repartition(1).sortWithinPartitions("part", "row")
        lines.select("value").write.text(path)
    finally:
        delete(spark, staged)


def _json(text: Column) -> Column:
    """A text as a JSON value."""
    return bind(F.to_json(F.array(text)), lambda a: F.substr(a, F.lit(2), F.char_length(a) - 2))


def _record_text(places: DataFrame) -> Column:
    """A place as the lines of its record."""
    fields = []
    for field in PLACE.fields:
        value, name = F.col(field.name), DOCUMENT_NAMES.get(field.name, field.name)
        if isinstance(field.dataType, T.ArrayType):
            each = F.array_join(F.transform(value, lambda v: F.concat(F.lit("        "), _json(v))), ",\n")
            some = F.concat(F.lit("[\n"), each, F.lit("\n      ]"))
            text = F.when(F.size(value) > 0, some).otherwise("[]")
        elif isinstance(field.dataType, T.BooleanType):
            text = F.coalesce(value.cast("string"), F.lit("null"))
        else:
            text = _json(value)
        fields.append(F.concat(F.lit(f'      "{name}": '), text))
    return F.concat(F.lit("    {\n"), F.concat_ws(",\n", *fields), F.lit(_RECORD_END))


def places_of_documents(documents: DataFrame) -> DataFrame:
    """The places of all valid documents, one row each."""
    columns = {v: k for k, v in DOCUMENT_NAMES.items()}
    places = documents.where(F.col(_CORRUPT).isNull()).select(F.inline("results"))
    return places.withColumnsRenamed(columns)


def corrupt_documents(documents: DataFrame) -> DataFrame:
    """Documents that are not valid JSON. Never overwrite a file that shows up here."""
    return documents.where(F.col(_CORRUPT).isNotNull()).select(
        "path", F.col(_CORRUPT).alias("text")
    )


def write_places(places: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replaces the results at ``path``: one row per place, as many files as partitions.
    JSON lines carry the field names of the documents."""
    if fmt == "json":
        places = places.withColumnsRenamed(DOCUMENT_NAMES)
    places.write.mode("overwrite").format(fmt).save(path)


def read_places(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    if fmt != "json":
        return spark.read.schema(PLACE).format(fmt).load(path)
    columns = [T.StructField(DOCUMENT_NAMES.get(f.name, f.name), f.dataType) for f in PLACE.fields]
    places = spark.read.schema(T.StructType(columns)).json(path)
    return places.withColumnsRenamed({v: k for k, v in DOCUMENT_NAMES.items()})


def result_store(spark: SparkSession, store: str) -> PublishedTables:
    """The places and the rows about runs of a store, committed run by run."""
    return PublishedTables(spark, store, {"places": STORE_PLACE, "runs": STORE_RUN}, ["run_id"])


def append_run(
    spark: SparkSession,
    new: DataFrame,
    store: str,
    run_id: int,
    query: str,
    location: str,
    buckets: int = KEY_BUCKETS,
) -> DataFrame:
    """Adds the places of a run that earlier runs lack, and a row about the run.

    Existing rows are neither rewritten nor read: which keys are known is asked of a bucketed
    table (``sources.known_keys``), and only the new run is shuffled. For a new store, choose
    one of the ``buckets`` per 128 MB of keys. Places and row appear at the same moment,
    when both are written; repeating a run replaces what it had.
    """
    tables, columns, own = result_store(spark, store), PLACE.fieldNames(), {"run_id": run_id}
    keys = KnownKeys(spark, store, buckets)
    others = [c["commit"] for c in tables.first_commits() if c["run_id"] != run_id]
    added, staged = new.select(*columns), new_work_dir(spark, "new-run")
    if others:
        # The places of a run are few bytes, but may have taken long to extract.
        added.write.parquet(staged)
        places = spark.read.schema(PLACE).parquet(staged)
        added = new_only_by_key(places, keys.of(others), keys.buckets)

    def envelope(written: dict) -> DataFrame:
        return results_envelope(written["places"], query, location)

    def remember(commit: str, written: dict) -> None:
        found = written["places"].select(merge_key().alias("key")).where("key is not null")
        keys.add(found, commit)

    try:
        tables.publish(own, {"places": added, "runs": envelope}, remember)
    finally:
        delete(spark, staged)
    return tables.read_key("places", own).select(*columns)


def read_store(spark: SparkSession, store: str) -> DataFrame:
    """All places of a store, with the run that brought them."""
    return result_store(spark, store).read("places")


def store_totals(spark: SparkSession, store: str) -> DataFrame:
    """One row per query and location: first and last run, and the places in store."""
    return (
        result_store(spark, store)
        .read("runs")
        .groupBy("query", "location")
        .agg(
            F.min("scraped_at").alias("scraped_at"),
            F.max("scraped_at").alias("last_updated"),
            F.sum("total_found").alias("total_found"),
        )
    )
