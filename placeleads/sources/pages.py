"""Tables of captured pages. Nothing here fetches anything."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from placeleads.schema import LOOKUP_PAGE, PAGE, RESULT_PAGE
from placeleads.sources.files import read_intact


def _read(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str, intact: bool
) -> DataFrame:
    if intact:
        return read_intact(spark, path, schema, fmt)
    return spark.read.schema(schema).format(fmt).load(path)


def read_pages(
    spark: SparkSession, path: str, fmt: str = "parquet", intact: bool = False
) -> DataFrame:
    """Place pages: ``page_id`` in the order of capture, ``url``, ``html``. With ``intact``,
    here and below, unreadable files are passed over (``files.unreadable_files`` reports
    them); otherwise one ends the job."""
    return _read(spark, path, PAGE, fmt, intact)


def read_result_pages(
    spark: SparkSession, path: str, fmt: str = "parquet", intact: bool = False
) -> DataFrame:
    """Pages of links that a search brought, with the text of the search."""
    return _read(spark, path, RESULT_PAGE, fmt, intact)


def read_lookup_pages(
    spark: SparkSession, path: str, fmt: str = "parquet", intact: bool = False
) -> DataFrame:
    """Pages that a web search for one business brought, with the text of the search."""
    return _read(spark, path, LOOKUP_PAGE, fmt, intact)


def stream_pages(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    max_files: int | None = None,
    intact: bool = False,
) -> DataFrame:
    """Place pages as a stream of files, oldest file first."""
    reader = spark.readStream.schema(PAGE).format(fmt).option("ignoreCorruptFiles", intact)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)
