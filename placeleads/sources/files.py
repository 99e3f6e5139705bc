"""Reading what may not be there, and what cannot be read."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Why rows of a file are missing.
NOT_PARQUET = "not a Parquet file, or cut off"
DAMAGED = "damaged pages"
# A Parquet file without rows is its description only.
_SMALL = 1 << 16
_NO_HASH = -(1 << 63)


def read_if_exists(
    spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet", **options
) -> DataFrame:
    """A table, or an empty one if there is nothing at the path yet."""
    return _or_empty(spark.read.schema(schema).options(**options).format(fmt), path, schema)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``path`` and ``length`` of every file below a folder; nothing is read of them."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return _or_empty(reader, path, "path string, length long").select("path", "length")


def _or_empty(reader: DataFrameReader, path: str, schema: T.StructType | str) -> DataFrame:
    try:
        return reader.load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return SparkSession.active().createDataFrame([], schema)


def read_intact(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet") -> DataFrame:
    """What can be read of a table. A file that cannot be read, or the rest of it from where
    it is damaged, is passed over instead of ending the job; ``unreadable_files`` says
    which."""
    return spark.read.schema(schema).option("ignoreCorruptFiles", True).format(fmt).load(path)


def unreadable_files(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The Parquet files below ``path`` of which rows are missing in ``read_intact``: ``path``,
    ``reason``, and the rows ``promised`` by the file's description and ``read``.

    Three scans: the listing; descriptions only, for the rows promised; and all columns, as a
    damaged page shows only when it is decoded. Just file names and counts are shuffled.
    Files of no bytes are not reported, as Spark never opens them.
    """
    rows = read_intact(spark, path, schema)
    name = F.col("_metadata.file_path").alias("path")
    promised = rows.select(name).groupBy("path").agg(F.count("*").alias("promised"))
    decoded = rows.select(name, F.xxhash64(*rows.columns).alias("all"))
    # No row has this hash, but Spark does not know that before it has read all columns.
    read = decoded.groupBy("path").agg(F.count(F.nullif("all", F.lit(_NO_HASH))).alias("read"))
    hidden = F.element_at(F.split("path", "/"), -1).rlike("^[._]")
    files = list_files(spark, path).where(~hidden)
    marked = _with_marks(spark, path)
    found = (
        files.join(promised, "path", "left")
        .join(read, "path", "left")
        .join(marked, "path", "left")
        .na.fill(0, ["promised", "read"])
    )
    is_parquet = F.coalesce("marked", F.lit(False))
    reason = F.when((F.col("promised") == 0) & ~is_parquet, NOT_PARQUET).when(
        F.col("read") < F.col("promised"), DAMAGED
    )
    return (
        found.withColumn("reason", reason)
        .where("reason is not null")
        .select("path", "reason", "promised", "read")
    )


def _with_marks(spark: SparkSession, path: str) -> DataFrame:
    """Small files, and whether they begin and end as Parquet files do. Only their content is
    read: a file without rows is small."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    small = _or_empty(reader, path, "path string, length long, content binary")
    mark = F.lit(b"PAR1")
    start, end = F.substring("content", 1, 4), F.substring("content", -4, 4)
    marked = (start == mark) & (end == mark) & (F.octet_length("content") > 8)
    return small.where(F.col("length") < _SMALL).select("path", marked.alias("marked"))
