"""Captured result pages laid out by the search that brought them.

A plan asks for some searches out of all that were ever captured. Pages lie in folders by a hash
of the search text, so that a plan reads only the folders of its own searches; the folder names
are partition values, which Spark prunes before it opens a file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeleads.schema import RESULT_PAGE
from placeleads.sources.workdir import folders

PARTS = 1024
_LAYOUT = "parts-"


def _part(search_query: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(search_query), F.lit(parts)).cast("int")


def _parts_of(spark: SparkSession, path: str) -> int | None:
    found = [f for f in folders(spark, path) if f.startswith(_LAYOUT)]
    return int(found[0].removeprefix(_LAYOUT)) if found else None


def write_result_pages(pages: DataFrame, path: str, parts: int = PARTS) -> None:
    """Adds captured result pages to a layout. ``parts`` holds for a new one, an existing one
    keeps its own. The pages are shuffled once, here; a search with very many pages is
    dealt to several tasks, and small parts share one."""
    base = path.rstrip("/")
    parts = _parts_of(pages.sparkSession, base) or parts
    if parts < 1:
        raise ValueError("a layout has at least one part")
    placed = pages.select(*RESULT_PAGE.names, _part(F.col("search_query"), parts).alias("part"))
    placed.hint("rebalance", "part").write.partitionBy("part").mode("append").parquet(
        f"{base}/{_LAYOUT}{parts}"
    )


def read_searched_pages(spark: SparkSession, path: str, plan: DataFrame) -> DataFrame:
    """The pages of a layout that may belong to the searches of a plan (``search_query``): all
    pages of those searches, and others of the same parts. What comes to the driver are
    numbers of parts, at most as many as the layout has."""
    base = path.rstrip("/")
    parts = _parts_of(spark, base)
    if parts is None:
        raise ValueError(f"no result pages were laid out in {path}")
    wanted = plan.where("search_query is not null").select(
        _part(F.col("search_query"), parts).alias("part")
    )
    numbers = sorted(row["part"] for row in wanted.distinct().collect())
    schema = T.StructType([*RESULT_PAGE.fields, T.StructField("part", T.IntegerType())])
    pages = spark.read.schema(schema).parquet(f"{base}/{_LAYOUT}{parts}")
    asked = F.col("part").isin(numbers) if numbers else F.lit(False)
    return pages.where(asked).drop("part")
