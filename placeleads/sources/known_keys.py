"""The keys of all places of a store, laid out in buckets.

A bucketed table next to the places: ``key``, and the ``commit`` that brought it. A run asks it
which of its keys are known; as the table is dealt by key already, only the run's own keys are
shuffled, and the table is read in place. Keys are added before their commit is
logged. Rows of commits that did not get that far, or were replaced, are not counted.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeleads.sources.workdir import folders


class KnownKeys:
    def __init__(self, spark: SparkSession, store: str, buckets: int):
        """The table of a store; ``buckets`` holds for a new one, and an existing one keeps its
        own number. The name in the session's catalog follows from the path."""
        self.spark = spark
        base = store.rstrip("/")
        there = [f for f in folders(spark, base) if f.startswith("keys-")]
        self.buckets = int(there[0].removeprefix("keys-")) if there else buckets
        self.path = f"{base}/keys-{self.buckets}"
        self.name = f"placeleads_keys_{hashlib.md5(self.path.encode()).hexdigest()}"
        place = self.path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"create table if not exists {self.name} (key string, commit string) using parquet "
            f"clustered by (key) sorted by (key) into {self.buckets} buckets location '{place}'"
        )

    def of(self, commits: list[str]) -> DataFrame:
        """The keys that some commits brought."""
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name).where(F.col("commit").isin(commits)).select("key")

    def add(self, keys: DataFrame, commit: str) -> None:
        """Adds distinct keys of a commit, one file per bucket."""
        rows = keys.distinct().repartition(self.buckets, "key")
        (
            rows.select("key", F.lit(commit).alias("commit"))
            .write.mode("append")
            .format("parquet")
            .bucketBy(self.buckets, "key")
            .sortBy("key")
            .saveAsTable(self.name)
        )
