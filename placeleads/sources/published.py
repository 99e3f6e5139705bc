"""Tables that grow by commits: readers see a commit whole or not at all.

The rows of a commit go into a new directory per table, ``<table>/<key>/commit=<id>``, which
nothing writes to a second time. What makes them visible is one row of the log, written as one
file when all tables are complete. The row names the commit and the commits it replaces. A
run that is repeated under the same key so replaces its first try in one step: until then a
reader gets the old rows, and a reader that has begun goes on with the files it knows.

The log has a directory per key, so a writer reads only the entries of its own key, however
many there are. Readers read all of it, a line per commit; ``compact`` replaces the many small
commits of a stream by one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeleads.sources.files import list_files
from placeleads.sources.workdir import delete, exists

_ENTRY = [
    T.StructField("commit", T.StringType()),
    T.StructField("replaces", T.ArrayType(T.StringType())),
    T.StructField("committed_at", T.TimestampType()),
]
_COMPACTED = "compacted"


class PublishedTables:
    """Tables of one store that are committed together.

    ``tables`` gives their schemas, ``key`` the columns that name a commit; they are part of
    the schemas, as are the columns of ``partition_by``, by which a table is laid out.
    """

    def __init__(
        self,
        spark: SparkSession,
        store: str,
        tables: dict[str, T.StructType],
        key: list[str],
        partition_by: dict[str, list[str]] | None = None,
    ):
        self.spark, self.store = spark, store.rstrip("/")
        self.tables, self.key, self.partition_by = tables, key, partition_by or {}
        fields = {f.name: f for f in next(iter(tables.values())).fields}
        self._log_schema = T.StructType(_ENTRY + [fields[k] for k in key])

    def publish(
        self,
        values: dict,
        rows: dict[str, DataFrame | Callable],
        before: Callable[[str, dict], None] | None = None,
    ) -> str:
        """Commits the rows under a key, in place of what the key had before. The key columns
        are not among those of the rows. Tables are written in their order; a function
        instead of rows is given what has been written, by table. ``before`` is called with
        the commit and the written tables before readers can see them."""
        replaced = [c["commit"] for c in self._commits_of(values)]
        commit, written = uuid.uuid4().hex, {}
        for table, df in rows.items():
            path, by = f"{self._of_key(table, values)}/commit={commit}", self.partition_by.get(table, [])
            df = df(written) if callable(df) else df
            df.write.partitionBy(*by).parquet(path)
            written[table] = self.spark.read.schema(df.schema).parquet(path)
        if before is not None:
            before(commit, written)
        self._log(commit, replaced, f"{self.store}/log/{self._path(values)}")
        return commit

    def read(self, table: str) -> DataFrame:
        """The rows of all commits."""
        return self._rows(table, self.commits())

    def read_key(self, table: str, values: dict) -> DataFrame:
        """The rows of one key, found without reading the rest of the log."""
        return self._rows(table, self._commits_of(values))

    def read_others(self, table: str, values: dict) -> DataFrame:
        """The rows of all commits but those under a key."""
        own = [values[k] for k in self.key]
        return self._rows(table, [c for c in self.commits() if [c[k] for k in self.key] != own])

    def commits(self) -> list[dict]:
        """Log entries that no other entry replaces. Their commits are directories, so the
        driver has to know them in any case."""
        none = dict.fromkeys(self.key)
        merged = [{**e, **none} for e in self._entries(f"log-{_COMPACTED}", T.StructType(_ENTRY))]
        return _live(self._entries("log", self._log_schema) + merged)

    def first_commits(self) -> list[dict]:
        """The commits that count, as they were before any compaction."""
        return _live(self._entries("log", self._log_schema))

    def compact(self) -> int:
        """Rewrites the commits as one, but for the newest of each stream or of all runs: only
        that one may be repeated. Returns how many are replaced. One compaction at a time;
        commits may go on meanwhile, and readers see the rows once at any moment."""
        last: dict = {}
        for c in self.commits():
            *owner, number = (c[k] for k in self.key)
            if number is not None and number >= last.get(tuple(owner), number):
                last[tuple(owner)] = number
        old = [
            c for c in self.commits()
            if c[self.key[-1]] is None or c[self.key[-1]] < last[tuple(c[k] for k in self.key[:-1])]
        ]
        if len(old) < 2:
            return 0
        commit = uuid.uuid4().hex
        for table in self.tables:
            path = f"{self.store}/{table}-{_COMPACTED}/commit={commit}"
            rows, by = self._rows(table, old), self.partition_by.get(table, [])
            rows.write.partitionBy(*by).parquet(path)
        self._log(commit, [c["commit"] for c in old], f"{self.store}/log-{_COMPACTED}")
        return len(old)

    def remove_replaced(self) -> int:
        """Deletes directories of replaced commits, and of writers that did not get as far as
        the log. For times without writers and without readers that began before the
        commits in question."""
        live = {c["commit"] for c in self.commits()}
        removed = 0
        for table in self.tables:
            for name in (table, f"{table}-{_COMPACTED}"):
                files = list_files(self.spark, f"{self.store}/{name}")
                directory = F.regexp_extract("path", "^(.*/commit=[0-9a-f]+)/", 1)
                for row in files.select(directory.alias("d")).distinct().toLocalIterator():
                    if row["d"] and row["d"].rsplit("=", 1)[1] not in live:
                        delete(self.spark, row["d"])
                        removed += 1
        return removed

    def _path(self, values: dict) -> str:
        return "/".join(f"{k}={values[k]}" for k in self.key)

    def _of_key(self, table: str, values: dict) -> str:
        return f"{self.store}/{table}/{self._path(values)}"

    def _log(self, commit: str, replaced: list[str], path: str) -> None:
        entry = self.spark.range(1).select(
            F.lit(commit).alias("commit"),
            F.array(*map(F.lit, replaced)).cast("array<string>").alias("replaces"),
            F.current_timestamp().alias("committed_at"),
        )
        entry.coalesce(1).write.mode("append").json(path)

    def _commits_of(self, values: dict) -> list[dict]:
        entries = self._entries(f"log/{self._path(values)}", T.StructType(_ENTRY))
        return _live([{**e, **values} for e in entries])

    def _entries(self, path: str, schema: T.StructType) -> list[dict]:
        if not exists(self.spark, f"{self.store}/{path}"):
            return []
        return [r.asDict() for r in self.spark.read.schema(schema).json(f"{self.store}/{path}").collect()]

    def _rows(self, table: str, commits: list[dict]) -> DataFrame:
        schema, parts = self.tables[table], []
        merged = [c["commit"] for c in commits if c[self.key[-1]] is None]
        own = [c for c in commits if c[self.key[-1]] is not None]
        for base, paths in (
            (table, [f"{self._of_key(table, c)}/commit={c['commit']}" for c in own]),
            (f"{table}-{_COMPACTED}", [f"{self.store}/{table}-{_COMPACTED}/commit={c}" for c in merged]),
        ):
            if paths:
                reader = self.spark.read.schema(schema).option("basePath", f"{self.store}/{base}")
                parts.append(reader.parquet(*paths).select(schema.fieldNames()))
        if not parts:
            return self.spark.createDataFrame([], schema)
        return reduce(DataFrame.unionByName, parts)


def _live(entries: list[dict]) -> list[dict]:
    gone = {commit for e in entries for commit in e["replaces"]}
    return [e for e in entries if e["commit"] not in gone]
