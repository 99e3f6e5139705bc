"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placeleads.sources.workdir import new_work_dir

# Whitespace as the contracts have it, in Java and RE2 notation.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut_lineage(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written to the shared folder and read again. Unlike a local checkpoint
    they survive the loss of an executor."""
    path = new_work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words_of(text: Column) -> Column:
    """Words between ASCII whitespace; none for a null text."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACE)
    return F.filter(parts, lambda w: w != "")


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that the DataFrame does not have."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def map_batches(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """``mapInArrow`` with a function of one batch."""

    def run(batches):
        for batch in batches:
            yield from function(batch)

    return df.mapInArrow(run, schema)


def shards(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows of about ``most`` bytes; a longer row is a range alone."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def add_columns(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], dict[str, pa.Array]],
    added: str,
    weigh: Callable[[pa.RecordBatch], list[int]] | None = None,
    most: int = 0,
) -> DataFrame:
    """The rows with columns computed per Arrow batch; they replace columns of their names,
    which the function still sees. With ``weigh``, the sizes of the rows, a batch is worked
    on and given back in parts of about ``most``."""
    kinds = [part.split() for part in added.split(";")]
    names = [name for name, _ in kinds]
    kept = [c for c in df.columns if c.lower() not in names]
    schema = df.select(
        *[F.col(f"`{c}`") for c in kept], *[F.lit(None).cast(k).alias(n) for n, k in kinds]
    ).schema

    def run(batches):
        for whole in batches:
            parts = shards(weigh(whole), most) if weigh else [(0, whole.num_rows)]
            for start, stop in parts:
                batch = whole.slice(start, stop - start)
                new = function(batch)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in kept], *[new[n] for n in names]], [*kept, *names]
                )
        # Workers wait for further tasks, of other queries as well, without this memory.
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


SLOTS = 1 << 20


def split_by_key(df: DataFrame, key: str, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose key (a hash) may be among the wanted ones, and the rows whose key is
    not. Marks one bit of ``64 * SLOTS`` for each wanted key; the marks, at most ``SLOTS``
    small rows whatever the tables, are broadcast. So a join of wide rows with few keys does
    not shuffle the rest; with very many keys more rows pass, and the join drops them."""

    def slot(k: str) -> Column:
        return F.pmod(F.col(k), F.lit(SLOTS))

    def bit(k: str) -> Column:
        return F.shiftrightunsigned(F.col(k), 58).cast("int")

    one = F.lit(1).cast("long")
    marks = (
        wanted.select(slot(key).alias("slot"), F.call_function("shiftleft", one, bit(key)).alias("bit"))
        .groupBy("slot")
        .agg(F.bit_or("bit").alias("marked"))
    )
    marks = F.broadcast(cut_lineage(marks, "marks"))
    found = df.join(marks, slot(key) == F.col("slot"), "left")
    hit = F.coalesce(F.call_function("getbit", F.col("marked"), bit(key)) == 1, F.lit(False))
    return found.where(hit).select(df.columns), found.where(~hit).select(df.columns)
