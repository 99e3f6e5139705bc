"""Merging a new run with earlier results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _id_key() -> Column:
    return F.when(F.col("place_id") != "", F.col("place_id"))


def _name_key() -> Column:
    """Lower-case name, only where there is no place id."""
    name = F.when(F.col("name") != "", F.lower("name"))
    return F.when(_id_key().isNull(), name)


def _tagged(keys: dict[str, Column]) -> list[Column]:
    """Keys as texts that differ between kinds of key."""
    return [F.concat(F.lit(f"{kind} "), key) for kind, key in keys.items()]


def _anti(new: DataFrame, existing: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """New rows whose key is not among the existing keys; of ``keys`` at most one is
    set in a row.

    Existing keys are made distinct first (combined before the shuffle), so a key
    that fills the existing results is one row. The join key is made of them only
    afterwards: with both inputs of the join freshly shuffled, the adaptive skew join
    can split a key that fills the new rows, which it does not do on top of an
    aggregate. Rows without a key must all stay; a hash of the row stands in for
    their key, which spreads them over the reducers. The empty key of existing rows
    without one equals none of the new; were it null, Spark would filter it below the
    distinct and compute the key, with all it is made of, twice.
    """
    known = (
        existing.select(*(key.alias(kind) for kind, key in keys.items()))
        .distinct()
        .select(F.coalesce(*_tagged({kind: F.col(kind) for kind in keys}), F.lit("")).alias("_key"))
    )
    stand_in = F.concat(F.lit("none "), F.xxhash64(*new.columns).cast("string"))
    keyed = new.withColumn("_key", F.coalesce(*_tagged(keys), stand_in))
    return keyed.join(known, "_key", "left_anti").drop("_key")


def new_by_id(new: DataFrame, existing: DataFrame) -> DataFrame:
    """New rows with a place id that no existing row has."""
    return _anti(new.where(_id_key().isNotNull()), existing, {"id": _id_key()})


def new_by_name(new: DataFrame, existing: DataFrame) -> DataFrame:
    """New rows without a place id whose name no existing row without one has. Rows
    with neither are kept."""
    return _anti(new.where(_id_key().isNull()), existing, {"name": _name_key()})


def new_only(new: DataFrame, existing: DataFrame) -> DataFrame:
    """``new_by_id`` and ``new_by_name`` together, in one join."""
    return _anti(new, existing, {"id": _id_key(), "name": _name_key()})


def merge_key() -> Column:
    """What ``new_only`` compares, as one text: the id or else the name; null without both."""
    return F.coalesce(*_tagged({"id": _id_key(), "name": _name_key()}))


def new_only_by_key(new: DataFrame, known: DataFrame, buckets: int) -> DataFrame:
    """``new_only`` against a table of keys, ``known(key)``, that lies in ``buckets`` by key.

    The keys of the new rows, each once, are dealt in the same way and go to the buckets; the
    table stays where it is. The few that are known are then taken from the new rows by a join
    of freshly shuffled inputs, so a key that fills the new rows can be split. The new rows
    are computed twice; write them to a table first if that is dear.
    """
    stand_in = F.concat(F.lit("none "), F.xxhash64(*new.columns).cast("string"))
    keyed = new.withColumn("_key", F.coalesce(merge_key(), stand_in))
    asked = new.select(merge_key().alias("key")).where("key is not null").distinct()
    # An inner join, as Spark would move a semi join below the dealing. A key that the table
    # has twice does no harm.
    there = asked.repartition(buckets, "key").join(known.hint("merge"), "key")
    there = there.select(F.concat(F.lit("is "), "key").alias("_is"))
    keyed = keyed.withColumn("_is", F.concat(F.lit("is "), "_key"))
    return keyed.join(there, "_is", "left_anti").drop("_key", "_is")


def merge_results(existing: DataFrame | None, new: DataFrame) -> DataFrame:
    """Existing rows and the new ones not among them; neither side is deduplicated."""
    if existing is None:
        return new
    return existing.unionByName(new_only(new, existing))
