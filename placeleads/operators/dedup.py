"""First sighting wins, and the lead filter."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of every key by ``order``, which must be total within a key.
    Rows with a null in a key are dropped.

    ``rank = 1`` lets Spark cut each key to one row per input partition *before* the
    shuffle (``WindowGroupLimit ... Partial`` in the plan), so a key that holds a third
    of all rows, or the null key, brings one row per map task to its reducer. The null
    test reads a column that is no window key: it would otherwise be pushed below the
    window, where it repeats the extraction that made the key.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    has_key = reduce(and_, [F.col(k).isNotNull() for k in keys])
    return (
        df.withColumn("_has_key", has_key)
        .withColumn("_rank", F.row_number().over(window))
        .where("_rank = 1 and _has_key")
        .drop("_rank", "_has_key")
    )


def is_lead() -> Column:
    return ~F.col("has_website") & F.col("name").isNotNull() & F.col("is_active")


def with_name_key(places: DataFrame, keys: tuple[str, ...] = ("name",)) -> DataFrame:
    """Adds ``name_key``, which places that count as one have in common: the lower-case name,
    or the lower-case texts of several columns. It is null without a name."""
    texts = [F.lower(F.coalesce(F.col(k).cast("string"), F.lit(""))) for k in keys if k != "name"]
    # Lengths keep the texts apart.
    more = [F.concat(F.lit("\n"), F.char_length(t).cast("string"), F.lit(" "), t) for t in texts]
    return places.withColumn("name_key", F.concat(F.lower("name"), *more) if more else F.lower("name"))


def dedup_by_name(
    places: DataFrame,
    order: list[str],
    run: list[str] | None = None,
    keys: tuple[str, ...] = ("name",),
) -> DataFrame:
    """First place of every lower-case name, per run. Comes before ``leads_only``: a
    first sighting with a website hides later places of the same name."""
    return first_wins(with_name_key(places, keys), [*(run or []), "name_key"], order)


def slim(places: DataFrame, kept: list[str], keys: tuple[str, ...] = ("name",)) -> DataFrame:
    """The ``kept`` columns, the name key, and all other fields in the struct ``lead``,
    which is null if the place cannot be a lead. Such a place still hides later places
    of its name, but its key and position are enough for that; the rest need not be
    shuffled."""
    fields = [F.col(c) for c in places.columns if c not in kept]
    lead = F.when(is_lead(), F.struct(*fields)).alias("lead")
    return with_name_key(places, keys).select(*kept, "name_key", lead)


def first_sightings(
    places: DataFrame,
    order: list[str],
    run: list[str] | None = None,
    keys: tuple[str, ...] = ("name",),
) -> DataFrame:
    """``dedup_by_name`` on ``slim`` places."""
    run = run or []
    return first_wins(slim(places, [*order, *run], keys), [*run, "name_key"], order)


def place_key(place_id: Column, name: Column) -> Column:
    return F.coalesce(F.when(place_id != "", place_id), F.when(name != "", F.lower(name)))


def dedup_by_place(places: DataFrame, order: list[str], run: list[str] | None = None) -> DataFrame:
    """First place of every place id, or of the lower-case name where there is no id."""
    keyed = places.withColumn("place_key", place_key(F.col("place_id"), F.col("name")))
    return first_wins(keyed, [*(run or []), "place_key"], order)


def leads_only(places: DataFrame) -> DataFrame:
    """Active places with a name and without a website."""
    return places.where(is_lead())
