"""Leads from a stream of captured pages, emitted as soon as they are found.

**Memory.** The dedup must know every name ever seen, rejected ones as well. The names are keyed
state of the streaming query: an aggregation that holds, per name, the first place and the time
of its batch. A batch gets back the names it brings, and those whose first place has the time
of this very batch are new. So a batch costs what it brings, however many came before, and
the winner is the earliest batch, then the smallest ``page_id``. State is kept by the state
store of the session; ``STATE_STORE`` is used where the session names none, as it holds more
names than fit in memory.

**Publication.** All rows of a batch, new places and quarantined pages, are written by one job
into a new directory and become visible by one entry of the log (``sources.published``). A batch
that is run again after a failure replaces its first try in one step.

**A new checkpoint** on a store that has batches of other ones starts with their names: they are
written once below the checkpoint, and the stream takes them in with its first batch.

**Progress** is counted inside the streaming plan by ``observe`` and given to ``on_progress`` by a
``StreamingQueryListener``; it takes no job of its own.

The clock of the driver must not be set back while a store is in use, as batches are told
apart by their time.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from placeleads.operators.dedup import slim
from placeleads.operators.enrich import enrich_emails
from placeleads.operators.extract import place_records, quarantine, quarantine_reason
from placeleads.schema import PLACE, STREAM_ROW
from placeleads.sources.published import PublishedTables
from placeleads.sources.workdir import exists

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STATE_SETTING = "spark.sql.streaming.stateStore.providerClass"
# What a row of a batch is; each has a directory of its own.
LEAD, OTHER, BAD = "lead", "other", "quarantined"
_LEAD_COLUMNS = [f.name for f in PLACE.fields]


def stream_store(spark: SparkSession, store: str) -> PublishedTables:
    """The batches of all streams that write to a store."""
    tables, layout = {"batches": STREAM_ROW}, {"batches": ["kind"]}
    return PublishedTables(spark, store, tables, ["run", "batch_id"], layout)


def read_sightings(spark: SparkSession, store: str) -> DataFrame:
    """First sightings of all names. Of those that are no leads, only the key and the
    page are kept."""
    rows = stream_store(spark, store).read("batches").where(F.col("kind") != BAD)
    return rows.withColumn("is_lead", F.col("kind") == LEAD).drop("kind", "url", "reason")


def read_stream_leads(spark: SparkSession, store: str) -> DataFrame:
    """The leads found so far; only their part of the table is read."""
    rows = stream_store(spark, store).read("batches").where(F.col("kind") == LEAD)
    return rows.drop("kind", "url", "reason")


def read_quarantine(spark: SparkSession, store: str) -> DataFrame:
    """The pages no place could be read from, with the reason."""
    rows = stream_store(spark, store).read("batches").where(F.col("kind") == BAD)
    return rows.select("page_id", "url", "reason", "run", "batch_id")


def stream_totals(spark: SparkSession, store: str) -> DataFrame:
    """Number of leads so far, and when the last one came."""
    return read_stream_leads(spark, store).agg(
        F.count("*").alias("total_found"), F.max("seen_at").alias("last_updated")
    )


class ProgressListener(StreamingQueryListener):
    """Hands the counts observed in the batches of one query to a function."""

    def __init__(self, query_name: str, on_progress: Callable[[dict], None]):
        self.finished = threading.Event()
        self._name, self._on_progress, self._run = query_name, on_progress, None

    def onQueryStarted(self, event) -> None:
        if event.name == self._name:
            self._run = event.runId

    def onQueryProgress(self, event) -> None:
        if event.progress.name == self._name:
            counts = observed_counts(event.progress)
            if counts:
                self._on_progress(counts)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.runId == self._run:
            self.finished.set()


def observed_counts(progress) -> dict | None:
    """``batch_id``, ``processed``, ``quarantined`` and ``found`` of a progress report; none if
    it is of no batch."""
    metrics = progress.observedMetrics
    if "pages" not in metrics:
        return None
    # Without rows there is nothing to observe.
    pages, leads = metrics["pages"].asDict(), metrics["leads"].asDict() if "leads" in metrics else {}
    return {"batch_id": progress.batchId, **pages, "found": leads.get("found") or 0}


def start_lead_stream(
    pages: DataFrame,
    store: str,
    checkpoint: str,
    *,
    emails: DataFrame | None = None,
    on_result: Callable[[DataFrame, int], None] | None = None,
    on_progress: Callable[[dict], None] | None = None,
    trigger: dict | None = None,
    keys: tuple[str, ...] = ("name",),
    **extract_options,
) -> StreamingQuery:
    """Starts the stream. ``pages`` has ``page_id``, ``url`` and ``html``; files must
    arrive in the order of ``page_id``. ``emails`` is the output of ``lookup_emails``;
    as every batch reads it, write it to a table first if it is large.

    ``on_result`` gets the new leads of every batch as a DataFrame once they are published;
    ``on_progress`` gets ``batch_id``, ``processed``, ``quarantined`` and ``found`` soon after
    (``await_lead_stream`` waits for the last of it). Places are the same if they agree in
    ``keys``, without regard to case; one without a name is left out.

    Pages are read in the streaming plan itself, so that a batch consists of records
    without HTML. Places of a name meet in the one shuffle of the aggregation, after a
    first one per name and task; quarantined pages, found by narrow scans of their own, do not
    take part in it.
    """
    spark = pages.sparkSession
    if spark.conf.get(_STATE_SETTING, None) is None:
        spark.conf.set(_STATE_SETTING, STATE_STORE)
    checkpoint = checkpoint.rstrip("/")
    batches = _new_places(pages, _known_names(spark, store, checkpoint), keys, extract_options)
    listener = None
    name = f"leads-{uuid.uuid4().hex}"
    if on_progress is not None:
        listener = ProgressListener(name, on_progress)
        spark.streams.addListener(listener)

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        tables = stream_store(spark, store)
        own = {"run": _query_id(spark, checkpoint), "batch_id": batch_id}
        rows = enrich_emails(batch, emails) if emails is not None else batch
        tables.publish(own, {"batches": rows})
        if on_result is not None:
            found = tables.read_key("batches", own).where(F.col("kind") == LEAD)
            on_result(found.drop("kind", "url", "reason"), batch_id)

    writer = batches.writeStream.queryName(name).outputMode("update").foreachBatch(run_batch)
    query = (
        writer.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    query.progress_listener = listener
    return query


def await_lead_stream(query: StreamingQuery, timeout: float = 60) -> None:
    """Waits until a stream has ended and its progress has been handed on."""
    listener = query.progress_listener
    try:
        query.awaitTermination()
    finally:
        if listener is not None:
            listener.finished.wait(timeout)
            SparkSession.active().streams.removeListener(listener)


def _new_places(
    pages: DataFrame, known: DataFrame, keys: tuple[str, ...], extract_options: dict
) -> DataFrame:
    """Per batch a row for each name that no earlier batch brought, and for each quarantined
    page."""
    reason, now = quarantine_reason(), F.current_timestamp()
    counted = pages.withColumn("reason", reason).observe(
        "pages", F.count("*").alias("processed"), F.count("reason").alias("quarantined")
    )
    readable = counted.where("reason is null").drop("reason")
    records = place_records(readable, for_leads=keys == ("name",), **extract_options)
    places = slim(records, ["page_id"], keys).where("name_key is not null")
    sighting = F.struct(now.alias("seen_at"), "page_id", "lead").alias("sighting")
    first = (
        places.select("name_key", sighting)
        .unionByName(_as_sightings(known, places.schema["lead"].dataType))
        .groupBy("name_key")
        .agg(F.min("sighting").alias("sighting"))
        .select("name_key", "sighting.*")
        .where(F.col("seen_at") == now)
        .observe("leads", F.count("lead").alias("found"))
    )
    kind = F.when(F.col("lead").isNotNull(), LEAD).otherwise(OTHER).alias("kind")
    new = first.select("page_id", "name_key", "lead.*", "seen_at", kind)
    bad = quarantine(pages.select("page_id", "url", "html")).withColumn("kind", F.lit(BAD))
    columns = [f.name for f in STREAM_ROW.fields if f.name not in ("run", "batch_id")]
    return new.unionByName(bad.withColumn("seen_at", now), allowMissingColumns=True).select(columns)


def _as_sightings(known: DataFrame, lead: T.DataType) -> DataFrame:
    """Names that are known, as seen before all batches."""
    start = F.lit(0).cast("timestamp").alias("seen_at")
    page, none = F.lit(None).cast("long").alias("page_id"), F.lit(None).cast(lead).alias("lead")
    return known.select("name_key", F.struct(start, page, none).alias("sighting"))


def _known_names(spark: SparkSession, store: str, checkpoint: str) -> DataFrame:
    """The names that other streams have brought to the store, as a stream that ends with its
    first batch. They are written when a checkpoint is used for the first time."""
    path = f"{checkpoint}/known-names"
    if not exists(spark, f"{checkpoint}/metadata"):
        names = read_sightings(spark, store).select("name_key").distinct()
        names.write.mode("overwrite").parquet(path)
    return spark.readStream.schema("name_key string").parquet(path)


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the streaming query, which its checkpoint holds from the start on."""
    written = spark.read.text(f"{checkpoint}/metadata").first()["value"]
    return json.loads(written)["id"]
