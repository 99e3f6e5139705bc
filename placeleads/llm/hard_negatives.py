"""Hard negatives: for each anchor and positive, rows of other labels that score nearly as high.

Anchors are the rows whose id is divisible by ``ANCHOR_EVERY``. The score of a row is the
inner product of its whole-number vector with the anchor's. An anchor's positives are its
first rows of the same label; each positive of score ``p`` has a window of scores, from
``low`` to ``high`` percent of ``p``, and its negatives are the first rows of other labels in it.

The windows of one anchor overlap, so they are not searched one by one. Their upper limits,
in descending order, split the scores into disjoint slots: a slot ends below the next limit.
Every score is in one slot at most. Combiners keep the first ``k`` rows of each slot, in the
tasks, per anchor and slot; then slots are merged from the lowest up: the list of a window is
its own slot followed by the list of the window below, cut at ``k``. What is under the lower
limit of a window is at the end of its list and is cut off.

Rows are reduced once to a table of whole numbers. Anchors are taken in blocks of at most
``BLOCK_BYTES``; a block is broadcast, and each task multiplies it with its rows in matrices of
bounded size. A task gives back at most ``k`` rows per anchor and slot. So rows are never
shuffled, and no pair of rows is written.

Defined results: rows without an id, label or vector take no part, nor do rows with a null or
non-finite component, or one of ``LIMIT`` or more (so that all scores are exact). Vectors of
different lengths are multiplied as if filled up with zeros. An id that occurs several times
counts once, with its smallest label and then vector. Ties go to the smaller id. A positive
without a row in its window gives no row; a window of a negative score is empty. Columns
beyond the named three are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placeleads.llm.common import cut_lineage
from placeleads.sources.workdir import new_work_dir

ANCHOR_EVERY = 100
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90
SCALE = 256
LIMIT = 1 << 20
BLOCK_BYTES = 16 << 20
ROWS = 10_000  # rows of a matrix
_NONE = np.iinfo(np.int64).min
_VECTOR = "vec_id bigint, label bigint, vector binary"


def whole_vectors(
    df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """``(vec_id, label, vector)`` of the rows that take part; the vector is packed 32-bit
    whole numbers."""
    rows = df.select(
        F.col(f"`{vec_id}`").cast("long").alias("vec_id"),
        F.col(f"`{label}`").cast("long").alias("label"),
        F.col(f"`{vector}`").cast("array<double>").alias("vector"),
    )

    def run(batches):
        for batch in batches:
            lists = batch.column("vector")
            offsets = np.asarray(lists.offsets).astype(np.int64)
            values = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
            with np.errstate(over="ignore", invalid="ignore"):
                scaled = np.floor(values * SCALE)
            bad = np.concatenate([[0], np.cumsum(~(np.abs(scaled) < LIMIT))])
            good = bad[offsets[1:]] == bad[offsets[:-1]]
            packed = np.where(np.abs(scaled) < LIMIT, scaled, 0).astype("<i4").tobytes()
            out = [packed[4 * a : 4 * b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            columns = [batch.column("vec_id"), batch.column("label"), pa.array(out, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "vector"]).filter(
                pa.array(good)
            )

    complete = rows.where("vec_id is not null and label is not null and vector is not null")
    return complete.mapInArrow(run, _VECTOR)


def once(vectors: DataFrame) -> DataFrame:
    """Each id once. Only rows of repeated ids are shuffled."""
    again = cut_lineage(
        vectors.groupBy("vec_id").agg(F.count("*").alias("n")).where("n > 1").select("vec_id"),
        "repeated-ids",
    )
    first = (
        vectors.join(again, "vec_id", "left_semi")
        .groupBy("vec_id")
        .agg(F.min(F.struct("label", "vector")).alias("row"))
        .select("vec_id", "row.*")
    )
    return vectors.join(again, "vec_id", "left_anti").unionByName(first)


def _matrix(packed: list[bytes], width: int) -> np.ndarray:
    """Vectors as rows of a matrix, filled up with zeros."""
    size = np.array([len(p) // 4 for p in packed])
    flat = np.frombuffer(b"".join(packed), "<i4")
    if len(size) and (size == width).all():
        return flat.reshape(len(packed), width).astype(np.float64)
    out = np.zeros((len(packed), width))
    out[np.arange(width) < size[:, None]] = flat
    return out


def _scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """All inner products, exact: in floating point as long as that holds them."""
    width = min(anchors.shape[1], rows.shape[1])
    a, b = anchors[:, :width], rows[:, :width]
    most = (np.abs(a).max(initial=0) or 1) * (np.abs(b).max(initial=0) or 1) * max(width, 1)
    if most < 2**53:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


class _First:
    """The first ``k`` rows of each of some lists, by descending score and ascending id."""

    def __init__(self, lists: int, k: int):
        self.k = k
        self.scores = np.full((lists, k), _NONE)
        self.ids = np.zeros((lists, k), np.int64)

    def least(self) -> np.ndarray:
        """The score a row must reach to get in; with a tie, its id decides."""
        return self.scores[:, -1]

    def add(self, at: int, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > self.k:
            # Ties of the last score are all kept until ids are compared.
            edge = np.partition(scores, len(scores) - self.k)[-self.k]
            inside = scores >= edge
            scores, ids = scores[inside], ids[inside]
        scores = np.concatenate([self.scores[at], scores])
        ids = np.concatenate([self.ids[at], ids])
        order = np.lexsort((ids, ~scores))[: self.k]  # not -scores: the least has no negative
        self.scores[at], self.ids[at] = scores[order], ids[order]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List, score and id of all that is kept."""
        at, place = np.nonzero(self.scores != _NONE)
        return at, self.scores[at, place], self.ids[at, place]


def _blocks_of_rows(batches):
    """Ids, labels and matrices of at most ``ROWS`` rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            packed = part.column("vector").to_pylist()
            width = max((len(p) // 4 for p in packed), default=0)
            yield (
                part.column("vec_id").to_numpy(),
                part.column("label").to_numpy(),
                _matrix(packed, width),
            )


def _parts(block: dict, rows: np.ndarray):
    """Places of anchors and their scores, a bounded number of scores at a time."""
    step = max(1, (4 << 20) // max(len(rows), 1))
    for start in range(0, len(block["ids"]), step):
        yield start, _scores(block["vectors"][start : start + step], rows)


_TOP = "anchor_id bigint, slot int, score bigint, vec_id bigint"


def _emit(block: dict, lists: _First, slots: int) -> pa.RecordBatch:
    at, scores, ids = lists.rows()
    columns = [block["ids"][at // slots], (at % slots).astype(np.int32), scores, ids]
    return pa.RecordBatch.from_arrays(
        [pa.array(c) for c in columns], ["anchor_id", "slot", "score", "vec_id"]
    )


def _top_positives(rows: DataFrame, shared, k: int) -> DataFrame:
    """Per task and anchor the first ``k`` other rows of its label."""

    def run(batches):
        block = shared.value
        lists = _First(len(block["ids"]), k)
        for ids, labels, vectors in _blocks_of_rows(batches):
            for start, scores in _parts(block, vectors):
                for i, own in enumerate(scores, start):
                    fit = (labels == block["labels"][i]) & (own >= lists.least()[i])
                    fit &= ids != block["ids"][i]
                    if fit.any():
                        lists.add(i, own[fit], ids[fit])
        yield _emit(block, lists, 1)

    return rows.mapInArrow(run, _TOP)


def _top_of_slots(rows: DataFrame, shared, k: int) -> DataFrame:
    """Per task, anchor and slot the first ``k`` rows of other labels. ``limits`` of an anchor
    are the upper limits in ascending order, ``least`` is the lowest score of any window."""

    def run(batches):
        block = shared.value
        limits, slots = block["limits"], block["limits"].shape[1]
        lists = _First(len(block["ids"]) * slots, k)
        for ids, labels, vectors in _blocks_of_rows(batches):
            for start, scores in _parts(block, vectors):
                for i, own in enumerate(scores, start):
                    fit = (labels != block["labels"][i]) & (own >= block["least"][i])
                    fit &= own <= limits[i, -1]
                    if not fit.any():
                        continue
                    some, names = own[fit], ids[fit]
                    # The slot of a score is that of the lowest limit it does not exceed.
                    slot = np.searchsorted(limits[i], some, side="left")
                    enough = some >= lists.least()[i * slots + slot]
                    for s in np.unique(slot[enough]):
                        inside = enough & (slot == s)
                        lists.add(i * slots + s, some[inside], names[inside])
        yield _emit(block, lists, slots)

    return rows.mapInArrow(run, _TOP)


def _first_rows(tops: DataFrame, k: int) -> DataFrame:
    """Of what the tasks kept, the first ``k`` per anchor and slot, with their ``place``."""
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    return tops.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


_LIST = "array<struct<place:int,score:bigint,vec_id:bigint>>"


def _merged(slots: Column, k: int) -> Column:
    """The list of every slot merged with those below it, from lists by ascending slot. Scores
    of a slot are all higher than those below, so a merge is one list behind the other."""
    start = F.struct(
        F.array().cast(_LIST).alias("list"), F.array().cast(f"array<{_LIST}>").alias("lists")
    )

    def step(state: Column, own: Column) -> Column:
        merged = F.slice(F.concat(own, state["list"]), 1, k)
        return F.struct(
            merged.alias("list"), F.concat(state["lists"], F.array(merged)).alias("lists")
        )

    return F.aggregate(slots, start, step, lambda state: state["lists"])


def _answers(slots: DataFrame, windows: DataFrame, count: int, k: int) -> DataFrame:
    """The negatives of all windows: the list of a window's slot, without what is below its
    lower limit."""
    each = slots.groupBy("anchor_id", "slot").agg(
        F.sort_array(F.collect_list(F.struct("place", "score", "vec_id"))).alias("list")
    )
    lists = each.groupBy("anchor_id").agg(
        F.map_from_entries(F.collect_list(F.struct("slot", "list"))).alias("of")
    )
    none = F.array().cast(_LIST)
    by_slot = F.transform(
        F.sequence(F.lit(0), F.lit(count - 1)), lambda s: F.coalesce(F.try_element_at("of", s), none)
    )
    merged = lists.select("anchor_id", _merged(by_slot, k).alias("lists"))
    inside = F.filter(F.get("lists", F.col("slot")), lambda r: r["score"] >= F.col("low"))
    found = windows.join(merged, "anchor_id").select(
        "anchor_id", "positive_id", "positive_score", F.posexplode(inside).alias("at", "row")
    )
    return found.select(
        "anchor_id",
        "positive_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("row.vec_id").alias("negative_id"),
        "positive_score",
        F.col("row.score").alias("negative_score"),
    )


_NEGATIVE = (
    "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, "
    "negative_score bigint"
)


def _hundredths(x: Column) -> Column:
    """A whole number divided by 100, rounded down."""
    return F.call_function("div", x - F.pmod(x, F.lit(100)), F.lit(100))


def _with_limits(positives: DataFrame, low: int, high: int) -> DataFrame:
    """The windows that are not empty: their limits, and their slot, counted from the lowest
    upper limit of the anchor."""
    p = F.col("score")
    own = Window.partitionBy("anchor_id").orderBy("high")
    return (
        positives.select(
            "anchor_id",
            F.col("vec_id").alias("positive_id"),
            p.alias("positive_score"),
            (-_hundredths(-p * low)).alias("low"),
            _hundredths(p * high).alias("high"),
        )
        .where("low <= high")
        .withColumn("slot", F.dense_rank().over(own) - 1)
    )


def mine(
    df: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``: for
    each anchor and positive its first negatives, ranked from 1."""
    spark = df.sparkSession
    rows = cut_lineage(once(cut_lineage(whole_vectors(df, vec_id, vector, label), "vectors")), "rows")
    anchors = rows.where(F.col("vec_id") % ANCHOR_EVERY == 0)
    # What an anchor takes in a task: its vector and its lists.
    need = F.octet_length("vector") * 2 + 16 * positives * negatives
    total = anchors.agg(F.sum(need)).first()[0] or 0
    blocks = math.ceil(total / BLOCK_BYTES)
    done = new_work_dir(spark, "hard-negatives")
    for number in range(blocks):
        own = anchors.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == number)
        block = _block(own)
        if not len(block["ids"]):
            continue
        shared = spark.sparkContext.broadcast(block)
        found = _first_rows(_top_positives(rows, shared, positives), positives)
        windows = cut_lineage(_with_limits(found, low, high), "windows")
        shared.unpersist()
        shared = spark.sparkContext.broadcast(_block_with_limits(block, windows, positives))
        slots = _first_rows(_top_of_slots(rows, shared, negatives), negatives)
        _answers(slots, windows, positives, negatives).write.parquet(f"{done}/block={number}")
        shared.unpersist()
    if not blocks:
        return spark.createDataFrame([], _NEGATIVE)
    return spark.read.schema(_NEGATIVE).parquet(done).select(*_NEGATIVE_COLUMNS)


_NEGATIVE_COLUMNS = [part.split()[0] for part in _NEGATIVE.split(", ")]


def _block(anchors: DataFrame) -> dict:
    """Ids, labels and vectors of a block of anchors, in the order of ids."""
    got = anchors.orderBy("vec_id").toArrow()
    packed = got.column("vector").to_pylist()
    width = max((len(p) // 4 for p in packed), default=0)
    return {
        "ids": got.column("vec_id").to_numpy(),
        "labels": got.column("label").to_numpy(),
        "vectors": _matrix(packed, width),
    }


def _block_with_limits(block: dict, windows: DataFrame, slots: int) -> dict:
    """The block with the limits of its windows, at most ``slots`` an anchor."""
    got = windows.select("anchor_id", "slot", "low", "high").toArrow()
    at = np.searchsorted(block["ids"], got.column("anchor_id").to_numpy())
    limits = np.full((len(block["ids"]), slots), _NONE)
    limits[at, got.column("slot").to_numpy()] = got.column("high").to_numpy()
    # Slots that an anchor lacks repeat its highest limit, so no score falls into them.
    limits = np.maximum.accumulate(limits, axis=1)
    least = np.full(len(block["ids"]), np.iinfo(np.int64).max)
    np.minimum.at(least, at, got.column("low").to_numpy())
    return {**block, "limits": limits, "least": least}
