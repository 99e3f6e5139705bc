"""Quality classifier by compression.

Two zstandard dictionaries are built, one from text labelled good and one from text labelled
bad. A text is cut into chunks, and each chunk is compressed with either dictionary. The
difference of the compressed sizes over the size of the text says which kind it resembles; a
logistic curve, fitted on labelled documents that gave nothing to the dictionaries, turns it
into a score from 0 to 1.

Fitting uses a bounded sample: at most ``max_docs`` labelled documents per label and
``max_chunks`` chunks of them, in the order of a hash. Documents of which the checksum of the
id leaves 1 modulo 3 are never used. Scoring reads every text in full.

Defined results: a null or empty text scores what a difference of 0 means. Documents with
labels that contradict each other are not used. Without labels of both kinds every score is
0.5. Rows are scored one by one; further columns are kept, columns named as the operator's
are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeleads.llm.common import add_columns

CHUNK = 4096
LEVEL = 3
DICTIONARY = 1 << 16
MAX_DOCS = 4000
MAX_CHUNKS = 6000


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def chunks(text: bytes) -> list[bytes]:
    return [text[i : i + CHUNK] for i in range(0, len(text), CHUNK)]


def build_dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the samples themselves if they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY:]


class Sizes:
    """Compressed sizes under the two dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        self.pair = []
        for raw in (good, bad):
            ready = zstandard.ZstdCompressionDict(raw)
            ready.precompute_compress(level=LEVEL)
            self.pair.append(
                zstandard.ZstdCompressor(
                    dict_data=ready, write_content_size=False, write_dict_id=False
                )
            )

    def difference(self, text: bytes) -> float:
        """Size with the bad dictionary less size with the good one, per byte of text."""
        good, bad = (sum(len(c.compress(part)) for part in chunks(text)) for c in self.pair)
        return (bad - good) / len(text) if text else 0.0


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve, by Newton steps with a small penalty."""
    rows = np.stack([x, np.ones_like(x)], axis=1)
    weights, penalty = np.zeros(2), np.diag([1e-4, 1e-4])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (y - p) - penalty @ weights
        curve = (rows * (p * (1 - p))[:, None]).T @ rows + penalty
        step = np.linalg.solve(curve, slope)
        weights = weights + step
        if np.abs(step).max() < 1e-9:
            break
    return float(weights[0]), float(weights[1])


@dataclass
class Model:
    good: bytes
    bad: bytes
    scale: float
    slope: float
    intercept: float


def _sample(
    documents: DataFrame, labels: DataFrame, text: str, doc_id: str, label: str, max_docs: int, max_chunks: int
) -> list:
    """Chunks of labelled documents: label, half (of the documents) and bytes."""
    known = (
        labels.select(F.col(doc_id).cast("long").alias("doc"), F.col(label).cast("int").alias("label"))
        .where("doc is not null and label in (0, 1)")
        .groupBy("doc")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other")
        .where(~held_out(F.col("doc")))
    )
    order = F.xxhash64("doc")
    parts = [
        known.where(F.col("label") == kind).orderBy(order, "doc").limit(max_docs).select("doc", "label")
        for kind in (0, 1)
    ]
    chosen = F.broadcast(parts[0].union(parts[1]))
    texts = documents.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc"), F.col(f"`{text}`").cast("binary").alias("text")
    )

    def cut(batches):
        for batch in batches:
            rows = [
                (label, doc, i, part)
                for doc, text, label in zip(*(c.to_pylist() for c in batch.columns), strict=True)
                for i, part in enumerate(chunks(text or b""))
            ]
            columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
            kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["label", "doc", "number", "part"],
            )

    schema = "label int, doc bigint, number int, part binary"
    cut_up = texts.join(chosen, "doc").mapInArrow(cut, schema)
    rows = []
    for kind in (0, 1):
        some = cut_up.where(F.col("label") == kind)
        rows += some.orderBy(F.xxhash64("doc", "number"), "doc", "number", "part").limit(max_chunks).collect()
    return rows


def fit(
    documents: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    label: str = "quality",
    max_docs: int = MAX_DOCS,
    max_chunks: int = MAX_CHUNKS,
) -> Model | None:
    """Dictionaries from one half of the sampled documents, the curve from the other; then
    the other way round for more to fit the curve on, with the dictionaries of the first."""
    rows = _sample(documents, labels, text, doc_id, label, max_docs, max_chunks)
    halves: dict[int, list] = {0: [], 1: []}
    for r in rows:
        halves[hash_half(r["doc"])].append(r)
    models, xs, ys = [], [], []
    for mine, other in ((0, 1), (1, 0)):
        good, bad = (
            [bytes(r["part"]) for r in halves[mine] if r["label"] == kind] for kind in (1, 0)
        )
        if not good or not bad:
            continue
        pair = build_dictionary(good), build_dictionary(bad)
        sizes = Sizes(*pair)
        docs: dict[tuple, list] = {}
        for r in halves[other]:
            docs.setdefault((r["doc"], r["label"]), []).append(bytes(r["part"]))
        xs += [sizes.difference(b"".join(parts)) for parts in docs.values()]
        ys += [kind for _, kind in docs]
        models.append(pair)
    if not models or len(set(ys)) < 2:
        return None
    x = np.array(xs)
    scale = float(np.abs(x).mean()) or 1.0
    slope, intercept = fit_curve(x / scale, np.array(ys, float))
    return Model(*models[0], scale, slope, intercept)


def hash_half(doc: int) -> int:
    """Half of the sample that a document is in."""
    return (doc * 0x9E3779B97F4A7C15 >> 40) & 1


def score(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The rows with ``score`` and ``predicted``."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    held: dict = {}

    def add(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        model = shared.value
        if model is None:
            scores = np.full(batch.num_rows, 0.5)
        else:
            if not held:
                held["sizes"] = Sizes(model.good, model.bad)
            difference = held["sizes"].difference
            x = np.array(
                [
                    difference((t.as_py() or "").encode("utf-8", "surrogatepass"))
                    for t in batch.column(text)
                ],
                float,
            )
            scores = 1 / (1 + np.exp(-np.clip(x / model.scale * model.slope + model.intercept, -30, 30)))
        return {
            "score": pa.array(scores, pa.float64()),
            "predicted": pa.array((scores >= 0.5).astype(np.int32), pa.int32()),
        }

    return add_columns(df, add, "score double;predicted int")
