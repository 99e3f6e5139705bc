"""Fill-in-the-middle: texts cut in three at boundaries, and put together in another order.

The boundaries of a text are the byte offsets at which a unit starts, and its end. They are
held as a ``BoundarySet``, a compressed set in the manner of Roaring bitmaps: the offsets are
split by their upper bits into chunks of ``CHUNK``, and each chunk is the smallest of

* a run container, starts and lengths of successive offsets (ASCII texts are runs),
* an array container, the offsets in order (lines, words),
* a bitmap container, one bit per offset (texts of wider characters).

Cumulative cardinalities say how many boundaries come before each container. The cut after
``r`` units is the boundary of rank ``r``: a search in the cumulative cardinalities finds the
container, a select within it the offset. Both cuts of a text are answered at once, and bytes
are sliced there, so no text is decoded.

Units are code points by default; ``unit="line"`` and ``unit="word"`` cut only in front of
lines or of words. The cuts, the form and the order follow from a hash of the document's id, so a run can be repeated.

Defined results: a null text counts as empty; empty texts and texts that contain one of the
markers stay plain. A missing id counts as an empty number. Rows are worked on one by one, in
parts of bounded size, so repeated rows give equal results; further columns are kept, those
with names of the operator's are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeleads.llm.common import add_columns, free_name

CHUNK = 1 << 16
SHARD_BYTES = 8 << 20
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN_FROM = 90  # of a hundred
SPM_BELOW = 20

RUN, ARRAY, BITMAP = "run", "array", "bitmap"


def _units_of_chunk(kind: str, data: np.ndarray, before: int) -> np.ndarray:
    """Marks the bytes that start a unit. ``before`` is the byte in front of them, -1 at the
    start of the text."""
    if kind == "char":
        return (data & 0xC0) != 0x80
    last = np.concatenate([[before], data[:-1].astype(np.int64)])
    if kind == "line":
        return (last == 10) | (last == -1)
    if kind == "word":
        blank = (data == 32) | ((data >= 9) & (data <= 13))
        gap = (last == 32) | ((last >= 9) & (last <= 13)) | (last == -1)
        return (~blank & gap) | (last == -1)
    raise ValueError(f"no such unit: {kind}")


class BoundarySet:
    """The unit starts of a text and its end, by rank."""

    def __init__(self, text: bytes, unit: str = "char"):
        data = np.frombuffer(text, np.uint8)
        self.size = len(data)
        self.containers: list[tuple] = []  # (kind, number of the chunk, what is in it)
        counts = []
        # The end of the text is a boundary as well, of a chunk of its own if need be.
        for number in range(self.size // CHUNK + 1):
            part = data[number * CHUNK : (number + 1) * CHUNK]
            before = int(data[number * CHUNK - 1]) if number else -1
            marks = _units_of_chunk(unit, part, before) if len(part) else np.zeros(0, bool)
            if len(part) < CHUNK:
                marks = np.append(marks, True)
            kind, content, count = _container(marks)
            if count:
                self.containers.append((kind, number, content))
                counts.append(count)
        self.ends = np.cumsum(counts)  # boundaries up to and with each container

    def __len__(self) -> int:
        """The number of boundaries, one more than there are units."""
        return int(self.ends[-1])

    @property
    def units(self) -> int:
        # An empty text has its end as the only boundary.
        return len(self) - 1

    def select(self, rank: int) -> int:
        """The byte offset of the boundary of this rank, from 0."""
        at = int(np.searchsorted(self.ends, rank, side="right"))
        kind, number, content = self.containers[at]
        local = rank - (int(self.ends[at - 1]) if at else 0)
        return number * CHUNK + _select(kind, content, local)


def _container(marks: np.ndarray) -> tuple[str, tuple, int]:
    """The smallest container for the marked places of a chunk, and their number."""
    count = int(np.count_nonzero(marks))
    if count == len(marks):
        return RUN, (np.zeros(1, np.int32), np.array([count], np.int32)), count
    edges = np.flatnonzero(np.diff(np.concatenate([[False], marks, [False]]).astype(np.int8)))
    starts, stops = edges[::2], edges[1::2]
    sizes = {RUN: 4 * len(starts), ARRAY: 2 * count, BITMAP: CHUNK // 8}
    kind = min(sizes, key=sizes.get)
    if kind == RUN:
        return kind, (starts.astype(np.int32), np.cumsum(stops - starts).astype(np.int32)), count
    if kind == ARRAY:
        return kind, (np.flatnonzero(marks).astype(np.uint16),), count
    bits = np.packbits(np.append(marks, np.zeros(-len(marks) % 8, bool)), bitorder="little")
    return kind, (bits, np.cumsum(np.bitwise_count(bits), dtype=np.int32)), count


def _select(kind: str, content: tuple, rank: int) -> int:
    """The place of the marked bit of this rank within a chunk."""
    if kind == ARRAY:
        return int(content[0][rank])
    values, ends = content
    at = int(np.searchsorted(ends, rank, side="right"))
    rank -= int(ends[at - 1]) if at else 0
    if kind == RUN:
        return int(values[at]) + rank
    bits = np.unpackbits(values[at : at + 1], bitorder="little")
    return 8 * at + int(np.flatnonzero(bits)[rank])


def arrange(text: bytes, form: str, first: int, second: int) -> bytes:
    """The output for cuts at two byte offsets."""
    if form == "plain":
        return text
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if form == "psm":
        return b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
    return b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))


def rebuild(output: bytes, form: str) -> bytes:
    """The text from an output and its form. No part contains a marker, and none can begin in
    one part and end in another, so the first of its kind is the right one."""
    if form == "plain":
        return output
    inner = SUFFIX if form == "psm" else PREFIX
    head, _, rest = output[len(PREFIX) :].partition(inner)
    tail, _, middle = rest.partition(MIDDLE)
    return head + middle + tail if form == "psm" else tail + middle + head


def _draw(digest: Column, i: int) -> Column:
    """The i-th group of eight hexadecimal digits as a number."""
    return F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long")


_ADDED = (
    "n bigint;form string;prefix_units bigint;middle_units bigint;prefix_bytes bigint;"
    "middle_bytes bigint;output string"
)


def transform(
    df: DataFrame, text: str = "text", doc_id: str = "doc_id", seed: int = 1, unit: str = "char"
) -> DataFrame:
    """The rows with ``n`` (units), ``form`` (plain, psm or spm), the units and bytes of prefix
    and middle (null if plain) and the ``output``."""
    number = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), number).cast("binary"), 256)
    draws = free_name(df, "draws")
    whole = free_name(df, "whole")
    rows = df.withColumn(draws, F.array(*[_draw(digest, i) for i in range(4)])).withColumn(
        whole, F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    )

    def one(data: bytes, h: list[int]) -> tuple:
        bounds = BoundarySet(data, unit)
        n = bounds.units
        marked = any(m in data for m in (PREFIX, SUFFIX, MIDDLE))
        if not data or marked or h[2] % 100 >= PLAIN_FROM:
            return n, "plain", None, None, None, None, data
        form = "spm" if h[3] % 100 < SPM_BELOW else "psm"
        low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        first, second = bounds.select(low), bounds.select(high)
        return n, form, low, high - low, first, second - first, arrange(data, form, first, second)

    def add(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        texts, groups = batch.column(whole), batch.column(draws).to_pylist()
        done = [one(t.as_py(), h) for t, h in zip(texts, groups, strict=True)]
        names = [part.split()[0] for part in _ADDED.split(";")]
        columns = list(zip(*done, strict=True)) if done else [()] * len(names)
        kinds = [pa.int64(), pa.string(), *[pa.int64()] * 4, pa.binary()]
        found = {c: pa.array(v, k) for c, v, k in zip(names, columns, kinds, strict=True)}
        found["output"] = found["output"].cast(pa.string())
        return found

    return add_columns(rows, add, _ADDED, lambda b: _sizes(b, whole), SHARD_BYTES).drop(draws, whole)


def restore(df: DataFrame, output: str = "output", form: str = "form") -> DataFrame:
    """The rows with ``restored``, the text rebuilt from an output and its form alone."""

    def add(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        both = zip(
            batch.column(output).cast(pa.binary()), batch.column(form).to_pylist(), strict=True
        )
        texts = pa.array([rebuild(o.as_py() or b"", f) for o, f in both], pa.binary())
        return {"restored": texts.cast(pa.string())}

    return add_columns(df, add, "restored string", lambda b: _sizes(b, output), SHARD_BYTES)


def _sizes(batch: pa.RecordBatch, column: str) -> list[int]:
    return [len(t.as_buffer()) if t.is_valid else 0 for t in batch.column(column)]
