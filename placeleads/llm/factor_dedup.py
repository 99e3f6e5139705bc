"""Substring dedup by longest previous factors.

A byte is removed if a string of ``length`` bytes over it also starts in a document with a
smaller id. For a position the longest previous factor is the longest string starting there
that also starts in an earlier document; here it need only be known whether it reaches
``length``, so suffixes are cut at that many bytes. In suffix order equal cut suffixes are
neighbours; the previous smaller document in that order, if it shares the cut suffix, is the
earlier match. The steps:

1. Whole copies of a text are found by a 128-bit hash; only the first goes on.
2. Every string of ``length`` bytes is represented by its ``GRAM``-byte gram with the smallest
   hash, one for about fourteen positions. Hashes that only one document has cannot repeat;
   they are dropped by one sort of ``(hash, document)`` pairs.
3. The documents with hashes left are cut into segments, the strings with one gram. Segments
   are sorted by the suffix that starts at the gram. All but the first document of a segment
   are removed there, which settles the inside of long matches. Where a gram has several
   segments (the ends of matches), the neighbours in this order, and in the order of what
   stands before the gram, tell the longest factors to the right and to the left.
   Grams with a few first documents are settled there and then.
4. Strings that these factors allow to repeat are sorted, and all that follow a smaller
   document with the same cut suffix are removed.

Only the first document of each distinct segment gets to step 4, so copies cost one row per
segment, never pairs. Steps 2 to 4 read sorted rows as a stream and keep a few in memory.
Texts are shuffled only of documents that have something in common with others.

Defined results: null and empty texts have no bytes. Documents without an id are kept whole
and are no one's earlier document. Rows with the same id never remove bytes from each other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeleads.llm.common import add_columns, cut_lineage, shards, split_by_key

LENGTH = 50
GRAM = 24
FEW = 256  # first rows of a gram that are compared at once
PART_BYTES = 1 << 20  # of text, of which segments are held at a time
_CHUNK = 1 << 16
_BASE = 0x5851F42D4C957F2D
_MIX = 0x9E3779B97F4A7C15


def _powers(base: int) -> np.ndarray:
    out = np.full(_CHUNK + 256, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


class Minima:
    """Smallest gram hash of every string of ``length`` bytes of a text."""

    def __init__(self, length: int):
        self.length = length
        self.gram = min(GRAM, max(length // 2, 1))
        self.up, self.down = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))

    def _hashes(self, data: np.ndarray) -> np.ndarray:
        """Hashes of all grams of some bytes."""
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=sums[1:])
        grams = (sums[self.gram :] - sums[: -self.gram]) * self.down[: len(data) - self.gram + 1]
        grams ^= grams >> np.uint64(29)
        grams *= np.uint64(_MIX)
        return grams ^ (grams >> np.uint64(32))

    def _least(self, low: np.ndarray) -> np.ndarray:
        """Smallest hash of the grams of every string."""
        left, width = self.length - self.gram + 1, 1
        while width * 2 <= left:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        return np.minimum(low[: len(low) - (left - width)], low[left - width :])

    def _last_least(self, hashes: np.ndarray) -> np.ndarray:
        """Place of the smallest gram of every string, the last one of equal grams."""
        low, place = hashes, np.arange(len(hashes))
        left, width = self.length - self.gram + 1, 1
        while width < left:
            step = min(width, left - width)
            later = low[step:] <= low[:-step]
            low = np.where(later, low[step:], low[:-step])
            place = np.where(later, place[step:], place[:-step])
            width += step
        return place

    def _parts(self, text: bytes):
        data = np.frombuffer(text, np.uint8)
        last = len(data) - self.length + 1
        for at in range(0, last, _CHUNK):
            yield at, data[at : min(at + _CHUNK, last) + self.length - 1]

    def values(self, text: bytes) -> np.ndarray:
        """The distinct minima of a text."""
        found = [self._least(self._hashes(part)) for _, part in self._parts(text)]
        found = [f[np.concatenate([[True], f[1:] != f[:-1]])] for f in found]
        return np.unique(np.concatenate(found)).view(np.int64) if found else np.zeros(0, np.int64)

    def segments(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of strings whose last smallest gram is the same: the hash and place of the
        gram, and the first string of each run and of the one after the last."""
        hashes, grams = [], []
        for at, part in self._parts(text):
            low = self._hashes(part)
            place = self._last_least(low)
            hashes.append(low[place])
            grams.append(place + at)
        if not grams:
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(1, np.int64)
        places = np.concatenate(grams)
        starts = np.concatenate([[0], np.flatnonzero(places[1:] != places[:-1]) + 1])
        bounds = np.concatenate([starts, [len(places)]])
        return np.concatenate(hashes)[starts].view(np.int64), places[starts], bounds


def _parts(batches):
    """Batches of texts, cut to about ``PART_BYTES``."""
    for batch in batches:
        sizes = [n or 0 for n in pc.binary_length(batch.column("text")).to_pylist()]
        for start, stop in shards(sizes, PART_BYTES):
            yield batch.slice(start, stop - start)


def _values(texts: DataFrame, length: int) -> DataFrame:
    """``(value, row)`` for each distinct value of a document."""

    def run(batches):
        minima = Minima(length)
        for batch in _parts(batches):
            found = [minima.values(t.as_py()) for t in batch.column("text")]
            rows = np.repeat(np.array(batch.column("row")), [len(f) for f in found])
            values = np.concatenate(found) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(rows)], ["value", "row"])

    long_enough = texts.where(F.octet_length("text") >= length).select("row", "text")
    return long_enough.mapInArrow(run, "value bigint, row bigint")


def _shared(values: DataFrame) -> DataFrame:
    """The pairs whose value has more than one row, from pairs in the order of values."""

    def run(batches):
        held = np.zeros((2, 0), np.int64)  # the last pair, whose next is not known yet
        twin = False  # whether the pair before it has its value
        for batch in batches:
            pairs = np.concatenate([held, np.array([np.asarray(c) for c in batch.columns])], axis=1)
            if not pairs.shape[1]:
                continue
            same = pairs[0][1:] == pairs[0][:-1]
            keep = np.concatenate([[twin], same]) | np.concatenate([same, [False]])
            twin, held = bool(keep[-1]), pairs[:, -1:]
            keep[-1] = False
            yield _two(pairs[:, keep])
        if twin:
            yield _two(held)

    def _two(pairs):
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["value", "row"])

    ordered = values.repartition("value").sortWithinPartitions("value")
    return ordered.mapInArrow(run, "value bigint, row bigint")


_SEGMENT = "value bigint, after binary, before binary, doc bigint, row bigint, gram int"


def _segments(texts: DataFrame, length: int) -> DataFrame:
    """Segments of the documents at their shared values: the bytes from the gram on, the bytes
    before it from its side outwards, and the place of the gram."""

    def run(batches):
        minima = Minima(length)
        for batch in _parts(batches):
            rows = []
            for row, doc, text, shared in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                values, grams, bounds = minima.segments(text)
                hit = np.flatnonzero(np.isin(values, np.array(shared, np.int64)))
                for value, gram, start, stop in zip(
                    values[hit].tolist(), grams[hit].tolist(), bounds[hit].tolist(),
                    bounds[hit + 1].tolist(), strict=True,
                ):
                    after = text[gram : stop + length - 1]
                    rows.append((value, after, text[start:gram][::-1], doc, row, gram))
            yield _batch(rows, _SEGMENT)

    return texts.select("row", "doc", "text", "shared").mapInArrow(run, _SEGMENT)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [part.split() for part in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)],
        [n for n, _ in fields],
    )


def _common(a: bytes, b: bytes) -> int:
    """Length of the common beginning."""
    size = min(len(a), len(b))
    if a[:size] == b[:size]:
        return size
    low, high = 0, size - 1
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle - 1
    return low


_HEAD = f"{_SEGMENT}, right int, stop int"
_FOUND = "doc bigint, row bigint, start int, stop int, suffix binary"


def _few(rows: list[tuple], length: int) -> list[tuple]:
    """Removed ranges among a few segments of one gram: strings that an earlier document of
    theirs has."""
    first: dict[bytes, int] = {}
    texts = [(before[::-1] + after, doc) for _, after, before, doc, _, _ in rows]
    for text, doc in texts:
        for i in range(len(text) - length + 1):
            w = text[i : i + length]
            if first.get(w, doc) >= doc:
                first[w] = doc
    out = []
    for (text, doc), (value, _, before, _, row, gram) in zip(texts, rows, strict=True):
        base, start = gram - len(before), None
        for i in range(len(text) - length + 2):
            inside = i <= len(text) - length and first[text[i : i + length]] < doc
            if inside and start is None:
                start = i
            elif not inside and start is not None:
                stop = base + i - 1 + length
                out.append((value, None, None, doc, row, base + start, None, stop))
                start = None
    return out


def _first_of_segments(segments: DataFrame, length: int) -> DataFrame:
    """In suffix order: of each distinct segment the rows of its first document, if its gram
    has other segments, with the longest factor to the right that another segment has; and
    removed ranges, which have a stop: the segments of later documents, and all that can be
    settled here because a gram has at most ``FEW`` first rows."""

    def run(batches):
        value = key = first = None
        held: list[tuple] = []  # rows of the first document of the segment at hand
        reach = -1  # longest factor with the segment before; -1 if it is the gram's first
        few: list[tuple] | None = []  # first rows of the gram; none if they are too many
        waiting: list[tuple] = []  # the same with their factors, as long as they are few

        def end_segment(common: int) -> list[tuple]:
            nonlocal few, waiting
            right, out = max(reach, common), []
            rows = [(*h, right, None) for h in held]
            if few is None:
                return rows
            waiting += rows
            few += held
            if len(few) > FEW:
                out, few, waiting = waiting, None, []
            return out

        def end_gram() -> list[tuple]:
            out = end_segment(-1)
            return out + (_few(few, length) if few and few[0][1:3] != few[-1][1:3] else [])

        for batch in batches:
            out: list[tuple] = []
            for each in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                v, after, before, doc, row, gram = each
                if v != value:
                    out += end_gram()
                    value, key, first, held, reach = v, (after, before), doc, [], -1
                    few, waiting = [], []
                elif (after, before) != key:
                    common = _common(after, key[0])
                    out += end_segment(common)
                    key, first, held, reach = (after, before), doc, [], common
                if doc > first:
                    out.append((v, None, None, doc, row, gram - len(before), None, gram + len(after)))
                else:
                    held.append(each)
            yield _batch(out, _HEAD)
        yield _batch(end_gram(), _HEAD)

    ordered = segments.repartition("value").sortWithinPartitions("value", "after", "before", "doc")
    return ordered.mapInArrow(run, _HEAD)


def _settled(heads: DataFrame, length: int) -> DataFrame:
    """Removed ranges (no suffix), and the cut suffixes that factors to the left, found in the
    order of what is before the gram, and to the right allow to repeat."""

    def run(batches):
        held: tuple | None = None  # the row whose next neighbour is not known yet
        reach = -1  # longest factor with the neighbour before

        def suffixes(row: tuple, left: int):
            _, after, before, doc, key, gram, right, _ = row
            text = before[::-1] + after
            base = gram - len(before)
            low = len(before) - left if left >= 0 else len(text)
            high = min(len(text), len(before) + right) - length
            for i in range(low, high + 1):
                yield doc, key, base + i, base + i + length, text[i : i + length]

        for batch in batches:
            out: list[tuple] = []
            for each in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                value, _, before, doc, key, gram, _, stop = each
                if stop is not None:
                    out.append((doc, key, gram, stop, None))
                    continue
                same = held is not None and held[0] == value
                common = _common(before, held[2]) if same else -1
                if held:
                    out += suffixes(held, max(reach, common))
                held, reach = each, common
            yield _batch(out, _FOUND)
        if held:
            yield _batch(list(suffixes(held, reach)), _FOUND)

    return heads.sortWithinPartitions("value", "before").mapInArrow(run, _FOUND)


def _earlier(suffixes: DataFrame) -> DataFrame:
    """Ranges of suffixes that follow, in suffix order, a smaller document's equal one."""

    def run(batches):
        last = first = None
        for batch in batches:
            out = []
            for doc, row, start, stop, suffix in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if suffix != last:
                    last, first = suffix, doc
                elif doc > first:
                    out.append((doc, row, start, stop))
            yield _batch(out, "doc bigint, row bigint, start int, stop int")

    ordered = suffixes.repartition("suffix").sortWithinPartitions("suffix", "doc")
    return ordered.mapInArrow(run, "doc bigint, row bigint, start int, stop int")


def _cut(text: bytes | None, ranges: np.ndarray) -> tuple[bytes, int, int]:
    """What is left of a text, the bytes removed and the removed runs. A range is a number of
    which the upper half is the start and the lower half the stop."""
    text = text or b""
    if not len(ranges):
        return text, 0, 0
    size = len(text) + 1
    steps = np.bincount(ranges >> 32, minlength=size) - np.bincount(ranges & 0xFFFFFFFF, minlength=size)
    gone = np.cumsum(steps) > 0  # the last entry is past the text and never covered
    runs = int(np.count_nonzero(gone[:-1] & ~gone[1:]))
    return np.frombuffer(text, np.uint8)[~gone[:-1]].tobytes(), int(gone.sum()), runs


def remove_repeats(
    df: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH
) -> DataFrame:
    """``(doc_id, n_bytes, kept, n_removed, n_spans)`` for every row; ``kept`` are the bytes
    that are left."""
    rows = df.select(
        F.xxhash64(F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`")).alias("row"),
        F.col(f"`{doc_id}`").cast("long").alias("doc"),
        F.col(f"`{text}`").cast("binary").alias("text"),
    )
    known = rows.where("doc is not null")
    hashed = known.where(F.octet_length("text") >= length).select(
        "doc", "row", F.md5("text").alias("copy"), F.octet_length("text").alias("size")
    )
    firsts = (
        hashed.groupBy("copy").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    ).where("first < last")
    copies = cut_lineage(
        hashed.join(cut_lineage(firsts, "first-copies"), "copy")
        .where("doc > first")
        .select("row", "doc", F.lit(0).alias("start"), F.col("size").alias("stop"))
        .distinct(),
        "copies",
    )
    maybe, single = split_by_key(known, "row", copies)
    known = single.union(maybe.join(copies.select("row"), "row", "left_anti").select(known.columns))
    shared = cut_lineage(
        _shared(_values(known, length)).groupBy("row").agg(F.collect_list("value").alias("shared")),
        "shared-values",
    )
    some, _ = split_by_key(known, "row", shared)
    heads = _first_of_segments(_segments(some.join(shared, "row"), length), length)
    found = cut_lineage(_settled(heads, length), "factors")
    settled = found.where("suffix is null").drop("suffix")
    later = settled.union(_earlier(found.where("suffix is not null"))).unionByName(copies)
    packed = F.call_function("shiftleft", F.col("start").cast("long"), F.lit(32)) + F.col("stop")
    ranges = cut_lineage(
        later.groupBy("row", "doc").agg(F.collect_list(packed).alias("ranges")), "ranges"
    )
    touched, whole = split_by_key(rows, "row", ranges)

    def cut(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        none = np.zeros(0, np.int64)
        done = [
            _cut(text.as_py(), np.asarray(r.values) if r.is_valid else none)
            for text, r in zip(batch.column("text"), batch.column("ranges"), strict=True)
        ]
        return {
            "kept": pa.array([d[0] for d in done], pa.binary()),
            "n_removed": pa.array([d[1] for d in done], pa.int64()),
            "n_spans": pa.array([d[2] for d in done], pa.int64()),
        }

    def weigh(batch: pa.RecordBatch) -> list[int]:
        return [n or 0 for n in pc.binary_length(batch.column("text")).to_pylist()]

    added = "kept binary;n_removed bigint;n_spans bigint"
    with_ranges = touched.join(ranges, ["row", "doc"], "left")
    changed = add_columns(with_ranges, cut, added, weigh, PART_BYTES)
    none = F.lit(0).cast("long")
    same = whole.select(
        "*", F.coalesce("text", F.lit(b"")).alias("kept"), none.alias("n_removed"), none.alias("n_spans")
    )
    return (
        changed.drop("ranges")
        .unionByName(same)
        .select(
            F.col("doc").alias("doc_id"),
            F.coalesce(F.octet_length("text").cast("long"), none).alias("n_bytes"),
            "kept",
            "n_removed",
            "n_spans",
        )
    )
