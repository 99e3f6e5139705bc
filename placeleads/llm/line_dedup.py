"""Line dedup: runs of lines that occurred before are deleted, the first occurrence stays.

A text is a sequence of lines; white space around a line does not count, and lines without a
word are passed over. Each line has a hash. Of every ``window`` consecutive lines the one
with the smallest hash is selected as a fingerprint (winnowing), so any run of at least
``window`` lines that two places share has a selected fingerprint in both. The steps:

1. select fingerprints in all documents, with the windows that chose each;
2. keep the positions of fingerprints that occur more than once;
3. extend there: every window around the position, to the left and to the right, is compared
   with the windows of the other positions by a 128-bit hash of its lines; a run grows as
   long as its windows repeat;
4. delete a line if a window over it occurred earlier, in a document with a smaller id or
   further up in the same one. Windows of fewer than ``min_chars`` characters do not count.

Only texts that lose a line are shuffled; the others stay where they are scanned.

Shorter passages count as well: every run of fewer than ``window`` lines with at least
``passage_words`` words (between ASCII white space), and every text of fewer lines that has
``min_chars`` characters, is a fingerprint of its own, with no selection. With None for
``passage_words`` such passages stay, as a single repeated line does.

Positions are compared with the first position of their window only, so a window that a third
of all documents share costs one row per document, never a pair.

Defined results: a null or empty text, or one without lines, is kept as it is. Documents
without an id are kept as they are and are not compared. Rows equal in id and text are one
document. Further columns are kept; columns named as the operator's are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeleads.llm.common import add_columns, cut_lineage, map_batches, shards, split_by_key

WINDOW = 3
MIN_CHARS = 60
PASSAGE_WORDS = 20  # of a passage that counts though it has fewer lines than a window
SHARD_CHARS = 4 << 20  # of texts whose fingerprints are given back at once
_TRIM = " \t\n\x0b\x0c\r"
_FINGERPRINTS = "h bigint, doc bigint, version bigint, spots array<struct<start:int,size:int,x:binary>>"


def numbered_lines(text: str | None) -> list[tuple[int, str]]:
    """Number and trimmed text of each line that is not blank."""
    trimmed = ((i, line.strip(_TRIM)) for i, line in enumerate((text or "").split("\n")))
    return [(i, line) for i, line in trimmed if line]


def fingerprints(text: str | None, window: int, min_chars: int):
    """Selected positions of a text: hash, and the windows that selected it, each with the
    number of its first line and its hash. Of equal hashes the last position is selected."""
    lines = [line for _, line in numbered_lines(text)]
    if len(lines) < window:
        return
    raw = [line.encode("utf-8", "surrogatepass") for line in lines]
    hashes = np.array([xxhash.xxh3_64_intdigest(r) for r in raw], np.uint64)
    views = np.lib.stride_tricks.sliding_window_view(hashes, window)
    chosen = np.arange(len(views)) + window - 1 - np.argmin(views[:, ::-1], axis=1)
    chars = np.cumsum([0, *map(len, lines)])
    spots: dict[int, list] = {}
    for start, at in enumerate(chosen.tolist()):
        if chars[start + window] - chars[start] >= min_chars:
            x = xxhash.xxh3_128_digest(b"\n".join(raw[start : start + window]))
            spots.setdefault(at, []).append({"start": start, "size": window, "x": x})
    for at, found in spots.items():
        yield int(hashes[at].astype(np.int64)), found


def passages(text: str | None, window: int, min_chars: int, passage_words: int):
    """Runs of fewer lines than a window that count: hash, and the run as its only window.
    A run of lines that all count alone is left out: if it occurred earlier, so did they."""
    lines = [line for _, line in numbered_lines(text)]
    raw = [line.encode("utf-8", "surrogatepass") for line in lines]
    words = np.array([len(r.split()) for r in raw], np.int64)
    for size in range(1, min(window - 1, len(lines)) + 1):
        views = np.lib.stride_tricks.sliding_window_view(words, size)
        counts = views.sum(axis=1) >= passage_words
        if size == len(lines) and sum(map(len, lines)) >= min_chars:
            counts[0] = True
        if size > 1:
            counts &= views.min(axis=1) < passage_words
        for start in np.flatnonzero(counts).tolist():
            x = xxhash.xxh3_128_digest(b"\n".join(raw[start : start + size]))
            h = int.from_bytes(x[:8], "big", signed=True)
            yield h, [{"start": start, "size": size, "x": x}]


def repeated_windows(
    df: DataFrame,
    text: str,
    doc_id: str,
    window: int,
    min_chars: int,
    passage_words: int | None = PASSAGE_WORDS,
) -> DataFrame:
    """Windows that occurred earlier: ``(doc, version, starts)`` per document, each with the
    number of its first line and its number of lines."""

    def points_of(t: str | None):
        yield from fingerprints(t, window, min_chars)
        if passage_words is not None:
            yield from passages(t, window, min_chars, passage_words)

    def select(batch: pa.RecordBatch):
        spot = pa.list_(
            pa.struct([("start", pa.int32()), ("size", pa.int32()), ("x", pa.binary())])
        )
        kinds = (pa.int64(), pa.int64(), pa.int64(), spot)
        sizes = [len(t) if t else 0 for t in batch.column("text").to_pylist()]
        for start, stop in shards(sizes, SHARD_CHARS):
            part = batch.slice(start, stop - start)
            rows = [
                (h, doc, version, spots)
                for doc, version, t in zip(*(c.to_pylist() for c in part.columns), strict=True)
                for h, spots in points_of(t)
            ]
            columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["h", "doc", "version", "spots"],
            )

    texts = df.where(F.col(f"`{doc_id}`").isNotNull()).select(
        F.col(f"`{doc_id}`").cast("long").alias("doc"),
        F.xxhash64(f"`{text}`").alias("version"),
        F.col(f"`{text}`").alias("text"),
    )
    points = cut_lineage(map_batches(texts, select, _FINGERPRINTS), "line-fingerprints")
    shared = cut_lineage(
        points.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "line-shared"
    )
    spots = points.join(shared, "h").select(
        "doc", "version", F.inline("spots").alias("start", "size", "x")
    )
    first = cut_lineage(
        spots.groupBy("x")
        .agg(F.min(F.struct("doc", "start")).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("x", "first"),
        "line-first",
    )
    later = spots.join(first, "x").where(F.struct("doc", "start") > F.col("first"))
    return later.groupBy("doc", "version").agg(F.collect_set(F.struct("start", "size")).alias("starts"))


def _without(text: str | None, starts: list[dict] | None):
    """Text without the lines under the windows, number of lines removed, number of runs."""
    if text is None or not starts:
        return text, 0, 0
    lines = text.split("\n")
    numbers = [i for i, _ in numbered_lines(text)]
    covered = np.zeros(len(numbers) + 1, bool)
    for s in starts:
        covered[s["start"] : s["start"] + s["size"]] = True
    covered[-1] = False
    gone = {numbers[i] for i in np.flatnonzero(covered).tolist()}
    runs = int(np.count_nonzero(covered[:-1] & ~covered[1:]))
    left = [line for i, line in enumerate(lines) if i not in gone]
    return ("\n".join(left) if len(gone) < len(numbers) else ""), len(gone), runs


def dedup_lines(
    df: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    window: int = WINDOW,
    min_chars: int = MIN_CHARS,
    passage_words: int | None = PASSAGE_WORDS,
) -> DataFrame:
    """The rows with ``clean_text``, ``removed_lines`` and ``removed_runs``."""
    added = "clean_text string;removed_lines bigint;removed_runs bigint"
    names = ("clean_text", "removed_lines", "removed_runs")
    own = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("own")
    doc, version = F.col(f"`{doc_id}`").cast("long"), F.xxhash64(f"`{text}`")
    rows = df.select(
        own,
        F.col(f"`{text}`").alias("text"),
        doc.alias("doc"),
        version.alias("version"),
        F.xxhash64(doc, version).alias("key"),
    )
    found = cut_lineage(
        repeated_windows(df, text, doc_id, window, min_chars, passage_words).withColumn(
            "key", F.xxhash64("doc", "version")
        ),
        "line-repeats",
    )
    touched, whole = split_by_key(rows, "key", found)
    marked = touched.join(found.drop("key"), ["doc", "version"], "left").select("own", "text", "starts")

    def clean(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        both = zip(
            batch.column("text").to_pylist(), batch.column("starts").to_pylist(), strict=True
        )
        done = [_without(t, s) for t, s in both]
        return {
            "clean_text": pa.array([d[0] for d in done], pa.string()),
            "removed_lines": pa.array([d[1] for d in done], pa.int64()),
            "removed_runs": pa.array([d[2] for d in done], pa.int64()),
        }

    kept = [F.col(f"own.`{c}`").alias(c) for c in df.columns if c.lower() not in names]
    none = F.lit(0).cast("long")
    same = whole.select(
        *kept, F.col("text").alias(names[0]), none.alias(names[1]), none.alias(names[2])
    )
    return add_columns(marked, clean, added).select(*kept, *names).unionByName(same)


def drop_repeated_lines(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents with the cleaned text in place of the text. A document of which nothing
    is left is a copy of earlier ones and goes."""
    done = dedup_lines(df, text, doc_id)
    left = done.where((F.col("removed_lines") == 0) | (F.col("clean_text") != ""))
    return left.select(
        *[F.col("clean_text").alias(c) if c == text else F.col(f"`{c}`") for c in df.columns]
    )
