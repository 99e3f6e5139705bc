"""Benchmark decontamination with a positional inverted index.

The index is spread like the documents: every task stores, for its shard of documents, the
postings (positions) of all terms that the benchmark uses. The benchmark's windows go to all
shards. A window is looked up from its rarest term in the shard: that term's positions,
shifted to the window's start, are intersected with the shifted postings of the next rarest
term and so on, until nothing or an exact phrase match is left.

A proximity match is a start from which each word of the window lies at most ``slop`` words
from its own place and at least one word, whichever, lies in its place. All starts within ``slop`` of the
rarest term are tried against every other word, so the matches do not depend on which term is
rarest, nor on how the documents are spread.

No document leaves its partition and nothing is shuffled. The benchmark is broadcast in
blocks of at most ``BLOCK_BYTES`` of text (a single item may be larger); a larger benchmark
takes several passes, so the size of what is broadcast does not grow with any table.

Words are runs of digits, ASCII letters (lower-cased) and characters above U+007F. An item
of fewer words than a window is one window; one without words matches nothing.

Defined results: null and empty texts have no words and are clean. Items are told apart by
their id as text; repeated items count once, a null id counts as the text ``null``. An empty
benchmark matches nothing. Rows are judged one by one; further columns are kept, columns
named as the operator's are replaced.
"""

from __future__ import annotations

import math
from collections import defaultdict
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeleads.llm.common import add_columns, free_name, shards

WINDOW = 10
SLOP = 2
BLOCK_BYTES = 16 << 20
SHARD_BYTES = 32 << 20

# Bytes to words: ASCII letters in lower case, digits and all bytes of non-ASCII characters
# are kept, everything else separates words.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def windows_of(items: list[tuple[str, str | None]], window: int) -> dict[tuple, set[str]]:
    """The windows of the items, each with the ids of the items that have it."""
    found = defaultdict(set)
    for item, text in items:
        ws = words(text)
        for i in range(max(len(ws) - window, 0) + 1 if ws else 0):
            found[tuple(ws[i : i + window])].add(item)
    return found


class Index:
    """Postings of the given terms in one shard of documents."""

    def __init__(self, texts: list[str | None], terms: dict[bytes, int], gap: int):
        rows, at = [], 0
        self.starts, self.sizes = [], []
        for text in texts:
            ws = words(text)
            rows.append(np.fromiter(map(terms.get, ws, repeat(-1)), np.int32, len(ws)))
            rows.append(np.full(gap, -1, np.int32))  # no match reaches the next document
            self.starts.append(at)
            self.sizes.append(len(ws))
            at += len(ws) + gap
        self.length = at
        ids = np.concatenate(rows) if rows else np.zeros(0, np.int32)
        known = np.flatnonzero(ids >= 0)
        self.positions = known[np.argsort(ids[known], kind="stable")]
        self.count = np.bincount(ids[known], minlength=len(terms))
        self.ends = np.cumsum(self.count)

    def postings(self, term: int) -> np.ndarray:
        return self.positions[self.ends[term] - self.count[term] : self.ends[term]]

    def match(self, window: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of exact matches, and of proximity matches, of a window of term numbers."""
        order = np.argsort(self.count[window], kind="stable")
        first = order[0]
        exact = self.postings(window[first]) - first
        near = np.unique(exact[:, None] + np.arange(-slop, slop + 1))
        for place in order[1:]:
            posting = self.postings(window[place])
            near = self._within(near, posting, place, slop)
            if not len(near):
                return near, near
            exact = self._within(exact, posting, place, 0)
        in_place = [self._within(near, self.postings(t), place, 0) for place, t in enumerate(window)]
        return exact, np.unique(np.concatenate(in_place))

    @staticmethod
    def _within(starts: np.ndarray, posting: np.ndarray, place: int, slop: int) -> np.ndarray:
        """Starts for which the posting has a position at most ``slop`` from the place."""
        if not len(starts):
            return starts
        at = np.searchsorted(posting, starts + (place - slop))
        got = posting[np.minimum(at, len(posting) - 1)]
        return starts[(at < len(posting)) & (got <= starts + (place + slop))]


def _block(items: list[tuple[str, str | None]], window: int, slop: int):
    """A function that adds the matches of these items to a batch of documents."""
    found = windows_of(items, window)
    terms = {t: i for i, t in enumerate(sorted({t for w in found for t in w}))}
    coded = [np.array([terms[t] for t in w], np.int64) for w in found]
    owners = [sorted(ids) for ids in found.values()]

    def search(texts: list[str | None]):
        """Per document: number of words, hit ranges, items matched, items near."""
        index = Index(texts, terms, window + 2 * slop + 1)
        starts = np.array(index.starts, np.int64)
        hits = [[] for _ in texts]
        exact_items, near_items = [set() for _ in texts], [set() for _ in texts]
        for code, ids in zip(coded, owners, strict=True):
            if not index.count[code].all():
                continue
            exact, near = index.match(code, slop)
            for doc in set((np.searchsorted(starts, near + slop, "right") - 1).tolist()):
                near_items[doc].update(ids)
            for at, doc in zip(
                exact.tolist(), (np.searchsorted(starts, exact, "right") - 1).tolist(), strict=True
            ):
                exact_items[doc].update(ids)
                hits[doc].append((at - index.starts[doc], at - index.starts[doc] + len(code)))
        return index.sizes, hits, exact_items, near_items

    return search


def _merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for start, stop in sorted(ranges):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(stop, merged[-1][1]))
        else:
            merged.append((start, stop))
    return merged


ADDED = "n_words bigint;hits array<struct<start:int,stop:int>>;items array<string>;near array<string>"


def find_benchmark(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    slop: int = SLOP,
) -> DataFrame:
    """The rows with ``n_words``, ``hits`` (ranges of words inside occurrences of windows),
    ``items`` (ids with an exact match) and ``near`` (ids with a match within ``slop``)."""
    items = benchmark.select(
        F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("null")).alias("item"),
        F.col(f"`{item_text}`").alias("text"),
    )
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = math.ceil(total / BLOCK_BYTES) or 1
    clash = [c for c in df.columns if c.lower() in ("n_words", "hits", "items", "near") and c != text]
    out = df.drop(*clash)
    kept = text
    if text.lower() in ("n_words", "hits", "items", "near"):
        kept = free_name(out, "text")
        out = out.withColumnRenamed(text, kept)
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        rows = [(r["item"], r["text"]) for r in part.toLocalIterator()]
        shared = df.sparkSession.sparkContext.broadcast(rows)
        out = add_columns(out, _adder(shared, kept, window, slop, block > 0), ADDED)
    return out


def _adder(shared, text: str, window: int, slop: int, again: bool):
    """Adds the matches of a block to those of the blocks before."""
    built = {}

    def add(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        if not built:
            built["search"] = _block(shared.value, window, slop)
        texts = batch.column(text).to_pylist()
        sizes = [len(t) if t else 0 for t in texts]
        n, hits, items, near = [], [], [], []
        for start, stop in shards(sizes, SHARD_BYTES):
            a, b, c, d = built["search"](texts[start:stop])
            n += a
            hits += b
            items += c
            near += d
        return {
            "n_words": pa.array(n, pa.int64()),
            "hits": pa.array(
                [[{"start": s, "stop": e} for s, e in _merge(h)] for h in hits],
                pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])),
            ),
            "items": pa.array([sorted(x) for x in items], pa.list_(pa.string())),
            "near": pa.array([sorted(x) for x in near], pa.list_(pa.string())),
        }

    def add_again(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        new = add(batch)
        old = {k: batch.column(k).to_pylist() for k in ("hits", "items", "near")}
        ranges = [
            _merge([(r["start"], r["stop"]) for r in [*a, *b]])
            for a, b in zip(old["hits"], new["hits"].to_pylist(), strict=True)
        ]
        new["hits"] = pa.array(
            [[{"start": s, "stop": e} for s, e in r] for r in ranges], new["hits"].type
        )
        for k in ("items", "near"):
            both = zip(old[k], new[k].to_pylist(), strict=True)
            new[k] = pa.array([sorted({*a, *b}) for a, b in both], pa.list_(pa.string()))
        return new

    return add_again if again else add


def remove_contaminated(df: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """Only the documents without an exact match, with their own columns."""
    row = free_name(df, "own")
    whole = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(row), F.col(f"`{text}`").alias("text"))
    clean = find_benchmark(whole, benchmark).where(F.size("hits") == 0)
    return clean.select(f"{row}.*")
