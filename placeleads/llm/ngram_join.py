"""Jaccard self-join of documents on word n-grams by vertical partitioning.

The n-grams of all documents have one global order: by how often their hash bucket occurs in
the corpus, then by hash. Rare n-grams come first. The steps:

1. Documents with equal n-gram sets form a class; only classes are joined.
2. Candidates: two sets as similar as asked share an n-gram among the first few of their
   order (prefix). Up to their first common n-gram they have nothing in common, so the places
   of that n-gram in both orders bound the overlap; only pairs that the bound allows count.
   Per shared n-gram all its classes are paired with one leader, the one that has it
   earliest; classes that links have brought into one component need no pair with each
   other. Pairs of different components are then tried one by one.
3. A pair goes on only if parity sketches allow it: the bits in which two sketches differ
   are at most the n-grams in which the sets differ, so no link is lost.
4. The global order is cut into ``FRAGMENTS`` pieces. Overlaps are counted per pair and
   piece, on separate rows, and summed per pair; the sum decides exactly.
5. Links join classes to components.

Shuffled are prefixes (a tenth of the n-grams), sketches, and the pieces of the sets that
have candidates. A class with very many links is spread over the pieces and split further by
the adaptive join. Broadcast is the histogram of the buckets only, of fixed size.

Sets are compared by 64-bit hashes of their n-grams, classes by 128 bits.

Defined results: white space separates words, ASCII letters count in lower case. A text of
fewer words than an n-gram is one n-gram; a null text or one without words has an empty set
and is linked with nothing. Documents without an id take part, but never name a component; a
component without any id has a null name. Rows with the same id are one node.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeleads.llm.common import cut_lineage, split_by_key
from placeleads.llm.components import components

BUCKET_BITS = 22
FRAGMENTS = 8
SKETCH_WORDS = 8
_BLOCKS = 64
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# Odd factors, one per place in an n-gram, and of a mixing step.
_STEP = 0x9E3779B97F4A7C15
_MIX_A = 0xBF58476D1CE4E5B9
_MIX_B = 0x94D049BB133111EB


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX_A)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX_B)
    return x ^ (x >> np.uint64(31))


def ngrams(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the n-grams of a text."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(size, len(words))
    last = len(words) - width + 1
    total = np.full(last, width, np.uint64)
    for place in range(width):
        factor = np.uint64((_STEP * (2 * place + 1)) & (2**64 - 1))
        total += _mixed(hashes[place : place + last] * factor)
    return np.unique(_mixed(total))


def _bucket(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _sketch(grams: np.ndarray) -> np.ndarray:
    """Parity of the n-grams that fall on each bit."""
    bits = np.bincount((grams & np.uint64(64 * SKETCH_WORDS - 1)).astype(np.int64), minlength=64 * SKETCH_WORDS)
    return np.packbits(bits.astype(np.uint8) & 1).view(np.int64)


def _class_key(grams: np.ndarray) -> tuple[int, int]:
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(grams.tobytes()), np.int64).tolist())


def _sets(texts: DataFrame, size: int) -> DataFrame:
    """One row per document (id, set size, class key, sketch), and the histogram of the
    buckets of every task as rows of ``block`` and ``counts``."""
    names = ["doc", "n", "k1", "k2", *[f"s{i}" for i in range(SKETCH_WORDS)]]

    def run(batches):
        histogram = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            n, rows = [], []
            for text in batch.column("text").to_pylist():
                grams = ngrams(text, size)
                n.append(len(grams))
                rows.append((*_class_key(grams), *_sketch(grams).tolist()))
                if len(grams):
                    np.add.at(histogram, _bucket(grams), 1)
            found = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
            if rows:
                none = [pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc"), pa.array(n, pa.int64()), *found, *none],
                    [*names, "block", "counts"],
                )
        if histogram.any():
            parts = histogram.reshape(_BLOCKS, -1)
            nothing = [pa.nulls(_BLOCKS, pa.int64()) for _ in names]
            yield pa.RecordBatch.from_arrays(
                [
                    *nothing,
                    pa.array(range(_BLOCKS), pa.int32()),
                    pa.array([zlib.compress(p.astype(np.uint32), 1) for p in parts], pa.binary()),
                ],
                [*names, "block", "counts"],
            )

    schema = ", ".join(f"{c} bigint" for c in names) + ", block int, counts binary"
    return texts.mapInArrow(run, schema)


def _histogram(sets: DataFrame) -> np.ndarray:
    """Sum of the tasks' histograms: ``2 ** BUCKET_BITS`` counts, whatever the corpus."""

    def add(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(*batch.columns, strict=True):
                part = np.frombuffer(zlib.decompress(counts.as_buffer()), np.uint32).astype(np.int64)
                totals[block.as_py()] = totals.get(block.as_py(), 0) + part
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(totals, pa.int32()),
                pa.array([zlib.compress(t, 1) for t in totals.values()], pa.binary()),
            ],
            ["block", "counts"],
        )

    parts = sets.where("block is not null").select("block", "counts").repartition("block")
    total = np.zeros((_BLOCKS, (1 << BUCKET_BITS) // _BLOCKS), np.int64)
    for row in parts.mapInArrow(add, "block int, counts binary").collect():
        total[row["block"]] = np.frombuffer(zlib.decompress(row["counts"]), np.int64)
    return total.reshape(-1)


def _global_order(histogram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each bucket, rare ones first, and the piece of the order it lies in. The
    cuts give every piece about the same share of all n-grams."""
    order = np.argsort(histogram, kind="stable")
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    mass = np.cumsum(histogram[order])
    cut = np.minimum(mass * FRAGMENTS // max(int(mass[-1]), 1), FRAGMENTS - 1)
    fragment = np.empty(len(order), np.int8)
    fragment[order] = cut
    return rank, fragment


def _prefixes(texts: DataFrame, ranks, size: int, percent: int) -> DataFrame:
    """The first n-grams of every set with their places: ``(token, k1, n, place)``."""

    def run(batches):
        rank = ranks.value[0]
        for batch in batches:
            tokens, keys, sizes, counts = [], [], [], []
            for text in batch.column("text").to_pylist():
                grams = ngrams(text, size)
                if len(grams):
                    first = len(grams) - (percent * len(grams) + 99) // 100 + 1
                    tokens.append(grams[np.lexsort((grams, rank[_bucket(grams)]))[:first]])
                    keys.append(_class_key(grams)[0])
                    sizes.append(len(grams))
                    counts.append(first)
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(tokens).view(np.int64)),
                        pa.array(np.repeat(np.array(keys, np.int64), counts)),
                        pa.array(np.repeat(np.array(sizes, np.int32), counts)),
                        pa.array(np.concatenate([np.arange(c, dtype=np.int32) for c in counts])),
                    ],
                    ["token", "k1", "n", "place"],
                )

    return texts.select("text").mapInArrow(run, "token bigint, k1 bigint, n int, place int")


def _pieces(texts: DataFrame, ranks, size: int) -> DataFrame:
    """The sets, cut at the global order: ``(node, k1, k2, fragment, grams)``."""

    def run(batches):
        fragment = ranks.value[1]
        for batch in batches:
            rows = []
            for doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                grams = ngrams(text, size)
                key = _class_key(grams)
                of = fragment[_bucket(grams)]
                for f in np.unique(of).tolist():
                    rows.append((doc, *key, f, grams[of == f].view(np.int64)))
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in range(5)]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["node", "k1", "k2", "fragment", "grams"],
            )

    schema = "node bigint, k1 bigint, k2 bigint, fragment int, grams array<bigint>"
    return texts.select("doc", "text").mapInArrow(run, schema)


def _least_overlap(percent: int) -> Column:
    """What sets of ``na`` and ``nb`` n-grams must share: the least ``o`` for which
    ``100 * o >= percent * (na + nb - o)``."""
    total = (F.col("na") + F.col("nb")).cast("long")
    return F.floor((total * percent + (99 + percent)) / (100 + percent))


def _allowed(percent: int) -> Column:
    """False if a common n-gram cannot be the first one of a link."""
    least = _least_overlap(percent)
    return (F.col("na") - F.col("aplace") >= least) & (F.col("nb") - F.col("bplace") >= least)


def _may_link(percent: int) -> Column:
    """False if sizes or sketches rule a link out. With an overlap of ``o`` the sets differ
    in ``na + nb - 2 * o`` n-grams."""
    least = _least_overlap(percent)
    bits = sum(
        (F.bit_count(F.col(f"a{i}").bitwiseXOR(F.col(f"b{i}"))) for i in range(SKETCH_WORDS)),
        F.lit(0),
    )
    return (F.least("na", "nb") >= least) & (bits <= F.col("na") + F.col("nb") - 2 * least)


def _verified(pairs: DataFrame, classes: DataFrame, texts, ranks, size, percent) -> DataFrame:
    """The pairs ``(a, b)`` of class keys that are links, as pairs of documents ``(u, v)``
    with the keys."""

    def side(x: str) -> DataFrame:
        sketch = [F.col(f"s{i}").alias(f"{x}{i}") for i in range(SKETCH_WORDS)]
        return classes.select(
            F.col("k1").alias(x), F.col("k2").alias(f"{x}k2"), F.col("n").alias(f"n{x}"),
            F.col("node").alias(f"{x}node"), *sketch,
        )

    columns = [f"{x}{c}" for x in "ab" for c in ("", "k2", "node")] + ["na", "nb"]
    near = cut_lineage(
        pairs.join(side("a"), "a").join(side("b"), "b").where(_may_link(percent)).select(columns),
        "near-pairs",
    )
    wanted = near.select(F.explode(F.array("anode", "bnode")).alias("doc")).distinct()
    wanted = wanted.select(F.xxhash64("doc").alias("key"))
    some, _ = split_by_key(texts.withColumn("key", F.xxhash64("doc")), "key", wanted)
    pieces = cut_lineage(_pieces(some, ranks, size), "pieces")
    keyed = pieces.withColumn("key", F.xxhash64("node"))

    def piece(x: str) -> DataFrame:
        """Pieces of the sets on this side of a pair; only these are shuffled for it."""
        wanted = near.select(F.xxhash64(f"{x}node").alias("key")).distinct()
        some, _ = split_by_key(keyed, "key", wanted)
        return some.select(pieces.columns).toDF(f"{x}node", x, f"{x}k2", "fragment", f"{x}grams")

    each = near.join(piece("a"), ["a", "ak2", "anode"]).join(
        piece("b"), ["b", "bk2", "bnode", "fragment"]
    )
    shared = F.size(F.array_intersect("agrams", "bgrams")).alias("shared")
    # the largest of equal rows: an id may have the same text twice
    once = each.select(*columns, "fragment", shared).groupBy(*columns, "fragment")
    total = (
        once.agg(F.max("shared").alias("shared"))
        .groupBy(*columns)
        .agg(F.sum("shared").alias("o"))
        .where(F.col("o") * 100 >= (F.col("na") + F.col("nb") - F.col("o")) * percent)
    )
    return total.select(F.col("anode").alias("u"), F.col("bnode").alias("v"))


def join_ngrams(
    df: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = 3, percent: int = 90
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row: the size of its set and the
    smallest id that links reach from it, itself included."""
    spark = df.sparkSession
    texts = df.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("text")
    )
    sets = cut_lineage(_sets(texts, size), "ngram-sets")
    documents = sets.where("block is null")
    ranks = spark.sparkContext.broadcast(_global_order(_histogram(sets)))
    sketch = [F.first(f"s{i}").alias(f"s{i}") for i in range(SKETCH_WORDS)]
    classes = cut_lineage(
        documents.where("n > 0")
        .groupBy("k1", "k2")
        .agg(F.min("doc").alias("node"), F.first("n").alias("n"), *sketch)
        .where("node is not null"),
        "classes",
    )
    prefixes = cut_lineage(_prefixes(texts, ranks, size, percent), "prefixes")
    # place and key as one number, so that the smallest is found before the shuffle
    order = F.call_function(
        "shiftleft", F.least("place", F.lit(1023)).cast("long"), F.lit(53)
    ) + F.shiftrightunsigned("k1", 11)
    leaders = cut_lineage(
        prefixes.groupBy("token")
        .agg(F.min(order).alias("lead"), F.max(order).alias("last"))
        .where("lead <> last")
        .select("token", "lead"),
        "leaders",
    )
    shared = cut_lineage(
        prefixes.join(leaders, "token")
        .select("token", "k1", "n", "place", (order == F.col("lead")).alias("leads"))
        .distinct(),
        "shared-ngrams",
    )
    first = shared.where("leads").toDF("token", "a", "na", "aplace", "leads").drop("leads")
    others = shared.where("not leads").toDF("token", "b", "nb", "bplace", "leads").drop("leads")
    stars = first.join(others, "token").where(_allowed(percent)).select("a", "b").distinct()
    links = cut_lineage(_verified(stars, classes, texts, ranks, size, percent), "star-links")
    groups = components(links)

    # n-grams whose classes, the leader aside, are in several components
    nodes = classes.select(F.col("k1").alias("b"), "node")
    places = cut_lineage(
        others.join(nodes, "b")
        .join(groups.toDF("node", "top"), "node", "left")
        .select("token", "b", "nb", "bplace", F.coalesce("top", "node").alias("btop")),
        "places",
    )
    open_tokens = (
        places.groupBy("token")
        .agg(F.min("btop").alias("low"), F.max("btop").alias("high"))
        .where("low <> high")
        .select("token")
    )
    rest = cut_lineage(places.join(open_tokens, "token"), "open")
    # the smaller set of a pair must have the n-gram so early that sets of its size allow it
    smaller = rest.toDF("token", "a", "na", "aplace", "atop").where(
        (F.col("na") - F.col("aplace")) * (100 + percent) >= F.col("na") * 2 * percent
    )
    pairs = (
        smaller.join(rest, "token")
        .where("na < nb or (na = nb and a < b)")
        .where("atop <> btop")
        .where(_allowed(percent))
        .select("a", "b")
        .distinct()
    )
    more = _verified(pairs, classes, texts, ranks, size, percent)
    groups = components(links.union(cut_lineage(more, "cross-links")))

    named = classes.join(groups.toDF("node", "top"), "node", "left").select(
        "k1", "k2", F.coalesce("top", "node").alias("component_id")
    )
    named = cut_lineage(named, "components")
    full = documents.select("doc", "n", "k1", "k2").join(named, ["k1", "k2"], "left")
    return full.select(
        F.col("doc").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc").alias("component_id"),
    )


def keep_one_of_each(df: DataFrame, text: str = "text", doc_id: str = "doc_id", **how) -> DataFrame:
    """The documents that name their component, and those without an id or words."""
    copies = (
        join_ngrams(df, text, doc_id, **how)
        .where("doc_id <> component_id")
        .select(F.col("doc_id").alias("copy"))
    )
    return df.join(copies, F.col(f"`{doc_id}`") == F.col("copy"), "left_anti")
