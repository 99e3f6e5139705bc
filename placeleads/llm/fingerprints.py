"""Document fingerprints by winnowing, and their likeness.

A text is a row of units: words between ASCII whitespace, cut every ``UNIT`` code points, and
single code points from U+2E80 on, whose scripts put no space between words. Every run of
``GRAM`` units has a rolling hash, the polynomial of the units' checksums modulo a prime. Of
every ``WINDOW`` successive hashes the smallest is selected, of equal ones the rightmost, and
kept with its position, the number of its first unit. Two texts that share
``GRAM + WINDOW - 1`` successive units therefore share a selected hash, and its positions say
where. A selected hash is extended by a second polynomial to 62 bits; the choice itself goes
by the first 31.

The likeness of two fingerprints is twice the number of hashes in both over the sum of their
numbers of hashes; that of two empty ones is 1.

``with_next`` brings each document together with the next one. Numbers in the order of ids
are made on narrow rows; texts are moved to their number and then to a bucket of ``BUCKET``
successive numbers, to which the first of the next bucket is added. No bucket grows with the
data, and nothing is sorted in one task.

Defined results: a null text counts as empty; an empty text has an empty fingerprint, and one
of fewer units than a gram is one gram. Rows with equal id and text count as one document and
give equal results; different texts of one id follow each other in the order of a hash, and
rows without an id come first. Further columns are kept by ``add_fingerprints``, which replaces
columns of its names; ``with_next`` has columns of its own only. All of it is built-in
functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placeleads.functions.text import bind
from placeleads.llm.common import cut_lineage

UNIT = 8
GRAM = 3
WINDOW = 4
BUCKET = 256
PRIME = (1 << 31) - 1
BASE, SECOND_BASE = 1_000_003, 998_244_353
UNITS = rf"[^\x20\x09-\x0D\x{{2E80}}-\x{{10FFFF}}]{{1,{UNIT}}}|[\x{{2E80}}-\x{{10FFFF}}]"


def _rolling(codes: Column, at: Column, gram: int, base: int) -> Column:
    """Polynomial of ``gram`` codes from a place on."""
    value = F.get(codes, at)
    for i in range(1, gram):
        value = (value * F.lit(base).cast("long") + F.get(codes, at + i)) % PRIME
    return value


def _window_minima(keys: Column, window: int) -> Column:
    """The smallest of every ``window`` neighbours; of all, if they are fewer."""

    def least(low: Column, step: int) -> Column:
        def both(x: Column) -> Column:
            left = F.size(x) - step
            return F.zip_with(F.slice(x, 1, left), F.slice(x, step + 1, left), lambda a, b: F.least(a, b))

        return bind(low, both)

    low, width = keys, 1
    while width < window:
        step = min(width, window - width)
        low, width = least(low, step), width + step
    return F.when(F.size(keys) < window, F.array(F.array_min(keys))).otherwise(low)


def fingerprint(text: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """``array<struct<hash:bigint,position:int>>`` in the order of positions."""
    units = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(UNITS), F.lit(0))
    codes = F.transform(units, lambda u: F.crc32(u.cast("binary")) % (PRIME - 1) + 1)

    def selected(c: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(c) - gram)
        # A smaller key is a smaller hash or, for equal ones, a place further right.
        keys = F.transform(
            places, lambda i: _rolling(c, i, gram, BASE) * (PRIME + 1) + (F.lit(PRIME) - i)
        )
        minima = F.array_distinct(bind(keys, lambda k: _window_minima(k, window)))

        def entry(key: Column) -> Column:
            at = (F.lit(PRIME) - key.bitwiseAND(PRIME)).cast("int")
            more = bind(at, lambda a: _rolling(c, a, gram, SECOND_BASE))
            first = F.shiftright(key, 31) * F.lit(PRIME + 1)
            return F.struct((first + more).alias("hash"), at.alias("position"))

        return F.transform(minima, entry)

    none = F.array().cast("array<struct<hash:bigint,position:int>>")
    short = F.array_repeat(F.lit(0).cast("long"), gram)
    padded = bind(
        codes,
        lambda c: F.when(F.size(c) >= gram, c).otherwise(F.slice(F.concat(c, short), 1, gram)),
    )
    return F.when(F.rlike(text, F.lit(r"[^\x20\x09-\x0D]")), bind(padded, selected)).otherwise(none)


def hashes(found: Column) -> Column:
    """The distinct hashes of a fingerprint."""
    return F.array_distinct(F.transform(found, lambda e: e["hash"]))


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two arrays of distinct hashes, from 0 to 1."""

    def of(x: Column, y: Column) -> Column:
        total = F.size(x) + F.size(y)
        both = F.size(F.array_intersect(x, y)).cast("double")
        return F.when(total == 0, F.lit(1.0)).otherwise(2 * both / F.greatest(total, F.lit(1)))

    return bind(a, lambda x: bind(b, lambda y: of(x, y)))


def as_text(found: Column) -> Column:
    """``hash:position`` with the hash in hexadecimal, joined by commas."""
    return F.array_join(
        F.transform(found, lambda e: F.concat(F.hex(e["hash"]), F.lit(":"), e["position"])), ","
    )


def add_fingerprints(
    df: DataFrame, text: str = "text", gram: int = GRAM, window: int = WINDOW
) -> DataFrame:
    """The rows with ``n_chars`` and ``fingerprint``."""
    rest = [F.col(f"`{c}`") for c in df.columns if c.lower() not in ("n_chars", "fingerprint")]
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return df.select(
        *rest,
        F.char_length(whole).cast("long").alias("n_chars"),
        fingerprint(whole, gram, window).alias("fingerprint"),
    )


def _numbered(keys: DataFrame) -> tuple[DataFrame, int]:
    """The distinct keys with their number in the order of all, and how many there are."""
    names = keys.columns
    ranged = keys.distinct().repartitionByRange(*names)
    parts = cut_lineage(ranged.withColumn("part", F.spark_partition_id()), "ordered-keys")
    # One row per partition.
    counts = parts.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut_lineage(
        counts.select("part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")),
        "offsets",
    )
    within = Window.partitionBy("part").orderBy(*names)
    numbered = parts.join(F.broadcast(offsets.drop("n")), "part").select(
        *names, (F.col("offset") + F.row_number().over(within) - 1).alias("number")
    )
    return cut_lineage(numbered, "numbers"), offsets.agg(F.sum("n")).first()[0] or 0


def with_next(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, text, fingerprint, next_text, next_hashes)`` for every row: the text and the
    hashes of the document with the next id; after the last comes the first."""
    doc, whole = F.col(f"`{doc_id}`").cast("long"), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    docs = df.select(doc.alias("doc_id"), whole.alias("text")).select(
        F.coalesce("doc_id", F.lit(-(1 << 63))).alias("d"),
        F.xxhash64("doc_id", "text").alias("h"),
        "doc_id",
        "text",
    )
    numbers, total = _numbered(docs.select("d", "h"))
    once = docs.groupBy("d", "h").agg(
        F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.count("*").alias("copies")
    )
    bucket = F.floor(F.col("number") / BUCKET).cast("long")
    ahead = F.when(F.col("number") == 0, F.lit(max(total - 1, 0) // BUCKET)).otherwise(bucket - 1)
    own = F.struct(bucket.alias("bucket"), F.lit(False).alias("extra"))
    extra = F.struct(ahead.cast("long").alias("bucket"), F.lit(True).alias("extra"))
    to = F.when(F.col("number") % BUCKET == 0, F.array(own, extra)).otherwise(F.array(own))
    placed = (
        once.join(numbers.hint("merge"), ["d", "h"])
        .select("doc_id", "text", "copies", "number", F.inline(to))
        .repartition("bucket")
        .withColumn("fingerprint", fingerprint(F.col("text")))
    )
    order = Window.partitionBy("bucket").orderBy("extra", "number")
    found = placed.select(
        "doc_id", "text", "copies", "extra", "fingerprint",
        F.lead(F.struct("text", hashes(F.col("fingerprint")).alias("hashes"))).over(order).alias("next"),
    )
    copies = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy")
    return (
        found.where(~F.col("extra"))
        .select(
            "doc_id", "text", "fingerprint", F.col("next.text").alias("next_text"),
            F.col("next.hashes").alias("next_hashes"), "copies",
        )
        .select("*", copies)
        .drop("copies", "copy")
    )


def compare_edited(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Every document next to its edited text, of which the second half is replaced by the
    beginning of the next document: ``(doc_id, text, edited, fingerprint, edited_fingerprint,
    near_edited, near_next)``."""
    pairs = with_next(df, text, doc_id)
    half = F.floor(F.char_length("text") / 2).cast("int")
    edited = bind(
        half,
        lambda n: F.concat(
            F.substr("text", F.lit(1), F.char_length("text") - n), F.substr("next_text", F.lit(1), n)
        ),
    )
    rows = pairs.withColumn("edited", edited).withColumn(
        "edited_fingerprint", fingerprint(F.col("edited"))
    )
    own = hashes(F.col("fingerprint"))
    return rows.select(
        "doc_id",
        "text",
        "edited",
        "fingerprint",
        "edited_fingerprint",
        likeness(own, hashes(F.col("edited_fingerprint"))).alias("near_edited"),
        likeness(own, F.col("next_hashes")).alias("near_next"),
    )
