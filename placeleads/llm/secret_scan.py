"""Secret scan: fixed patterns, and a battery of randomness tests for everything else.

Patterns give the base spans ``assign``, ``access`` and ``hex``. The battery looks at every
run of at least ``MIN_LENGTH`` characters that keys are written in and that no base span
touches. ``=`` belongs to a run only as padding at its end, so the value after ``NAME=`` is a
run of its own. From its characters an encoding is inferred (base 16, 32 or 64), which fixes the
alphabet. Three tests then ask how likely ordinary text is to look this random:

* uniformity: the chi-squared statistic over the alphabet, here as the share of equal pairs
  of characters, against the share that text has;
* runs: changes between lower case, upper case, digits and signs against their rate in text;
* serial correlation of neighbouring characters against that of ordered or repeated ones.

The tests add up: the product of independent p-values has a known distribution (Fisher), which
gives one p-value. Ordinary tokens are of two sorts, and a token must look random against both:
words, also joined by signs or capitals, whose characters are unevenly used and change class
with each joint (uniformity and runs); and ordered characters, which may all differ (serial
correlation and runs). A token at least as correlated as ordered ones is one of them. Only
tokens of the wide alphabet can be joined words; the others change class more rarely. Which p-values count is decided
over the whole corpus: within each band of lengths the Benjamini-Hochberg rule keeps the
expected share of false finds under ``RATE``. Short tokens have weak tests and many chance
candidates, long ones neither, so bands are controlled apart. The rule needs the number of
tokens per band and p-value level only; levels are hundredths of a power of ten, rounded to
the safe side. These counts are bounded and are broadcast.

Found tokens have kind ``random``; base spans always stay.

Defined results: a null or empty text has no spans. Rows are scanned one by one, repeated
rows count as often as they occur. The text column is dropped, further columns are kept,
columns named as the operator's are replaced.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placeleads.llm.common import add_columns, cut_lineage

MIN_LENGTH = 20
RATE = 0.05
BASE_KINDS = ("assign", "access", "hex")

# Fixed patterns of the base. ASCII letters in either case in the first.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
_WORDS = ("passw", "secret", "token", "api")  # one is in every match of the first
_KEY = "[A-Za-z0-9+/_-]"
# The look ahead only saves time; a name before "=" may still be shorter than MIN_LENGTH.
_TOKEN = re.compile(rf"(?<!{_KEY})(?=[A-Za-z0-9+/_=-]{{{MIN_LENGTH}}}){_KEY}{{4,}}+(?:=++(?!{_KEY}))?")

# Encodings from narrow to wide: characters, size of the alphabet, and for ordinary text in
# it the chance that two characters, and that three, are equal.
_ENCODINGS = (
    (re.compile(r"[0-9]+"), None),
    (re.compile(r"[0-9a-f]+|[0-9A-F]+"), (16, 0.25, 0.08)),
    (re.compile(r"[A-Z2-7]+"), (32, 0.066, 0.0056)),
    (re.compile(r"[A-Za-z0-9+/_-]+"), (64, 0.066, 0.0056)),
)
CHANGE_RATE = 0.05  # changes of character class per place in ordinary text
JOINED_RATE = 2 / 7  # the same in words of about six letters joined by signs or capitals
CORRELATION = 0.5  # of neighbouring characters in ordered text
MAX_LEVEL = 30_000


def _normal_tail(z: float) -> float:
    """Chance of a standard normal value below z."""
    return 0.5 * math.erfc(-z / math.sqrt(2))


def _uniformity(token: str, alphabet: tuple) -> float:
    size, pair, triple = alphabet
    n = len(token)
    counts = [token.count(c) for c in set(token)]
    chi = size / n * sum(c * c for c in counts) - n
    equal = ((chi + n) * n / size - n) / (n * (n - 1))
    spread = 4 * (triple - pair * pair) / n + 2 * (pair - pair * pair) / (n * n)
    return _normal_tail((equal - pair) / math.sqrt(spread))


def _char_class(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def _runs(token: str, rate: float) -> float:
    """Chance of at least as many changes in text, by the exact tail if it is short."""
    classes = [_char_class(c) for c in token]
    places = len(token) - 1
    changes = sum(a != b for a, b in zip(classes, classes[1:], strict=False))
    mean = places * rate
    if places > 200:
        return _normal_tail(-(changes - 0.5 - mean) / math.sqrt(mean * (1 - rate)))
    return min(
        sum(
            math.comb(places, k) * rate**k * (1 - rate) ** (places - k)
            for k in range(changes, places + 1)
        ),
        1.0,
    )


def _serial(token: str) -> float:
    codes = [ord(c) for c in token]
    n, mean = len(codes), sum(codes) / len(codes)
    total = sum((c - mean) ** 2 for c in codes)
    if not total:
        return 1.0
    r = sum((a - mean) * (b - mean) for a, b in zip(codes, codes[1:], strict=False)) / total
    r = max(min(abs(r), 0.999), 0.0)
    return _normal_tail((math.atanh(r) - math.atanh(CORRELATION)) * math.sqrt(n - 3))


def _both(p: float, q: float) -> float:
    """Chance that the product of two independent p-values is at most this."""
    product = p * q
    return min(product * (1 - math.log(product)), 1.0) if product > 0 else 0.0


def p_value(token: str) -> float | None:
    """How likely text is to look as random; none for plain numbers and other characters."""
    core = token.rstrip("=")
    for pattern, alphabet in _ENCODINGS:
        if pattern.fullmatch(core):
            if alphabet is None or len(core) < 4:
                return None
            serial = _serial(core)
            if serial >= 0.5:
                return 1.0
            joined = JOINED_RATE if alphabet[0] == 64 else CHANGE_RATE
            words = _both(_uniformity(core, alphabet), _runs(core, joined))
            return max(words, _both(serial, _runs(core, CHANGE_RATE)))
    return None


def level(p: float) -> int:
    return MAX_LEVEL if p <= 0 else min(int(-100 * math.log10(p)), MAX_LEVEL)


def band(length: int) -> int:
    """Lengths 20 to 23, to 31, to 47, to 95, and longer."""
    return sum(length >= edge for edge in (24, 32, 48, 96))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans by start, then kind."""
    found = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        for m in _ASSIGN.finditer(text):
            if len(m[2]) >= 6:
                found.append(("assign", m.start(), m.end()))
    if "AKIA" in text:
        for m in _ACCESS.finditer(text):
            if m.end() - m.start() >= 20:
                found.append(("access", m.start(), m.end()))
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], BASE_KINDS.index(s[0])))


def tokens(text: str, base: list[tuple[str, int, int]]) -> list[tuple[int, int, int, int]]:
    """Candidates that touch no base span: start, stop, band and level."""
    found, at = [], 0
    ordered = sorted((start, stop) for _, start, stop in base)
    for m in _TOKEN.finditer(text):
        start, stop = m.span()
        if stop - start < MIN_LENGTH:
            continue
        while at < len(ordered) and ordered[at][1] <= start:
            at += 1
        if any(a < stop and start < b for a, b in ordered[max(at - 3, 0) : at + 2]):
            continue
        p = p_value(m[0])
        if p is not None:
            found.append((start, stop, band(stop - start), level(p)))
    return found


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())])
_TOKEN_TYPE = pa.struct([(n, pa.int32()) for n in ("start", "stop", "band", "level")])


def scan(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows with ``base`` spans and ``tokens``, the candidates of the battery."""

    def add(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        base, other = [], []
        for value in batch.column(text):
            whole = value.as_py() or ""
            spans = base_spans(whole)
            base.append([dict(zip(("kind", "start", "stop"), s, strict=True)) for s in spans])
            other.append(
                [
                    dict(zip(("start", "stop", "band", "level"), t, strict=True))
                    for t in tokens(whole, spans)
                ]
            )
        return {"base": pa.array(base, pa.list_(_SPAN)), "tokens": pa.array(other, pa.list_(_TOKEN_TYPE))}

    span = "struct<kind:string,start:int,stop:int>"
    token = "struct<start:int,stop:int,band:int,level:int>"
    return add_columns(df, add, f"base array<{span}>;tokens array<{token}>")


def thresholds(scanned: DataFrame, rate: float = RATE) -> DataFrame:
    """``(band, least)``: the lowest level that counts in each band of lengths."""
    counts = scanned.select(F.inline("tokens")).groupBy("band", "level").count()
    higher = Window.partitionBy("band").orderBy(F.desc("level"))
    every = Window.partitionBy("band")
    ranked = counts.select(
        "band", "level", F.sum("count").over(higher).alias("k"), F.sum("count").over(every).alias("m")
    )
    p = F.pow(F.lit(10.0), -F.col("level") / 100)
    return (
        ranked.where(p <= F.lit(rate) * F.col("k") / F.col("m"))
        .groupBy("band")
        .agg(F.min("level").alias("least"))
    )


def find_secrets(df: DataFrame, text: str = "text", rate: float = RATE) -> DataFrame:
    """The rows without their text, with ``base`` spans and all ``spans``, each by start and
    then kind, ``random`` last."""
    scanned = scan(df, text)
    if text not in ("base", "tokens"):
        scanned = scanned.drop(text)
    scanned = cut_lineage(scanned, "secret-scan")
    least = thresholds(scanned, rate).agg(
        F.map_from_entries(F.collect_list(F.struct("band", "least"))).alias("least_")
    )
    kept = F.filter(
        "tokens", lambda t: t["level"] >= F.coalesce(F.col("least_")[t["band"]], F.lit(MAX_LEVEL + 1))
    )
    random = F.transform(
        kept,
        lambda t: F.struct(F.lit("random").alias("kind"), t["start"].alias("start"), t["stop"].alias("stop")),
    )
    rank = F.create_map(*[x for i, k in enumerate((*BASE_KINDS, "random")) for x in (F.lit(k), F.lit(i))])
    keyed = F.transform(
        F.concat("base", random),
        lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("rank"), s.alias("span")),
    )
    spans = F.transform(F.sort_array(keyed), lambda s: s["span"])
    one = F.broadcast(least)  # a single row of at most five numbers
    return scanned.join(one).withColumn("spans", spans).drop("least_", "tokens")
