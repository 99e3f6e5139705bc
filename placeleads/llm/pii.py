"""Personal data: patterns propose spans, checksums confirm them, context adjusts the score.

Kinds ``email``, ``ip``, ``card`` (Luhn) and ``phone`` are the base; they are always kept.
The method adds ``iban`` (confirmed by mod 97) and ``ssn`` (nothing to check but its number
ranges, so it needs a context word among the ``CONTEXT_CHARS`` characters between the match before
and it). Every span has a
score: a start value per kind, raised by context words of that kind in front of it; spans
under ``THRESHOLD`` are left out, base kinds start above it.

All of it is built-in functions in one narrow stage. Matches of one pattern are located by
splitting the text at the same pattern, so offsets are code points and matches are the
leftmost ones that do not overlap. Patterns are written so that they take linear time: each
starts only where a run of its characters starts, and loops give no characters back or only a few.

Defined results: a null or empty text has no spans. Rows are judged one by one: repeated rows
give equal results, further columns are kept, columns named as the operator's are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeleads.functions.text import bind

# The kinds in their order, the base first.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")

# What must be in a text for a kind to be in it, and the pattern. A base match starts at the
# start of a run or, for emails, right where the match before ended.
QUICK = {
    "email": "@",
    "ip": r"[0-9]\.[0-9]",
    "card": "[0-9][ -]?[0-9][ -]?[0-9]",
    "phone": r"\+[0-9]",
    "iban": "[A-Z]{2}[0-9]{2}",
    "ssn": "[0-9]{3}-[0-9]{2}-[0-9]{4}",
}
PATTERN = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9_])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9_])",
    "ssn": r"(?<![A-Za-z0-9_])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9_])",
}
# Words in front of a span that make it likelier.
CONTEXT = {
    "email": "mail|contact|write",
    "ip": "address|server|host|login",
    "card": "card|visa|credit|payment|account",
    "phone": "phone|tel|call|mobile|fax",
    "iban": "iban|bank|account|transfer",
    "ssn": "ssn|social|security|tax",
}
START = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.8, "ssn": 0.3}
CONTEXT_GAIN = 0.3
CONTEXT_CHARS = 40
THRESHOLD = 0.5


def luhn(digits: Column) -> Column:
    """True for a text of digits whose Luhn sum is a multiple of ten."""
    each = F.split(F.reverse(digits), "")
    total = F.aggregate(
        F.transform(
            each,
            lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
                F.get(F.array(*[F.lit(2 * n - 9 * (n > 4)) for n in range(10)]), d.cast("int"))
            ),
        ),
        F.lit(0),
        lambda s, x: s + x,
    )
    return total % 10 == 0


def mod_97(iban: Column) -> Column:
    """True for an account number whose rearranged digits leave 1 modulo 97."""
    moved = F.concat(F.substr(iban, F.lit(5)), F.substring(iban, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        value = F.conv(c, 36, 10).cast("int")
        return F.when(value < 10, rest * 10 + value).otherwise(rest * 100 + value) % 97

    return F.aggregate(F.split(moved, ""), F.lit(0), step) == 1


def _confirmed(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        part = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
        return F.rlike(match, F.lit(rf"^{part}(?:\.{part}){{3}}$"))
    if kind == "card":
        return luhn(digits)
    if kind == "phone":
        return F.char_length(digits).between(9, 15)
    if kind == "iban":
        plain = F.replace(match, F.lit(" "), F.lit(""))
        return F.char_length(plain).between(15, 34) & mod_97(plain)
    if kind == "ssn":
        return ~F.rlike(match, F.lit("^(?:000|666|9)")) & ~F.rlike(match, F.lit("-00-|-0000$"))
    return F.lit(True)


def _score(kind: str, before: Column) -> Column:
    """Start value, raised if a context word stands before the span."""
    near = F.rlike(F.lower(before), F.lit(CONTEXT[kind]))
    gain = F.when(near, F.lit(CONTEXT_GAIN)).otherwise(F.lit(0.0))
    return F.least(F.lit(START[kind]) + gain, F.lit(1.0))


# Matches that are located together: sums run within a block, then over blocks, so that a
# text of a million matches costs thousands of copies of a list each, not a million.
BLOCK = 200


def _running(steps: Column) -> Column:
    """Places ``(start, stop, before, match)`` of matches from ``(gap, before, match)``."""
    empty = F.lit([]).cast("array<struct<start:int,stop:int,before:string,match:string>>")

    def add(done: Column, s: Column) -> Column:
        at = F.coalesce(F.get(done, F.size(done) - 1)["stop"], F.lit(0)) + s["gap"]
        found = F.struct(
            at.alias("start"),
            (at + F.char_length(s["match"])).cast("int").alias("stop"),
            s["before"].alias("before"),
            s["match"].alias("match"),
        )
        return F.concat(done, F.array(found))

    def shift(blocks: Column) -> Column:
        lengths = F.transform(blocks, lambda b: F.get(b, F.size(b) - 1)["stop"])
        bases = F.aggregate(
            lengths,
            F.array(F.lit(0)),
            lambda done, n: F.concat(done, F.array(F.get(done, F.size(done) - 1) + n)),
        )
        moved = bind(
            bases,
            lambda base: F.transform(
                blocks,
                lambda block, i: F.transform(
                    block,
                    lambda s: F.struct(
                        (s["start"] + F.get(base, i)).alias("start"),
                        (s["stop"] + F.get(base, i)).alias("stop"),
                        s["before"].alias("before"),
                        s["match"].alias("match"),
                    ),
                ),
            ),
        )
        return F.flatten(moved)

    def in_blocks(s: Column) -> Column:
        parts = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(s) - 1) / BLOCK).cast("int")),
            lambda i: F.aggregate(F.slice(s, i * BLOCK + 1, BLOCK), empty, add),
        )
        return F.when(F.size(s) == 0, empty).otherwise(bind(parts, shift))

    return bind(steps, in_blocks)


def spans_of(kind: str, text: Column) -> Column:
    """Confirmed spans ``(kind, start, stop, score)`` of a text that is not null."""
    pattern = F.lit(PATTERN[kind])

    def locate(matches: Column) -> Column:
        # start of match i: the pieces up to it and the matches before it
        steps = bind(
            F.split(text, PATTERN[kind], -1),
            lambda pieces: F.zip_with(
                F.slice(pieces, 1, F.size(matches)),
                matches,
                lambda p, m: F.struct(
                    F.char_length(p).alias("gap"),
                    F.substring(p, -CONTEXT_CHARS, CONTEXT_CHARS).alias("before"),
                    m.alias("match"),
                ),
            ),
        )
        return _running(steps)

    def judge(found: Column) -> Column:
        good = F.filter(found, lambda s: _confirmed(kind, s["match"]))
        scored = F.transform(
            good,
            lambda s: F.struct(
                F.lit(kind).alias("kind"),
                s["start"].alias("start"),
                s["stop"].alias("stop"),
                _score(kind, s["before"]).alias("score"),
            ),
        )
        return F.filter(scored, lambda s: s["score"] >= THRESHOLD)

    none = F.lit([]).cast("array<struct<kind:string,start:int,stop:int,score:double>>")
    quick = F.contains(text, F.lit("@")) if kind == "email" else F.rlike(text, F.lit(QUICK[kind]))
    hit = quick & F.rlike(text, pattern)
    found = bind(bind(F.regexp_extract_all(text, pattern, F.lit(0)), locate), judge)
    return F.when(hit, found).otherwise(none)


def spans_text(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ","
    )


def find_pii(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows with ``pii``: spans ``(kind, start, stop, score)`` by kind, then start."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rest = [F.col(f"`{c}`") for c in df.columns if c.lower() != "pii"]
    every = bind(whole, lambda t: F.concat(*[spans_of(kind, t) for kind in KINDS]))
    return df.select(*rest, every.alias("pii"))


def of_kinds(spans: Column, kinds: tuple[str, ...]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))
