"""Line-first cleaning: rules per line, then a verdict on what is left of the document.

Each line of a text is judged on its own by three rules:

* punctuation: too many characters of the line are symbols or exclamation marks, or too many
  of its words end in one (``max_mark_ends``);
* navigation: the line has ``min_bars`` separators (``|``, ``>``, ``»``, dots in the middle),
  and ``short_items`` percent of the items between them have ``max_item_words`` words at
  most. With None for the latter, ``min_bars`` of ``|`` are enough, whatever is between them;
* boilerplate: the line holds one of the fixed phrases of licences, cookie notices, and
  the like.

Failing lines are removed. A document that loses more than ``max_lost`` percent of its
word characters is rejected, as is one that fails the base rules (too few words, or too
many words in windows that the text repeats).

Defined results: a null or empty text has no words, fails the base rules and is rejected;
its cleaned text is the empty text. Rows are judged one by one, so repeated rows get equal
results, null ids and further columns are kept as they are. Columns that the operator adds
replace columns of the same name. All of it is one narrow stage of built-in functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeleads.functions.text import bind
from placeleads.llm.common import WORD, words_of

# Phrases (lower case) that mark a line as boilerplate.
BOILERPLATE = (
    "all rights reserved",
    "accept cookies",
    "cookie policy",
    "enable javascript",
    "javascript is disabled",
    "licensed under",
    "lorem ipsum",
    "privacy policy",
    "released under",
    "sign up for our newsletter",
    "skip to content",
    "subscribe to our",
    "terms of service",
    "terms of use",
    "this work is licensed",
    "use of cookies",
)
# The symbols that are counted, for the base and for the punctuation rule.
SYMBOLS = "[#*$%&|<>]"
MARKS = "[#*$%&<>!]"
SEPARATORS = "[|>»›·•]"
SPECIAL = "[#*$%&<>!|»›·•]"  # marks and separators


@dataclass(frozen=True)
class Rules:
    """Percentages and counts of the rules."""

    min_words: int = 20
    max_repeated: int = 30
    window: int = 8
    max_marks: int = 20
    min_bars: int = 3
    max_lost: int = 50
    max_mark_ends: int | None = 50  # percent of a line's words; none: not evaluated
    max_item_words: int | None = 4  # of an item in a bar; none: only "|" are counted
    short_items: int = 80  # percent of the items of a bar that have so few words


def _repeated_words(words: Column, window: int) -> Column:
    """Words in windows that occur twice or more. Windows are compared by a 64-bit hash of
    their words' hashes; sorted with their places, equal windows are neighbours."""

    def covered(hashes: Column) -> Column:
        last = F.size(hashes) - window

        def places(found: Column) -> Column:
            twins = F.filter(
                F.sequence(F.lit(0), last),
                lambda i: (F.get(found, i)["h"] == F.get(found, i - 1)["h"])
                | (F.get(found, i)["h"] == F.get(found, i + 1)["h"]),
            )
            at = F.sort_array(F.transform(twins, lambda i: F.get(found, i)["i"]))
            return bind(
                at,
                lambda p: F.aggregate(
                    F.zip_with(p, F.slice(p, 2, F.size(p)), lambda a, b: b - a),
                    F.lit(0),
                    lambda total, gap: total + F.least(F.coalesce(gap, F.lit(window)), F.lit(window)),
                ),
            )

        keys = F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.struct(F.xxhash64(F.slice(hashes, i + 1, window)).alias("h"), i.alias("i")),
        )
        found = bind(
            keys,
            lambda k: F.when(
                F.size(F.array_distinct(F.transform(k, lambda e: e["h"]))) < F.size(k),
                bind(F.sort_array(k), places),
            ).otherwise(0),
        )
        return F.when(last < 1, F.lit(0)).otherwise(found)

    return bind(F.transform(words, lambda w: F.xxhash64(w)), covered)


def _line_fails(line: Column, rules: Rules) -> Column:
    """True if a rule removes the line. Quick tests come first."""
    chars = F.char_length(F.regexp_replace(line, r"[\x20\x09-\x0D]+", ""))
    marks = F.regexp_count(line, F.lit(MARKS))
    bar = F.regexp_count(line, F.lit(r"\|")) >= rules.min_bars
    if rules.max_item_words is not None:
        items = F.transform(F.split(line, SEPARATORS), lambda i: F.regexp_count(i, F.lit(WORD)))
        short = bind(
            items,
            lambda ns: F.size(F.filter(ns, lambda n: n <= rules.max_item_words)) * 100
            >= F.size(ns) * rules.short_items,
        )
        bar = (F.regexp_count(line, F.lit(SEPARATORS)) >= rules.min_bars) & short
    ends = F.lit(False)
    if rules.max_mark_ends is not None:
        ended = F.regexp_count(line, F.lit(MARKS + r"(?=[\x20\x09-\x0D]|\z)"))
        ends = ended * 100 > F.regexp_count(line, F.lit(WORD)) * rules.max_mark_ends
    low = F.lower(line)
    phrase = F.lit(False)
    for part in BOILERPLATE:
        phrase = phrase | F.contains(low, F.lit(part))
    special = F.rlike(line, F.lit(SPECIAL))
    return phrase | (special & ((marks * 100 > chars * rules.max_marks) | bar | ends))


def judge(df: DataFrame, text: str = "text", rules: Rules | None = None) -> DataFrame:
    """The rows with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept`` and ``clean_text``, the text without the lines that fail."""
    rules = rules or Rules()
    whole = F.coalesce(F.col(text), F.lit(""))
    word = F.lit(WORD)

    def measure(t: Column) -> Column:
        def with_words(words: Column) -> Column:
            def with_lines(lines: Column) -> Column:
                full = F.filter(lines, lambda line: F.rlike(line, word))
                good = F.filter(lines, lambda line: ~_line_fails(line, rules))
                return F.struct(
                    F.size(words).cast("long").alias("n_words"),
                    F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
                    F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
                    bind(full, lambda x: F.size(x) - F.size(F.array_distinct(x)))
                    .cast("long")
                    .alias("n_dup_lines"),
                    _repeated_words(words, rules.window).cast("long").alias("n_repeat_words"),
                    F.array_join(good, "\n").alias("clean_text"),
                )

            return bind(F.split(t, "\n"), with_lines)

        return bind(words_of(t), with_words)

    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    added = {*names, "clean_text", "base_failed", "kept"}
    rest = [c for c in df.columns if c.lower() not in added]
    out = df.select(*[F.col(f"`{c}`") for c in rest], bind(whole, measure).alias("clean_text"))
    out = out.select(*[F.col(f"`{c}`") for c in rest], "clean_text.*")
    failed = (F.col("n_words") < rules.min_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * rules.max_repeated
    )
    left = F.char_length(F.regexp_replace("clean_text", r"[\x20\x09-\x0D]+", ""))
    lost_too_much = (F.col("word_chars") - left) * 100 > F.col("word_chars") * rules.max_lost
    return out.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & ~lost_too_much
    )


def keep_good(df: DataFrame, text: str = "text", rules: Rules | None = None) -> DataFrame:
    """Only the documents that the rules keep, with their columns, and the cleaned text in
    place of the text."""
    # The other columns travel as one struct, beside the text.
    others = [F.col(f"`{c}`") for c in df.columns if c != text]
    own = F.struct(F.lit(0).alias("_"), *others).alias("own")
    judged = judge(df.select(own, F.col(f"`{text}`").alias("text")), "text", rules)
    out = [
        F.col("clean_text").alias(c) if c == text else F.col("own").getField(c).alias(c)
        for c in df.columns
    ]
    # Not a filter: that would be pushed below the measures and compute them a second time.
    return judged.select(
        F.inline(F.when(F.col("kept"), F.array(F.struct(*out))).otherwise(F.array()))
    )
