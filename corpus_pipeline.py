"""A corpus from raw documents to pieces: rules, line dedup, near copies, benchmark, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeleads.llm import (
    decontaminate,
    line_dedup,
    ngram_join,
    quality_rules,
    sentencepiece_nbest,
)
from placeleads.llm.common import cut_lineage, table

# Near copies in the pipeline: words of a shingle, and percent of shingles in common.
SHINGLE, SIMILAR = 5, 80


def _counted(docs: DataFrame) -> DataFrame:
    """The documents with their number of characters brought up to date."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long"))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that fail a rule go, documents that fail go."""
    return _counted(quality_rules.keep_good(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of lines that occurred before go."""
    return _counted(line_dedup.drop_repeated_lines(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return ngram_join.keep_one_of_each(docs, size=SHINGLE, percent=SIMILAR)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark phrase go."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the text, its next best segmentations, and whether the pieces give it back."""
    coded = sentencepiece_nbest.encode(docs, decoded=True)
    return coded.select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("long").alias("n_pieces"),
        "score",
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"),
        "ids",
        "alternatives",
    )


STAGES = [
    ("quality_rules", rules),
    ("line_dedup", lines),
    ("ngram_jaccard_join", near_copies),
    ("benchmark_decontamination", benchmark),
    ("sentencepiece", pieces),
]

# SQL cannot express the segmentation; tests compare the rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
