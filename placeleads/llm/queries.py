"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeleads.llm import (
    decontaminate,
    factor_dedup,
    fill_in_middle,
    fingerprints,
    hard_negatives,
    line_dedup,
    ngram_join,
    page_wrapper,
    pii,
    quality_classifier,
    quality_rules,
    secret_scan,
    sentencepiece_nbest,
)
from placeleads.llm.common import table


def _texts(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_quality_classifier(spark, sf_dir):
    texts = _texts(spark, sf_dir)
    model = quality_classifier.fit(texts, table(spark, sf_dir, "labels"))
    return quality_classifier.score(texts, model).select(
        "doc_id", quality_classifier.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


def op2_html_extraction(spark, sf_dir):
    pages = page_wrapper.extract_text(table(spark, sf_dir, "pages"))
    return pages.withColumn("n_chars", F.char_length("text").cast("long"))


def op3_secret_scan(spark, sf_dir):
    found = secret_scan.find_secrets(_texts(spark, sf_dir))

    def joined(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ","
        )

    def count(kind):
        own = F.filter("base", lambda s: s["kind"] == kind)
        return F.size(own).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in secret_scan.BASE_KINDS]
    base = F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, joined(F.col("spans")).alias("spans"))


def op4_sentencepiece(spark, sf_dir):
    done = sentencepiece_nbest.encode(_texts(spark, sf_dir), decoded=True)
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        "score",
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"),
        "ids",
        "alternatives",
    )


def op5_line_dedup(spark, sf_dir):
    return line_dedup.dedup_lines(_texts(spark, sf_dir)).select(
        "doc_id",
        F.col("removed_lines").alias("n_removed"),
        F.col("removed_runs").alias("n_runs"),
        F.col("clean_text").alias("text"),
    )


def op5_passage_dedup(spark, sf_dir):
    """As ``op5_line_dedup``, whose default is this length of passages as well."""
    done = line_dedup.dedup_lines(_texts(spark, sf_dir), passage_words=line_dedup.PASSAGE_WORDS)
    return done.select(
        "doc_id",
        F.col("removed_lines").alias("n_removed"),
        F.col("removed_runs").alias("n_runs"),
        F.col("clean_text").alias("text"),
    )


def op6_decontamination(spark, sf_dir):
    found = decontaminate.find_benchmark(_texts(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, r: n + r["stop"] - r["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op6_proximity(spark, sf_dir):
    """Items with a match within the tolerance, exact ones included."""
    found = decontaminate.find_benchmark(_texts(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("near").cast("long").alias("n_near"),
        F.sha2(F.array_join("near", ",").cast("binary"), 256).alias("near_sha256"),
    )


def op7_ngram_join(spark, sf_dir):
    return ngram_join.join_ngrams(_texts(spark, sf_dir))


def op8_pii(spark, sf_dir):
    found = pii.find_pii(_texts(spark, sf_dir))
    base = pii.of_kinds(F.col("pii"), pii.BASE_KINDS)
    counts = [
        F.size(pii.of_kinds(F.col("pii"), (kind,))).cast("long").alias(f"n_{kind}")
        for kind in pii.BASE_KINDS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.spans_text(base).cast("binary"), 256).alias("base_sha256"),
        pii.spans_text(F.col("pii")).alias("spans"),
    )


def op9_factor_dedup(spark, sf_dir):
    return factor_dedup.remove_repeats(_texts(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", F.col("n_spans").cast("long"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op10_quality_rules(spark, sf_dir):
    return quality_rules.judge(_texts(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op11_fingerprints(spark, sf_dir):
    found = fingerprints.compare_edited(_texts(spark, sf_dir))
    return found.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("fingerprint")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op12_fill_in_middle(spark, sf_dir):
    done = fill_in_middle.restore(fill_in_middle.transform(_texts(spark, sf_dir)))
    return done.select(
        "doc_id",
        "n",
        "form",
        F.col("prefix_units").alias("prefix_chars"),
        F.col("middle_units").alias("middle_chars"),
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"),
    )


def op13_hard_negatives(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved))


LLM_QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_classifier,
        op2_html_extraction,
        op3_secret_scan,
        op4_sentencepiece,
        op5_line_dedup,
        op5_passage_dedup,
        op6_decontamination,
        op6_proximity,
        op7_ngram_join,
        op8_pii,
        op9_factor_dedup,
        op10_quality_rules,
        op11_fingerprints,
        op12_fill_in_middle,
        op13_hard_negatives,
    )
}
