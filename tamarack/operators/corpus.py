"""The corpus table: one labelled card per kept brief."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.functions.text import card_simple, card_tiered, doc_title
from tamarack.operators.labels import EXEMPT_TITLES, FALLBACK, HEALTH_TOPICS, stakeholders, with_topics


def clean_eligible() -> Column:
    """Documents to clean: not waiting for OCR and of a known language."""
    return ~F.coalesce(F.col("needs_ocr"), F.lit(False)) & F.col("language").isNotNull()


def hash_eligible() -> Column:
    return clean_eligible() & ~F.coalesce(F.col("dropped_short"), F.lit(False))


def embed_eligible() -> Column:
    return hash_eligible() & (F.col("source_type") == "hesa_brief")


def corpus_eligible() -> Column:
    return embed_eligible() & (F.length(F.coalesce("language", F.lit(""))) > 0) & (F.length(F.coalesce("duplicate_of", F.lit(""))) == 0)


def inclusion_counts(manifest: DataFrame) -> DataFrame:
    """How many documents each rule leaves out, the first that applies counting, and how many stay."""
    reason = (
        F.when(F.col("source_type") != "hesa_brief", "not_brief")
        .when(F.length(F.coalesce("duplicate_of", F.lit(""))) > 0, "duplicate")
        .when(F.coalesce(F.col("dropped_short"), F.lit(False)), "short")
        .when(F.coalesce(F.col("needs_ocr"), F.lit(False)), "needs_ocr")
        .when(F.length(F.coalesce("language", F.lit(""))) == 0, "no_language")
        .otherwise("included")
    )
    return manifest.groupBy(reason.alias("outcome")).agg(F.count("*").alias("n_docs"))


def build_corpus(manifest: DataFrame, texts: DataFrame, lookup: DataFrame, rules=HEALTH_TOPICS, exempt=EXEMPT_TITLES, fallback: str = FALLBACK, tiered: bool = False) -> DataFrame:
    """The corpus of eligible briefs with a clean text.

    ``texts``: doc_id, clean_text, masked_text; the masked text makes the card where there is one.
    Documents without text are left out. The title of the text, else of the study, is the name.
    """
    base = manifest.filter(corpus_eligible()).join(texts.select("doc_id", "clean_text", "masked_text"), "doc_id").filter("clean_text is not null")
    body = F.coalesce("masked_text", "clean_text")
    title = F.nullif(doc_title(F.col("clean_text")), F.lit(""))
    card = card_tiered(title, body) if tiered else card_simple(body)
    carded = base.select(
        "doc_id",
        F.coalesce(title, "study_or_consultation_title").alias("Name"),
        F.col("organization").alias("org"),
        "source_type",
        F.coalesce("published_date", "fetch_date").alias("date"),
        "language",
        F.col("study_or_consultation_title").alias("study_title"),
        card.alias("card_text"),
        F.concat(F.lit("masked/"), "doc_id", F.lit(".txt")).alias("text_org_masked_path"),
        F.concat(F.lit("clean/"), "doc_id", F.lit(".txt")).alias("full_text_path"),
        "near_dup_cluster",
    )
    labelled = with_topics(carded, "card_text", "study_title", rules, exempt, fallback).withColumn("label_source", F.lit("weak"))
    return stakeholders(labelled, "org", lookup).select("doc_id", "Name", "org", "source_type", "date", "language", "study_title", "card_text", "text_org_masked_path", "full_text_path", "topic_seed", "stakeholder_type", "label_source", "near_dup_cluster")
