"""Schemas of the tables that pass between stages; readers never infer them."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


def _flags(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.BooleanType()) for n in names]


MANIFEST = T.StructType(
    [
        *_strings("doc_id", "source_url", "fetch_date", "source_type", "organization", "study_or_consultation_title", "parliament_session", "language", "file_type"),
        *_flags("needs_ocr", "joint"),
        *_strings("published_date", "published_raw", "pdf_url"),
        *_flags("layout_mangled", "dropped_short"),
        *_strings("duplicate_of", "near_dup_cluster"),
    ]
)
CORPUS = T.StructType(_strings("doc_id", "Name", "org", "source_type", "date", "language", "study_title", "card_text", "text_org_masked_path", "full_text_path", "topic_seed", "stakeholder_type", "label_source", "near_dup_cluster"))
CHUNK = T.StructType(
    [
        *_strings("chunk_id", "doc_id", "source_type", "section_title"),
        *[T.StructField(n, T.IntegerType()) for n in ("page_start", "page_end", "token_approx")],
        *_strings("text"),
        *_flags("is_recommendation"),
        T.StructField("rec_numbers", T.ArrayType(T.IntegerType())),
    ]
)
ORG_LOOKUP = T.StructType(_strings("org", "stakeholder_type"))
GOLD = T.StructType(_strings("doc_id", "gold_topic", "gold_stakeholder"))
LABELLING_SHEET = T.StructType(_strings("doc_id", "org", "card_text", "gold_topic", "gold_stakeholder", "notes"))
WHITELIST = T.StructType(_strings("study_activity_id", "study_title", "note"))
DISCARDED = T.StructType(_strings("study_activity_id", "study_title", "parl_session", "reason"))
FAILED = T.StructType(_strings("doc_id", "source_url", "error", "timestamp"))
INVENTORY = T.StructType(_strings("source", "parl_session", "study_slug", "study_title", "listing_url"))
PDF_BLOCKS = T.StructType(
    [
        T.StructField("doc_id", T.StringType()),
        T.StructField("page", T.IntegerType()),
        T.StructField("x0", T.DoubleType()),
        T.StructField("y0", T.DoubleType()),
        T.StructField("block_type", T.IntegerType()),
        T.StructField("text", T.StringType()),
    ]
)
