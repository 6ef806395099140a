"""Selection of studies and of documents to fetch; fetching itself is left to the caller."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.functions.scalars import procedural_reason


class Fetcher(Protocol):
    """What brings the bytes of an address; implementations wait between requests and stop when refused."""

    def fetch(self, url: str) -> bytes: ...


def select_studies(studies: DataFrame, whitelist: DataFrame, id_col: str = "study_id", title_col: str = "title") -> DataFrame:
    """studies with reason and kept: listed studies are kept whatever their title, procedural ones are not."""
    listed = whitelist.select(F.trim("study_activity_id").alias(id_col)).distinct().withColumn("_w", F.lit(True))
    joined = studies.join(listed, id_col, "left")
    reason = F.when(F.col("_w").isNull(), procedural_reason(F.col(title_col)))
    return joined.select(*[studies[c] for c in studies.columns], reason.alias("reason"), reason.isNull().alias("kept"))


def to_extract(manifest: DataFrame, raw: DataFrame, texts: DataFrame) -> DataFrame:
    """Documents with a raw file whose text or language is still missing and that do not wait for OCR."""
    done = texts.select("doc_id").join(manifest.filter("language is not null").select("doc_id"), "doc_id", "left_semi")
    return manifest.filter(~F.coalesce(F.col("needs_ocr"), F.lit(False))).join(raw.select("doc_id"), "doc_id", "left_semi").join(done, "doc_id", "left_anti")


def ocr_flags(manifest: DataFrame, raw: DataFrame, texts: DataFrame, always: tuple[str, ...] = ()) -> DataFrame:
    """The manifest with needs_ocr set for PDFs that have a raw file but no text, and for the ids of ``always``."""
    missing = raw.filter("file_type = 'pdf'").select("doc_id").distinct().join(texts.select("doc_id"), "doc_id", "left_anti").withColumn("_m", F.lit(True))
    joined = manifest.join(missing, "doc_id", "left")
    flag = F.when(F.col("_m").isNotNull() | F.col("doc_id").isin(*always), True).otherwise(manifest["needs_ocr"])
    return joined.select(*[flag.alias(c) if c == "needs_ocr" else manifest[c] for c in manifest.columns])
