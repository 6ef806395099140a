"""The cleaning of documents, as one projection without a shuffle and without Python."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.functions import cleaning
from tamarack.functions.text import SHORT_WORDS, is_mangled, org_names, scrubbed, tidy_space, word_count

#: Types whose front and back matter is cut, and the type whose submitters are masked.
REPORT_TYPES = ("hesa_report", "gov_response")
MASKED_TYPE = "hesa_brief"

SCHEMA = "doc_id string, clean_text string, masked_text string, words_before int, words_after int, hf_removed int, title_echoes int, contact_count int, layout_mangled boolean, dropped_short boolean"


def clean_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", org_col: str = "organization", type_col: str = "source_type") -> DataFrame:
    """Rows of SCHEMA for every document with a text.

    Running lines and title echoes go first, on the text as it stands; then print damage, contents
    lists, paragraphs about the submitter, front and back matter of reports, contact details and the
    signature. Layout is judged before contacts are scrubbed, short texts are marked but kept.
    Null texts give no row, empty ones an empty short document. Repeated rows each give one row,
    other columns are ignored. No shuffle: every document is cleaned where it is read.
    """
    c = F.col
    source = docs.select(c(id_col).cast("string").alias("doc_id"), c(text_col).cast("string").alias("text"), c(org_col).cast("string").alias("org"), c(type_col).cast("string").alias("kind")).filter("text is not null")
    bare = source.select("*", cleaning.without_running(c("text")).alias("bare"), F.coalesce(org_names(c("org")), F.array().cast("array<string>")).alias("names"))
    whole = bare.select("*", cleaning.tidy(c("bare.text")).alias("whole"))
    named = whole.select("*", cleaning.aliases(c("whole"), c("names")).alias("more"), cleaning.without_about(cleaning.without_contents(c("whole"))).alias("body"))
    cut = named.withColumn("body", F.when(c("kind").isin(*REPORT_TYPES), cleaning.without_back(cleaning.without_front(c("body")))).otherwise(c("body")))
    clean = cut.select("*", is_mangled(c("body")).alias("layout_mangled"), scrubbed(c("body")).alias("scrubbed"))
    done = clean.select("*", tidy_space(cleaning.without_signature(c("scrubbed.text"))).alias("clean_text"))
    counted = done.withColumn("words_after", word_count(c("clean_text")))
    return counted.select(
        "doc_id",
        "clean_text",
        F.when(c("kind") == MASKED_TYPE, cleaning.masked(c("clean_text"), F.concat("names", "more"))).alias("masked_text"),
        word_count(c("text")).alias("words_before"),
        "words_after",
        c("bare.hf_removed").alias("hf_removed"),
        c("bare.title_echoes").alias("title_echoes"),
        c("scrubbed.n").alias("contact_count"),
        "layout_mangled",
        (c("words_after") < SHORT_WORDS).alias("dropped_short"),
    )
