"""The engine's queries over the tables of a data directory."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack import fixtures
from tamarack.functions import scalars, text
from tamarack.operators import chunks, clean, corpus, dedupe, harvest, ids, labels, qa, sampling, splits
from tamarack.operators.latest import latest
from tamarack.sources import files, html, sinks
from tamarack.sources.tables import table, text_table

#: Thresholds at which the embeddings of the test tables have pairs at all.
COSINE, COSINE_STRICT = 0.35, 0.40

C = F.col


def _docs(spark: SparkSession, sf: str, *more: str) -> DataFrame:
    return text_table(spark, sf, "documents", "doc_id", "text", *more).filter("text is not null")


def _manifest(spark: SparkSession, sf: str) -> DataFrame:
    return latest(table(spark, sf, "manifest"), "doc_id", "line_no")


def _corpus(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "corpus_fixture")


def _gold(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "gold_test_fixture", "doc_id").filter("doc_id is not null").distinct()


def _duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return _manifest(spark, sf).filter(F.length("duplicate_of") > 0).select("doc_id")


def _topiced(spark: SparkSession, sf: str) -> DataFrame:
    topic = F.regexp_replace(F.lower(F.trim(C("topic_seed"))), r"[ -]", "_")
    return _corpus(spark, sf).withColumn("topic_seed", F.nullif(topic, F.lit("")))


def entry(spark: SparkSession, sf: str) -> DataFrame:
    """Kept, duplicate and short documents by language."""
    docs = _docs(spark, sf, "lang")
    marks = dedupe.mark_exact(docs, "doc_id", C("text"))
    flagged = docs.join(marks, "doc_id").select(F.coalesce(F.nullif(C("lang"), F.lit("")), F.lit("unknown")).alias("lang"), C("duplicate_of").isNotNull().alias("dup"), text.is_short(C("text")).alias("short"))
    return flagged.groupBy("lang").agg(F.count_if(~C("dup") & ~C("short")).alias("n_kept"), F.count_if("dup").alias("n_duplicate"), F.count_if(~C("dup") & C("short")).alias("n_short"))


def text_normalize_hash(s: SparkSession, d: str) -> DataFrame:
    return _docs(s, d).select("doc_id", text.text_hash(C("text")).alias("h"))


def exact_dup_groups(s: SparkSession, d: str) -> DataFrame:
    return dedupe.mark_exact(_docs(s, d), "doc_id", C("text"))


def word_counts(s: SparkSession, d: str) -> DataFrame:
    return _docs(s, d).select("doc_id", text.word_count(C("text")).alias("n_words"), text.approx_tokens(C("text")).alias("token_approx"), text.is_short(C("text")).alias("is_short"))


def scrub_contacts(s: SparkSession, d: str) -> DataFrame:
    scrubbed, n = text.scrub_contacts(C("card_text"))
    return text_table(s, d, "corpus_fixture", "doc_id", "card_text").filter("card_text is not null").select("doc_id", F.sha2(scrubbed, 256).alias("h"), n.cast("int").alias("n_contacts")).distinct()


def whitespace_normalize(s: SparkSession, d: str) -> DataFrame:
    tidy = text.tidy_space(text.join_hyphens(text.fix_ligatures(C("text"))))
    return _docs(s, d).select("doc_id", F.sha2(tidy, 256).alias("h"))


def line_fingerprint_df(s: SparkSession, d: str) -> DataFrame:
    pages = _docs(s, d, "source")
    return qa.running_line_frequency(pages, "source", "doc_id", F.transform(text.lines(C("text")), text.line_print))


def line_fingerprints(s: SparkSession, d: str) -> DataFrame:
    """In how many documents each line occurs, for the lines of at least two."""
    prints = _docs(s, d).select("doc_id", F.explode(F.array_distinct(F.transform(text.lines(C("text")), text.line_print))).alias("print")).filter(F.length("print") > 0)
    return prints.groupBy("print").agg(F.count("*").alias("n_docs")).filter("n_docs >= 2")


def layout_mangled(s: SparkSession, d: str) -> DataFrame:
    return _docs(s, d).select("doc_id", text.is_mangled(C("text")).alias("mangled"))


def caps_headings(s: SparkSession, d: str) -> DataFrame:
    rows = _docs(s, d).select("doc_id", F.posexplode(text.lines(C("text"))).alias("line_no", "line"))
    return rows.filter(text.is_caps_heading(C("line"))).select("doc_id", "line_no", text.strip(C("line")).alias("heading"))


def first_n_words_card(s: SparkSession, d: str) -> DataFrame:
    return _docs(s, d).select("doc_id", text.card_simple(C("text")).alias("card"), text.card_tiered(text.doc_title(C("text")), C("text")).alias("tiered"))


def doc_title(s: SparkSession, d: str) -> DataFrame:
    return _docs(s, d).select("doc_id", text.doc_title(C("text")).alias("title"), text.snippet(C("text"), 220, " | ").alias("snippet"))


def _topics(s: SparkSession, d: str) -> DataFrame:
    cards = _docs(s, d, "study_title").select("doc_id", "study_title", text.card_simple(C("text")).alias("card"))
    return labels.with_topics(cards, "card", "study_title", content_first="content_first", title_first="title_first").select("doc_id", "content_first", "title_first")


def topic_labels(s: SparkSession, d: str) -> DataFrame:
    return _topics(s, d)


def label_transition_matrix(s: SparkSession, d: str) -> DataFrame:
    return labels.transition_matrix(_topics(s, d), "title_first", "content_first")


def label_deltas(s: SparkSession, d: str) -> DataFrame:
    return labels.label_deltas(_topics(s, d), "title_first", "content_first")


def stakeholder_lookup(s: SparkSession, d: str) -> DataFrame:
    docs = _corpus(s, d).select("doc_id", "org")
    return labels.stakeholders(docs, "org", table(s, d, "org_lookup")).distinct()


def procedural_filter(s: SparkSession, d: str) -> DataFrame:
    studies = _manifest(s, d).select(C("study_or_consultation_title").alias("title")).union(s.createDataFrame([(t,) for t in fixtures.TITLES], "title string")).filter("title is not null").distinct()
    listed = s.createDataFrame([(t,) for t in fixtures.LISTED], "study_activity_id string")
    return harvest.select_studies(studies.withColumn("study_id", C("title")), listed).select("title", "reason", "kept")


def slugs(s: SparkSession, d: str) -> DataFrame:
    rows = _manifest(s, d).select("study_or_consultation_title", "parliament_session", "pdf_url").distinct()
    return rows.select(
        C("study_or_consultation_title").alias("title"),
        scalars.slugify(C("study_or_consultation_title")).alias("slug"),
        scalars.session_slug(C("parliament_session")).alias("session"),
        scalars.absolute_url(F.regexp_replace("pdf_url", "^https:", "")).alias("url"),
    ).distinct()


def doc_id_counter(s: SparkSession, d: str) -> DataFrame:
    new = table(s, d, "documents", "doc_id", "source_type").withColumn("prefix", F.when(C("source_type") == "crawl", "fix_unl").when(C("source_type") == "hesa_report", "fix_can").otherwise("fix_pub"))
    return ids.next_ids(new, _corpus(s, d).select(C("doc_id").alias("used")), "prefix", "doc_id", "used", digits=8)


def chunk_word_windows(s: SparkSession, d: str) -> DataFrame:
    words = _docs(s, d).select("doc_id", text.words(C("text")).alias("w"))
    cut = words.select("doc_id", "w", F.posexplode(text.window_starts(F.size("w"))).alias("window_no", "first_word"))
    part = F.array_join(F.slice("w", C("first_word") + 1, 600), " ")
    return cut.select("doc_id", "window_no", "first_word", F.least(F.size("w") - C("first_word"), F.lit(600)).alias("n_words"), F.sha2(part, 256).alias("h"))


def _chunks(s: SparkSession, d: str, keep: str, as_type: str) -> DataFrame:
    docs = _docs(s, d, "source_type").filter(keep).withColumn("source_type", F.lit(as_type))
    out = chunks.chunk_documents(docs)
    return out.select("chunk_id", "doc_id", "seq", "section_title", "page_start", "page_end", "token_approx", "is_recommendation", F.array_join("rec_numbers", ",").alias("rec_numbers"), F.sha2("text", 256).alias("h"))


def chunk_sections(s: SparkSession, d: str) -> DataFrame:
    return _chunks(s, d, "source_type not in ('hesa_report', 'gov_response')", "policy")


def chunk_gov_response(s: SparkSession, d: str) -> DataFrame:
    """Every document cut by the rules of responses."""
    return _chunks(s, d, "true", "gov_response")


def chunk_report(s: SparkSession, d: str) -> DataFrame:
    """Every document cut by the rules of reports."""
    return _chunks(s, d, "true", "hesa_report")


def chunk_stats(s: SparkSession, d: str) -> DataFrame:
    """Chunks of the types that the stage cuts."""
    return qa.chunk_stats(chunks.chunk_documents(_docs(s, d, "source_type"), types=chunks.CHUNKED_TYPES))


def cosine_pairs(s: SparkSession, d: str) -> DataFrame:
    return dedupe.cosine_pairs(table(s, d, "embeddings", "vec_id", "embedding"), "vec_id", "embedding", COSINE).withColumn("similarity", F.round("similarity", 6))


def _pairs(s: SparkSession, d: str) -> DataFrame:
    return dedupe.cosine_pairs(table(s, d, "embeddings", "vec_id", "embedding"), "vec_id", "embedding", COSINE)


def near_dup_clusters(s: SparkSession, d: str) -> DataFrame:
    return dedupe.near_clusters(_pairs(s, d), COSINE)


def semantic_dups(s: SparkSession, d: str) -> DataFrame:
    return dedupe.semantic_duplicates(_pairs(s, d), threshold=COSINE_STRICT)


def latest_manifest(s: SparkSession, d: str) -> DataFrame:
    return _manifest(s, d).select("doc_id", "line_no", "source_url", "language", "needs_ocr", "published_date")


def new_documents(s: SparkSession, d: str) -> DataFrame:
    """Documents whose address the manifest does not hold."""
    docs, known = table(s, d, "documents", "doc_id", "source_url"), _manifest(s, d)
    found = docs.select(F.concat(F.lit("doc_"), "doc_id").alias("doc_id"), "source_url")
    # addresses found twice, ids with two addresses, and ids and addresses that the manifest holds
    again = docs.filter("doc_id % 3 = 0").select(F.concat(F.lit("again_"), "doc_id").alias("doc_id"), "source_url")
    moved = docs.filter("doc_id % 5 = 0").select(F.concat(F.lit("doc_"), "doc_id").alias("doc_id"), F.concat("source_url", F.lit("#"), "doc_id").alias("source_url"))
    held = known.select("doc_id", F.concat("source_url", F.lit("#new")).alias("source_url")).union(known.select(F.concat(F.lit("new_"), "doc_id").alias("doc_id"), "source_url"))
    return sinks.new_documents(found.union(again).union(moved).union(held), known)


def contaminated_clusters(s: SparkSession, d: str) -> DataFrame:
    return splits.contaminated_clusters(_corpus(s, d), _gold(s, d), _duplicates(s, d))


def _eligible(s: SparkSession, d: str) -> DataFrame:
    return splits.eligible(_topiced(s, d), _gold(s, d), _duplicates(s, d))


def split_units_mode(s: SparkSession, d: str) -> DataFrame:
    return splits.split_units(_eligible(s, d))


def train_dev_split(s: SparkSession, d: str) -> DataFrame:
    return splits.train_dev(_eligible(s, d))


def split_topic_counts(s: SparkSession, d: str) -> DataFrame:
    return splits.topic_counts(splits.train_dev(_eligible(s, d)))


def split_checks(s: SparkSession, d: str) -> DataFrame:
    return splits.checks(splits.train_dev(_eligible(s, d)), _corpus(s, d), _gold(s, d), _duplicates(s, d))


def gold_allocation(s: SparkSession, d: str) -> DataFrame:
    pool = _topiced(s, d).dropDuplicates(["doc_id"]).filter("topic_seed is not null and coalesce(near_dup_cluster, '') = ''")
    sizes = pool.groupBy("topic_seed").agg(F.count("*").alias("n_docs"))
    return sampling.allocate(sizes, "topic_seed", "n_docs", "topic_seed", 180, 10)


def gold_sample(s: SparkSession, d: str) -> DataFrame:
    return sampling.gold_sample(_topiced(s, d)).select("doc_id", "topic_seed")


def labelling_sheet(s: SparkSession, d: str) -> DataFrame:
    """Fifty records of the gold sample to label a second time."""
    return sinks.labelling_sheet(sampling.sample_rows(sampling.gold_sample(_topiced(s, d)), "doc_id", 50, 7)).select("doc_id", "org", "gold_topic", "gold_stakeholder", "notes")


def qa_counts(s: SparkSession, d: str) -> DataFrame:
    return qa.value_counts(_topiced(s, d).distinct(), "topic_seed", "stakeholder_type", "source_type", "language", "label_source")


def qa_gold(s: SparkSession, d: str) -> DataFrame:
    return qa.value_counts(table(s, d, "gold_test_fixture").distinct(), "gold_topic", "gold_stakeholder")


def qa_dist_stats(s: SparkSession, d: str) -> DataFrame:
    return qa.distribution(_docs(s, d), text.word_count(C("text")))


def percentile_index(s: SparkSession, d: str) -> DataFrame:
    return qa.index_percentiles(_docs(s, d), text.word_count(C("text")), p10=0.1, p50=0.5, p90=0.9, p99=0.99).withColumn("mean", F.round("mean", 6))


def study_type_pivot(s: SparkSession, d: str) -> DataFrame:
    return qa.pivot_counts(_manifest(s, d), "study_or_consultation_title", "source_type", ["hesa_brief", "hesa_report", "gov_response", "crawl"])


def qa_flags(s: SparkSession, d: str) -> DataFrame:
    return qa.flag_counts(_manifest(s, d))


def qa_clusters(s: SparkSession, d: str) -> DataFrame:
    return qa.cluster_stats(_corpus(s, d).dropDuplicates(["doc_id"]))


def qa_topics(s: SparkSession, d: str) -> DataFrame:
    return qa.corpus_report(_topiced(s, d).distinct()).withColumn("share", F.round("share", 9))


def corpus_inclusion(s: SparkSession, d: str) -> DataFrame:
    return corpus.inclusion_counts(_manifest(s, d))


def corpus_build(s: SparkSession, d: str) -> DataFrame:
    """The corpus of the manifest's briefs, their card texts standing for the clean texts."""
    texts = _corpus(s, d).filter("card_text is not null").groupBy("doc_id").agg(F.min("card_text").alias("clean_text")).withColumn("masked_text", F.lit(None).cast("string"))
    out = corpus.build_corpus(_manifest(s, d), texts, table(s, d, "org_lookup"))
    return out.select("doc_id", "Name", "org", "date", "language", "study_title", F.sha2("card_text", 256).alias("card_hash"), "topic_seed", "stakeholder_type", "label_source", "near_dup_cluster")


def clean_documents(s: SparkSession, d: str) -> DataFrame:
    return clean.clean_documents(_docs(s, d, "organization", "source_type"))


def clean_wrapped(s: SparkSession, d: str) -> DataFrame:
    """Every document cleaned with pages around its text that hold all that cleaning removes."""
    before, between, after = map(F.lit, fixtures.WRAP)
    name = F.coalesce("organization", F.lit("Example Society"))
    wrapped = F.concat(before, name, between, "text", after, F.when(C("doc_id") % 2 == 0, fixtures.WRAP_EVEN).otherwise(fixtures.WRAP_ODD))
    return clean.clean_documents(_docs(s, d, "organization", "source_type").select("doc_id", wrapped.alias("text"), name.alias("organization"), "source_type"))


def cleaning_summary(s: SparkSession, d: str) -> DataFrame:
    return qa.cleaning_summary(clean_documents(s, d))


def published_dates(s: SparkSession, d: str) -> DataFrame:
    raw = _manifest(s, d).select(F.coalesce("published_raw", "published_date").alias("published")).union(s.createDataFrame([(t,) for t in fixtures.PUBLISHED], "published string")).filter("published is not null").distinct()
    return raw.select("published", scalars.published_date(C("published")).alias("iso"))


def pdf_extract(s: SparkSession, d: str) -> DataFrame:
    return files.pdf_text(s.createDataFrame(fixtures.BLOCKS, "doc_id string, page int, x0 double, y0 double, block_type int, text string"))


def _pages(s: SparkSession) -> DataFrame:
    return s.createDataFrame(fixtures.PAGES, "page_id int, html string")


def html_extract(s: SparkSession, d: str) -> DataFrame:
    return html.extract_pages(_pages(s), "page_id", "html")


def study_list(s: SparkSession, d: str) -> DataFrame:
    return html.parse_studies(_pages(s), "page_id", "html")


def study_meta(s: SparkSession, d: str) -> DataFrame:
    found = html.parse_study_pages(_pages(s), "page_id", "html")
    return found.select("page_id", "title", scalars.absolute_url(C("report_viewer_url")).alias("report_viewer_url"), scalars.absolute_url(C("govresponse_viewer_url")).alias("govresponse_viewer_url"))


def brief_parse(s: SparkSession, d: str) -> DataFrame:
    found = html.parse_briefs(_pages(s), "page_id", "html")
    iso = scalars.published_date(C("published_text"))
    return found.select("page_id", "position", "organization", scalars.absolute_url(C("pdf_href")).alias("pdf_url"), "is_joint", iso.alias("published_date"), F.when(iso.isNull(), C("published_text")).alias("published_raw"))


def pdf_links(s: SparkSession, d: str) -> DataFrame:
    return html.parse_pdf_links(_pages(s), "page_id", "html").select("page_id", scalars.absolute_url(C("pdf_href")).alias("pdf_url"))


NAMES = """text_normalize_hash exact_dup_groups word_counts scrub_contacts whitespace_normalize line_fingerprint_df line_fingerprints layout_mangled
caps_headings first_n_words_card doc_title topic_labels label_transition_matrix label_deltas stakeholder_lookup procedural_filter slugs doc_id_counter
chunk_word_windows chunk_sections chunk_gov_response chunk_report chunk_stats cosine_pairs near_dup_clusters semantic_dups latest_manifest new_documents
contaminated_clusters split_units_mode train_dev_split split_topic_counts split_checks gold_allocation gold_sample labelling_sheet qa_counts qa_gold
qa_dist_stats percentile_index study_type_pivot qa_flags qa_clusters qa_topics corpus_inclusion corpus_build clean_documents clean_wrapped cleaning_summary
published_dates pdf_extract html_extract study_list study_meta brief_parse pdf_links""".split()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"entry": entry} | {name: globals()[name] for name in NAMES}
