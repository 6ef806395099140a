"""Weak topic labels from ordered keyword rules, stakeholders from a lookup."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.functions.text import strip
from tamarack.plans.skew import lookup_join

# Topics in order of precedence: code, words of which one is enough, words of which two are needed; a leading re: marks a pattern.
HEALTH_TOPICS = (
    ("indigenous_health", ("indigenous health", "first nations", "inuit", r"re:\bmétis|\bmetis\b", "jordan's principle", "non-insured health benefits"), ("indigenous",)),
    ("womens_health", ("women's health", "womens health", "reproductive health", "maternal health", "breast cancer", "cervical cancer", "menopause", "endometriosis", "contraception", "midwifery"), ()),
    ("mental_health", ("suicide prevention", "depression"), ("mental health", "mental illness", "psychiatric", "mood disorder", "anxiety disorder")),
    (
        "public_health",
        ("pandemic preparedness", "emergency preparedness", "antimicrobial", "immunization", "immunisation", "disease surveillance", "long covid", "opioid", "overdose", "harm reduction", "safe supply"),
        ("public health", "pandemic", "epidemic", r"re:\bcovid", "infectious disease", "communicable disease", "outbreak", r"re:\bvaccin", "substance use", "addiction", "drug policy", "toxic drug"),
    ),
    (
        "pharmacare",
        ("pharmacare", "patented medicine", "formulary", "rare disease drug", "biosimilar", "medical device"),
        ("pharmaceutical", "prescription drug", "drug coverage", "drug pricing", "drug shortage", "drug approval", "drug safety"),
    ),
    (
        "workforce",
        ("physician shortage", "nurse shortage", "nursing shortage", "health human resources", "credential recognition", "internationally educated", "internationally trained", "scope of practice"),
        ("workforce", "burnout", "retention and recruitment"),
    ),
    ("childrens_health", (r"re:\bpaediatric|\bpediatric", r"re:\bneonatal", r"re:\binfant health"), ("children's health", "childrens health", "child health")),
    ("cancer", ("cancer prevention", "cancer treatment", "cancer care", "oncology", r"re:\bchemo", "radiation therapy", "cancer screening", "carcinogen"), ()),
)
# Studies whose title says too little, compared in lower case.
EXEMPT_TITLES = (
    "emergency situation facing canadians in light of the covid-19 pandemic",
    "impact of immigration policy on healthcare and barriers to integrating internationally trained professionals",
    "children's health",
)
FALLBACK = "unlabeled"

Rules = tuple[tuple[str, tuple[str, ...], tuple[str, ...]], ...]


def rules_from(document: dict) -> tuple[Rules, str, tuple[str, ...]]:
    """(rules, fallback, exempt titles) of a parsed rules file."""
    rules = tuple((t["code"], tuple(t.get("strong_keywords") or ()), tuple(t.get("keywords") or ())) for t in document.get("topics", []))
    return rules, document.get("fallback", FALLBACK), tuple(t.lower() for t in document.get("title_exempt_studies") or ())


def keyword_pattern(keyword: str) -> str:
    return keyword[3:] if keyword.startswith("re:") else re.sub(r"([^\w\s'é])", r"\\\1", keyword)


def _holds(low: Column, keyword: str) -> Column:
    return low.rlike(f"(?iu){keyword_pattern(keyword)}") if keyword.startswith("re:") else low.contains(keyword.lower())


def _any(low: Column, keywords: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for k in keywords:
        out = out | _holds(low, k)
    return out


def _two(low: Column, keywords: tuple[str, ...]) -> Column:
    hits = F.lit(0)
    for k in keywords:
        hits = hits + _holds(low, k).cast("int")
    return hits >= 2


def first_topic(low: Column, rules: Rules, loose: bool) -> Column:
    """The first topic of which the lower-case text holds a strong word, or any word (loose), or else two plain ones; null without."""
    choice = F.lit(None).cast("string")
    for code, strong, plain in reversed(rules):
        holds = _any(low, strong + plain) if loose else _any(low, strong) | _two(low, plain)
        choice = F.when(holds, code).otherwise(choice)
    return choice


def _title_topic(low: Column, rules: Rules, exempt: tuple[str, ...]) -> Column:
    return F.when((F.length(low) > 0) & ~low.isin(*exempt), first_topic(low, rules, loose=True)) if exempt else first_topic(low, rules, loose=True)


def with_topics(df: DataFrame, card: str, title: str, rules: Rules = HEALTH_TOPICS, exempt: tuple[str, ...] = EXEMPT_TITLES, fallback: str = FALLBACK, content_first: str | None = "topic_seed", title_first: str | None = None) -> DataFrame:
    """df with the topic by content first, by title first, or both, under the given column names.

    Both texts are lower-cased once, in a step of their own, since every rule reads them. Null texts
    hold no keyword.
    """
    low = df.select("*", F.lower(card).alias("_card"), F.lower(title).alias("_title"))
    by_title = _title_topic(F.col("_title"), rules, exempt)
    wanted = []
    if content_first:
        wanted.append(F.coalesce(first_topic(F.col("_card"), rules, loose=False), by_title, F.lit(fallback)).alias(content_first))
    if title_first:
        wanted.append(F.coalesce(by_title, first_topic(F.col("_card"), rules, loose=True), F.lit(fallback)).alias(title_first))
    return low.select(*df.columns, *wanted)


def transition_matrix(labels: DataFrame, old: str, new: str) -> DataFrame:
    """Documents by (old, new) label; moved says whether the label changed."""
    return labels.groupBy(F.col(old).alias("old_topic"), F.col(new).alias("new_topic")).agg(F.count("*").alias("n_docs")).withColumn("moved", F.col("old_topic") != F.col("new_topic"))


def label_deltas(labels: DataFrame, old: str, new: str) -> DataFrame:
    """Documents per topic under the old and the new label, and the difference."""
    sides = labels.select(F.explode(F.array(F.struct(F.col(old).alias("topic"), F.lit(1).alias("o"), F.lit(0).alias("n")), F.struct(F.col(new).alias("topic"), F.lit(0).alias("o"), F.lit(1).alias("n")))).alias("s"))
    counts = sides.groupBy("s.topic").agg(F.sum("s.o").alias("n_old"), F.sum("s.n").alias("n_new"))
    return counts.withColumn("delta", F.col("n_new") - F.col("n_old"))


# Letters of 'Surname, Given' as submitters type it.
_LETTERS = "A-Za-záàâäéèêëíìîïóòôöúùûü"
INDIVIDUAL = rf"^[{_LETTERS}ÉÈÊÀÂÄÔÛÙ-]+,[ \t-\r]+[{_LETTERS}]"


def stakeholders(docs: DataFrame, org_col: str, lookup: DataFrame, order: str | None = None) -> DataFrame:
    """docs with stakeholder_type: of the whole organisation, else of its first known part, else 'individual' by form, else null.

    Distinct organisations are resolved once and joined back, hot ones without a shuffle of their
    rows; the lookup is joined like any table, so it may grow. Null and empty organisations have none. Of several
    rows of an organisation the one with the greatest ``order`` counts, or without one the greatest type.
    """
    keys = lookup.select(F.col("org").alias("_o"), F.col("stakeholder_type").alias("_t"), *([F.col(order).alias("_p")] if order else [])).filter("_o is not null").groupBy("_o").agg((F.max_by("_t", "_p") if order else F.max("_t")).alias("_t"))
    orgs = docs.groupBy(F.col(org_col).alias("_org")).agg(F.count("*").alias("_n")).filter(F.length("_org") > 0)
    tried = orgs.select("_org", F.posexplode(F.concat(F.array("_org"), F.transform(F.split("_org", " / ", -1), strip))).alias("_k", "_o"))
    found = tried.join(keys, "_o").groupBy("_org").agg(F.min_by("_t", "_k").alias("_t"))
    resolved = orgs.join(found, "_org", "left").select(F.col("_org").alias(org_col), "_n", F.coalesce("_t", F.when(F.col("_org").rlike(INDIVIDUAL), F.lit("individual"))).alias("stakeholder_type"))
    rest = [c for c in docs.columns if c != "stakeholder_type"]
    return lookup_join(docs.select(*rest), resolved, org_col, "_n", docs.count(), F.xxhash64(*rest)).select(*rest, "stakeholder_type")
