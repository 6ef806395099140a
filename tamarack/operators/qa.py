"""Quality aggregates: counts, shares, distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tamarack.functions.scalars import bar
from tamarack.operators.splits import dominant  # noqa: F401  (part of this module's interface)
from tamarack.plans.lineage import cut


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    """(field, value, n_rows) of several columns in one pass over the table; nulls count as 'unknown'."""
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit("unknown")).alias("value")) for c in columns])
    return df.select(F.explode(pairs).alias("p")).groupBy("p.field", "p.value").agg(F.count("*").alias("n_rows"))


def order_statistics(df: DataFrame, value: Column, wanted: dict[str, Column]) -> DataFrame:
    """One row with the values at the wanted 0-based ranks, which are expressions of ``n_values``.

    Values are counted first, so what is ranked is the distinct values, range by range.
    """
    counts = cut(df.select(value.alias("v")).filter("v is not null").groupBy("v").agg(F.count("*").alias("c")))
    parts = counts.repartitionByRange("v").withColumn("part", F.spark_partition_id())
    sizes = parts.groupBy("part").agg(F.sum("c").alias("s"))
    before = sizes.select("part", F.coalesce(F.sum("s").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    upto = parts.join(F.broadcast(before), "part").withColumn("hi", F.col("before") + F.sum("c").over(W.partitionBy("part").orderBy("v")))
    total = counts.agg(F.sum("c").alias("n_values"))
    joined = upto.crossJoin(F.broadcast(total)).withColumn("lo", F.col("hi") - F.col("c"))
    picks = [F.max(F.when((F.col("lo") <= k) & (k < F.col("hi")), F.col("v"))).alias(name) for name, k in wanted.items()]
    return joined.agg(F.max("n_values").alias("n_values"), *picks)


def distribution(df: DataFrame, value: Column) -> DataFrame:
    """min, p25, median, p75, p95, max by the exclusive method, cut to integers; exact for any size."""
    cuts = {"p25": (1, 4), "p75": (3, 4), "p95": (95, 100)}
    m = F.col("n_values")
    wanted, deltas = {"lowest": F.lit(0), "highest": m - 1, "mid_lo": F.floor((m - 1) / 2), "mid_hi": F.floor(m / 2)}, {}
    for name, (i, n) in cuts.items():
        j = F.least(F.greatest(F.floor(F.lit(i) * (m + 1) / n), F.lit(1)), m - 1)
        wanted[f"{name}_lo"], wanted[f"{name}_hi"] = F.greatest(j - 1, F.lit(0)), F.least(j, m - 1)
        deltas[name] = (F.lit(i) * (m + 1) - j * n) / n
    row = order_statistics(df, value, wanted)
    at = {name: F.when(m >= 2, (F.col(f"{name}_lo") * (1 - d) + F.col(f"{name}_hi") * d).cast("long")) for name, d in deltas.items()}
    median = ((F.col("mid_lo") + F.col("mid_hi")) / 2).cast("long")
    return row.select("n_values", F.col("lowest").cast("long").alias("min"), at["p25"].alias("p25"), median.alias("median"), at["p75"].alias("p75"), at["p95"].alias("p95"), F.col("highest").cast("long").alias("max"))


def index_percentiles(df: DataFrame, value: Column, **shares: float) -> DataFrame:
    """Values at floor(n * share) of the sorted values, counted from 0, and the mean."""
    row = order_statistics(df, value, {name: F.floor(F.col("n_values") * F.lit(p)) for name, p in shares.items()})
    mean = df.select(F.avg(value).alias("mean"))
    return row.crossJoin(F.broadcast(mean))


def pivot_counts(df: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    """Rows by ``row`` and listed ``column`` values, with totals; the total over all rows has a null ``row``."""
    counts = [F.count_if(F.col(column) == v).alias(v) for v in values]
    return df.filter(F.col(row).isNotNull()).rollup(row).agg(*counts, F.count("*").alias("total"))


def flag_counts(manifest: DataFrame) -> DataFrame:
    return manifest.agg(
        F.count_if(F.length("duplicate_of") > 0).alias("n_duplicates"),
        F.count_if(F.coalesce("needs_ocr", F.lit(False))).alias("n_needs_ocr"),
        F.count_if(F.coalesce("layout_mangled", F.lit(False))).alias("n_mangled"),
        F.count_if(F.coalesce("dropped_short", F.lit(False))).alias("n_short"),
    )


def cleaning_summary(cleaned: DataFrame) -> DataFrame:
    hf = F.col("hf_removed")
    return cleaned.agg(
        F.count("*").alias("n_docs"),
        F.count_if("dropped_short").alias("n_short"),
        F.count_if("layout_mangled").alias("n_mangled"),
        F.sum("contact_count").alias("n_contacts"),
        F.sum("title_echoes").alias("n_echoes"),
        F.count_if(F.col("title_echoes") > 0).alias("docs_with_echoes"),
        F.count_if(hf > 0).alias("docs_with_hf"),
        F.sum("hf_removed").alias("n_hf"),
        F.coalesce(F.avg(F.when(hf > 0, hf)), F.lit(0.0)).alias("avg_hf"),
    )


def corpus_report(corpus: DataFrame, topic: str = "topic_seed", fallback: str = "unlabeled") -> DataFrame:
    """Records, share and bar of each topic."""
    counts = corpus.groupBy(F.coalesce(topic, F.lit("unknown")).alias("topic")).agg(F.count("*").alias("n_docs"))
    total = corpus.agg(F.count("*").alias("n_all"))
    joined = counts.crossJoin(F.broadcast(total))
    return joined.select("topic", "n_docs", (F.col("n_docs") / F.col("n_all")).alias("share"), bar(F.col("n_docs"), F.col("n_all"), 40).alias("bar"), (F.col("topic") == fallback).alias("is_fallback"))


def cluster_stats(corpus: DataFrame, cluster: str = "near_dup_cluster") -> DataFrame:
    sizes = corpus.filter(F.length(cluster) > 0).groupBy(cluster).agg(F.count("*").alias("n"))
    return sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("clustered_docs"), F.count("*").alias("n_clusters"), F.max("n").alias("largest"), F.count_if(F.col("n") == 1).alias("n_single"))


def chunk_stats(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("source_type").agg(F.count("*").alias("n_chunks"), F.count_if("is_recommendation").alias("n_recommendations"), F.sum("token_approx").alias("n_tokens"), F.max("token_approx").alias("longest"))


def running_line_frequency(pages: DataFrame, doc: str, page: str, fingerprints: Column) -> DataFrame:
    """(doc, print, n_pages, of_pages) of the line fingerprints on more than half of the pages of a document of two or more.

    The relational form of header and footer detection; ``fingerprints`` is a page's array of them.
    """
    prints = pages.select(doc, page, F.explode(F.array_distinct(fingerprints)).alias("print")).filter(F.length("print") > 0)
    on = prints.groupBy(doc, "print").agg(F.count("*").alias("n_pages"))
    of = pages.groupBy(doc).agg(F.count("*").alias("of_pages")).filter("of_pages >= 2")
    return on.join(of, doc).filter(F.col("n_pages") > F.col("of_pages") * 0.5).select(doc, "print", "n_pages", "of_pages")
