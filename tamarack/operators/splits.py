"""Splits in which no cluster straddles a border or touches the gold set, and their checks."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tamarack.plans.lineage import cut
from tamarack.plans.ranking import hash_order, hash_rank

DEV_SHARE = 0.1


def contaminated_clusters(corpus: DataFrame, gold: DataFrame, duplicates: DataFrame) -> DataFrame:
    """Distinct non-empty clusters that a gold record of the corpus without duplicates belongs to."""
    kept = corpus.join(duplicates.select("doc_id"), "doc_id", "left_anti")
    return kept.join(gold.select("doc_id"), "doc_id", "left_semi").filter(F.length("near_dup_cluster") > 0).select("near_dup_cluster").distinct()


def eligible(corpus: DataFrame, gold: DataFrame, duplicates: DataFrame) -> DataFrame:
    """The records left after duplicates, gold records and members of contaminated clusters, each id once; a null cluster counts as none."""
    kept = corpus.withColumn("near_dup_cluster", F.coalesce("near_dup_cluster", F.lit(""))).dropDuplicates(["doc_id"]).join(duplicates.select("doc_id"), "doc_id", "left_anti").join(gold.select("doc_id"), "doc_id", "left_anti")
    return kept.join(contaminated_clusters(corpus, gold, duplicates), "near_dup_cluster", "left_anti").select(*corpus.columns)


def split_units(records: DataFrame) -> DataFrame:
    """(unit, topic, n_docs, first_id): clusters with their most frequent topic, ties to the first by name, and single records."""
    single = F.length(F.coalesce("near_dup_cluster", F.lit(""))) == 0
    counts = records.withColumn("unit", F.when(single, F.concat(F.lit("d:"), "doc_id")).otherwise(F.concat(F.lit("c:"), "near_dup_cluster"))).groupBy("unit", F.coalesce("topic_seed", F.lit("")).alias("topic")).agg(F.count("*").alias("n"), F.min("doc_id").alias("least"))
    return counts.groupBy("unit").agg(F.min(F.struct(-F.col("n"), "topic")).alias("best"), F.sum("n").alias("n_docs"), F.min("least").alias("first_id")).select("unit", F.col("best.topic").alias("topic"), "n_docs", "first_id")


def _with_unit(records: DataFrame) -> DataFrame:
    single = F.length(F.coalesce("near_dup_cluster", F.lit(""))) == 0
    return records.withColumn("unit", F.when(single, F.concat(F.lit("d:"), "doc_id")).otherwise(F.concat(F.lit("c:"), "near_dup_cluster")))


def train_dev(records: DataFrame, seed: int = 42) -> DataFrame:
    """(doc_id, unit, topic, split): by topic a tenth of the units, half-even and at least one, goes to dev.

    Units are taken in hash order, so a topic's split does not depend on other topics; large topics
    are ranked without sorting them in one task.
    """
    units = split_units(records).withColumn("h", hash_order(seed, F.col("unit")))
    ranked = hash_rank(cut(units), ["topic"], "h")
    sizes = units.groupBy("topic").agg(F.greatest(F.lit(1), F.bround(F.count("*") * F.lit(DEV_SHARE))).alias("n_dev"))
    chosen = ranked.join(sizes, "topic").select("unit", "topic", F.when(F.col("rank") <= F.col("n_dev"), "dev").otherwise("train").alias("split"))
    return _with_unit(records).select("doc_id", "unit").join(chosen, "unit").select("doc_id", "unit", "topic", "split")


def train_dev_seeded(records: DataFrame, seed: int = 42) -> DataFrame:
    """Like ``train_dev`` in the order of one seeded Mersenne Twister that runs through the topics.

    For small corpora that must repeat an earlier split exactly: (topic, unit) pairs go through the
    driver. Larger ones take ``train_dev``.
    """
    pairs = sorted((r["topic"], r["unit"][2:], r["unit"]) for r in split_units(records).select("topic", "unit").collect())
    rng, rows = random.Random(seed), []
    for topic in sorted({p[0] for p in pairs}):
        own = [p[2] for p in pairs if p[0] == topic]
        rng.shuffle(own)
        n_dev = max(1, round(len(own) * DEV_SHARE))
        rows += [(u, topic, "dev" if k < n_dev else "train") for k, u in enumerate(own)]
    chosen = records.sparkSession.createDataFrame(rows, "unit string, topic string, split string")
    return _with_unit(records).select("doc_id", "unit").join(chosen, "unit").select("doc_id", "unit", "topic", "split")


def topic_counts(split: DataFrame) -> DataFrame:
    """Units and records of train and dev by topic."""
    units = split.groupBy("topic", "unit").agg(F.sum((F.col("split") == "train").cast("long")).alias("tr"), F.sum((F.col("split") == "dev").cast("long")).alias("dv"))
    return units.groupBy("topic").agg(F.count("*").alias("n_units"), F.sum("tr").alias("train"), F.sum("dv").alias("dev"))


def checks(split: DataFrame, corpus: DataFrame, gold: DataFrame, duplicates: DataFrame) -> DataFrame:
    """One row per rule with the number of records or clusters that break it; all are 0 for a sound split."""
    placed = split.join(corpus.select("doc_id", "near_dup_cluster").dropDuplicates(["doc_id"]), "doc_id")
    rules = {
        "gold_in_split": split.join(gold.select("doc_id"), "doc_id", "left_semi"),
        "duplicate_in_split": split.join(duplicates.select("doc_id"), "doc_id", "left_semi"),
        "cluster_in_both": placed.filter(F.length("near_dup_cluster") > 0).groupBy("near_dup_cluster").agg(F.count_distinct("split").alias("n")).filter("n > 1"),
    }
    parts = [df.agg(F.count("*").alias("n_broken")).select(F.lit(name).alias("rule"), "n_broken") for name, df in rules.items()]
    return parts[0].union(parts[1]).union(parts[2])


def dominant(df: DataFrame, group: str, value: str) -> DataFrame:
    """The most frequent value of each group, ties to the first by name."""
    counts = df.groupBy(group, value).agg(F.count("*").alias("n"))
    return counts.withColumn("rn", F.row_number().over(W.partitionBy(group).orderBy(F.desc("n"), value))).filter("rn = 1").select(group, F.col(value).alias("dominant"), F.col("n").alias("n_rows"))
