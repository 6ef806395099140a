"""Stratified allocation and reproducible samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tamarack.plans.lineage import cut
from tamarack.plans.ranking import hash_order, hash_rank


def allocate(strata: DataFrame, stratum: str, n_col: str, order_col: str, target: int, floor: int) -> DataFrame:
    """strata with ``quota``: a floor, then the rest in proportion to what is left, by largest remainders.

    Remainder ties go by ``order_col``. Quotas are capped by what a stratum has; what a cap leaves
    over is not given to others.
    """
    everything = W.partitionBy()
    base = strata.withColumn("_a", F.least(F.lit(floor), F.col(n_col)))
    base = base.withColumn("_room", F.col(n_col) - F.col("_a")).withColumn("_rest", F.lit(target) - F.sum("_a").over(everything)).withColumn("_rooms", F.sum("_room").over(everything))
    real = F.when((F.col("_rest") > 0) & (F.col("_rooms") > 0), F.col("_rest") * F.col("_room") / F.col("_rooms")).otherwise(F.lit(0.0))
    base = base.withColumn("_real", real).withColumn("_int", F.floor("_real"))
    base = base.withColumn("_extra", F.greatest(F.col("_rest") - F.sum("_int").over(everything), F.lit(0)))
    rank = F.row_number().over(W.partitionBy().orderBy(F.desc(F.round(F.col("_real") - F.col("_int"), 12)), order_col))
    more = F.when((F.col("_rest") > 0) & (F.col("_rooms") > 0) & (rank <= F.col("_extra")), 1).otherwise(0)
    return base.withColumn("_more", more).withColumn("quota", F.col("_a") + F.least(F.col("_int") + F.col("_more"), F.col("_room"))).select(*strata.columns, F.col("quota").cast("long"))


def sample_strata(rows: DataFrame, stratum: str, id_col: str, quotas: DataFrame, seed: int = 42) -> DataFrame:
    """The first ``quota`` rows of each stratum in hash order."""
    ranked = hash_rank(cut(rows.withColumn("_h", hash_order(seed, F.col(id_col)))), [stratum], "_h", "_rank")
    return ranked.join(quotas.select(stratum, "quota"), stratum).filter(F.col("_rank") <= F.col("quota")).select(*rows.columns)


def sample_rows(rows: DataFrame, id_col: str, k: int, seed: int = 42) -> DataFrame:
    """k rows in hash order: a top-k, of which every task sends at most k rows."""
    return rows.withColumn("_h", hash_order(seed, F.col(id_col))).orderBy("_h").limit(k).select(*rows.columns)


def gold_sample(corpus: DataFrame, seed: int = 42, labelled: int = 180, unlabelled: int = 20, floor: int = 10, fallback: str = "unlabeled") -> DataFrame:
    """Records outside clusters to label by hand: by topic as allocated, and some without a label."""
    pool = corpus.dropDuplicates(["doc_id"]).filter((F.length(F.coalesce("near_dup_cluster", F.lit(""))) == 0) & F.col("topic_seed").isNotNull())
    sizes = pool.groupBy("topic_seed").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))
    quotas = allocate(sizes.filter(F.col("topic_seed") != fallback), "topic_seed", "n", "first", labelled, floor).select("topic_seed", "quota")
    rest = sizes.filter(F.col("topic_seed") == fallback).select("topic_seed", F.least(F.col("n"), F.lit(unlabelled)).alias("quota"))
    return sample_strata(pool, "topic_seed", "doc_id", quotas.union(rest), seed)
