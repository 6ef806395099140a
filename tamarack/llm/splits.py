"""Splits that keep related records together (problem 1).

Records tied by a shared cluster or organisation form components. The graph is contracted to the
tie keys first: a record with one key needs no edge, so a hub key costs one row per record only in
a pre-aggregated count. Components are found by hash-to-min, then assigned to splits by weighted
rendezvous hashing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.functions.basic import hash_unit, nonblank
from tamarack.operators.components import hash_to_min
from tamarack.plans.lineage import cut
from tamarack.plans.skew import lookup_join
from tamarack.sources.tables import table

#: Components above this share of all records are hashed one after another, each with the room the larger ones left; there are at most 1 / GIANT_SHARE of them.
GIANT_SHARE = 0.002


def tie_keys(cluster: Column, org: Column) -> Column:
    """The distinct tie keys of a record: its cluster and each part of its organisation, empty ones left out."""
    parts = F.transform(F.split(org, " / ", -1), lambda x: F.when(nonblank(x).isNotNull(), F.concat(F.lit("o:"), x)))
    keys = F.concat(F.array(F.when(nonblank(cluster).isNotNull(), F.concat(F.lit("c:"), cluster))), F.coalesce(parts, F.array().cast("array<string>")))
    return F.array_sort(F.array_distinct(F.filter(keys, lambda x: x.isNotNull())))


def tied_groups(records: DataFrame, id_col: str = "doc_id", cluster_col: str = "near_dup_cluster", org_col: str = "org", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per record id: its id, ``keep`` columns, group_id and group_rows.

    Repeated rows of an id are merged and all their keys tie, however many. Records without keys are their own
    group. Null ids are left out. group_id is the smallest id of the group. Input columns other
    than those named are ignored. An empty table gives an empty result.
    """
    rows = records.select(F.col(id_col).cast("string").alias("id"), tie_keys(F.col(cluster_col), F.col(org_col)).alias("ks"), *[F.col(c).alias(f"keep_{c}") for c in keep]).filter("id is not null")
    rows = rows.withColumn("first", F.try_element_at("ks", F.lit(1)))
    docs = cut(rows.groupBy("id").agg(F.min("first").alias("k"), F.max("first").alias("last"), *[F.min(f"keep_{c}").alias(f"keep_{c}") for c in keep]))
    # a row ties its keys to its first one; rows of one id with other first keys tie those to the id's
    inside = rows.filter(F.size("ks") > 1).select(F.col("first").alias("k"), F.explode("ks").alias("b"))
    repeated = docs.filter(F.col("k") != F.col("last")).select("id", "k").join(rows.select("id", F.col("first").alias("b")), "id").select("k", "b")
    edges = inside.unionByName(repeated).filter("k <> b").distinct()
    comps = hash_to_min(edges, "k", "b")
    per_key = docs.filter("k is not null").groupBy("k").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    named = per_key.join(comps, F.col("k") == F.col("node"), "left").select("k", "least", "n", F.coalesce("component", "k").alias("component"))
    per_comp = named.groupBy("component").agg(F.min("least").alias("group_id"), F.sum("n").alias("group_rows"))
    keys = named.join(per_comp, "component").select("k", "n", "group_id", "group_rows")
    total = docs.count()
    joined = lookup_join(docs.drop("last"), keys, "k", "n", total, F.col("id"))
    return joined.select(F.col("id").alias(id_col), *[F.col(f"keep_{c}").alias(c) for c in keep], F.coalesce("group_id", "id").alias("group_id"), F.coalesce("group_rows", F.lit(1)).alias("group_rows"))


def _luck(key: Column, name: str, seed: int) -> Column:
    """-ln of a uniform number that depends on key and split: the exponential draw behind rendezvous hashing."""
    return -F.log(hash_unit(key, F.lit(name), F.lit(seed)))


def _rendezvous(key: Column, weights: list[tuple[str, Column]], seed: int) -> Column:
    """The split with the greatest weight / -ln(u), u depending on key and split; splits of weight 0 are never chosen."""
    scores = [F.when(w > 0, F.struct((w / _luck(key, name, seed)).alias("score"), F.lit(name).alias("name"))) for name, w in weights]
    return F.greatest(*scores, F.lit(None).cast("struct<score:double,name:string>"))["name"]


def _fitting(room: dict[str, float], size: float) -> dict[str, float]:
    """Weights for a component: the room of the splits it fits into, or of all that have any where it fits nowhere, or else 1 for all."""
    for least in (size, 1e-9):
        fits = {n: r for n, r in room.items() if r >= least}
        if fits:
            return fits
    return dict.fromkeys(room, 1.0)


def assign_splits(grouped: DataFrame, targets: list[tuple[str, float]], stratum: str, id_col: str = "doc_id", seed: int = 42) -> DataFrame:
    """Give every group one split by weighted rendezvous hashing, with shares near ``targets`` overall and within ``stratum``.

    The weights are the room that larger groups have left in the splits. Groups above GIANT_SHARE of all
    records move the room by themselves, so they are hashed one after another, the largest first (there are at
    most 1 / GIANT_SHARE of them, which bounds what reaches the driver); a split that a group doesn't fit into has
    weight 0 where it fits into another. All other groups of several records are hashed with the room then left,
    single records last with the room left in their stratum. Rows: id, stratum, group_id, split_name.
    """
    names = [n for n, _ in targets]
    whole = sum(w for _, w in targets) or 1.0
    share = {n: w / whole for n, w in targets}
    total = grouped.count()
    limit = max(1, int(GIANT_SHARE * total))
    draws = [_luck(F.col("group_id"), n, seed).alias(f"luck_{i}") for i, n in enumerate(names)]
    giants = grouped.filter(F.col("group_rows") > limit).groupBy("group_id").agg(F.max("group_rows").alias("n")).select("group_id", "n", *draws).orderBy(F.desc("n"), "group_id").collect()
    left = {n: share[n] * total for n in names}
    placed: dict[str, str] = {}
    for g in giants:
        luck = {n: g[f"luck_{i}"] for i, n in enumerate(names)}
        weights = _fitting(left, g["n"])
        best = max(weights, key=lambda n: (weights[n] / luck[n], n))
        placed[g["group_id"]] = best
        left[best] -= g["n"]
    spark = grouped.sparkSession
    giant_df = spark.createDataFrame(list(placed.items()) or [], "group_id string, giant string")
    tagged = grouped.join(F.broadcast(giant_df), "group_id", "left")
    overall = [(n, F.lit(float(w))) for n, w in _fitting({n: left[n] for n in names}, 1e-9).items()]
    middle = tagged.withColumn("early", F.coalesce("giant", F.when(F.col("group_rows") > 1, _rendezvous(F.col("group_id"), overall, seed))))
    counts = middle.groupBy(stratum).agg(F.count("*").alias("n"), *[F.sum((F.col("early") == n).cast("long")).alias(f"has_{i}") for i, n in enumerate(names)])
    room = counts.select(F.col(stratum).alias("_s"), *[F.greatest(F.lit(share[n]) * F.col("n") - F.coalesce(f"has_{i}", F.lit(0)), F.lit(0.0)).alias(f"room_{i}") for i, n in enumerate(names)])
    late = middle.join(room, F.col(stratum).eqNullSafe(F.col("_s")), "left")
    by_room = [(n, F.col(f"room_{i}")) for i, n in enumerate(names)]
    fallback = F.lit(max(names, key=lambda n: share[n]))
    return late.select(id_col, stratum, "group_id", F.coalesce("early", _rendezvous(F.col("group_id"), by_room, seed + 1), fallback).alias("split_name"))


def canonical_topic(c: Column) -> Column:
    """Lower case, trimmed, blanks and hyphens as underscores; blank is null."""
    return nonblank(F.regexp_replace(F.lower(F.trim(c)), r"[\s-]", "_"))


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    groups = tied_groups(table(spark, sf, "corpus_fixture", "doc_id", "near_dup_cluster", "org"))
    return groups.filter("group_rows > 1").select("doc_id", "group_id")


def _targets(spark: SparkSession, sf: str) -> list[tuple[str, float]]:
    """The split targets, a table of fixed size."""
    rows = table(spark, sf, "split_targets").groupBy("split_name").agg(F.max("target_share").alias("w")).filter("split_name is not null and w > 0").orderBy("split_name").collect()
    return [(r["split_name"], r["w"]) for r in rows]


def _assigned(spark: SparkSession, sf: str) -> DataFrame:
    records = table(spark, sf, "corpus_fixture", "doc_id", "near_dup_cluster", "org", "topic_seed").withColumn("topic_seed", canonical_topic(F.col("topic_seed")))
    return assign_splits(cut(tied_groups(records, keep=("topic_seed",))), _targets(spark, sf), "topic_seed")


def p1_splits(spark: SparkSession, sf: str) -> DataFrame:
    """One row per record: its group and its split."""
    return _assigned(spark, sf).select("doc_id", "group_id", "split_name")


def p1_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Records and shares of each split by topic; topic null holds the records without one, level 'all' the whole."""
    out = _assigned(spark, sf)
    counted = out.rollup("topic_seed", "split_name").agg(F.count("*").alias("n_rows"), F.grouping_id().alias("gid"))
    counted = counted.unionByName(out.groupBy("split_name").agg(F.count("*").alias("n_rows")).select(F.lit(None).cast("string").alias("topic_seed"), "split_name", "n_rows", F.lit(9).cast("long").alias("gid")))
    leaf = counted.filter("gid in (0, 9)").withColumn("level", F.when(F.col("gid") == 9, "all").otherwise("topic"))
    top = counted.filter("gid in (1, 3)").select(F.when(F.col("gid") == 3, "all").otherwise("topic").alias("level"), F.col("topic_seed").alias("t"), F.col("n_rows").alias("of_rows"))
    joined = leaf.alias("l").join(top.alias("t"), (F.col("l.level") == F.col("t.level")) & F.col("l.topic_seed").eqNullSafe(F.col("t.t")))
    return joined.select("l.level", "l.topic_seed", "l.split_name", "l.n_rows", (F.col("l.n_rows") / F.col("t.of_rows")).alias("share"))
