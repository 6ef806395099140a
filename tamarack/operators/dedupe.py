"""Exact and semantic duplicates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tamarack.functions.text import text_hash
from tamarack.operators.components import hash_to_min
from tamarack.plans.lineage import cut
from tamarack.plans.skew import lookup_join

EXACT, NEAR = 0.98, 0.90
#: Vectors of a block; two blocks and their products take about 4 * BLOCK**2 bytes.
BLOCK = 2048


def mark_exact(docs: DataFrame, id_col: str, text: Column, marked: str | None = None) -> DataFrame:
    """(id, h, group_size, duplicate_of): the smallest id of equal texts is kept, the others point to it.

    An earlier mark in column ``marked`` is never overwritten. Null texts are left out; repeated rows
    each give one row. Groups are counted by a partial aggregation and looked up by a join that
    spreads hot groups, so a text that a third of all rows share is no bottleneck.
    """
    rows = docs.select(F.col(id_col), text_hash(text).alias("h"), *([F.col(marked).alias("_m")] if marked else [])).filter("h is not null")
    rows = cut(rows)
    groups = rows.groupBy("h").agg(F.min(id_col).alias("_keep"), F.count("*").alias("group_size"))
    joined = lookup_join(rows, groups, "h", "group_size", rows.count(), F.col(id_col))
    own = F.when(F.col(id_col) != F.col("_keep"), F.col("_keep"))
    return joined.select(id_col, "h", "group_size", (F.coalesce(F.nullif(F.col("_m"), F.lit("")), own) if marked else own).alias("duplicate_of"))


def _block_products(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for left, right, ids_a, ids_b in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                a, b = (np.asarray(x, dtype=np.float64) for x in (left, right))
                sims = a @ b.T
                i, j = np.nonzero(sims >= threshold)
                x, y = np.asarray(ids_a)[i], np.asarray(ids_b)[j]
                # within one block both orders of a pair come up, between two blocks only one
                keep = (x < y) if ids_a == ids_b else (x != y)
                x, y = np.minimum(x, y), np.maximum(x, y)
                yield pa.RecordBatch.from_arrays([pa.array(x[keep]), pa.array(y[keep]), pa.array(sims[i, j][keep])], ["a", "b", "similarity"])

    return run


def cosine_pairs(vectors: DataFrame, id_col: str, vector_col: str, threshold: float) -> DataFrame:
    """(a, b, similarity) of the pairs a < b with a cosine of at least ``threshold``, exactly.

    Vectors are packed into blocks; each unordered pair of blocks is one matrix product, and only
    pairs above the threshold leave it. That is quadratic work by nature, spread evenly whatever the
    data: for large collections use ``cosine_pairs_lsh``. Null vectors are left out; zero vectors
    have a cosine of 0 to all.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).dropna().dropDuplicates(["id"])
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    unit = rows.withColumn("v", F.transform("v", lambda x: x / F.greatest(norm, F.lit(1e-9))))
    n_blocks = max(1, -(-rows.count() // BLOCK))
    blocks = cut(unit.withColumn("k", F.pmod(F.xxhash64("id"), F.lit(n_blocks))).groupBy("k").agg(F.collect_list("v").alias("vs"), F.collect_list("id").alias("ids")))
    left = blocks.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))).alias("other"), "k", "vs", "ids")
    right = blocks.select(F.col("k").alias("other"), F.col("vs").alias("vs2"), F.col("ids").alias("ids2"))
    # each unordered pair of blocks once
    both = left.filter("k <= other").join(right, "other").select("vs", "vs2", "ids", "ids2")
    return both.repartition(max(1, min(n_blocks * (n_blocks + 1) // 2, 4096))).mapInArrow(_block_products(threshold), "a long, b long, similarity double")


def cosine_pairs_lsh(vectors: DataFrame, id_col: str, vector_col: str, threshold: float, tables: int = 24, bits: int = 14, seed: int = 11) -> DataFrame:
    """Like ``cosine_pairs`` for large collections: vectors that share all signs of some table of random planes are compared.

    A pair at cosine c meets in a table with probability (1 - acos(c) / pi) ** bits.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).dropna().dropDuplicates(["id"])

    def signs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = None
        for batch in batches:
            ids, vs = batch.column(0).to_pylist(), np.asarray(batch.column(1).to_pylist(), dtype=np.float64)
            if not len(ids):
                continue
            if planes is None:
                planes = np.random.default_rng(seed).standard_normal((vs.shape[1], tables * bits))
            codes = ((vs @ planes) > 0).reshape(len(ids), tables, bits) @ (1 << np.arange(bits, dtype=np.int64)) + (np.arange(tables, dtype=np.int64) << bits)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, tables)), pa.array(codes.ravel())], ["id", "code"])

    codes = cut(rows.mapInArrow(signs, "id long, code long"))
    salts = 16
    left = codes.select("code", F.col("id").alias("a"), F.pmod(F.xxhash64("id"), F.lit(salts)).alias("salt"))
    right = codes.select("code", F.col("id").alias("b"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"))
    pairs = left.join(right, ["code", "salt"]).filter("a < b").select("a", "b").distinct()
    va, vb = (rows.select(F.col("id").alias(x), F.col("v").alias(f"v{x}")) for x in ("a", "b"))
    dot = F.aggregate(F.zip_with("va", "vb", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    length = lambda c: F.greatest(F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, x: s + x * x)), F.lit(1e-9))
    return pairs.join(va, "a").join(vb, "b").select("a", "b", (dot / length("va") / length("vb")).alias("similarity")).filter(F.col("similarity") >= threshold)


def semantic_duplicates(pairs: DataFrame, marks: DataFrame | None = None, threshold: float = EXACT) -> DataFrame:
    """(id, duplicate_of) of all but one member of each component of pairs at ``threshold``.

    The smallest id that is not yet a duplicate is kept. ``marks`` holds earlier (id, duplicate_of);
    members marked there keep their mark and do not appear.
    """
    comps = hash_to_min(pairs.filter(F.col("similarity") >= threshold), "a", "b").withColumnRenamed("node", "id")
    if marks is not None:
        comps = comps.join(marks.filter("duplicate_of is not null").select("id"), "id", "left_anti")
    kept = comps.groupBy("component").agg(F.min("id").alias("duplicate_of"))
    return comps.join(kept, "component").filter(F.col("id") != F.col("duplicate_of")).select("id", "duplicate_of")


def near_clusters(pairs: DataFrame, threshold: float = NEAR) -> DataFrame:
    """(id, cluster): components of pairs above ``threshold``, numbered ndc_001 on by their first member.

    Numbers come from a running count over ranges of first members, so no task sorts all clusters.
    """
    comps = hash_to_min(pairs.filter(F.col("similarity") > threshold), "a", "b").withColumnRenamed("node", "id")
    firsts = cut(comps.groupBy("component").agg(F.min("id").alias("first")).repartitionByRange("first").withColumn("part", F.spark_partition_id()))
    sizes = firsts.groupBy("part").count()
    before = F.coalesce(F.sum("count").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("part", before.alias("before"))
    numbered = firsts.withColumn("rn", F.row_number().over(W.partitionBy("part").orderBy("first"))).join(F.broadcast(offsets), "part")
    name = F.format_string("ndc_%03d", F.col("rn") + F.col("before"))
    return comps.join(numbered.select("component", name.alias("cluster")), "component").select("id", "cluster")


def near_pair_report(pairs: DataFrame, docs: DataFrame, id_col: str, *columns: str) -> DataFrame:
    """Pairs between the two thresholds, the most similar first, with columns of both documents."""
    near = pairs.filter((F.col("similarity") > NEAR) & (F.col("similarity") < EXACT))
    for side in ("a", "b"):
        near = near.join(docs.select(F.col(id_col).alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns]), side, "left")
    return near.orderBy(F.desc("similarity"), "a", "b")
