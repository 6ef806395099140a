"""Connected components by hash-to-min over a relation of (node, member) rows.

A node's cluster is kept as rows, never as one array, and a hub's rows find their minimum by a broadcast
of the few hot nodes, so that a hub with a third of all nodes is spread over many tasks. Each round sends
every cluster to its minimum and the minimum to every member; rounds needed grow with the logarithm of
the longest path. The rows of a past round are deleted from the checkpoint folder once the next is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.plans.lineage import cut, forget
from tamarack.plans.skew import lookup_join

MAX_ROUNDS = 60


def _fingerprint(df: DataFrame) -> tuple:
    return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("v", "u")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def hash_to_min(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, component) for every node of ``edges``; component is the smallest node of its component.

    Null ends are ignored, self-loops keep their node, repeated edges count once and an empty
    relation gives an empty result. Raises if MAX_ROUNDS rounds do not reach a stable state.
    """
    e = edges.select(F.col(a).alias("v"), F.col(b).alias("u")).dropna()
    state = cut(e.union(e.select("u", "v")).union(e.select("v", F.col("v").alias("u"))).union(e.select("u", "u")).toDF("v", "u").distinct())
    seen = _fingerprint(state)
    for _ in range(MAX_ROUNDS):
        least = state.groupBy("v").agg(F.min("u").alias("m"), F.count("*").alias("n"))
        sent = lookup_join(state, least, "v", "n", seen[0], F.col("u")).select(F.explode(F.array(F.struct(F.col("m").alias("v"), F.col("u").alias("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))).alias("s")).select("s.v", "s.u")
        before, state = state, cut(sent.distinct())
        forget(before)
        now = _fingerprint(state)
        if now == seen:
            return state.groupBy("v").agg(F.min("u").alias("component")).withColumnRenamed("v", "node")
        seen = now
    raise RuntimeError("components did not become stable")
