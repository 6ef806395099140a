"""Ranks within groups in hash order that never sort a whole group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Hexadecimal digits of the digest that make the bucket; the order of buckets is the order of digests.
BUCKET_DIGITS = 3


def hash_order(seed: int, *key: Column) -> Column:
    """The digest by which rows are put in a seeded random order."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *key))


def hash_rank(df: DataFrame, group: list[str], digest: str, out: str = "rank") -> DataFrame:
    """df with the 1-based rank of each row within its group by ``digest``, a hexadecimal digest.

    Rows are counted by (group, bucket), the counts are summed up bucket by bucket, and only rows of a
    bucket are sorted together; a group of any size is spread over 16**BUCKET_DIGITS buckets.
    """
    bucketed = df.withColumn("_b", F.substring(digest, 1, BUCKET_DIGITS))
    sizes = bucketed.groupBy(*group, "_b").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy(*group).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select(*group, "_b", before.alias("_before"))
    inside = bucketed.withColumn("_rn", F.row_number().over(W.partitionBy(*group, "_b").orderBy(digest)))
    match = [inside[g].eqNullSafe(offsets[g]) for g in group] + [inside["_b"] == offsets["_b"]]
    condition = match[0]
    for m in match[1:]:
        condition = condition & m
    return inside.join(offsets, condition).select(*[inside[c] for c in df.columns], (inside["_rn"] + offsets["_before"]).alias(out))
