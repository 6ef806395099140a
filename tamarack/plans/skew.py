"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: At most this many keys can each hold more than 1/HOT_KEYS of the rows, so the hot side is always broadcastable.
HOT_KEYS = 1000
#: Keys with fewer rows than this are never worth the special path.
HOT_ROWS = 50_000


def hot_threshold(total_rows: int) -> int:
    return max(HOT_ROWS, total_rows // HOT_KEYS)


def lookup_join(left: DataFrame, right: DataFrame, key: str, count_col: str, total_rows: int, spread: Column) -> DataFrame:
    """Left-join each row of ``left`` to the one row of ``right`` with its key.

    ``right`` has unique keys and ``count_col``, the number of left rows of the key. Keys above
    ``hot_threshold`` (at most HOT_KEYS of them) are matched by a broadcast whose size that bound
    proves; their left rows then go through the shuffle join under a salted key that matches
    nothing, so they spread evenly. ``spread`` is a value that differs between left rows. Null keys
    match nothing and are spread in the same way.
    """
    columns = [c for c in right.columns if c != key]
    hot = right.filter(F.col(count_col) > hot_threshold(total_rows)).select(F.col(key).alias("_hk"), F.struct(*columns).alias("_hot"))
    cold = right.filter(F.col(count_col) <= hot_threshold(total_rows)).select(F.col(key).alias("_ck"), F.struct(*columns).alias("_cold"))
    salted = F.concat(F.lit("\u0000"), F.xxhash64(spread).cast("string"))
    tagged = left.join(F.broadcast(hot), F.col(key) == F.col("_hk"), "left").drop("_hk")
    tagged = tagged.withColumn("_jk", F.when(F.col("_hot").isNull() & F.col(key).isNotNull(), F.col(key)).otherwise(salted))
    joined = tagged.join(cold, F.col("_jk") == F.col("_ck"), "left")
    picked = F.coalesce(F.col("_hot"), F.col("_cold"))
    return joined.select(*left.columns, *[picked[c].alias(c) for c in columns])


#: Rows of one key that one task of a split join takes from the left side.
SPLIT_ROWS = 4096
#: At most this many keys are split; their sizes are broadcast.
SPLIT_KEYS = 10_000


def split_join(left: DataFrame, right: DataFrame, key: str, total_rows: int, spread: Column) -> DataFrame:
    """Inner join on ``key`` for keys that may hold many rows on both sides; other columns must have different names.

    A key with more than SPLIT_ROWS rows on the left, and more than 1/SPLIT_KEYS of ``total_rows``, is dealt out by
    ``spread`` to as many salts as it has SPLIT_ROWS, and its right rows go to each of them. There are at most
    SPLIT_KEYS such keys, which bounds what is broadcast. Null keys match nothing.
    """
    least = max(SPLIT_ROWS, total_rows // SPLIT_KEYS)
    sizes = left.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.count("*").alias("_n")).filter(F.col("_n") > least)
    salts = sizes.select("_k", F.ceil(F.col("_n") / SPLIT_ROWS).cast("int").alias("_salts"))
    dealt = left.join(F.broadcast(salts), F.col(key) == F.col("_k"), "left").withColumn("_salt", F.pmod(F.xxhash64(spread), F.coalesce("_salts", F.lit(1))).cast("int")).drop("_k", "_salts")
    copies = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    copied = right.join(F.broadcast(salts), F.col(key) == F.col("_k"), "left").withColumn("_salt", F.explode(copies)).drop("_k", "_salts")
    return dealt.join(copied, [key, "_salt"]).drop("_salt")
