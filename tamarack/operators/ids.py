"""Identifiers for new records: the smallest unused numbers of a prefix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tamarack.plans.lineage import cut
from tamarack.plans.ranking import hash_rank

#: Numbers of a prefix that are looked at together.
RANGE = 10_000


def next_ids(new: DataFrame, used: DataFrame, prefix: str, key: str, used_id: str, digits: int = 4) -> DataFrame:
    """(prefix, key, new_id): each new row, in hash order of its key, gets the next free number of its prefix.

    Only used ids of exactly ``digits`` digits count. Numbers are grouped in ranges: the free numbers of
    each range are counted, so a row finds its range by rank, and only ranges that are needed are
    listed. Repeated keys each get a number; null prefixes get none. Numbers beyond ``digits`` digits are written in full.
    """
    taken = used.select(F.regexp_extract(used_id, rf"^(.*)_([0-9]{{{digits}}})$", 1).alias("p"), F.regexp_extract(used_id, rf"^(.*)_([0-9]{{{digits}}})$", 2).alias("n")).filter("p <> '' and cast(n as long) > 0")
    taken = taken.select("p", F.col("n").cast("long").alias("n")).distinct()
    ranked = cut(hash_rank(cut(new.filter(F.col(prefix).isNotNull()).select(F.col(prefix).alias("p"), F.col(key).alias("key"), F.md5(F.col(key).cast("string")).alias("h"))), ["p"], "h", "k"))
    need = ranked.groupBy("p").agg(F.max("k").alias("most"))
    filled = taken.groupBy("p", F.floor((F.col("n") - 1) / RANGE).alias("r")).agg(F.count("*").alias("c"))
    span = need.join(taken.groupBy("p").agg(F.count("*").alias("all")), "p", "left").select("p", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("most") + F.coalesce("all", F.lit(0))) / RANGE).cast("long"))).alias("r"))
    free = span.join(filled, ["p", "r"], "left").withColumn("f", RANGE - F.coalesce("c", F.lit(0)))
    ends = F.sum("f").over(W.partitionBy("p").orderBy("r"))
    ranges = free.withColumn("hi", ends).withColumn("lo", F.col("hi") - F.col("f"))
    # a rank and the ranges it can lie in meet in buckets of RANGE ranks: a range of at most RANGE free numbers touches at most two of them
    bucket = lambda x: F.floor((x - 1) / RANGE).cast("long")
    spread = ranges.filter("f > 0").select("p", "r", "lo", "hi", F.explode(F.array_distinct(F.array(bucket(F.col("lo") + 1), bucket(F.col("hi"))))).alias("q"))
    near = ranked.withColumn("q", bucket(F.col("k"))).join(spread, ["p", "q"])
    placed = near.filter((F.col("k") > F.col("lo")) & (F.col("k") <= F.col("hi"))).select("p", "key", "r", (F.col("k") - F.col("lo")).alias("j"))
    wanted = placed.select("p", "r").distinct()
    numbers = wanted.select("p", "r", F.explode(F.sequence(F.col("r") * RANGE + 1, (F.col("r") + 1) * RANGE)).alias("n")).join(taken, ["p", "n"], "left_anti")
    listed = numbers.withColumn("j", F.row_number().over(W.partitionBy("p", "r").orderBy("n")))
    out = placed.join(listed, ["p", "r", "j"])
    return out.select(F.col("p").alias("prefix"), "key", F.concat("p", F.lit("_"), F.format_string(f"%0{digits}d", F.col("n"))).alias("new_id"))
