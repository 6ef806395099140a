"""The last version of every record of an append-only log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest(log: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, the one with the greatest ``order``.

    An aggregation with partial maxima, so a key that was written very often is combined before the
    shuffle. Rows with a null key are left out; ties are broken by the other values.
    """
    rest = [c for c in log.columns if c not in (key, order)]
    best = log.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(order, *rest)).alias("_last"))
    return best.select(*[F.col(key) if c == key else F.col("_last")[c].alias(c) for c in log.columns])
