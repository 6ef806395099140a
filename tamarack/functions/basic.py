"""Small column helpers used by many operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def nonblank(c: Column) -> Column:
    """The value, or null where it is null, empty or only white space."""
    return F.when(F.length(F.trim(F.regexp_replace(c, r"(?U)\s+", " "))) > 0, c)


def hash_unit(*cols: Column) -> Column:
    """A double in (0, 1) that depends only on the values."""
    bits = F.shiftrightunsigned(F.xxhash64(*cols), 11)
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
