"""Column expressions used by quality checks and the star schema."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorlake.functions.text import col_

__all__ = ["null_pct", "flags", "surrogate", "in_range", "count_if"]


def count_if(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def null_pct(c, digits: int = 2) -> Column:
    """Aggregate: percent of NULLs in a column, rounded."""
    return F.round(F.lit(100.0) * count_if(col_(c).isNull()) / F.count(F.lit(1)), digits)


def flags(*conds: Column) -> Column:
    """Bitmask: bit k set when conds[k] is true (NULL counts as not set)."""
    out = F.lit(0)
    for k, cond in enumerate(conds):
        out = out + F.when(cond, F.lit(1 << k)).otherwise(F.lit(0))
    return out


def surrogate(*cols) -> Column:
    """Deterministic 64-bit surrogate key of a natural key."""
    return F.xxhash64(*[col_(c) for c in cols])


def in_range(c, lo, hi) -> Column:
    return col_(c).between(lo, hi)
