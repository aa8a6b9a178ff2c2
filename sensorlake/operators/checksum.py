"""Checksums of row multisets that add up.

A group's checksum is its row count and the sums of two 64-bit hashes of
its rows. Sums do not depend on row order, count copies, and roll up: a
month's is the sum of its days'. Two datasets are compared from the top;
only groups whose sums differ are looked into, and only their rows read.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.functions.time import year_month
from sensorlake.operators.merge import compare
from sensorlake.operators.util import bounded_broadcast
from sensorlake.session import materialize

SUMS = ("n", "sum_a", "sum_b")
#: From the coarsest to the finest group of a published row.
LEVELS = (("source",), ("source", "year_month"), ("source", "year_month", "day"))


def row_hashes(cols: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of a row. Hashes pass over nulls, so which columns are null is hashed as well."""
    cs = [F.col(f"`{c}`") for c in cols]
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in cs])
    return [F.xxhash64(F.lit(salt), nulls, *cs) for salt in ("a", "b")]


def _total(c) -> Column:
    return F.sum(F.col(c).cast("decimal(38,0)") if isinstance(c, str) else c.cast("decimal(20,0)")).cast("decimal(38,0)")


def checksums(df: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """(by..., n, sum_a, sum_b): one hash aggregate with partial sums on the map side."""
    a, b = row_hashes(cols)
    return df.groupBy(*by).agg(F.count("*").alias("n"), _total(a).alias("sum_a"), _total(b).alias("sum_b"))


def day_checksums(df: DataFrame, by: Sequence[str] = ("source",), time_col: str = "time", cols: Sequence[str] | None = None) -> DataFrame:
    """(by..., year_month, day, n, sum_a, sum_b). Rows without a time are a day of their own (null)."""
    cols = list(cols or df.columns)
    dated = df.withColumns({"year_month": year_month(time_col), "day": F.to_date(time_col)})
    return checksums(dated, [*by, "year_month", "day"], cols)


def rolled_up(sums: DataFrame, by: Sequence[str]) -> DataFrame:
    """Checksums of coarser groups, from those of finer ones."""
    return sums.groupBy(*by).agg(F.sum("n").alias("n"), _total("sum_a").alias("sum_a"), _total("sum_b").alias("sum_b"))


def _within(x: DataFrame, groups: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Rows of ``x`` whose group is among ``groups`` (null keys are keys too); ``names``: other column names in ``x``."""
    names = names or {}
    named = groups.select(*[F.col(c).alias(f"_group_{c}") for c in groups.columns])
    same = functools.reduce(lambda p, q: p & q, [F.col(names.get(c, c)).eqNullSafe(F.col(f"_group_{c}")) for c in groups.columns])
    return x.join(bounded_broadcast(named), same, "left_semi")


def differing(now: DataFrame, before: DataFrame, by: Sequence[str]) -> DataFrame:
    """Groups that are new, gone or hold other rows (null keys are keys too)."""
    signed = rolled_up(now, by).unionByName(rolled_up(before, by).select(*by, *[(-F.col(c)).alias(c) for c in SUMS]))
    return rolled_up(signed, by).filter(" OR ".join(f"{c} <> 0" for c in SUMS)).select(*by)


def differing_days(now: DataFrame, before: DataFrame, levels: Sequence[Sequence[str]] = LEVELS) -> DataFrame:
    """The finest groups that differ; each level looks only into the groups in which the one above differs."""
    found = None
    for by in levels:
        if found is not None:
            found = materialize(found)
            now, before = _within(now, found), _within(before, found)
        found = differing(now, before, by)
    return found


def compare_days(a: DataFrame, b: DataFrame, a_sums: DataFrame | None = None, b_sums: DataFrame | None = None,
                 levels: Sequence[Sequence[str]] = LEVELS, time_col: str = "time") -> DataFrame:
    """U05 over the days that differ: rows only in ``a`` or only in ``b``.

    With stored day checksums the datasets are read for those days only; a
    ``year_month`` column (a partition of both) prunes whole months.
    """
    cols = [c for c in a.columns if c != "year_month"]
    by = [c for c in levels[-1] if c not in ("year_month", "day")]
    a_sums = a_sums if a_sums is not None else materialize(day_checksums(a, by, time_col, cols))
    b_sums = b_sums if b_sums is not None else materialize(day_checksums(b, by, time_col, cols))
    days = materialize(differing_days(a_sums, b_sums, levels))
    months = [r[0] for r in days.select("year_month").distinct().collect()]       # months, as a filter on partitions

    def some(df: DataFrame) -> DataFrame:
        month = F.col("year_month") if "year_month" in df.columns else year_month(time_col)
        known = [m for m in months if m is not None]
        pick = month.isin(known) if known else F.lit(False)
        if None in months:
            pick = pick | month.isNull()
        x = df.filter(pick).withColumns({"_month": month, "_day": F.to_date(time_col)})
        return _within(x, days, {"year_month": "_month", "day": "_day"}).select(*cols)

    return compare(some(a), some(b))
