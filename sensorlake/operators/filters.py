"""Filters and predicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.functions.text import col_, is_numeric
from sensorlake.functions.time import ts_literal


def drop_null_time(df: DataFrame, col: str = "time") -> DataFrame:
    """F01."""
    return df.filter(F.col(col).isNotNull())


def retention_start(history, as_of=None) -> Column:
    """First instant kept: month start of ``as_of`` minus (history - 1) months."""
    as_of_c = ts_literal(as_of) if as_of is not None else F.current_timestamp().cast("timestamp_ntz")
    month0 = F.date_trunc("month", as_of_c).cast("date")
    h = history if isinstance(history, Column) else F.lit(int(history))
    return F.add_months(month0, -(h.cast("int") - 1)).cast("timestamp_ntz")


def retain_months(df: DataFrame, history, as_of=None, col: str = "time",
                  params: DataFrame | None = None, lazy_bound: bool = False) -> DataFrame:
    """keep ``col >= month_start(as_of) - (history-1) months``.

    ``history`` is an int, or pass ``params`` (rows with a ``history`` column,
    e.g. the sources seed filtered to one file); the latest start among them
    wins and no row gives a NULL bound, hence an empty result.

    With ``params`` the bound is one aggregated value of a configuration
    table, resolved on the driver so that it reaches the Parquet scan as a
    pushed filter (row-group skipping on time). ``lazy_bound=True`` keeps it
    as an uncorrelated scalar subquery instead (evaluated once at run time,
    applied as a scan data filter).
    """
    if params is not None:
        start = params.select(F.max(retention_start(F.col("history"), as_of)).alias("start_ts"))
        if lazy_bound:
            return df.filter(F.col(col) >= start.scalar())
        value = start.first()[0]
        if value is None:
            return df.filter(F.lit(False))
        return df.filter(F.col(col) >= ts_literal(value))
    return df.filter(F.col(col) >= retention_start(history, as_of))


def retention_bound(params: DataFrame, as_of=None):
    """The latest retention start among ``params`` as a value (one configuration table); None if there is no row."""
    return params.select(F.max(retention_start(F.col("history"), as_of))).first()[0]


def for_measurement(df: DataFrame, m: str, col: str = "measurement") -> DataFrame:
    """F03."""
    return df.filter(F.col(col) == m)


def time_range(df: DataFrame, start, stop, col: str = "time") -> DataFrame:
    """half-open [start, stop)."""
    return df.filter((F.col(col) >= ts_literal(start)) & (F.col(col) < ts_literal(stop)))


def drop_dead_rows(df: DataFrame, a: str, b: str) -> DataFrame:
    """drop rows where both measures are NULL; keep rows with one."""
    return df.filter(~(F.col(f"`{a}`").isNull() & F.col(f"`{b}`").isNull()))


def require_numeric(df: DataFrame, cols: Sequence[str], mode: str = "quarantine"):
    """non-NULL text must be a plain decimal number.

    mode ``fail``: the returned frame raises at execution when a bad value is
    met (``assert_true``); mode ``quarantine``: returns (good, bad) frames.
    """
    bad = F.lit(False)
    for c in cols:
        bad = bad | (F.col(f"`{c}`").isNotNull() & ~is_numeric(F.col(f"`{c}`")))
    if mode == "fail":
        return df.filter(F.assert_true(~bad, F.lit("non-numeric measure")).isNull())
    if mode == "quarantine":
        flagged = df.withColumn("_bad", bad)
        return flagged.filter(~F.col("_bad")).drop("_bad"), flagged.filter(F.col("_bad")).drop("_bad")
    raise ValueError(mode)


# A drop line's date is `NN/NN/NNNN`, its time `H:MM` or `H:MM:SS`.
DATE_TEXT = r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$"
TIME_TEXT = r"^[0-9]{1,2}:[0-9]{2}(:[0-9]{2})?$"


def valid_line(date_text, time_text) -> Column:
    """F08 predicate: `NN/NN/NNNN` date and `H:MM[:SS]` time."""
    return F.coalesce(col_(date_text).rlike(DATE_TEXT) & col_(time_text).rlike(TIME_TEXT), F.lit(False))


def month_guard(df: DataFrame, month_col: str = "month", mode: str = "fail"):
    """a parsed month > 12 fails the run (``fail``) or is split off."""
    bad = F.col(month_col) > 12
    if mode == "fail":
        return df.filter(F.assert_true(~F.coalesce(bad, F.lit(False)), F.lit("month > 12 in parsed output")).isNull())
    flagged = df.withColumn("_bad", F.coalesce(bad, F.lit(False)))
    return flagged.filter(~F.col("_bad")).drop("_bad"), flagged.filter(F.col("_bad")).drop("_bad")


def range_gate(df: DataFrame, value_col: str, lo, hi, as_of=None, start=None, time_col: str = "time",
               required: Sequence[str] = ("time", "location", "data_value")) -> DataFrame:
    """plausible value, not in the future, inside the window, required cells present."""
    cond = F.col(value_col).between(lo, hi)
    for c in required:
        cond = cond & F.col(c).isNotNull()
    if as_of is not None:
        cond = cond & (F.col(time_col) <= ts_literal(as_of))
    if start is not None:
        cond = cond & (F.col(time_col) >= ts_literal(start))
    return df.filter(cond)


def months_filter(df: DataFrame, months, col: str = "time", month_col: str | None = None) -> DataFrame:
    """keep only the listed `YYYY-MM` months.

    ``months`` may be a list or a DataFrame with a ``year_month`` column (the
    output of S13); a partition column ``month_col`` gets partition pruning.
    """
    key = F.col(month_col) if month_col else F.date_format(F.col(col), "yyyy-MM")
    if isinstance(months, DataFrame):
        return df.withColumn("_ym", key).join(
            months.select(F.col("year_month").alias("_ym")), "_ym", "left_semi").drop("_ym")
    return df.filter(key.isin(list(months)))
