"""Window operators (W03-W08; W01/W02 live in datefmt)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorlake.functions.time import trunc
from sensorlake.schemas import SERIES_KEY


def prev_in_series(df: DataFrame, series: Sequence[str], time_col: str = "time", bucket: str = "day",
                   prev_col: str = "prev_time") -> DataFrame:
    """Previous time of the same series, without putting a whole series in one task.

    The ordered window runs per (series, time bucket); the first row of each
    bucket takes the newest time of the nearest earlier bucket of its series
    (a window over the small per-bucket summary). The join back uses the
    same (series, bucket) hash partitioning as the window, so it adds no
    exchange on the large side.
    """
    series = list(series)
    b = df.withColumn("_b", trunc(time_col, bucket))
    inner = b.withColumn(prev_col, F.lag(time_col).over(Window.partitionBy(*series, "_b").orderBy(time_col)))
    summary = b.groupBy(*series, "_b").agg(F.max(time_col).alias("_bmax"))
    summary = summary.withColumn("_carry", F.lag("_bmax").over(Window.partitionBy(*series).orderBy("_b")))
    out = inner.join(summary.select(*series, "_b", "_carry"), [*series, "_b"], "inner")
    return out.withColumn(prev_col, F.coalesce(F.col(prev_col), F.col("_carry"))).drop("_b", "_carry")


def gaps(df: DataFrame, max_hours: float, series: Sequence[str] = SERIES_KEY, time_col: str = "time",
         bucket: str = "day") -> DataFrame:
    """Spans longer than ``max_hours`` without data, per series."""
    p = prev_in_series(df.select(*series, time_col).filter(F.col(time_col).isNotNull()), series, time_col, bucket)
    hours = (F.unix_micros(F.col(time_col).cast("timestamp")) - F.unix_micros(F.col("prev_time").cast("timestamp"))) / 3.6e9
    return (p.withColumn("gap_hours", hours).filter(F.col("gap_hours") > max_hours)
             .select(*series, F.col("prev_time").alias("gap_start"), F.col(time_col).alias("gap_end"), "gap_hours"))


def head_per_series(df: DataFrame, n: int, series: Sequence[str] = SERIES_KEY, time_col: str = "time",
                    tiebreak: Sequence[str] = ("data_value",)) -> DataFrame:
    """First ``n`` points of each series.

    ``row_number() <= n`` is planned with a partial WindowGroupLimit before
    the shuffle, so each map task sends at most n rows per series.
    """
    w = Window.partitionBy(*series).orderBy(F.col(time_col), *[F.col(c) for c in tiebreak])
    return df.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n)


def neighbours(df: DataFrame, period_col: str = "period", by: Sequence[str] = ()) -> DataFrame:
    """Previous / next period that has data (over distinct periods only)."""
    d = df.select(*by, period_col).filter(F.col(period_col).isNotNull()).distinct()
    w = (Window.partitionBy(*by) if by else Window.partitionBy()).orderBy(period_col)
    return d.select(*by, period_col, F.lag(period_col).over(w).alias("prev_period"),
                    F.lead(period_col).over(w).alias("next_period"))


def volume_drop(metrics: DataFrame, count_col: str = "row_count", by: Sequence[str] = ("source",),
                order_col: str = "day", ratio: float = 0.5) -> DataFrame:
    """Periods whose row count is below ``ratio`` x the preceding period's.

    ``metrics`` is a per-period summary (e.g. ``daily_quality``), so the
    window runs over periods, not readings.
    """
    w = Window.partitionBy(*by).orderBy(order_col)
    m = metrics.withColumn("prev_count", F.lag(count_col).over(w))
    return m.filter(F.col(count_col) < F.col("prev_count") * F.lit(ratio))


def rank_for_upsert(df: DataFrame, key: Sequence[str], order: Sequence[str], bucket: str | None = "day") -> DataFrame:
    """Rank rows of a key, newest first (rank 1 = winner); ``order`` are
    column names, compared descending.

    When the first order column is a time, the rank is computed without
    sorting a whole key in one task: rows are ranked inside (key, time
    bucket) and shifted by the number of rows of the key's later buckets,
    taken from a one-row-per-bucket summary of the same windowed frame.
    For keeping only winners prefer ``merge.upsert`` (aggregate form).
    """
    from pyspark.sql import types as T
    key, order = list(key), list(order)
    ords = [F.desc(o) for o in order]
    first_type = df.schema[order[0]].dataType if order else None
    if not bucket or not isinstance(first_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return df.withColumn("write_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*ords)))
    b = df.withColumn("_b", trunc(order[0], bucket))
    inner = b.withColumn("_r", F.row_number().over(Window.partitionBy(*key, "_b").orderBy(*ords)))
    summary = inner.groupBy(*key, "_b").agg(F.count(F.lit(1)).alias("_n"))
    later = Window.partitionBy(*key).orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.withColumn("_before", F.coalesce(F.sum("_n").over(later), F.lit(0)))
    out = inner.join(summary.select(*key, "_b", "_before"), [*key, "_b"], "inner")
    return out.withColumn("write_rank", (F.col("_r") + F.col("_before")).cast("int")).drop("_b", "_r", "_before")


def carry_forward(df: DataFrame, series: Sequence[str], time_col: str, value_col: str, out_col: str,
                  bucket: str = "month", tie_col: str | None = None, inclusive: bool = True,
                  descending: bool = False, cut_lineage: bool = False) -> DataFrame:
    """Last non-NULL ``value_col`` at or before each row of the same series.

    The skew-safe form of ``last(value, ignorenulls) over (partition by
    series order by time)``: the ordered window runs per (series, bucket),
    and rows with nothing earlier in their bucket take the newest value of
    the nearest earlier bucket, found on a one-row-per-bucket summary.
    ``tie_col`` orders rows with equal time (ascending; later wins).
    ``inclusive=False`` looks strictly before the row; ``descending=True``
    walks backwards in time (the next value instead of the previous one).
    ``cut_lineage`` materialises the windowed frame once (checkpoint) so that
    an expensive input is not recomputed by the summary branch.
    """
    series = list(series)
    b = df.withColumn("_b", trunc(time_col, bucket))
    cols = [F.col(time_col)] + ([F.col(tie_col)] if tie_col else [])
    order = [c.desc() for c in cols] if descending else cols
    frame_end = Window.currentRow if inclusive else -1
    w = Window.partitionBy(*series, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, frame_end)
    inner = b.withColumn(out_col, F.last(value_col, ignorenulls=True).over(w))
    if cut_lineage:
        from sensorlake.session import materialize
        inner = materialize(inner)
    # One summary row per (series, bucket), taken from the windowed frame itself:
    # it is already hash-partitioned by (series, bucket), so the aggregate and
    # the join back add no exchange of the large side.
    okey = F.struct(*cols) if tie_col else F.col(time_col)   # primitive key keeps the hash aggregate
    pick = F.min_by if descending else F.max_by
    summary = inner.groupBy(*series, "_b").agg(
        pick(F.col(value_col), F.when(F.col(value_col).isNotNull(), okey)).alias("_last"))
    # every bucket takes the value of the nearest bucket before it
    border = F.desc("_b") if descending else F.asc("_b")
    sw = Window.partitionBy(*series).orderBy(border).rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.withColumn("_carry", F.last("_last", ignorenulls=True).over(sw)).drop("_last")
    out = inner.join(summary, [*series, "_b"], "inner")
    return out.withColumn(out_col, F.coalesce(F.col(out_col), F.col("_carry"))).drop("_b", "_carry")


def asof_join(left: DataFrame, right: DataFrame, key: Sequence[str], left_time: str, right_time: str,
              right_cols: Sequence[str], bucket: str = "day", cut_lineage: bool = False) -> DataFrame:
    """Each left row gets the right row of the same key with the latest
    ``right_time <= left_time`` (NULLs when none) -- without emitting
    left x right pairs per key: both sides are unioned and the right row is
    carried forward in time order (``carry_forward``)."""
    key = list(key)
    rcols = list(right_cols)
    payload = F.struct(*[F.col(c) for c in rcols]).alias("_r")
    l = left.select(*[F.col(c) for c in left.columns], F.col(left_time).alias("_t"), F.lit(1).alias("_side"),
                    F.lit(None).cast(right.select(payload).schema[0].dataType).alias("_r"))
    r = right.select(*key, F.col(right_time).alias("_t"), F.lit(0).alias("_side"), payload)
    both = l.unionByName(r, allowMissingColumns=True)
    carried = carry_forward(both, key, "_t", "_r", "_rc", bucket=bucket, tie_col="_side", cut_lineage=cut_lineage)
    out = carried.filter(F.col("_side") == 1)
    return out.select(*left.columns, *[F.col(f"_rc.{c}").alias(c) for c in rcols])
