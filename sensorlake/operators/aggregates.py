"""Aggregations (A01-A13 except the file-evidence ones in datefmt)."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorlake.functions.quality import count_if
from sensorlake.functions.time import ts_literal, trunc
from sensorlake.schemas import SERIES_KEY
from sensorlake.session import materialize


AGG_FUNCS = {"sum": F.sum, "mean": F.avg, "avg": F.avg, "min": F.min, "max": F.max, "count": F.count,
             "last": None}


def resample(df: DataFrame, every: str = "1 hour", label: str = "end", series: Sequence[str] = SERIES_KEY,
             time_col: str = "time", value_col: str = "data_value", measurement_col: str = "measurement",
             drop_last: bool = False, fn: str | None = None) -> DataFrame:
    """Tumbling windows per series; additive -> sum, others -> mean.

    One pass: the measurement class is a grouping column, so both sums are
    computed in the same partial/final hash aggregate and the right one is
    picked per group. NULL values are not points; empty windows are not
    emitted. ``label`` = ``end`` (window stop) or ``start``. ``drop_last``
    reproduces an export whose range stops (exclusive) at the newest point of
    each measurement: that point is dropped and the last window ends there.
    ``fn`` (sum, mean, min, max, count, last) overrides the per-class choice.
    """
    pts = df.filter(F.col(time_col).isNotNull() & F.col(value_col).isNotNull())
    v = F.col(value_col)
    if fn is not None:
        agg = F.max_by(v, F.col(time_col)) if fn == "last" else AGG_FUNCS[fn](v)
        out = pts.groupBy(F.window(time_col, every).alias("_w"), *series).agg(agg.cast("double").alias(value_col))
        return out.select(F.col(f"_w.{label}").alias(time_col), *series, value_col)
    if drop_last:
        # parity with an exclusive range stop at the newest point: that point is
        # lost and the last window is clipped to the stop (its end label too)
        newest = pts.groupBy(measurement_col).agg(F.max(time_col).alias("_newest"))
        pts = pts.join(newest, measurement_col).filter(F.col(time_col) < F.col("_newest"))
        out = pts.groupBy(F.window(time_col, every).alias("_w"), *series).agg(
            F.when(F.col(measurement_col) == "additive", F.sum(v)).otherwise(F.avg(v)).alias(value_col),
            F.max("_newest").alias("_stop"))
        t = F.least(F.col("_w.end"), F.col("_stop")) if label == "end" else F.col(f"_w.{label}")
        return out.select(t.alias(time_col), *series, value_col)
    out = pts.groupBy(F.window(time_col, every).alias("_w"), *series).agg(
        F.when(F.col(measurement_col) == "additive", F.sum(v)).otherwise(F.avg(v)).alias(value_col))
    return out.select(F.col(f"_w.{label}").alias(time_col), *series, value_col)


def time_span(df: DataFrame, by: Sequence[str] = ("measurement",), time_col: str = "time") -> DataFrame:
    """min/max time per group (no sort; Parquet footers can answer it)."""
    return df.groupBy(*by).agg(F.min(time_col).alias("time_min"), F.max(time_col).alias("time_max"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Frequency of non-NULL values, most frequent first."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col).count()
              .orderBy(F.desc("count"), F.asc(col)))


def dataset_profile(df: DataFrame, time_col: str = "time", top: int = 15) -> DataFrame:
    """One long table of (metric, key, value) describing the dataset.

    One pass over the data down to a row per (measurement, data_key), which
    is stored; totals, rows per measurement and top keys come from it.
    """
    base = materialize(df.groupBy("measurement", "data_key").agg(
        F.count(F.lit(1)).alias("n"), F.min(time_col).alias("low"), F.max(time_col).alias("high")))
    totals = base.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("string").alias("rows"), F.min("low").cast("string").alias("time_min"),
                      F.max("high").cast("string").alias("time_max"))
    t = (totals.unpivot([], ["rows", "time_min", "time_max"], "metric", "value")
               .select("metric", F.lit(None).cast("string").alias("key"), "value"))

    def counts(col: str, metric: str) -> DataFrame:
        return (base.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("key")).agg(F.sum("n").alias("n"))
                .select(F.lit(metric).alias("metric"), "key", "n"))

    keys = counts("data_key", "top_data_key").orderBy(F.desc("n"), "key").limit(top)
    both = counts("measurement", "measurement_rows").unionByName(keys)
    return t.unionByName(both.select("metric", "key", F.col("n").cast("string").alias("value")))


def freshness(df: DataFrame, col: str, as_of, warn_after_days: int = 365,
              error_after_days: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Newest load time, its age in seconds, and pass/warn/error.

    An empty source reports year 0001, which is always stale.
    """
    newest = F.coalesce(F.max(F.col(col).cast("timestamp_ntz")), F.lit("0001-01-01 00:00:00").cast("timestamp_ntz"))
    out = df.groupBy(*by).agg(newest.alias("max_loaded_at"))
    age = (F.unix_micros(ts_literal(as_of).cast("timestamp")) - F.unix_micros(F.col("max_loaded_at").cast("timestamp"))) / 1e6
    status = F.when(F.lit(error_after_days is not None) & (age > F.lit((error_after_days or 0) * 86400)), "error") \
        .when(age > F.lit(warn_after_days * 86400), "warn").otherwise("pass")
    return out.select(*by, "max_loaded_at", age.alias("age_seconds"), status.alias("status"))


#: The grain whose rows a coarser one is merged from; a period holds at most 24, 31 or 12 of them.
FINER = {"day": "hour", "week": "day", "month": "day", "quarter": "month", "year": "month"}


def _moments(df: DataFrame, by: Sequence, value_col: str) -> DataFrame:
    """(by..., n, total, m2): count, sum and sum of squared deviations of non-null values."""
    v = F.col(value_col)
    return df.groupBy(*by).agg(F.count(v).alias("n"), F.sum(v).alias("total"), (F.var_pop(v) * F.count(v)).alias("m2"))


def merged_moments(moments: DataFrame, by: Sequence[str]) -> DataFrame:
    """Moments of unions of few groups: deviations inside the groups, and of their means from the mean of all (parallel variance)."""
    every = Window.partitionBy(*by)
    mean = F.try_divide(F.sum("total").over(every), F.sum("n").over(every))
    apart = F.try_divide(F.col("total"), F.col("n")) - F.col("_mean")
    # the aggregate keeps the window's partitioning: one shuffle of the finer rows
    return (moments.withColumn("_mean", mean).groupBy(*by)
            .agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum(F.col("m2") + F.col("n") * apart * apart).alias("m2")))


def multi_grain(df: DataFrame, grains: Sequence[str] = ("hour", "day", "week", "month"),
                series: Sequence[str] = ("location", "data_key"), time_col: str = "time",
                value_col: str = "data_value") -> DataFrame:
    """Mean / sample stddev / count at several grains, one table.

    Readings are aggregated once, to the finest grain needed; coarser periods
    merge the moments of the next finer ones (hour -> day -> week and month),
    so no reading is copied per grain, and sums are those of the readings.
    """
    made: dict[str, DataFrame] = {}
    wanted = list(grains)

    def chain(g):
        return [g] if g not in FINER else [*chain(FINER[g]), g]

    # the coarsest grain all wanted ones descend from; only this one is aggregated from readings
    common = os.path.commonprefix([chain(g) for g in wanted])
    first = common[-1] if common else None

    def at(g: str) -> DataFrame:
        if g not in made:
            if g == first or g not in FINER or first is None:
                made[g] = _moments(df.select(trunc(time_col, g).alias("period"), *series, value_col), ["period", *series], value_col)
            else:
                made[g] = merged_moments(at(FINER[g]).withColumn("period", trunc("period", g)), ["period", *series])
        return made[g]

    out = None
    for g in wanted:
        x = at(g).select(F.lit(g).alias("grain"), "period", *series, F.try_divide(F.col("total"), F.col("n")).alias("mean"),
                         F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("std"), "n")
        out = x if out is None else out.unionByName(x)
    return out


def distinct_times(df: DataFrame, by: Sequence[str], time_col: str = "time") -> DataFrame:
    """(by..., distinct_times): exact distinct timestamps per group, which must lie within a day.

    Whole seconds are bits of mergeable bitmaps (three of 4 kB a group and
    map task, whatever the number of rows); only times with a fraction of a
    second are told apart one by one.
    """
    second = (F.hour(time_col) * 3600 + F.minute(time_col) * 60 + F.second(time_col)).cast("long")
    whole = F.date_trunc("second", F.col(time_col)).cast("timestamp_ntz") == F.col(time_col).cast("timestamp_ntz")
    x = df.filter(F.col(time_col).isNotNull())
    bits = (x.filter(whole).groupBy(*by, F.bitmap_bucket_number(second + 1).alias("_bucket"))
            .agg(F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(second + 1))).alias("k")).drop("_bucket"))
    rest = x.filter(~whole).select(*by, time_col).distinct().groupBy(*by).agg(F.count("*").alias("k"))
    return bits.unionByName(rest).groupBy(*by).agg(F.sum("k").alias("distinct_times"))


def daily_quality(df: DataFrame, by: Sequence[str] = ("source", "measurement"), time_col: str = "time",
                  value_col: str = "data_value") -> DataFrame:
    """A10: per day and group: counts, distinct timestamps, nulls, range, spread, active sensors.

    Each figure has an aggregate of its own kind, so no reading is copied per
    distinct count: plain statistics; the series of a day, from which
    locations and keys are counted; and ``distinct_times``.
    """
    v = F.col(value_col)
    x = df.withColumn("day", F.to_date(time_col))
    key = ["day", *by]
    stats = x.groupBy(*key).agg(
        F.count(F.lit(1)).alias("row_count"),
        count_if(v.isNull()).alias("null_count"),
        F.round(F.lit(100.0) * count_if(v.isNull()) / F.count(F.lit(1)), 2).alias("null_pct"),
        F.min(v).alias("min_value"), F.max(v).alias("max_value"),
        F.avg(v).alias("avg_value"), F.stddev_samp(v).alias("std_value"))
    active = x.select(*key, F.col("location").alias("_location"), F.col("data_key").alias("_key")).distinct()
    told = []
    for c, name in (("_location", "active_locations"), ("_key", "active_keys")):
        told.append(active.filter(F.col(c).isNotNull()).select(*key, c).distinct().groupBy(*key).agg(F.count("*").alias(name)))
    told.append(distinct_times(x, key, time_col))
    # united and folded rather than joined: one row a group from each side
    names = ["row_count", "distinct_times", "null_count", "null_pct", "min_value", "max_value", "avg_value", "std_value",
             "active_locations", "active_keys"]
    both = stats
    for t in told:
        both = both.unionByName(t, allowMissingColumns=True)
    out = both.groupBy(*key).agg(*[F.max(n).alias(n) for n in names])
    zero = ["distinct_times", "active_locations", "active_keys"]
    return out.withColumns({n: F.coalesce(n, F.lit(0).cast("long")) for n in zero}).select(*key, *names)


def having_drop(agg: DataFrame, count_col: str, expected, ratio: float = 0.5) -> DataFrame:
    """Groups with fewer than ``ratio`` x expected rows."""
    exp = expected if isinstance(expected, Column) else F.lit(expected)
    return agg.filter(F.col(count_col) < exp * F.lit(ratio))


def hierarchy_rollup(df: DataFrame, levels: Sequence[str], value_col: str = "data_value") -> DataFrame:
    """Aggregate at every prefix of the hierarchy levels (ROLLUP)."""
    v = F.col(value_col)
    return df.rollup(*levels).agg(
        F.grouping_id().alias("grouping_level"), F.count(v).alias("n"),
        F.avg(v).alias("avg_value"), F.min(v).alias("min_value"), F.max(v).alias("max_value"))


def latest_value(df: DataFrame, series: Sequence[str] = SERIES_KEY, time_col: str = "time",
                 value_col: str = "data_value") -> DataFrame:
    """Newest reading per series (ties broken by the larger value).

    ``max_by`` in a hash aggregate, so a hot series is reduced map-side.
    """
    order = F.struct(F.col(time_col), F.col(value_col))
    return df.groupBy(*series).agg(F.max(time_col).alias("time"),
                                   F.max_by(F.col(value_col), order).alias(value_col))


def envelope(df: DataFrame, grain: str = "day", line_cols: Sequence[str] = ("location", "data_key"),
             aggregate_location_keys: Sequence[str] = (), time_col: str = "time",
             value_col: str = "data_value", location_col: str = "location") -> DataFrame:
    """Max / avg / min per period and chart line.

    Metrics listed in ``aggregate_location_keys`` merge all locations into
    one line (location ``*``).
    """
    loc = F.when(F.col("data_key").isin(list(aggregate_location_keys)), F.lit("*")).otherwise(F.col(location_col)) \
        if aggregate_location_keys else F.col(location_col)
    lines = [loc.alias(location_col) if c == location_col else F.col(c) for c in line_cols]
    v = F.col(value_col)
    return df.groupBy(trunc(time_col, grain).alias("period"), *lines).agg(
        F.max(v).alias("max_value"), F.avg(v).alias("avg_value"), F.min(v).alias("min_value"))
