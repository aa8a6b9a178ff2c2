"""Data-quality gates (Q01-Q16): tables in, a result table out.

Row rules are expressed as boolean Columns so that many of them can be
counted in one aggregate (one scan); key and order rules are their own
aggregations.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.functions.quality import count_if, flags
from sensorlake.functions.time import ts_literal
from sensorlake.operators.windows import volume_drop


def not_null(df: DataFrame, col: str = "time") -> DataFrame:
    """Q01: failing rows (col IS NULL)."""
    return df.filter(F.col(col).isNull())


def accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Q04: failing rows -- a non-NULL value outside the accepted set."""
    return df.filter(F.col(col).isNotNull() & ~F.col(col).isin(list(values)))


def unique_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Q05: keys that occur more than once, with their count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def duplicate_timestamps(df: DataFrame, key: Sequence[str] = ("time", "location")) -> DataFrame:
    """Q06: duplicated (time, location) groups; ``extra`` = copies beyond the first."""
    return unique_key(df, key).withColumn("extra", F.col("n") - 1)


def future_rows(df: DataFrame, as_of, col: str = "time") -> DataFrame:
    """Q07: rows stamped after ``as_of``."""
    return df.filter(F.col(col) > ts_literal(as_of))


def _per_group(value, by: Sequence[str], default):
    """A threshold as a Column: a scalar, or {group value: threshold} on the first ``by`` column."""
    if isinstance(value, Mapping):
        m = F.create_map(*[x for k, v in value.items() for x in (F.lit(k), F.lit(v))])
        return F.coalesce(m[F.col(by[0])], F.lit(default))
    return F.lit(value)


def null_ratio(df: DataFrame, cols: Sequence[str], threshold: float | Mapping = 0.05, by: Sequence[str] = (),
               default_threshold: float = 0.05) -> DataFrame:
    """Q08: per column (and group) NULL count, total, ratio and pass/fail -- one aggregate.

    ``threshold`` may be a map keyed by the first ``by`` column (e.g. a
    per-source limit: 5 % for one source, 2 % for another)."""
    aggs = [F.count(F.lit(1)).alias("_total")] + [count_if(F.col(c).isNull()).alias(c) for c in cols]
    wide = df.groupBy(*by).agg(*aggs)
    long = wide.unpivot([*by, "_total"], list(cols), "column", "null_count")
    ratio = F.when(F.col("_total") > 0, F.col("null_count") / F.col("_total")).otherwise(F.lit(0.0))
    limit = _per_group(threshold, by, default_threshold)
    return long.select(*by, "column", "null_count", F.col("_total").alias("total"), ratio.alias("null_ratio"),
                       F.when(ratio > limit, "fail").otherwise("pass").alias("status"))


def row_count_between(df: DataFrame, lo: int | Mapping, hi: int | Mapping, by: Sequence[str] = ()) -> DataFrame:
    """Q09: row count (per group) and pass/fail against [lo, hi] (scalars or per-group maps)."""
    out = df.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"))
    lo_c, hi_c = _per_group(lo, by, 0), _per_group(hi, by, 1 << 62)
    return out.select(*by, "row_count", lo_c.alias("min_rows"), hi_c.alias("max_rows"),
                      F.when(F.col("row_count").between(lo_c, hi_c), "pass").otherwise("fail").alias("status"))


def value_between(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Q10: failing rows -- non-NULL value outside [lo, hi]."""
    return df.filter(F.col(col).isNotNull() & ~F.col(col).between(lo, hi))


def row_count_reconcile(source: DataFrame, landed: DataFrame) -> DataFrame:
    """Q13: landed rows must equal source rows (two counts, one result row)."""
    s = source.agg(F.count(F.lit(1)).alias("source_rows"))
    t = s.withColumn("landed_rows", landed.select(F.count(F.lit(1))).scalar())
    return t.select("source_rows", "landed_rows",
                                 (F.col("landed_rows") - F.col("source_rows")).alias("diff"),
                                 F.when(F.col("landed_rows") == F.col("source_rows"), "pass")
                                  .otherwise("fail").alias("status"))


def anomalies(metrics: DataFrame, by: Sequence[str] = ("source",), order_col: str = "day",
              count_col: str = "row_count", null_pct_col: str = "null_pct", avg_col: str = "avg_value",
              std_col: str = "std_value", drop_ratio: float = 0.5, null_pct_max: float = 10.0,
              std_factor: float = 2.0) -> DataFrame:
    """Q14: 50 % volume drop, NULL % above 10, stddev above 2x the mean -- tagged rows."""
    keys = [*by, order_col]
    drop = volume_drop(metrics, count_col, by, order_col, drop_ratio).select(
        *keys, F.lit("volume_drop").alias("anomaly"), F.col(count_col).cast("double").alias("observed"))
    nul = metrics.filter(F.col(null_pct_col) > null_pct_max).select(
        *keys, F.lit("null_pct").alias("anomaly"), F.col(null_pct_col).cast("double").alias("observed"))
    spread = metrics.filter(F.col(std_col) > F.lit(std_factor) * F.col(avg_col)).select(
        *keys, F.lit("high_stddev").alias("anomaly"), F.col(std_col).cast("double").alias("observed"))
    return drop.unionByName(nul).unionByName(spread)


@dataclass(frozen=True)
class RowRule:
    name: str
    fails: Column          # true when the row breaks the rule
    severity: str = "error"
    threshold: int = 0     # failures allowed before the rule fails


def standard_row_rules(as_of=None, lo: float = -10.0, hi: float = 50.0,
                       measurements: Sequence[str] = ("additive", "nonadditive")) -> list[RowRule]:
    rules = [
        RowRule("not_null_time", F.col("time").isNull()),
        RowRule("accepted_measurement", F.col("measurement").isNotNull() & ~F.col("measurement").isin(list(measurements))),
        RowRule("value_between", F.col("data_value").isNotNull() & ~F.col("data_value").between(lo, hi), "warn"),
        RowRule("null_value", F.col("data_value").isNull(), "warn"),
    ]
    if as_of is not None:
        rules.append(RowRule("future_rows", F.col("time") > ts_literal(as_of)))
    return rules


def quality_report(df: DataFrame, rules: Sequence[RowRule],
                   key_checks: Mapping[str, tuple[DataFrame, str, int]] | None = None) -> DataFrame:
    """Q15: row rules counted in one aggregate, then unpivoted to
    (rule, failures, severity, threshold, status); key/order checks are
    given as frames of failing groups ({name: (frame, severity, threshold)})
    and counted as their own jobs, results unioned."""
    wide = df.agg(*[count_if(r.fails).alias(r.name) for r in rules])
    long = wide.unpivot([], [r.name for r in rules], "rule", "failures")
    meta = df.sparkSession.createDataFrame([(r.name, r.severity, r.threshold) for r in rules],
                                           "rule string, severity string, threshold int")
    out = long.join(F.broadcast(meta), "rule")
    for name, (frame, severity, threshold) in (key_checks or {}).items():
        c = frame.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(name).alias("rule"), "failures", F.lit(severity).alias("severity"), F.lit(threshold).alias("threshold"))
        out = out.unionByName(c)
    status = F.when(F.col("failures") <= F.col("threshold"), "pass") \
        .when(F.col("severity") == "error", "fail").otherwise("warn")
    return out.withColumn("status", status)


def gate(report: DataFrame) -> DataFrame:
    """Overall verdict of a report: fail when any error-severity rule fails."""
    return report.agg(F.max(F.when(F.col("status") == "fail", 1).otherwise(0)).alias("_f")).select(
        F.when(F.col("_f") == 1, "fail").otherwise("pass").alias("gate"))


def flag_quality(df: DataFrame, rules: Sequence[RowRule], col: str = "quality_flags") -> DataFrame:
    """Q16: per-row bitmask, bit k = rules[k] broken."""
    return df.withColumn(col, flags(*[r.fails for r in rules]))
