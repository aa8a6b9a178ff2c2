"""Sorts, limits and top-k."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.functions.text import floor_code


PUBLIC_SORT = ["time", "location", "data_key", "source"]


def public_order(df: DataFrame, cols: Sequence[str] = PUBLIC_SORT) -> DataFrame:
    """Total order by time, location, data_key, source; NULLs last.

    A global sort is a range-partitioned shuffle (sampled boundaries), so it
    scales with the data and writes sorted part files in order.
    """
    return df.orderBy(*[F.asc_nulls_last(c) for c in cols])


def first_last(df: DataFrame, time_col: str = "time", by: Sequence[str] = ("measurement",)) -> DataFrame:
    """Earliest and latest point per group -- an aggregate, not sort + limit."""
    return df.groupBy(*by).agg(F.min(time_col).alias("first_time"), F.max(time_col).alias("last_time"))


def top_k(df: DataFrame, col: str, k: int = 15) -> DataFrame:
    """The k most frequent values (ties by value, ascending).

    The limit is the feature; Spark plans it as TakeOrderedAndProject over
    the per-value counts.
    """
    return (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
              .orderBy(F.desc("count"), F.asc(col)).limit(k))


def floor_sort_key(c) -> Column:
    """NP floors before PP; NP by number descending, PP ascending."""
    code = floor_code(c)
    suffix = F.right(code, F.lit(2))
    num = F.coalesce(F.left(code, F.length(code) - 2).try_cast("int"), F.lit(0))
    return F.struct(F.when(suffix == "NP", 0).otherwise(1).alias("cls"),
                    F.when(suffix == "NP", -num).otherwise(num).alias("num"))


def floor_order(df: DataFrame, col: str = "location") -> DataFrame:
    """O05 applied: distinct valid floor codes (NP/PP only) with their display rank."""
    from pyspark.sql import Window
    floors = (df.select(floor_code(col).alias("floor")).filter(F.col("floor").contains("NP") | F.col("floor").contains("PP"))
                .distinct())
    key = floor_sort_key(F.col("floor"))
    return floors.withColumn("floor_rank", F.row_number().over(Window.orderBy(key.cls, key.num, F.col("floor"))))


def display_order(df: DataFrame, source_priority: Mapping[str, int], metric_order: Mapping[str, int],
                  source_col: str = "source", metric_col: str = "data_key") -> DataFrame:
    """Sort by source priority, then the declared metric order (unknown last)."""
    sp = F.create_map(*[x for k, v in source_priority.items() for x in (F.lit(k), F.lit(v))])
    mo = F.create_map(*[x for k, v in metric_order.items() for x in (F.lit(k), F.lit(v))])
    big = F.lit(1 << 30)
    return (df.withColumn("source_rank", F.coalesce(sp[F.col(source_col)], big))
              .withColumn("metric_rank", F.coalesce(mo[F.col(metric_col)], big))
              .orderBy("source_rank", "metric_rank", source_col, metric_col))


def head_tail(lines: DataFrame, n: int, file_col: str = "file", order_cols: Sequence[str] = ("line_no",)) -> DataFrame:
    """First and last ``n`` lines of each file (partial group limits both ways)."""
    from pyspark.sql import Window
    asc = Window.partitionBy(file_col).orderBy(*[F.col(c) for c in order_cols])
    desc = Window.partitionBy(file_col).orderBy(*[F.desc(c) for c in order_cols])
    head = lines.withColumn("rn", F.row_number().over(asc)).filter(F.col("rn") <= n).withColumn("part", F.lit("head"))
    tail = lines.withColumn("rn", F.row_number().over(desc)).filter(F.col("rn") <= n).withColumn("part", F.lit("tail"))
    return head.unionByName(tail)



def global_row_number(df: DataFrame, order: Sequence[Column | str], col: str = "row_no") -> DataFrame:
    """1-based position of each row in a total order, without a single-partition window.

    Range-partitioned sort, written once to the shared checkpoint folder:
    counts and rows must come from one sort, as two would sample different
    bounds. Per-partition row counts (one row per partition) become
    offsets; position = partition offset + rank inside the partition.
    """
    from pyspark.sql import Window

    from sensorlake.session import materialize
    ords = [F.asc_nulls_last(o) if isinstance(o, str) else o for o in order]
    s = df.orderBy(*ords).withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id())
    s = materialize(s)
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    out = s.join(F.broadcast(offsets.select("_pid", "_off", "_m0")), "_pid")
    return out.withColumn(col, F.col("_off") + (F.col("_mid") - F.col("_m0")) + 1).drop("_pid", "_mid", "_off", "_m0")
