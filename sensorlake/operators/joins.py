"""Joins (J01-J13).

Lookup sides go through ``bounded_broadcast``: broadcast only when a row
count bound is proven, otherwise the planner shuffles (and AQE may still
switch to a broadcast once it has measured the side at runtime).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.operators.util import DEFAULT_BROADCAST_ROWS, bounded_broadcast, proven_small
from sensorlake.session import materialize

#: Versions of a key that ``as_at`` looks through for each reading; a longer history goes through the as-of join.
MAX_VERSIONS = 64


def map_signals(df: DataFrame, mapping: DataFrame, key: str = "data_key_original",
                time_col: str = "date", max_broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS,
                carry: Sequence[str] = ()) -> DataFrame:
    """Inner join on the original column name -> (time, location, data_key, data_value, carried columns).

    Unmapped columns drop out; rows without time are dropped.
    """
    m = bounded_broadcast(mapping.select(key, "location", "data_key"), max_broadcast_rows)
    return (df.filter(F.col(time_col).isNotNull()).join(m, key, "inner")
              .select(F.col(time_col).alias("time"), "location", "data_key", "data_value", *carry))


def map_sensors(df: DataFrame, mapping_indoor: DataFrame, sensor_col: str = "Location",
                max_broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Sensor id -> location (several sensors may share one location)."""
    m = bounded_broadcast(mapping_indoor.select(F.col("sensor").alias("_sensor"), F.col("location").alias("_loc")),
                          max_broadcast_rows)
    out = df.join(m, F.col(f"`{sensor_col}`") == F.col("_sensor"), "inner")
    return out.drop(sensor_col, "_sensor").withColumnRenamed("_loc", "location")


def with_scalar(df: DataFrame, params: DataFrame) -> DataFrame:
    """Attach a one-row parameter frame to every row.

    Each parameter becomes an uncorrelated scalar subquery (evaluated once,
    reduced with ``max`` so it is provably one value); no join is planned.
    """
    return df.withColumns({c: params.select(F.max(c)).scalar() for c in params.columns})


def rename_values(df: DataFrame, mapping: DataFrame, col: str = "location", from_col: str = "from",
                  to_col: str = "to", order_col: str | None = None,
                  max_broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Replace values that have a mapping, keep the others.

    Duplicate ``from`` keys: the last mapping row wins (``order_col`` gives the
    row order; without it the greatest target is taken, deterministically).
    """
    win = F.max_by(F.col(to_col), F.col(order_col)) if order_col else F.max(F.col(to_col))
    m = mapping.groupBy(F.col(from_col).alias("_from")).agg(win.alias("_to"))
    m = bounded_broadcast(m, max_broadcast_rows)
    out = df.join(m, F.col(col) == F.col("_from"), "left")
    return out.withColumn(col, F.coalesce(F.col("_to"), F.col(col))).drop("_from", "_to")


def attach_source(df: DataFrame, mapping_sources: DataFrame, file_col: str = "file_nm",
                  max_broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Source name by originating file."""
    m = bounded_broadcast(mapping_sources.select(F.col("file_nm").alias("_f"), F.col("source_nm").alias("source")),
                          max_broadcast_rows)
    return df.join(m, F.col(file_col) == F.col("_f"), "inner").drop("_f")


def unmapped(df: DataFrame, mapping: DataFrame, key: str = "data_key_original",
             max_broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """The rows an inner map join would lose."""
    return df.join(bounded_broadcast(mapping.select(key), max_broadcast_rows), key, "left_anti")


def mapped_only(df: DataFrame, mapping: DataFrame, key: str = "data_key_original",
                max_broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Same test, no columns added."""
    return df.join(bounded_broadcast(mapping.select(key), max_broadcast_rows), key, "left_semi")


def star_join(fct: DataFrame, dims: Sequence[tuple[DataFrame, str]],
              max_broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Fact to each (dimension, surrogate key column)."""
    out = fct
    for dim, key in dims:
        out = out.join(bounded_broadcast(dim, max_broadcast_rows), key, "inner")
    return out


def as_at(fct: DataFrame, dim: DataFrame, key: Sequence[str], time_col: str = "time",
          from_col: str = "effective_from", to_col: str = "effective_to", attrs: Sequence[str] | None = None,
          bucket: str = "day", cut_lineage: bool = False,
          max_broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """The dimension version valid at each reading's time (inner).

    The latest version with ``from <= t``, followed by the ``t < to`` test.
    A dimension proven small, with at most ``MAX_VERSIONS`` versions of a
    key, is broadcast as one list of versions per key and the readings are
    not shuffled. Any other goes through an as-of join on the natural key.
    Neither forms reading x version pairs; results are the same.
    """
    from sensorlake.operators.windows import asof_join
    key = list(key)
    attrs = list(attrs) if attrs is not None else [c for c in dim.columns if c not in key]
    cols = list(dict.fromkeys([from_col, to_col, *attrs]))
    if max_broadcast_rows is not None:
        dim = materialize(dim.select(*key, *cols))
        most = dim.groupBy(*key).agg(F.count("*").alias("n")).agg(F.max("n").alias("n")).first()["n"] or 0
        if most <= MAX_VERSIONS and proven_small(dim, max_broadcast_rows):
            lists = dim.groupBy(*key).agg(F.collect_list(F.struct(*cols)).alias("_versions"))
            own = [c for c in fct.columns if c not in cols]
            hit = fct.join(F.broadcast(lists), key, "inner").withColumn(
                "_v", F.array_max(F.filter("_versions", lambda v: v[from_col] <= F.col(time_col))))
            hit = hit.filter(F.col(f"_v.{to_col}").isNull() | (F.col(time_col) < F.col(f"_v.{to_col}")))
            return hit.filter(F.col("_v").isNotNull()).select(*own, *[F.col(f"_v.{c}").alias(c) for c in cols])
    out = asof_join(fct, dim, key, time_col, from_col, cols, bucket=bucket, cut_lineage=cut_lineage)
    return out.filter(F.col(from_col).isNotNull() & (F.col(to_col).isNull() | (F.col(time_col) < F.col(to_col))))


def orphans(fct: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Fact rows whose key is missing from the dimension."""
    dim_key = dim_key or key
    return fct.join(dim.select(F.col(dim_key).alias("_k")), F.col(key) == F.col("_k"), "left_anti")


def latest_period_asof(requested: DataFrame, available: DataFrame, period_col: str = "period",
                       by: Sequence[str] = (), bucket: str = "year") -> DataFrame:
    """For each requested period, the latest available period <= it
    (NULL when there is none). ``available`` is reduced to distinct periods
    first; the lookup is an as-of join (no non-equi join)."""
    from sensorlake.operators.windows import asof_join
    by = list(by)
    av = available.select(*by, F.col(period_col).alias("resolved")).distinct()
    req = requested.select(*by, period_col)
    if not by:
        req, av = req.withColumn("_all", F.lit(0)), av.withColumn("_all", F.lit(0))
    keys = by or ["_all"]
    out = asof_join(req, av, keys, period_col, "resolved", ["resolved"], bucket=bucket)
    return out.drop("_all") if not by else out
