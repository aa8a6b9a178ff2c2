"""Star schema and slowly changing dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.functions.quality import flags, surrogate
from sensorlake.functions.time import ts_literal
from sensorlake.operators.filters import retention_start
from sensorlake.operators.quality import RowRule
from sensorlake.operators.util import DEFAULT_BROADCAST_ROWS, bounded_broadcast
from sensorlake.operators.windows import carry_forward


def stage(df: DataFrame, m: Mapping, as_of=None) -> DataFrame:
    """Templated staging from one mapping row.

    Keys: timestamp_column, location_column (may be empty -> the
    datasource's ``location`` literal), measurement_column, value_column,
    source_name, value_min, value_max, retention_months.
    """
    loc = F.col(m["location_column"]).cast("string") if m.get("location_column") else F.lit(m.get("location"))
    out = df.select(
        F.col(m["timestamp_column"]).cast("timestamp_ntz").alias("time"),
        loc.alias("location"),
        F.col(m["measurement_column"]).cast("string").alias("data_key"),
        F.col(m["value_column"]).cast("double").alias("data_value"),
        F.lit(m["source_name"]).alias("source"),
    )
    cond = F.col("time").isNotNull() & F.col("data_value").between(m["value_min"], m["value_max"])
    if m.get("retention_months"):
        cond = cond & (F.col("time") >= retention_start(int(m["retention_months"]), as_of))
    if as_of is not None:
        cond = cond & (F.col("time") <= ts_literal(as_of))
    return out.filter(cond)


def stage_from_table(frames: Mapping[str, DataFrame], mappings: DataFrame, as_of=None,
                     id_col: str = "datasource_id") -> DataFrame:
    """M01 over a mapping table: one staged frame per datasource row, unioned.

    The mapping table is configuration (one row per datasource), read on the
    driver; datasources without a frame are skipped."""
    rows = mappings.collect()
    staged = [stage(frames[r[id_col]], r.asDict(), as_of).withColumn(id_col, F.lit(r[id_col]))
              for r in rows if r[id_col] in frames]
    if not staged:
        raise ValueError("no datasource of the mapping table has input")
    out = staged[0]
    for f in staged[1:]:
        out = out.unionByName(f)
    return out


def dim(df: DataFrame, natural_key: Sequence[str], attrs: Sequence[str] = (), key_col: str = "key") -> DataFrame:
    """Distinct natural keys (+ attributes) with a deterministic surrogate key."""
    nk = list(natural_key)
    d = df.select(*nk, *attrs).distinct() if not attrs else \
        df.groupBy(*nk).agg(*[F.max(a).alias(a) for a in attrs])
    return d.withColumn(key_col, surrogate(*nk))


def fct_sensor_readings(staged: DataFrame, dims: Sequence[tuple[DataFrame, Sequence[str], str]],
                        rules: Sequence[RowRule] = (), max_broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Staged rows with dimension keys looked up, quality flags and a date partition column.

    ``dims`` = [(dimension, natural key columns, surrogate column)].
    """
    out = staged
    for d, nk, key in dims:
        out = out.join(bounded_broadcast(d.select(*nk, key), max_broadcast_rows), list(nk), "left")
    out = out.withColumn("quality_flags", flags(*[r.fails for r in rules]) if rules else F.lit(0))
    return out.withColumn("date", F.to_date("time"))


def scd2(changes: DataFrame, key: Sequence[str], attrs: Sequence[str], time_col: str = "time",
         bucket: str = "month", cut_lineage: bool = False) -> DataFrame:
    """effective_from / effective_to intervals per key; consecutive
    observations with unchanged attributes collapse into one version.

    Several observations of one key at the same instant: the greatest
    attribute set (field by field) is taken. Both neighbour lookups use
    ``carry_forward`` (bucketed windows plus a per-bucket carry), so a key
    with a very long history is never sorted in one task. No job runs while
    the plan is built: the summary branches repeat the exchange of the rows,
    which adaptive execution runs once. ``cut_lineage`` stores the windowed
    frames instead.
    """
    key = list(key)
    a = F.struct(*[F.col(c) for c in attrs])
    x = (changes.select(*key, F.col(time_col).alias("_t"), a.alias("_a"))
                .groupBy(*key, "_t").agg(F.max("_a").alias("_a")))
    prev = carry_forward(x, key, "_t", "_a", "_prev", bucket=bucket, inclusive=False, cut_lineage=cut_lineage)
    starts = prev.filter(F.col("_prev").isNull() | (F.col("_prev") != F.col("_a"))).select(*key, "_t", "_a")
    # end of a version = start of the next one, carried backwards in time
    nxt = carry_forward(starts.withColumn("_tv", F.col("_t")), key, "_t", "_tv", "effective_to",
                        bucket=bucket, inclusive=False, descending=True, cut_lineage=cut_lineage)
    return nxt.select(*key, *[F.col(f"_a.{c}").alias(c) for c in attrs], F.col("_t").alias("effective_from"),
                      "effective_to", F.col("effective_to").isNull().alias("is_current"))


def add_tenant(df: DataFrame, building: str, col: str = "building") -> DataFrame:
    """A building key as the first column, so one table holds several buildings."""
    return df.select(F.lit(building).alias(col), *df.columns)
