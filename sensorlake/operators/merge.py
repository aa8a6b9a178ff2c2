"""Set operations, dedup and upsert."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.schemas import FACT_COLS
from sensorlake.session import scratch_path


def _conformed(df: DataFrame, cols: Sequence[str], types: Mapping[str, str] | None) -> DataFrame:
    types = types or {}
    return df.select([F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in cols])


def merge_history(new: DataFrame, old: DataFrame, cols: Sequence[str] = FACT_COLS,
                  value_type: str = "double", value_col: str = "data_value", incremental: bool = False,
                  time_col: str = "time") -> DataFrame:
    """UNION DISTINCT of new facts and the previous fact table.

    Both sides are cast to one value type *before* the union (quirk K1):
    ``double`` (default) makes `21.5` and `21.50` one row, ``string`` keeps
    them apart as the text-typed original does. Distinct = one hash
    aggregate with map-side partial dedup.

    ``incremental=True`` is for a history that is this operator's own earlier
    output (already distinct): only the months the load touches are
    deduplicated with it, all other months pass through without a shuffle.
    The load is computed once, when this is called: its distinct rows are
    stored, since its months are looked up first. The result does not depend
    on the size of either side.
    """
    types = {value_col: value_type}
    n = _conformed(new, cols, types)
    o = _conformed(old, cols, types)
    if not incremental:
        return n.unionByName(o).distinct()
    load = scratch_path(n.sparkSession, "merge-load")
    n.distinct().write.parquet(load)
    n = n.sparkSession.read.schema(n.schema).parquet(load)
    # a month as a number, which costs less than its text; facts without a time are a month of their own
    month = F.coalesce(F.year(time_col) * 12 + F.month(time_col), F.lit(-1))
    touched = F.broadcast(n.select(month.alias("_touched")).distinct())
    same = month == F.col("_touched")
    again = n.unionByName(o.join(touched, same, "left_semi")).distinct()
    return again.unionByName(o.join(touched, same, "left_anti"))


def merge_loads(new: DataFrame, old: DataFrame | None, cols: Sequence[str] = FACT_COLS, seq_col: str = "load_seq") -> DataFrame:
    """U01 that keeps the write order: UNION DISTINCT of facts, each with the latest ``load_seq`` it was written with."""
    both = new.select(*cols, seq_col) if old is None else new.select(*cols, seq_col).unionByName(old.select(*cols, seq_col))
    return both.groupBy(*cols).agg(F.max(seq_col).alias(seq_col))


def last_written(facts: DataFrame, key: Sequence[str] = ("time", "location", "data_key"), value_col: str = "data_value",
                 seq_col: str = "load_seq") -> DataFrame:
    """One row per point: the value written last. Equal write orders (one file read twice) go to the larger value."""
    return facts.groupBy(*key).agg(F.max_by(F.struct(value_col), F.struct(seq_col, value_col)).alias("_v")).select(*key, f"_v.{value_col}")


def concat(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by name; missing columns become NULL."""
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_sources(frames: Mapping[str, DataFrame], tag_col: str = "source") -> DataFrame:
    """Several sources of one shape, each tagged with a literal."""
    return concat([df.withColumn(tag_col, F.lit(name)) for name, df in frames.items()])


def schema_diff(spark: SparkSession, expected: T.StructType | Sequence[str], actual: DataFrame,
                extra_severity: str = "warn") -> DataFrame:
    """Missing / unexpected columns as a table (column, issue, severity).

    Built on the driver from two schemas (metadata only, no data read).
    """
    exp = [f.name for f in expected.fields] if isinstance(expected, T.StructType) else list(expected)
    act = list(actual.columns)
    rows = [(c, "missing", "error") for c in exp if c not in act]
    rows += [(c, "unexpected", extra_severity) for c in act if c not in exp]
    return spark.createDataFrame(rows, "column string, issue string, severity string")


def compare(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows only in ``a`` or only in ``b`` (multiset), tagged with the side.

    One aggregate over both sides: copies in ``a`` count up, copies in ``b`` down.
    """
    cols = a.columns
    signed = a.withColumn("_n", F.lit(1).cast("long")).unionByName(b.select(cols).withColumn("_n", F.lit(-1).cast("long")))
    left = signed.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.sum("_n").alias("_n")).filter("_n <> 0")
    each = left.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.abs("_n"))))
    return each.select(*[F.col(f"`{c}`") for c in cols], F.when(F.col("_n") > 0, "only_a").otherwise("only_b").alias("side"))


def upsert(base: DataFrame, delta: DataFrame | None, key: Sequence[str], order: Sequence[str],
           seq_col: str = "_write_seq") -> DataFrame:
    """One row per key -- the latest write wins.

    ``order`` are columns giving write order (larger = later); ``delta`` rows
    come after all ``base`` rows. Implemented as ``max_by`` over a struct in
    a hash aggregate rather than ``row_number``: partial aggregation keeps
    only one row per key in each map task, so a key with millions of copies
    never lands whole in one task.
    """
    key = list(key)
    frames = [base.withColumn(seq_col, F.lit(0))]
    if delta is not None:
        frames.append(delta.withColumn(seq_col, F.lit(1)))
    both = functools.reduce(lambda x, y: x.unionByName(y), frames)
    rest = [c for c in base.columns if c not in key]
    ordering = F.struct(F.col(seq_col), *[F.col(c) for c in order])
    agg = both.groupBy(*key).agg(F.max_by(F.struct(*[F.col(c) for c in rest]), ordering).alias("_w"))
    return agg.select(*key, *[F.col(f"_w.{c}").alias(c) for c in rest])
