"""Projections and reshaping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def all_to_string(df: DataFrame) -> DataFrame:
    """Every column as text, so one unpivot can hold them all."""
    return df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def wide_to_narrow(df: DataFrame, ids: Sequence[str] = ("date",), name: str = "data_key_original",
                   value: str = "data_value", columns: Sequence[str] | None = None,
                   keep_nulls: bool = False) -> DataFrame:
    """Unpivot every non-id column (or only ``columns``); NULL cells vanish.

    Passing ``columns`` (e.g. the mapped names of a signal map, read on the
    driver) keeps unmapped signals from ever being expanded.
    """
    ids = list(ids)
    values = [c for c in (columns if columns is not None else df.columns) if c not in ids]
    out = df.unpivot([F.col(f"`{c}`") for c in ids], [F.col(f"`{c}`") for c in values], name, value)
    return out if keep_nulls else out.filter(F.col(value).isNotNull())


def stack_columns(df: DataFrame, mapping: Mapping[str, str], ids: Sequence[str],
                  name: str = "data_key", value: str = "data_value") -> DataFrame:
    """One row per (id, mapped column) with the mapped key; NULLs kept."""
    values = [F.col(f"`{c}`").alias(k) for c, k in mapping.items()]
    return df.unpivot([F.col(f"`{c}`") for c in ids], values, name, value)


def rename_map(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns that are present; others are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


# Column names of the time-series point format (to and from the warehouse names).
TO_POINT = {"time": "_time", "data_key": "quantity", "data_value": "_value"}
FROM_POINT = {"_time": "time", "quantity": "data_key", "_value": "data_value", "_measurement": "measurement"}


def tag(df: DataFrame, **consts) -> DataFrame:
    """Add constant columns."""
    return df.withColumns({k: F.lit(v) for k, v in consts.items()})


def conform(df: DataFrame, cols: Sequence[str], types: Mapping[str, T.DataType | str] | None = None) -> DataFrame:
    """Fixed column order; absent columns appear as typed NULLs."""
    types = dict(types or {})
    out = []
    for c in cols:
        if c in df.columns:
            e = F.col(f"`{c}`")
            if c in types:
                e = e.cast(types[c])
        else:
            e = F.lit(None).cast(types.get(c, "string"))
        out.append(e.alias(c))
    return df.select(out)


def keep(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Column pruning."""
    return df.select([F.col(f"`{c}`") for c in cols])


def measure_columns_to_facts(df: DataFrame, measures: Mapping[str, str], time_col: str = "Datetime",
                             location_col: str = "Location", carry: Sequence[str] = ()) -> DataFrame:
    """One measure column per fact key -> (time, location, data_key, data_value, carried columns).

    Both facts come from one scan (one Expand); rows without time are dropped,
    NULL values are kept.
    """
    out = stack_columns(df, measures, [time_col, location_col, *carry])
    return (out.filter(F.col(f"`{time_col}`").isNotNull())
               .select(F.col(f"`{time_col}`").alias("time"), F.col(f"`{location_col}`").alias("location"),
                       "data_key", F.col("data_value").cast("double").alias("data_value"), *carry))
