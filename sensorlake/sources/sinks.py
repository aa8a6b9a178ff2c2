"""Writers (S09-S12, S19)."""

from __future__ import annotations

import datetime as _dt
import warnings
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.functions.time import year_month
from sensorlake.operators.ordering import public_order
from sensorlake.schemas import PUBLIC_COLS
from sensorlake.session import materialize

TS_TEXT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


def write_fact(df: DataFrame, root: str, version: str | None = None) -> str:
    """Write a new version of the fact table under ``root/version=...``.

    Spark cannot overwrite a path it is reading, and the fact is merged
    with its own previous version, so every run appends a new version
    partition; readers take the newest (``read_fact_version``).
    """
    version = version or _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    base = root.rstrip("/")
    df.write.mode("overwrite").parquet(f"{base}/version={version}")
    # the marker comes last: a run that dies before it leaves no version for readers
    df.sparkSession.createDataFrame([(version,)], "done string").write.mode("append").parquet(f"{base}/_versions")
    return version


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``; None if nothing was ever written there. Any other error is raised."""
    try:
        return spark.read.parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def newest_version(spark: SparkSession, root: str) -> str | None:
    done = stored(spark, f"{root.rstrip('/')}/_versions")
    return None if done is None else done.agg(F.max("done").alias("v")).first()["v"]


def read_fact_version(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """Newest finished (or the named) fact version."""
    version = version or newest_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no finished fact version under {root}")
    return spark.read.parquet(f"{root.rstrip('/')}/version={version}")


def write_monthly(df: DataFrame, path: str, fmt: str = "parquet", time_col: str = "time") -> None:
    """One output per (measurement, YYYY-MM); only months present are
    rewritten (dynamic partition overwrite).

    The rebalance hint gathers a month's rows, and lets Spark split a month
    that is larger than the advisory partition size over several tasks.
    """
    out = df.withColumn("year_month", year_month(time_col))
    w = (out.hint("rebalance", "measurement", "year_month").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("measurement", "year_month"))
    if fmt == "csv":
        w.option("header", True).option("timestampNTZFormat", TS_TEXT).csv(path)
    else:
        w.parquet(path)


write_raw_monthly = write_monthly


def write_public(df: DataFrame, out_dir: str, sort: bool = True) -> dict:
    """Sorted public table as gzip CSV and Parquet; a Parquet failure is
    only a warning (the CSV is the primary product). The table is computed
    once and both are written from the stored result."""
    data = materialize(public_order(df.select(PUBLIC_COLS)) if sort else df.select(PUBLIC_COLS))
    csv_path = f"{out_dir.rstrip('/')}/public_csv"
    pq_path = f"{out_dir.rstrip('/')}/public_parquet"
    (data.write.mode("overwrite").option("header", True).option("compression", "gzip")
         .option("timestampNTZFormat", TS_TEXT).csv(csv_path))
    written = {"csv": csv_path}
    try:
        data.write.mode("overwrite").parquet(pq_path)
        written["parquet"] = pq_path
    except Exception as e:  # pragma: no cover - reported, not raised
        warnings.warn(f"parquet not written: {e}")
    return written


def write_multi_grain(frames: Mapping[str, DataFrame | Callable[[DataFrame], DataFrame]], out_dir: str,
                      source: DataFrame | None = None) -> dict:
    """A set of Parquet tables (raw / hourly / monthly / hierarchy...).

    With ``source`` a table may be given as a function of it; the source is
    then computed once for all tables.
    """
    if source is not None:
        source = materialize(source)
    paths = {}
    for name, df in frames.items():
        p = f"{out_dir.rstrip('/')}/{name}"
        (df(source) if callable(df) else df).write.mode("overwrite").parquet(p)
        paths[name] = p
    return paths
