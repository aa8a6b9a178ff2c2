"""The driver's Parquet tables and the views derived from them.

Each view has a Spark form and the same expression as SQL text for the
oracle, kept side by side so they cannot drift apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

# Fixed as_of used by every time-dependent query (repeatable results).
AS_OF = "2001-08-15 12:00:00"
AS_OF_EVENTS = "2024-01-20 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str, nulls: bool = False) -> DataFrame:
    """events as sensor points: (time, location, source, data_key, measurement, data_value)."""
    ev = table(spark, sf_dir, "events")
    uid = F.col("user_id")
    # Values in hundredths (integer-valued doubles): sums and means are then
    # exact and bit-identical in any engine, whatever the summation order.
    hundredths = F.round(F.col("value") * 100)
    value = F.when(F.col("event_id") % 17 == 0, F.lit(None).cast("double")).otherwise(hundredths) \
        if nulls else hundredths
    return ev.select(
        F.col("ts").alias("time"),
        F.concat((uid % 5 + 1).cast("string"), F.lit("NP-S"), (uid % 9 + 1).cast("string")).alias("location"),
        F.when(uid % 2 == 0, F.lit("A")).otherwise(F.lit("B")).alias("source"),
        F.col("event_type").alias("data_key"),
        F.when(F.col("event_type").isin("purchase", "click"), F.lit("additive"))
         .otherwise(F.lit("nonadditive")).alias("measurement"),
        value.alias("data_value"),
    )


READINGS_SQL = """(SELECT ts AS time,
  concat(CAST(user_id % 5 + 1 AS VARCHAR), 'NP-S', CAST(user_id % 9 + 1 AS VARCHAR)) AS location,
  CASE WHEN user_id % 2 = 0 THEN 'A' ELSE 'B' END AS source,
  event_type AS data_key,
  CASE WHEN event_type IN ('purchase','click') THEN 'additive' ELSE 'nonadditive' END AS measurement,
  round(value * 100) AS data_value
FROM events)"""

READINGS_NULLS_SQL = READINGS_SQL.replace(
    "round(value * 100) AS data_value", "CASE WHEN event_id % 17 = 0 THEN NULL ELSE round(value * 100) END AS data_value")


def sql_with(sql: str, **views: str) -> str:
    """Prefix ``WITH name AS (...)`` clauses (views given as SQL bodies)."""
    if not views:
        return sql
    ctes = ",\n".join(f"{k} AS {v if v.strip().startswith('(') else '(' + v + ')'}" for k, v in views.items())
    return f"WITH {ctes}\n{sql}"
