"""Driver-table queries: quality gates (Q01-Q16, A05/A07 forms)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorlake.operators import aggregates as ag
from sensorlake.operators import quality as qa
from sensorlake.plans.registry import register
from sensorlake.plans.tables import AS_OF_EVENTS, READINGS_NULLS_SQL, READINGS_SQL, readings, sql_with, table

R, RN = READINGS_SQL, READINGS_NULLS_SQL
COLS = "time, location, source, data_key, measurement, data_value"


def _w(sql, nulls=False):
    return sql_with(sql, readings=RN if nulls else R)


@register("not_null", _w("SELECT * FROM readings WHERE data_value IS NULL", nulls=True))
def q_not_null(spark, d):
    return qa.not_null(readings(spark, d, nulls=True), "data_value")


@register("accepted_values", _w("SELECT * FROM readings WHERE data_key IS NOT NULL AND data_key NOT IN "
                                "('purchase', 'click', 'view')"))
def q_accepted_values(spark, d):
    return qa.accepted_values(readings(spark, d), "data_key", ["purchase", "click", "view"])


@register("unique_key", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber "
          "HAVING count(*) > 1")
def q_unique_key(spark, d):
    return qa.unique_key(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("duplicate_timestamps", "SELECT l_shipdate AS time, CAST(l_suppkey AS VARCHAR) AS location, count(*) AS n, "
          "count(*) - 1 AS extra FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def q_duplicate_timestamps(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_shipdate").alias("time"),
                                           F.col("l_suppkey").cast("string").alias("location"))
    return qa.duplicate_timestamps(li)


@register("future_rows", "SELECT o_orderkey, o_orderdate AS time FROM orders WHERE o_orderdate > TIMESTAMP '2001-01-01'")
def q_future_rows(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").alias("time"))
    return qa.future_rows(o, "2001-01-01")


@register("null_ratio", _w(
    "SELECT source, 'data_value' AS column, count(*) FILTER (WHERE data_value IS NULL) AS null_count, count(*) AS total, "
    "count(*) FILTER (WHERE data_value IS NULL) / count(*) AS null_ratio, CASE WHEN count(*) FILTER (WHERE data_value "
    "IS NULL) / count(*) > 0.05 THEN 'fail' ELSE 'pass' END AS status FROM readings GROUP BY source UNION ALL "
    "SELECT source, 'location', count(*) FILTER (WHERE location IS NULL), count(*), count(*) FILTER (WHERE location "
    "IS NULL) / count(*), CASE WHEN count(*) FILTER (WHERE location IS NULL) / count(*) > 0.05 THEN 'fail' ELSE "
    "'pass' END FROM readings GROUP BY source", nulls=True))
def q_null_ratio(spark, d):
    return qa.null_ratio(readings(spark, d, nulls=True), ["data_value", "location"], 0.05, by=["source"])


@register("row_count_between", _w("SELECT count(*) AS row_count, 100 AS min_rows, 100000 AS max_rows, CASE WHEN "
                                  "count(*) BETWEEN 100 AND 100000 THEN 'pass' ELSE 'fail' END AS status FROM readings"))
def q_row_count_between(spark, d):
    return qa.row_count_between(readings(spark, d), 100, 100000)


@register("row_count_between_sources", _w(
    "SELECT source, count(*) AS row_count, CASE source WHEN 'A' THEN 100 WHEN 'B' THEN 50 END AS min_rows, "
    "CAST(CASE source WHEN 'A' THEN 100000 WHEN 'B' THEN 2000 END AS BIGINT) AS max_rows, CASE WHEN count(*) BETWEEN CASE source WHEN "
    "'A' THEN 100 WHEN 'B' THEN 50 END AND CASE source WHEN 'A' THEN 100000 WHEN 'B' THEN 2000 END THEN 'pass' ELSE "
    "'fail' END AS status FROM readings GROUP BY source"))
def q_row_count_between_sources(spark, d):
    """Per-source expected volumes (one source's upper bound is exceeded)."""
    return qa.row_count_between(readings(spark, d), {"A": 100, "B": 50}, {"A": 100000, "B": 2000}, by=["source"])


@register("value_between", _w("SELECT * FROM readings WHERE data_value IS NOT NULL AND NOT (data_value BETWEEN 100 "
                              "AND 9000)", nulls=True))
def q_value_between(spark, d):
    return qa.value_between(readings(spark, d, nulls=True), "data_value", 100, 9000)


@register("null_ratio_sources", _w(
    "SELECT source, 'data_value' AS column, count(*) FILTER (WHERE data_value IS NULL) AS null_count, count(*) AS total, "
    "count(*) FILTER (WHERE data_value IS NULL) / count(*) AS null_ratio, CASE WHEN count(*) FILTER (WHERE data_value "
    "IS NULL) / count(*) > CASE source WHEN 'A' THEN 0.05 WHEN 'B' THEN 0.07 END THEN 'fail' ELSE 'pass' END AS status "
    "FROM readings GROUP BY source", nulls=True))
def q_null_ratio_sources(spark, d):
    """Per-source NULL limits (5 % and 7 %)."""
    return qa.null_ratio(readings(spark, d, nulls=True), ["data_value"], {"A": 0.05, "B": 0.07}, by=["source"])


@register("row_count_reconcile", _w("SELECT s.n AS source_rows, l.n AS landed_rows, l.n - s.n AS diff, CASE WHEN "
                                    "l.n = s.n THEN 'pass' ELSE 'fail' END AS status FROM (SELECT count(*) AS n FROM "
                                    "events) s, (SELECT count(*) AS n FROM readings) l"))
def q_row_count_reconcile(spark, d):
    return qa.row_count_reconcile(table(spark, d, "events"), readings(spark, d))


@register("freshness", _w(
    f"SELECT source, max(time) AS max_loaded_at, (epoch_us(TIMESTAMP '{AS_OF_EVENTS}') - epoch_us(max(time))) / 1e6 "
    "AS age_seconds, CASE WHEN (epoch_us(TIMESTAMP '" + AS_OF_EVENTS + "') - epoch_us(max(time))) / 1e6 > 7 * 86400 "
    "THEN 'warn' ELSE 'pass' END AS status FROM readings WHERE time < TIMESTAMP '2024-01-10' OR source = 'A' "
    "GROUP BY source"))
def q_freshness(spark, d):
    r = readings(spark, d).filter((F.col("time") < F.lit("2024-01-10").cast("timestamp_ntz")) | (F.col("source") == "A"))
    return ag.freshness(r, "time", AS_OF_EVENTS, warn_after_days=7, by=["source"])


DQ_SQL = ("(SELECT CAST(time AS DATE) AS day, source, location, count(*) AS row_count, round(100.0 * count(*) FILTER "
          "(WHERE data_value IS NULL) / count(*), 2) AS null_pct, avg(data_value) AS avg_value, "
          "stddev_samp(data_value) AS std_value FROM readings GROUP BY 1, source, location)")


@register("anomalies", _w(
    "SELECT source, location, day, 'volume_drop' AS anomaly, CAST(row_count AS DOUBLE) AS observed FROM (SELECT *, "
    "lag(row_count) OVER (PARTITION BY source, location ORDER BY day) AS prev FROM " + DQ_SQL + " m) x WHERE "
    "row_count < prev * 0.5 UNION ALL SELECT source, location, day, 'null_pct', null_pct FROM " + DQ_SQL + " m WHERE "
    "null_pct > 10 UNION ALL SELECT source, location, day, 'high_stddev', round(std_value, 6) FROM " + DQ_SQL + " m "
    "WHERE std_value > 2 * avg_value", nulls=True))
def q_anomalies(spark, d):
    r = readings(spark, d, nulls=True)
    m = ag.daily_quality(r, by=["source", "location"])
    out = qa.anomalies(m, by=["source", "location"])
    return out.withColumn("observed", F.round("observed", 6))


RULES_SQL = [
    ("not_null_time", "time IS NULL", "error", 0),
    ("accepted_measurement", "measurement IS NOT NULL AND measurement NOT IN ('additive', 'nonadditive')", "error", 0),
    ("value_between", "data_value IS NOT NULL AND NOT (data_value BETWEEN 100 AND 9000)", "warn", 0),
    ("null_value", "data_value IS NULL", "warn", 0),
    ("future_rows", f"time > TIMESTAMP '{AS_OF_EVENTS}'", "error", 0),
]


def _status(f, sev, thr):
    return f"CASE WHEN {f} <= {thr} THEN 'pass' WHEN '{sev}' = 'error' THEN 'fail' ELSE 'warn' END"


@register("quality_report", _w(" UNION ALL ".join(
    f"SELECT '{n}' AS rule, count(*) FILTER (WHERE {c}) AS failures, '{s}' AS severity, {t} AS threshold, "
    + _status(f"count(*) FILTER (WHERE {c})", s, t) + " AS status FROM readings" for n, c, s, t in RULES_SQL)
    + " UNION ALL SELECT 'unique_key', count(*), 'error', 0, " + _status("count(*)", "error", 0)
    + " FROM (SELECT time, location, data_key, source FROM readings GROUP BY ALL HAVING count(*) > 1) k", nulls=True))
def q_quality_report(spark, d):
    r = readings(spark, d, nulls=True)
    rules = qa.standard_row_rules(AS_OF_EVENTS, 100, 9000)
    keys = {"unique_key": (qa.unique_key(r, ["time", "location", "data_key", "source"]), "error", 0)}
    return qa.quality_report(r, rules, keys)


@register("flag_quality", _w(
    "SELECT *, " + " + ".join(f"CASE WHEN {c} THEN {1 << k} ELSE 0 END" for k, (n, c, s, t) in enumerate(RULES_SQL))
    + " AS quality_flags FROM readings", nulls=True))
def q_flag_quality(spark, d):
    return qa.flag_quality(readings(spark, d, nulls=True), qa.standard_row_rules(AS_OF_EVENTS, 100, 9000))


@register("quality_gate", _w(
    "SELECT CASE WHEN count(*) FILTER (WHERE data_value IS NOT NULL AND NOT (data_value BETWEEN 100 AND 9000)) > 0 "
    "THEN 'fail' ELSE 'pass' END AS gate FROM readings", nulls=True))
def q_quality_gate(spark, d):
    r = readings(spark, d, nulls=True)
    rules = [qa.RowRule("value_between", F.col("data_value").isNotNull() & ~F.col("data_value").between(100, 9000))]
    return qa.gate(qa.quality_report(r, rules))
