"""Driver-table queries: aggregations, windows, sorts over the readings view."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from sensorlake.functions.time import trunc
from sensorlake.operators import aggregates as ag
from sensorlake.operators import ordering as od
from sensorlake.operators import windows as wn
from sensorlake.plans.registry import register
from sensorlake.plans.tables import READINGS_NULLS_SQL, READINGS_SQL, readings, sql_with, table

R = READINGS_SQL
RN = READINGS_NULLS_SQL
SERIES = "measurement, location, source, data_key"


def _w(sql: str, nulls: bool = False) -> str:
    return sql_with(sql, readings=RN if nulls else R)


@register("resample", _w(
    "SELECT date_trunc('hour', time) + INTERVAL 1 HOUR AS time, " + SERIES + ", CASE WHEN measurement = 'additive' "
    "THEN sum(data_value) ELSE avg(data_value) END AS data_value FROM readings WHERE time IS NOT NULL AND "
    "data_value IS NOT NULL GROUP BY date_trunc('hour', time), " + SERIES, nulls=True))
def q_resample(spark, d):
    return ag.resample(readings(spark, d, nulls=True), "1 hour", label="end")


@register("resample_start", _w(
    "SELECT date_trunc('day', time) AS time, " + SERIES + ", CASE WHEN measurement = 'additive' "
    "THEN sum(data_value) ELSE avg(data_value) END AS data_value FROM readings WHERE data_value IS NOT NULL "
    "GROUP BY date_trunc('day', time), " + SERIES))
def q_resample_start(spark, d):
    return ag.resample(readings(spark, d), "1 day", label="start")


@register("resample_drop_last", _w(
    "SELECT least(date_trunc('hour', r.time) + INTERVAL 1 HOUR, max(n.newest)) AS time, "
    + ", ".join(f"r.{c}" for c in SERIES.split(", "))
    + ", CASE WHEN r.measurement = 'additive' THEN sum(r.data_value) ELSE avg(r.data_value) END AS data_value "
    "FROM readings r JOIN (SELECT measurement, max(time) AS newest FROM readings WHERE data_value IS NOT NULL "
    "GROUP BY measurement) n ON r.measurement = n.measurement WHERE r.time < n.newest AND r.data_value IS NOT NULL "
    "GROUP BY date_trunc('hour', r.time), " + ", ".join(f"r.{c}" for c in SERIES.split(", "))))
def q_resample_drop_last(spark, d):
    return ag.resample(readings(spark, d), "1 hour", label="end", drop_last=True)


GRAINS = ["hour", "day", "week", "month"]


@register("multi_grain", _w(" UNION ALL ".join(
    f"SELECT '{g}' AS grain, date_trunc('{g}', time) AS period, location, data_key, avg(data_value) AS mean, "
    f"round(stddev_samp(data_value), 6) AS std, count(data_value) AS n FROM readings "
    f"GROUP BY date_trunc('{g}', time), location, data_key" for g in GRAINS), nulls=True))
def q_multi_grain(spark, d):
    out = ag.multi_grain(readings(spark, d, nulls=True), GRAINS, series=["location", "data_key"])
    return out.withColumn("std", F.round("std", 6))


@register("time_span", _w("SELECT measurement, min(time) AS time_min, max(time) AS time_max FROM readings "
                          "GROUP BY measurement"))
def q_time_span(spark, d):
    return ag.time_span(readings(spark, d))


@register("first_last", _w("SELECT source, measurement, min(time) AS first_time, max(time) AS last_time FROM readings "
                           "GROUP BY source, measurement"))
def q_first_last(spark, d):
    return od.first_last(readings(spark, d), by=["source", "measurement"])


@register("envelope", _w(
    "SELECT date_trunc('day', time) AS period, CASE WHEN data_key = 'view' THEN '*' ELSE location END AS location, "
    "data_key, max(data_value) AS max_value, avg(data_value) AS avg_value, min(data_value) AS min_value FROM readings "
    "GROUP BY 1, 2, data_key", nulls=True))
def q_envelope(spark, d):
    return ag.envelope(readings(spark, d, nulls=True), "day", aggregate_location_keys=["view"])


@register("envelope_hour", _w(
    "SELECT date_trunc('hour', time) AS period, data_key, max(data_value) AS max_value, avg(data_value) AS avg_value, "
    "min(data_value) AS min_value FROM readings GROUP BY 1, data_key"))
def q_envelope_hour(spark, d):
    return ag.envelope(readings(spark, d), "hour", line_cols=["data_key"])


@register("latest_value", _w(
    "SELECT " + SERIES + ", time, data_value FROM (SELECT *, row_number() OVER (PARTITION BY " + SERIES
    + " ORDER BY time DESC, data_value DESC) AS rn FROM readings) x WHERE rn = 1"))
def q_latest_value(spark, d):
    return ag.latest_value(readings(spark, d))


@register("hierarchy_rollup", _w(
    "SELECT source, left(location, 3) AS floor, location, GROUPING(source, left(location, 3), location) AS grouping_level, "
    "count(data_value) AS n, avg(data_value) AS avg_value, min(data_value) AS min_value, max(data_value) AS max_value "
    "FROM readings GROUP BY ROLLUP (source, left(location, 3), location)", nulls=True))
def q_hierarchy_rollup(spark, d):
    r = readings(spark, d, nulls=True).withColumn("floor", F.left("location", F.lit(3)))
    return ag.hierarchy_rollup(r, ["source", "floor", "location"])


@register("dataset_profile", _w(
    "SELECT 'rows' AS metric, NULL::VARCHAR AS key, CAST(count(*) AS VARCHAR) AS value FROM readings UNION ALL "
    "SELECT 'time_min', NULL, CAST(min(time) AS VARCHAR) FROM readings UNION ALL "
    "SELECT 'time_max', NULL, CAST(max(time) AS VARCHAR) FROM readings UNION ALL "
    "SELECT 'measurement_rows', measurement, CAST(count(*) AS VARCHAR) FROM readings WHERE measurement IS NOT NULL "
    "GROUP BY measurement UNION ALL SELECT * FROM (SELECT 'top_data_key', data_key, CAST(count(*) AS VARCHAR) FROM "
    "readings WHERE data_key IS NOT NULL GROUP BY data_key ORDER BY count(*) DESC, data_key LIMIT 15)"))
def q_dataset_profile(spark, d):
    return ag.dataset_profile(readings(spark, d))


@register("value_counts", _w("SELECT location, count(*) AS count FROM readings WHERE location IS NOT NULL "
                             "GROUP BY location"))
def q_value_counts(spark, d):
    return ag.value_counts(readings(spark, d), "location")


@register("top_k", _w("SELECT location, count(*) AS count FROM readings WHERE location IS NOT NULL GROUP BY location "
                      "ORDER BY count DESC, location LIMIT 15"))
def q_top_k(spark, d):
    return od.top_k(readings(spark, d), "location", 15)


@register("public_order", _w(
    "SELECT *, row_number() OVER (ORDER BY time NULLS LAST, location NULLS LAST, data_key NULLS LAST, "
    "source NULLS LAST, data_value NULLS LAST, measurement NULLS LAST) AS row_no FROM readings", nulls=True))
def q_public_order(spark, d):
    r = readings(spark, d, nulls=True)
    return od.global_row_number(r, [*od.PUBLIC_SORT, "data_value", "measurement"])


@register("row_number_payload", "SELECT event_id, user_id, event_type, value, row_number() OVER (ORDER BY event_id) AS row_no FROM events")
def q_row_number_payload(spark, d):
    """Numbers of a frame with columns outside its sort key."""
    ev = table(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    return od.global_row_number(ev, ["event_id"])


@register("head_per_series", _w(
    "SELECT *, CAST(row_number() OVER (PARTITION BY " + SERIES + " ORDER BY time, data_value) AS INTEGER) AS rn "
    "FROM readings QUALIFY rn <= 3"))
def q_head_per_series(spark, d):
    return wn.head_per_series(readings(spark, d), 3)


@register("neighbours", _w(
    "SELECT location, data_key, period, lag(period) OVER (PARTITION BY location, data_key ORDER BY period) AS "
    "prev_period, lead(period) OVER (PARTITION BY location, data_key ORDER BY period) AS next_period FROM (SELECT "
    "DISTINCT location, data_key, date_trunc('day', time) AS period FROM readings) x"))
def q_neighbours(spark, d):
    """Previous/next day with data for every chart line (location x metric)."""
    r = readings(spark, d).withColumn("period", trunc("time", "day"))
    return wn.neighbours(r, "period", by=["location", "data_key"])


DAILY_SQL = ("(SELECT CAST(time AS DATE) AS day, source, location, count(*) AS row_count FROM readings "
             "GROUP BY 1, source, location)")


def daily_counts(spark, d):
    r = readings(spark, d)
    return r.groupBy(F.to_date("time").alias("day"), "source", "location").agg(F.count(F.lit(1)).alias("row_count"))


@register("volume_drop", _w(
    "SELECT * FROM (SELECT *, lag(row_count) OVER (PARTITION BY source, location ORDER BY day) AS prev_count FROM "
    + DAILY_SQL + " m) x WHERE row_count < prev_count * 0.5"))
def q_volume_drop(spark, d):
    return wn.volume_drop(daily_counts(spark, d), by=["source", "location"])


@register("having_drop", _w(
    "SELECT day, source, location, row_count FROM (SELECT *, avg(row_count) OVER (PARTITION BY source, location) AS "
    "expected FROM " + DAILY_SQL + " m) x WHERE row_count < expected * 0.5"))
def q_having_drop(spark, d):
    m = daily_counts(spark, d)
    expected = F.avg("row_count").over(Window.partitionBy("source", "location"))
    return ag.having_drop(m.withColumn("_exp", expected), "row_count", F.col("_exp"), 0.5).drop("_exp")


@register("gaps", _w(
    "SELECT " + SERIES + ", prev_time AS gap_start, time AS gap_end, gap_hours FROM (SELECT *, "
    "(epoch_us(time) - epoch_us(prev_time)) / 3.6e9 AS gap_hours FROM (SELECT " + SERIES + ", time, lag(time) OVER "
    "(PARTITION BY " + SERIES + " ORDER BY time) AS prev_time FROM readings WHERE time IS NOT NULL) a) b "
    "WHERE gap_hours > 24"))
def q_gaps(spark, d):
    return wn.gaps(readings(spark, d), 24)


@register("daily_quality", _w(
    "SELECT CAST(time AS DATE) AS day, source, measurement, count(*) AS row_count, count(DISTINCT time) AS "
    "distinct_times, count(*) FILTER (WHERE data_value IS NULL) AS null_count, round(100.0 * count(*) FILTER (WHERE "
    "data_value IS NULL) / count(*), 2) AS null_pct, min(data_value) AS min_value, max(data_value) AS max_value, "
    "avg(data_value) AS avg_value, round(stddev_samp(data_value), 6) AS std_value, count(DISTINCT location) AS "
    "active_locations, count(DISTINCT data_key) AS active_keys FROM readings GROUP BY 1, source, measurement",
    nulls=True))
def q_daily_quality(spark, d):
    return ag.daily_quality(readings(spark, d, nulls=True)).withColumn("std_value", F.round("std_value", 6))
