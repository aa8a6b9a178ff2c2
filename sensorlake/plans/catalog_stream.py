"""Driver-table queries for the streaming operators: events are rendered as
Parquet files under the shared checkpoint folder, processed with
``trigger(availableNow=True)``, and the sink is read back. The oracle is
the batch SQL (update mode + upsert: every window; append mode: only the
windows/sessions the final watermark has closed)."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from sensorlake.operators import quality as qa
from sensorlake.plans.catalog_drops import PARSED_SQL, drops_sql, render_drops
from sensorlake.plans.registry import register
from sensorlake.plans.tables import READINGS_NULLS_SQL, READINGS_SQL, sql_with, table
from sensorlake.session import scratch_path
from sensorlake.streaming import streams as st

R, RN = READINGS_SQL, READINGS_NULLS_SQL
POINT = ["time", "measurement", "location", "source", "data_key", "data_value"]


def _w(sql, nulls=False):
    return sql_with(sql, readings=RN if nulls else R)


def render_events(spark, d, files: int = 4, copies: int = 1, late: bool = False) -> str:
    """``files`` files, each a range of time, with modification times in that order, which is the order a stream reads them in.

    Copies of a range follow it directly; ``late`` sends the first day once more at the end.
    """
    ev = table(spark, d, "events")
    root = scratch_path(spark, "events_stream")
    paths = [f"{root}/copy{c}" for c in range(copies)]
    for path in paths:
        ev.repartitionByRange(files, "ts").write.parquet(path)
    if late:
        first_day = ev.select((F.min("ts") + F.expr("INTERVAL 1 DAY")).alias("until"))
        paths.append(f"{root}/late")
        ev.filter(F.col("ts") < first_day.scalar()).coalesce(1).write.parquet(paths[-1])
    jvm = spark._jvm
    fs = jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    first = int(time.time() * 1000) - 3_600_000
    for c, path in enumerate(paths):
        for f in fs.listStatus(jvm.org.apache.hadoop.fs.Path(path)):
            name = f.getPath().getName()
            if name.startswith("part-"):
                part = files if path.endswith("/late") else int(name.split("-")[1])
                fs.setTimes(f.getPath(), first + 1000 * (part * len(paths) + c), -1)
    return root


def stream_readings(spark, d, files=4, copies=1, nulls=False, max_files=1, late=False):
    """readings view over a file stream of events."""
    path = render_events(spark, d, files, copies, late)
    schema = table(spark, d, "events").schema
    ev = (spark.readStream.schema(schema).option("recursiveFileLookup", True)
          .option("maxFilesPerTrigger", max_files).parquet(path))
    uid = F.col("user_id")
    hundredths = F.round(F.col("value") * 100)
    value = F.when(F.col("event_id") % 17 == 0, F.lit(None).cast("double")).otherwise(hundredths) if nulls else hundredths
    return ev.select(
        F.col("ts").alias("time"),
        F.concat((uid % 5 + 1).cast("string"), F.lit("NP-S"), (uid % 9 + 1).cast("string")).alias("location"),
        F.when(uid % 2 == 0, "A").otherwise("B").alias("source"), F.col("event_type").alias("data_key"),
        F.when(F.col("event_type").isin("purchase", "click"), "additive").otherwise("nonadditive").alias("measurement"),
        value.alias("data_value"))


def _ckpt(spark, name):
    return scratch_path(spark, f"ckpt_{name}")


RESAMPLE_SQL = ("SELECT date_trunc('hour', time) + INTERVAL 1 HOUR AS time, measurement, location, source, data_key, "
                "CASE WHEN measurement = 'additive' THEN sum(data_value) ELSE avg(data_value) END AS data_value FROM "
                "readings WHERE data_value IS NOT NULL GROUP BY date_trunc('hour', time), measurement, location, source, "
                "data_key")
KEY = ["time", "measurement", "location", "source", "data_key"]


@register("stream_resample", _w(RESAMPLE_SQL, nulls=True))
def q_stream_resample(spark, d):
    """Update mode, several micro-batches, results upserted per month partition."""
    out = scratch_path(spark, "stream_resample")
    s = st.stream_resample(stream_readings(spark, d, nulls=True), delay="1 hour")
    st.run_available_now(s, _ckpt(spark, "resample"), mode="update",
                         foreach_batch=st.upsert_months_writer(out, KEY, ["data_value"]))
    return spark.read.parquet(out).select(*POINT)


@register("stream_resample_append", _w(
    "SELECT * FROM (" + RESAMPLE_SQL + ") h WHERE time <= (SELECT max(time) FROM readings) - INTERVAL 1 HOUR"))
def q_stream_resample_append(spark, d):
    """Append mode, several batches: a window is emitted once the watermark (max time - 1 h) passes its end."""
    out = scratch_path(spark, "stream_resample_append")
    s = st.stream_resample(stream_readings(spark, d), delay="1 hour")
    st.run_available_now(s, _ckpt(spark, "resample_append"), path=out, mode="append")
    return spark.read.parquet(out).select(*POINT)


@register("stream_resample_late", _w(
    "SELECT * FROM (" + RESAMPLE_SQL.replace("FROM readings", "FROM (SELECT * FROM readings UNION ALL SELECT * FROM (SELECT * "
    "FROM readings WHERE time < (SELECT min(time) FROM readings) + INTERVAL 1 DAY) sent_again WHERE time >= (SELECT max(time) "
    "FROM readings) - INTERVAL 1 HOUR) r") + ") h WHERE time <= (SELECT max(time) FROM readings) - INTERVAL 1 HOUR"))
def q_stream_resample_late(spark, d):
    """The first day arrives once more after everything else: its rows are behind the watermark and dropped."""
    out = scratch_path(spark, "stream_resample_late")
    s = st.stream_resample(stream_readings(spark, d, late=True), delay="1 hour")
    st.run_available_now(s, _ckpt(spark, "resample_late"), path=out, mode="append")
    return spark.read.parquet(out).select(*POINT)


@register("stream_dedupe", _w("SELECT DISTINCT * FROM readings"))
def q_stream_dedupe(spark, d):
    """Every file imported twice, in batches of its own; the second copy is dropped, and old state is evicted on the way."""
    out = scratch_path(spark, "stream_dedupe")
    s = st.stream_dedupe(stream_readings(spark, d, copies=2), POINT, delay="20 days")
    st.run_available_now(s, _ckpt(spark, "dedupe"), path=out, mode="append")
    return spark.read.parquet(out).select(*POINT)


@register("stream_upsert", _w(
    "SELECT time, measurement, location, source, data_key, CASE WHEN data_key = 'purchase' THEN data_value + 1 ELSE "
    "data_value END AS data_value FROM (SELECT *, row_number() OVER (PARTITION BY time, measurement, location, source, "
    "data_key ORDER BY data_value DESC) AS rn FROM readings) x WHERE rn = 1"))
def q_stream_upsert(spark, d):
    """Two runs into one month-partitioned table: the base load, then late corrections."""
    out = scratch_path(spark, "stream_upsert")
    writer = st.upsert_months_writer(out, KEY, ["data_value"])
    st.run_available_now(stream_readings(spark, d), _ckpt(spark, "upsert1"), foreach_batch=writer)
    corr = stream_readings(spark, d).filter("data_key = 'purchase'").withColumn("data_value", F.col("data_value") + 1)
    st.run_available_now(corr, _ckpt(spark, "upsert2"), foreach_batch=writer)
    return spark.read.parquet(out).select(*POINT)


@register("late_data", _w("SELECT * FROM readings WHERE time >= TIMESTAMP '2024-01-15'"))
def q_late_data(spark, d):
    out = scratch_path(spark, "late_data")
    s = st.late_data(stream_readings(spark, d), "2024-01-15")
    st.run_available_now(s, _ckpt(spark, "late"), path=out, mode="append")
    return spark.read.parquet(out).select(*POINT)


@register("stream_drops", drops_sql(
    "SELECT make_timestamp(y, month, day, hh, mi, ss) AS Datetime, CAST(temp AS DOUBLE) AS Temperature_Celsius, "
    "CAST(rh AS DOUBLE) AS \"Relative_Humidity(%)\", sensor AS Location FROM " + PARSED_SQL + " p WHERE "
    "(temp IS NULL OR regexp_matches(temp, '^-?[0-9]+([.][0-9]+)?$')) AND "
    "(rh IS NULL OR regexp_matches(rh, '^-?[0-9]+([.][0-9]+)?$'))"))
def q_stream_drops(spark, d):
    """New drop files, 40 per micro-batch, archived after processing."""
    src = render_drops(spark, d, fresh=True)
    out = scratch_path(spark, "stream_drops_out")
    s = st.stream_drops(spark, src, archive_dir=scratch_path(spark, "drops_archive"), max_files=40)
    st.run_available_now(s, _ckpt(spark, "drops"), foreach_batch=st.drops_batch_writer(out, "2024-01-31"))
    with st.settings(spark, st.LISTING):        # a folder a micro-batch
        return spark.read.parquet(out).drop("_batch")


ORDER_POINTS = ("(SELECT 'orders' AS source, strftime(o_orderdate, '%Y-%m') AS year_month, max(o_orderdate) AS "
                "max_loaded_at, count(*) AS row_count FROM orders {w} GROUP BY 2)")


@register("changed_months", "SELECT * FROM " + ORDER_POINTS.format(w="") + " c WHERE NOT EXISTS (SELECT 1 FROM "
          + ORDER_POINTS.format(w="WHERE o_orderstatus <> 'P'") + " s WHERE s.source = c.source AND s.year_month = "
          "c.year_month AND s.row_count >= c.row_count)")
def q_changed_months(spark, d):
    o = table(spark, d, "orders").select(F.lit("orders").alias("source"), F.col("o_orderdate").alias("time"),
                                         "o_orderstatus")
    current = st.month_markers(o)
    state = st.month_markers(o.filter("o_orderstatus <> 'P'"))
    return st.changed_months(current, state, marker="row_count")


@register("changed_months_loaded", "SELECT * FROM " + ORDER_POINTS.format(w="") + " c WHERE NOT EXISTS (SELECT 1 FROM "
          + ORDER_POINTS.format(w="WHERE o_orderkey % 3 <> 0") + " s WHERE s.source = c.source AND s.year_month = "
          "c.year_month AND s.max_loaded_at >= c.max_loaded_at)")
def q_changed_months_loaded(spark, d):
    """The freshness marker: months whose newest point is later than recorded."""
    o = table(spark, d, "orders").select("o_orderkey", F.lit("orders").alias("source"), F.col("o_orderdate").alias("time"))
    return st.changed_months(st.month_markers(o), st.month_markers(o.filter("o_orderkey % 3 <> 0")))


ALERT_RULES = [("value_between", "data_value IS NOT NULL AND NOT (data_value BETWEEN 100 AND 9000)"),
               ("null_value", "data_value IS NULL")]


@register("stream_alerts", _w(" UNION ALL ".join(f"SELECT *, '{n}' AS rule FROM readings WHERE {c}" for n, c in ALERT_RULES),
                              nulls=True))
def q_stream_alerts(spark, d):
    out = scratch_path(spark, "alerts")
    rules = [qa.RowRule("value_between", F.col("data_value").isNotNull() & ~F.col("data_value").between(100, 9000)),
             qa.RowRule("null_value", F.col("data_value").isNull())]
    s = st.stream_alerts(stream_readings(spark, d, nulls=True), rules)
    st.run_available_now(s, _ckpt(spark, "alerts"), path=out, mode="append")
    return spark.read.parquet(out).select(*POINT, "rule")


@register("stream_sessions", _w(
    "SELECT location, data_key, min(time) AS session_start, max(time) + INTERVAL 2 HOUR AS session_end, count(*) AS n "
    "FROM (SELECT *, sum(CASE WHEN prev IS NULL OR time - prev >= INTERVAL 2 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY "
    "location, data_key ORDER BY time ROWS UNBOUNDED PRECEDING) AS sid FROM (SELECT *, lag(time) OVER (PARTITION BY "
    "location, data_key ORDER BY time) AS prev FROM readings) a) b GROUP BY location, data_key, sid HAVING "
    "max(time) + INTERVAL 2 HOUR <= (SELECT max(time) FROM readings) - INTERVAL 1 HOUR"))
def q_stream_sessions(spark, d):
    out = scratch_path(spark, "sessions")
    s = st.stream_sessions(stream_readings(spark, d), gap="2 hours", delay="1 hour")
    st.run_available_now(s, _ckpt(spark, "sessions"), path=out, mode="append")
    return spark.read.parquet(out)
