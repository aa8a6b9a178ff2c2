"""Driver-table queries for scalar functions (X01-X22) and the remaining row
operators (F06, F08, W08, Q03)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorlake import functions as X
from sensorlake.operators import filters as flt
from sensorlake.operators import windows as wn
from sensorlake.plans.catalog_drops import drops_sql, render_drops
from sensorlake.plans.registry import register
from sensorlake.plans.tables import READINGS_SQL, readings, sql_with, table
from sensorlake.sources.files import read_sensor_drops, require_columns


@register("text_functions", "SELECT c_custkey, upper(trim(c_mktsegment)) AS upper_trim, replace(CAST(c_acctbal AS "
          "VARCHAR), '.', ',') AS comma_text, CAST(CAST(replace(replace(CAST(c_acctbal AS VARCHAR), '.', ','), ',', '.') "
          "AS DECIMAL(18,3)) AS DOUBLE) AS decimal_comma, right(c_name, 4) AS level_suffix, left(c_name, 8) AS level_prefix, "
          "split_part(c_name, '#', 2) AS after_sep, CASE WHEN starts_with(c_name, 'Customer') THEN substr(c_name, 9) "
          "ELSE c_name END AS after_pref, TRY_CAST(right(c_name, 1) AS INTEGER) AS section, left(c_name, 3) AS floor, "
          "CASE WHEN left(c_name, 3) LIKE '%NP%' THEN 'NP' WHEN left(c_name, 3) LIKE '%PP%' THEN 'PP' END AS "
          "floor_class FROM customer")
def q_text_functions(spark, d):
    c = table(spark, d, "customer")
    name = F.col("c_name")
    comma = F.replace(F.col("c_acctbal").cast("string"), F.lit("."), F.lit(","))
    return c.select("c_custkey", X.upper_trim("c_mktsegment").alias("upper_trim"), comma.alias("comma_text"),
                    X.decimal_comma(comma).cast("double").alias("decimal_comma"), X.level(name, "suffix", 4).alias("level_suffix"),
                    X.level(name, "prefix", 8).alias("level_prefix"), X.after(name, "#").alias("after_sep"),
                    X.after_prefix(name, "Customer").alias("after_pref"), X.section(name).alias("section"),
                    X.floor_code(name).alias("floor"), X.floor_class(name).alias("floor_class"))


def _vd(d, m):
    return (f"({m} BETWEEN 1 AND 12 AND {d} BETWEEN 1 AND 31 AND NOT ({m} IN (4, 6, 9, 11) AND {d} > 30) AND NOT "
            f"({m} = 2 AND {d} > 29))")


@register("time_functions", "SELECT o_orderkey, " + _vd("day(o_orderdate)", "month(o_orderdate)") + " AS valid_dmy, "
          + _vd("month(o_orderdate)", "day(o_orderdate)") + " AS valid_swapped, ((year(o_orderdate) * 10000 + "
          "month(o_orderdate) * 100 + day(o_orderdate)) * 1000000 + hour(o_orderdate) * 10000) AS ts_num, "
          "date_trunc('month', o_orderdate) AS month_start, date_trunc('week', o_orderdate) AS week_start, "
          "o_orderdate - INTERVAL 3 MONTH AS minus3, strftime(o_orderdate, '%Y-%m') AS year_month, "
          "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS rfc3339, TRY_CAST(strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') "
          "AS TIMESTAMP) AS lenient, CAST(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS strict, "
          "TRY_CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE) AS lenient_double FROM orders")
def q_time_functions(spark, d):
    o = table(spark, d, "orders")
    t = F.col("o_orderdate")
    return o.select(
        "o_orderkey", X.valid_day(F.dayofmonth(t), F.month(t)).alias("valid_dmy"),
        X.valid_day(F.month(t), F.dayofmonth(t)).alias("valid_swapped"),
        X.ts_num(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.lit(0), F.lit(0)).alias("ts_num"),
        X.trunc(t, "month").alias("month_start"), X.trunc(t, "week").alias("week_start"),
        X.minus_months(t, 3).alias("minus3"), X.year_month(t).alias("year_month"), X.rfc3339(t).alias("rfc3339"),
        X.lenient_ts(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")).alias("lenient"),
        X.strict_ts(F.date_format(t, "yyyy-MM-dd HH:mm:ss")).alias("strict"),
        X.lenient_double(F.col("o_totalprice").cast("string")).alias("lenient_double"))


@register("build_ts", "SELECT l_orderkey, l_linenumber, make_timestamp(year(l_shipdate), month(l_shipdate), "
          "CASE WHEN l_linenumber = 1 THEN 31 ELSE day(l_shipdate) END, l_linenumber, 5, 0) AS ts FROM lineitem WHERE "
          + _vd("CASE WHEN l_linenumber = 1 THEN 31 ELSE day(l_shipdate) END", "month(l_shipdate)")
          + " UNION ALL SELECT l_orderkey, l_linenumber, NULL FROM lineitem WHERE NOT "
          + _vd("CASE WHEN l_linenumber = 1 THEN 31 ELSE day(l_shipdate) END", "month(l_shipdate)"))
def q_build_ts(spark, d):
    li = table(spark, d, "lineitem")
    day = F.when(F.col("l_linenumber") == 1, F.lit(31)).otherwise(F.dayofmonth("l_shipdate"))
    return li.select("l_orderkey", "l_linenumber",
                     X.build_ts(F.year("l_shipdate"), F.month("l_shipdate"), day, F.col("l_linenumber"), F.lit(5))
                     .alias("ts"))


@register("quality_functions", "SELECT l_orderkey, l_linenumber, l_tax * 100 + 273.15 - 273.15 AS kelvin_c, "
          "(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END) + (CASE WHEN l_tax = 0 THEN 2 ELSE 0 END) + (CASE WHEN "
          "l_quantity BETWEEN 10 AND 20 THEN 4 ELSE 0 END) AS flags, l_quantity BETWEEN 10 AND 20 AS in_range FROM lineitem")
def q_quality_functions(spark, d):
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", X.kelvin_to_c(F.col("l_tax") * 100 + 273.15).alias("kelvin_c"),
                     X.flags(F.col("l_discount") > 0.05, F.col("l_tax") == 0, X.in_range("l_quantity", 10, 20))
                     .alias("flags"), X.in_range("l_quantity", 10, 20).alias("in_range"))


@register("null_pct", "SELECT l_returnflag, round(100.0 * count(*) FILTER (WHERE CASE WHEN l_linenumber = 1 THEN NULL "
          "ELSE l_tax END IS NULL) / count(*), 2) AS null_pct, count(DISTINCT l_orderkey) AS orders FROM lineitem "
          "GROUP BY l_returnflag")
def q_null_pct(spark, d):
    li = table(spark, d, "lineitem").withColumn(
        "tax", F.when(F.col("l_linenumber") == 1, F.lit(None).cast("double")).otherwise(F.col("l_tax")))
    return li.groupBy("l_returnflag").agg(X.null_pct("tax").alias("null_pct"),
                                          F.countDistinct("l_orderkey").alias("orders"))


@register("surrogate", "SELECT count(DISTINCT o_custkey) AS natural_keys, count(DISTINCT o_custkey) AS surrogate_keys "
          "FROM orders")
def q_surrogate(spark, d):
    o = table(spark, d, "orders")
    return o.agg(F.countDistinct("o_custkey").alias("natural_keys"),
                 F.countDistinct(X.surrogate("o_custkey")).alias("surrogate_keys"))


@register("drop_dead_rows", "SELECT * FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice "
          "END AS a, CASE WHEN o_orderpriority IN ('1-URGENT', '5-LOW') THEN NULL ELSE o_custkey END AS b FROM orders) x "
          "WHERE NOT (a IS NULL AND b IS NULL)")
def q_drop_dead_rows(spark, d):
    o = table(spark, d, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", F.lit(None).cast("double")).otherwise(F.col("o_totalprice"))
        .alias("a"), F.when(F.col("o_orderpriority").isin("1-URGENT", "5-LOW"), F.lit(None).cast("long"))
        .otherwise(F.col("o_custkey")).alias("b"))
    return flt.drop_dead_rows(o, "a", "b")


@register("valid_lines", drops_sql("SELECT file_name, text FROM src WHERE valid"))
def q_valid_lines(spark, d):
    from sensorlake.operators.datefmt import split_fields
    lines = read_sensor_drops(spark, render_drops(spark, d))
    return split_fields(lines).filter("valid").select("file_name", "text")


@register("rank_for_upsert", "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, CAST(row_number() OVER "
          "(PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_extendedprice DESC, l_quantity DESC, "
          "l_discount DESC, l_tax DESC) AS INTEGER) AS write_rank FROM lineitem")
def q_rank_for_upsert(spark, d):
    li = table(spark, d, "lineitem")
    out = wn.rank_for_upsert(li, ["l_orderkey", "l_linenumber"],
                             ["l_shipdate", "l_extendedprice", "l_quantity", "l_discount", "l_tax"])
    return out.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "write_rank")


@register("require_columns", sql_with("SELECT * FROM readings", readings=READINGS_SQL))
def q_require_columns(spark, d):
    r = readings(spark, d)
    return require_columns(r, ["time", "location", "source", "measurement", "data_key", "data_value"], "readings")


@register("strip_bom", "SELECT event_id, props AS text FROM events")
def q_strip_bom(spark, d):
    """Every third line carries a byte order mark."""
    mark = F.when(F.col("event_id") % 3 == 0, "\ufeff").otherwise("")
    return table(spark, d, "events").select("event_id", X.strip_bom(F.concat(mark, F.col("props"))).alias("text"))


@register("date_parts", "SELECT event_id, CAST(day(ts) AS INTEGER) AS p1, CAST(month(ts) AS INTEGER) AS p2, CAST(year(ts) AS INTEGER) AS year, "
          "CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute, CASE WHEN event_id % 3 = 0 THEN 0 ELSE "
          "CAST(second(ts) AS INTEGER) END AS second FROM events")
def q_date_parts(spark, d):
    """Day-first dates, a third of the times without seconds."""
    time = F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "H:mm")).otherwise(F.date_format("ts", "H:mm:ss"))
    parts = X.date_parts(F.date_format("ts", "dd/MM/yyyy"), time)
    return table(spark, d, "events").select("event_id", parts.alias("_p")).select("event_id", "_p.*")


@register("month_guard_split", "SELECT event_id, CAST(day(ts) AS INTEGER) AS month, day(ts) > 12 AS split_off FROM events")
def q_month_guard_split(spark, d):
    """Dates read in the wrong order: days that cannot be months are split off."""
    from sensorlake.operators.filters import month_guard
    read = table(spark, d, "events").select("event_id", F.dayofmonth("ts").alias("month"))
    good, bad = month_guard(read, mode="split")
    return good.withColumn("split_off", F.lit(False)).unionByName(bad.withColumn("split_off", F.lit(True)))
