"""Driver-table queries: minimum slice, reshaping, filters, joins, merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorlake.functions.time import strict_ts
from sensorlake.operators import filters as flt
from sensorlake.operators import joins as jn
from sensorlake.operators import merge as mg
from sensorlake.operators import reshape as rs
from sensorlake.operators.aggregates import resample
from sensorlake.plans.flows import tag_points, ventilation_fact
from sensorlake.plans.registry import register
from sensorlake.plans.tables import AS_OF, table
from sensorlake.session import scratch_path

# ---------------------------------------------------------------- fixtures
# The wide export is lineitem: `date` + one text column per signal.
SIGNALS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
# Signal map seed: l_tax is left out on purpose (unmapped signal).
SIGNAL_MAP = [("l_quantity", "unit_01", "qty"), ("l_extendedprice", "unit_02", "price"),
              ("l_discount", "unit_03", "discount")]
SIGNAL_MAP_SQL = ("(SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in SIGNAL_MAP)
                  + ") AS m(data_key_original, location, data_key))")
HISTORY_MONTHS = 24


def wide(spark, d):
    # Signals in hundredths so that means are exact (see tables.readings).
    li = table(spark, d, "lineitem")
    return li.select(F.col("l_shipdate").alias("date"), *[F.round(F.col(c) * 100).alias(c) for c in SIGNALS])


def signal_map(spark):
    return spark.createDataFrame(SIGNAL_MAP, "data_key_original string, location string, data_key string")


def old_fact(spark, d):
    # previous fact table: order totals in hundredths (exact means, see tables.readings)
    o = table(spark, d, "orders")
    return o.select(F.col("o_orderdate").alias("time"), F.lit("orders").alias("location"),
                    F.lit("price").alias("data_key"), F.round(F.col("o_totalprice") * 100).alias("data_value"))


WIDE_SQL = "(SELECT l_shipdate AS date, " + ", ".join(f"round({c} * 100) AS {c}" for c in SIGNALS) + " FROM lineitem)"
WIDE_TEXT_SQL = ("(SELECT CAST(l_shipdate AS VARCHAR) AS date, "
                 + ", ".join(f"CAST(round({c} * 100) AS VARCHAR) AS {c}" for c in SIGNALS) + " FROM lineitem)")
OLD_FACT_SQL = ("(SELECT o_orderdate AS time, 'orders' AS location, 'price' AS data_key, "
                "round(o_totalprice * 100) AS data_value FROM orders)")
NARROW_SQL = ("(SELECT * FROM (UNPIVOT " + WIDE_TEXT_SQL + " ON " + ", ".join(SIGNALS)
              + " INTO NAME data_key_original VALUE data_value))")
MAPPED_SQL = ("(SELECT CAST(n.date AS TIMESTAMP) AS time, m.location, m.data_key, "
              "CAST(n.data_value AS DOUBLE) AS data_value FROM " + NARROW_SQL + " n JOIN "
              + SIGNAL_MAP_SQL + " m ON n.data_key_original = m.data_key_original WHERE n.date IS NOT NULL)")
START_SQL = f"(date_trunc('month', TIMESTAMP '{AS_OF}') - INTERVAL {HISTORY_MONTHS - 1} MONTH)"
FACT_SQL = ("(SELECT * FROM (SELECT * FROM " + MAPPED_SQL + " UNION SELECT * FROM " + OLD_FACT_SQL
            + ") f WHERE time >= " + START_SQL + ")")


def ventilation(spark, d):
    return ventilation_fact(wide(spark, d), signal_map(spark), old_fact(spark, d),
                            history=HISTORY_MONTHS, as_of=AS_OF)


# ---------------------------------------------------------------- flagship
@register("ventilation_fact", "SELECT * FROM " + FACT_SQL)
def q_ventilation_fact(spark, d):
    return ventilation(spark, d)


FLAGSHIP_SQL = (
    "SELECT time_bucket(INTERVAL 1 DAY, time) AS time, measurement, location, source, data_key, "
    "CASE WHEN measurement = 'additive' THEN sum(data_value) ELSE avg(data_value) END AS data_value "
    "FROM (SELECT *, 'warehouse' AS source, CASE WHEN data_key = 'qty' THEN 'additive' ELSE 'nonadditive' END "
    "AS measurement FROM " + FACT_SQL + ") p WHERE data_value IS NOT NULL "
    "GROUP BY 1, measurement, location, source, data_key")


@register("flagship_daily", FLAGSHIP_SQL)
def q_flagship(spark, d):
    """wide -> narrow -> map -> merge -> retain -> tag -> daily resample."""
    pts = tag_points(ventilation(spark, d), "warehouse", additive_keys=["qty"])
    return resample(pts, every="1 day", label="start")


# ---------------------------------------------------------------- reshape
@register("all_to_string", "SELECT strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS date, "
          + ", ".join(f"CAST(CAST({c} AS DECIMAL(18,2)) AS VARCHAR) AS {c}" for c in SIGNALS) + ", l_returnflag, "
          "CAST(l_linenumber AS VARCHAR) AS l_linenumber FROM lineitem")
def q_all_to_string(spark, d):
    li = table(spark, d, "lineitem")
    return rs.all_to_string(li.select(F.col("l_shipdate").alias("date"), *[F.col(c).cast("decimal(18,2)") for c in SIGNALS],
                                      "l_returnflag", "l_linenumber"))


@register("wide_to_narrow", "SELECT date, data_key_original, CAST(data_value AS DOUBLE) AS data_value FROM (UNPIVOT "
          + WIDE_SQL + " ON " + ", ".join(SIGNALS) + " INTO NAME data_key_original VALUE data_value)")
def q_wide_to_narrow(spark, d):
    return rs.wide_to_narrow(wide(spark, d), ids=["date"])


STACK = {"l_quantity": "qty", "l_discount": "discount"}


@register("stack_columns", " UNION ALL ".join(
    f"SELECT l_orderkey, l_linenumber, '{k}' AS data_key, CASE WHEN l_linenumber = 1 THEN NULL ELSE {c} END "
    f"AS data_value FROM lineitem" for c, k in STACK.items()))
def q_stack_columns(spark, d):
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber",
        *[F.when(F.col("l_linenumber") == 1, F.lit(None).cast("double")).otherwise(F.col(c)).alias(c) for c in STACK])
    return rs.stack_columns(li, STACK, ids=["l_orderkey", "l_linenumber"])


@register("measure_columns_to_facts",
          "SELECT o_orderdate AS time, CAST(o_custkey AS VARCHAR) AS location, 'price' AS data_key, "
          "o_totalprice AS data_value FROM orders WHERE o_orderdate IS NOT NULL UNION ALL "
          "SELECT o_orderdate, CAST(o_custkey AS VARCHAR), 'status_p', "
          "CASE WHEN o_orderstatus = 'P' THEN 1.0 ELSE NULL END FROM orders WHERE o_orderdate IS NOT NULL")
def q_measure_columns_to_facts(spark, d):
    o = table(spark, d, "orders").select(
        F.col("o_orderdate").alias("Datetime"), F.col("o_custkey").cast("string").alias("Location"),
        F.col("o_totalprice").alias("price"),
        F.when(F.col("o_orderstatus") == "P", F.lit(1.0)).alias("status_p"))
    return rs.measure_columns_to_facts(o, {"price": "price", "status_p": "status_p"})


@register("rename_map", "SELECT o_orderdate AS _time, o_orderpriority AS quantity, o_totalprice AS _value FROM orders")
def q_rename_map(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderdate").alias("time"), F.col("o_orderpriority").alias("data_key"),
                                         F.col("o_totalprice").alias("data_value"))
    return rs.rename_map(o, rs.TO_POINT)


@register("tag", "SELECT o_orderkey, o_totalprice, 'orders' AS source, 'nonadditive' AS measurement FROM orders")
def q_tag(spark, d):
    return rs.tag(table(spark, d, "orders").select("o_orderkey", "o_totalprice"),
                  source="orders", measurement="nonadditive")


@register("conform", "SELECT o_orderdate AS time, CAST(o_custkey AS VARCHAR) AS location, CAST(NULL AS VARCHAR) AS source, "
          "CAST(NULL AS VARCHAR) AS measurement, o_orderpriority AS data_key, o_totalprice AS data_value FROM orders")
def q_conform(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderdate").alias("time"), F.col("o_custkey").alias("location"),
                                         F.col("o_orderpriority").alias("data_key"),
                                         F.col("o_totalprice").alias("data_value"))
    return rs.conform(o, ["time", "location", "source", "measurement", "data_key", "data_value"],
                      {"location": "string"})


@register("keep", "SELECT l_orderkey, l_shipdate FROM lineitem")
def q_keep(spark, d):
    return rs.keep(table(spark, d, "lineitem"), ["l_orderkey", "l_shipdate"])


# ---------------------------------------------------------------- filters
ORDERS_TS_SQL = ("(SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderdate END AS time, "
                 "o_totalprice AS data_value, CAST(o_custkey AS VARCHAR) AS location, o_orderstatus AS measurement "
                 "FROM orders)")


def orders_ts(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey",
                    F.when(F.col("o_orderkey") % 13 == 0, F.lit(None).cast("timestamp_ntz"))
                     .otherwise(F.col("o_orderdate")).alias("time"),
                    F.col("o_totalprice").alias("data_value"), F.col("o_custkey").cast("string").alias("location"),
                    F.col("o_orderstatus").alias("measurement"))


@register("drop_null_time", "SELECT * FROM " + ORDERS_TS_SQL + " t WHERE time IS NOT NULL")
def q_drop_null_time(spark, d):
    return flt.drop_null_time(orders_ts(spark, d))


@register("retain_months", "SELECT * FROM " + ORDERS_TS_SQL + " t WHERE time >= "
          f"(date_trunc('month', TIMESTAMP '{AS_OF}') - INTERVAL 11 MONTH)")
def q_retain_months(spark, d):
    return flt.retain_months(orders_ts(spark, d), 12, AS_OF)


# Source-parameter rows as in the sources seed: the latest start wins.
SOURCES = [("fact.csv", "Vent", 4), ("fact.csv", "Vent-old", 9), ("other.csv", "X", 40)]


@register("retain_months_params", "SELECT * FROM " + ORDERS_TS_SQL + " t WHERE time >= "
          f"(date_trunc('month', TIMESTAMP '{AS_OF}') - INTERVAL 3 MONTH)")
def q_retain_months_params(spark, d):
    params = spark.createDataFrame(SOURCES, "file_nm string, source_nm string, history int").filter("file_nm = 'fact.csv'")
    return flt.retain_months(orders_ts(spark, d), None, AS_OF, params=params)


@register("for_measurement", "SELECT * FROM " + ORDERS_TS_SQL + " t WHERE measurement = 'F'")
def q_for_measurement(spark, d):
    return flt.for_measurement(orders_ts(spark, d), "F")


@register("time_range", "SELECT * FROM " + ORDERS_TS_SQL + " t WHERE time >= TIMESTAMP '1997-03-01' "
          "AND time < TIMESTAMP '1999-07-01'")
def q_time_range(spark, d):
    return flt.time_range(orders_ts(spark, d), "1997-03-01", "1999-07-01")


@register("range_gate", "SELECT * FROM " + ORDERS_TS_SQL + " t WHERE data_value BETWEEN 1000 AND 300000 "
          f"AND time IS NOT NULL AND location IS NOT NULL AND data_value IS NOT NULL AND time <= TIMESTAMP '{AS_OF}' "
          "AND time >= TIMESTAMP '1996-01-01'")
def q_range_gate(spark, d):
    return flt.range_gate(orders_ts(spark, d), "data_value", 1000, 300000, as_of=AS_OF, start="1996-01-01")


@register("months_filter", "SELECT * FROM " + ORDERS_TS_SQL + " t WHERE strftime(time, '%Y-%m') IN "
          "(SELECT DISTINCT strftime(l_shipdate, '%Y-%m') FROM lineitem WHERE l_returnflag = 'R')")
def q_months_filter(spark, d):
    from sensorlake.sources.files import months_to_process
    li = table(spark, d, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_shipdate").alias("time"))
    return flt.months_filter(orders_ts(spark, d), months_to_process(li))


# ---------------------------------------------------------------- joins
@register("map_signals", "SELECT time AS date, location, data_key, data_value FROM (SELECT n.date AS time, m.location, "
          "m.data_key, n.data_value FROM (UNPIVOT " + WIDE_SQL + " ON " + ", ".join(SIGNALS)
          + " INTO NAME data_key_original VALUE data_value) n JOIN " + SIGNAL_MAP_SQL
          + " m USING (data_key_original) WHERE n.date IS NOT NULL) x")
def q_map_signals(spark, d):
    narrow = rs.wide_to_narrow(wide(spark, d), ids=["date"])
    return jn.map_signals(narrow, signal_map(spark)).withColumnRenamed("time", "date")


NARROW_NUM_SQL = ("(UNPIVOT " + WIDE_SQL + " ON " + ", ".join(SIGNALS)
                  + " INTO NAME data_key_original VALUE data_value)")


@register("unmapped", "SELECT * FROM " + NARROW_NUM_SQL + " n WHERE NOT EXISTS (SELECT 1 FROM "
          + SIGNAL_MAP_SQL + " m WHERE m.data_key_original = n.data_key_original)")
def q_unmapped(spark, d):
    return jn.unmapped(rs.wide_to_narrow(wide(spark, d), ids=["date"]), signal_map(spark))


@register("mapped_only", "SELECT * FROM " + NARROW_NUM_SQL + " n WHERE EXISTS (SELECT 1 FROM "
          + SIGNAL_MAP_SQL + " m WHERE m.data_key_original = n.data_key_original)")
def q_mapped_only(spark, d):
    return jn.mapped_only(rs.wide_to_narrow(wide(spark, d), ids=["date"]), signal_map(spark))


# Sensor map derived from the supplier table: sensor = supplier key, location
# = its nation; suppliers of nation 0 are left out (unmapped sensors).
@register("map_sensors", "SELECT l.l_shipdate AS time, l.l_quantity AS temp, 'N' || CAST(s.s_nationkey AS VARCHAR) "
          "AS location FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey WHERE s.s_nationkey <> 0")
def q_map_sensors(spark, d):
    s = table(spark, d, "supplier").filter("s_nationkey <> 0").select(
        F.col("s_suppkey").alias("sensor"), F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("location"))
    li = table(spark, d, "lineitem").select(F.col("l_shipdate").alias("time"), F.col("l_quantity").alias("temp"),
                                           F.col("l_suppkey").alias("Location"))
    return jn.map_sensors(li, s)


@register("with_scalar", "SELECT o_orderkey, o_totalprice, p.max_total FROM orders, "
          "(SELECT max(o_totalprice) AS max_total FROM orders) p")
def q_with_scalar(spark, d):
    o = table(spark, d, "orders")
    return jn.with_scalar(o.select("o_orderkey", "o_totalprice"), o.agg(F.max("o_totalprice").alias("max_total")))


# Location map from nation: NATION_k -> region name; customers of nations
# 20..24 are not in the map and keep their value. Duplicate keys: nation 3
# also maps to 'DUP' in a later row, which must win.
LOCMAP_SQL = ("(SELECT n_name AS \"from\", r_name AS \"to\", n_nationkey AS ord FROM nation JOIN region "
              "ON n_regionkey = r_regionkey WHERE n_nationkey < 20 UNION ALL SELECT 'NATION_3', 'DUP', 100)")


def location_map(spark, d):
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    m = (n.filter("n_nationkey < 20").join(r, n.n_regionkey == r.r_regionkey)
          .select(F.col("n_name").alias("from"), F.col("r_name").alias("to"), F.col("n_nationkey").alias("ord")))
    extra = spark.createDataFrame([("NATION_3", "DUP", 100)], "`from` string, `to` string, ord int")
    return m.unionByName(extra)


@register("rename_values", "SELECT c.c_custkey, COALESCE(m.\"to\", c.location) AS location FROM "
          "(SELECT c_custkey, 'NATION_' || CAST(c_nationkey AS VARCHAR) AS location FROM customer) c LEFT JOIN "
          "(SELECT \"from\", max_by(\"to\", ord) AS \"to\" FROM " + LOCMAP_SQL + " x GROUP BY \"from\") m "
          "ON c.location = m.\"from\"")
def q_rename_values(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string"))
                                          .alias("location"))
    return jn.rename_values(c, location_map(spark, d), "location", order_col="ord")


@register("attach_source", "SELECT o.o_orderkey, o.o_orderpriority AS file_nm, s.source FROM orders o JOIN "
          "(SELECT * FROM (VALUES ('1-URGENT', 'Vent'), ('2-HIGH', 'Logger'), ('3-MEDIUM', 'Logger')) "
          "AS t(file_nm, source)) s ON o.o_orderpriority = s.file_nm")
def q_attach_source(spark, d):
    ms = spark.createDataFrame([("1-URGENT", "Vent", 4), ("2-HIGH", "Logger", 2), ("3-MEDIUM", "Logger", 2)],
                               "file_nm string, source_nm string, history int")
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderpriority").alias("file_nm"))
    return jn.attach_source(o, ms)


@register("orphans", "SELECT o.* FROM orders o WHERE NOT EXISTS (SELECT 1 FROM customer c "
          "WHERE c.c_custkey = o.o_custkey AND c.c_nationkey < 20)")
def q_orphans(spark, d):
    cust = table(spark, d, "customer").filter("c_nationkey < 20")
    return jn.orphans(table(spark, d, "orders"), cust, "o_custkey", "c_custkey")


# ---------------------------------------------------------------- merges
@register("merge_history", "SELECT * FROM " + MAPPED_SQL + " a UNION SELECT * FROM " + OLD_FACT_SQL + " b")
def q_merge_history(spark, d):
    narrow = rs.wide_to_narrow(rs.all_to_string(wide(spark, d)), ids=["date"])
    facts = jn.map_signals(narrow, signal_map(spark)).withColumn("time", strict_ts("time"))
    return mg.merge_history(facts, old_fact(spark, d))


def stored_history(spark, facts):
    """Distinct facts as a table that is stored, which the daily form reads."""
    path = scratch_path(spark, "history")
    facts.write.parquet(path)
    return spark.read.schema(facts.schema).parquet(path)


@register("merge_history_incremental", "SELECT * FROM " + MAPPED_SQL + " a UNION SELECT * FROM " + OLD_FACT_SQL + " b")
def q_merge_history_incremental(spark, d):
    """The daily form: the stored history is already distinct, so only the months
    of the new facts are deduplicated with it."""
    narrow = rs.wide_to_narrow(rs.all_to_string(wide(spark, d)), ids=["date"])
    facts = jn.map_signals(narrow, signal_map(spark)).withColumn("time", strict_ts("time"))
    history = stored_history(spark, mg.merge_history(old_fact(spark, d), old_fact(spark, d).limit(0)))
    return mg.merge_history(facts, history, incremental=True)


@register("merge_history_overlap", "SELECT DISTINCT * FROM " + MAPPED_SQL + " a")
def q_merge_history_overlap(spark, d):
    """Old and new facts share half of their rows, and the new ones come twice."""
    narrow = rs.wide_to_narrow(rs.all_to_string(wide(spark, d)), ids=["date"])
    facts = jn.map_signals(narrow, signal_map(spark)).withColumn("time", strict_ts("time"))
    split = F.coalesce(F.dayofmonth("time"), F.lit(0))
    new = facts.filter(split <= 20)
    history = stored_history(spark, facts.filter(split > 10).distinct())
    return mg.merge_history(new.unionByName(new), history, incremental=True)


@register("concat", "SELECT o_orderkey, o_totalprice, NULL::VARCHAR AS o_orderstatus FROM orders WHERE o_orderstatus = 'F' "
          "UNION ALL SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'")
def q_concat(spark, d):
    o = table(spark, d, "orders")
    return mg.concat([o.filter("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice"),
                      o.filter("o_orderstatus <> 'F'").select("o_orderkey", "o_totalprice", "o_orderstatus")])


@register("union_sources", "SELECT s_suppkey AS k, s_acctbal AS bal, 'supplier' AS source FROM supplier UNION ALL "
          "SELECT c_custkey, c_acctbal, 'customer' FROM customer")
def q_union_sources(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("bal"))
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("bal"))
    return mg.union_sources({"supplier": s, "customer": c})


# Old vs new outputs: lineitem against itself with one flag class replaced.
@register("compare", "SELECT *, 'only_a' AS side FROM (SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem "
          "EXCEPT ALL SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 'X' ELSE l_returnflag END "
          "FROM lineitem) a UNION ALL SELECT *, 'only_b' FROM (SELECT l_orderkey, l_linenumber, CASE WHEN "
          "l_returnflag = 'R' THEN 'X' ELSE l_returnflag END FROM lineitem EXCEPT ALL SELECT l_orderkey, "
          "l_linenumber, l_returnflag FROM lineitem) b")
def q_compare(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    b = li.withColumn("l_returnflag", F.when(F.col("l_returnflag") == "R", "X").otherwise(F.col("l_returnflag")))
    return mg.compare(li, b)


# lineitem's (l_orderkey, l_linenumber) is not unique: the latest write per
# key wins; base = shipped before 1998, delta = the rest (later writes).
UPSERT_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"]


@register("upsert", "SELECT l_orderkey, l_linenumber, " + ", ".join(UPSERT_COLS) + " FROM (SELECT *, row_number() OVER "
          "(PARTITION BY l_orderkey, l_linenumber ORDER BY CASE WHEN l_shipdate < TIMESTAMP '1998-01-01' THEN 0 ELSE 1 END "
          "DESC, " + ", ".join(f"{c} DESC" for c in UPSERT_COLS) + ") AS rn FROM lineitem) x WHERE rn = 1")
def q_upsert(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *UPSERT_COLS)
    base = li.filter(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    delta = li.filter(~(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")))
    return mg.upsert(base, delta, ["l_orderkey", "l_linenumber"], order=UPSERT_COLS)
