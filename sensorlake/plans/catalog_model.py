"""Driver-table queries: explorer facets, star schema, SCD2, hierarchy."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorlake.functions.time import trunc
from sensorlake.operators import explore as ex
from sensorlake.operators import hierarchy as hy
from sensorlake.operators import joins as jn
from sensorlake.operators import ordering as od
from sensorlake.operators import quality as qa
from sensorlake.operators import star as st
from sensorlake.plans.registry import register
from sensorlake.plans.tables import AS_OF, AS_OF_EVENTS, READINGS_NULLS_SQL, READINGS_SQL, readings, sql_with, table

R, RN = READINGS_SQL, READINGS_NULLS_SQL


def _w(sql, nulls=False):
    return sql_with(sql, readings=RN if nulls else R)


# ---------------------------------------------------------------- explorer
@register("facet_filter", _w(
    "SELECT * FROM readings WHERE data_key IN ('purchase', 'view', 'error') AND (data_key IN ('view') OR "
    "TRY_CAST(right(location, 1) AS INTEGER) IN (1, 2, 3)) AND (source = 'A' OR (source = 'B' AND left(location, 3) "
    "IN ('1NP', '4NP')))"))
def q_facet_filter(spark, d):
    return ex.facet_filter(readings(spark, d), ["purchase", "view", "error"], [1, 2, 3],
                           {"A": True, "B": ["1NP", "4NP", "9XX"]}, global_metrics=["view"])


@register("levels", _w(
    "SELECT DISTINCT location, TRY_CAST(right(location, 1) AS INTEGER) AS section, left(location, 3) AS floor, "
    "CASE WHEN left(location, 3) LIKE '%NP%' THEN 'NP' WHEN left(location, 3) LIKE '%PP%' THEN 'PP' END AS floor_class "
    "FROM readings"))
def q_levels(spark, d):
    return ex.with_levels(readings(spark, d).select("location").distinct())


# Floors from nation names are not NP/PP codes; the floor codes come from readings.
@register("floor_order", _w(
    "SELECT floor, CAST(row_number() OVER (ORDER BY CASE WHEN right(floor, 2) = 'NP' THEN 0 ELSE 1 END, CASE WHEN "
    "right(floor, 2) = 'NP' THEN -COALESCE(TRY_CAST(left(floor, length(floor) - 2) AS INTEGER), 0) ELSE "
    "COALESCE(TRY_CAST(left(floor, length(floor) - 2) AS INTEGER), 0) END, floor) AS INTEGER) AS floor_rank FROM "
    "(SELECT DISTINCT "
    "left(loc, 3) AS floor FROM (SELECT location AS loc FROM readings UNION ALL SELECT replace(location, 'NP', 'PP') "
    "FROM readings) u WHERE left(loc, 3) LIKE '%NP%' OR left(loc, 3) LIKE '%PP%') f"))
def q_floor_order(spark, d):
    r = readings(spark, d).select("location")
    both = r.unionByName(r.select(F.replace(F.col("location"), F.lit("NP"), F.lit("PP")).alias("location")))
    return od.floor_order(both)


SOURCE_PRIORITY = {"A": 1, "B": 2}
METRIC_ORDER = {"view": 1, "click": 2, "purchase": 3, "signup": 4}


@register("display_order", _w(
    "SELECT DISTINCT source, data_key, COALESCE(CASE source WHEN 'A' THEN 1 WHEN 'B' THEN 2 END, 1073741824) AS "
    "source_rank, COALESCE(CASE data_key WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 WHEN "
    "'signup' THEN 4 END, 1073741824) AS metric_rank FROM readings"))
def q_display_order(spark, d):
    r = readings(spark, d).select("source", "data_key").distinct()
    return od.display_order(r, SOURCE_PRIORITY, METRIC_ORDER)


@register("latest_period_asof", sql_with(
    "SELECT req.location, req.period, av.resolved FROM req ASOF LEFT JOIN av ON req.location = av.location AND "
    "req.period >= av.resolved", readings=R,
    req="SELECT DISTINCT location, date_trunc('day', time) AS period FROM readings",
    av="SELECT DISTINCT location, date_trunc('day', time) AS resolved FROM readings WHERE data_key = 'purchase'"))
def q_latest_period_asof(spark, d):
    r = readings(spark, d).withColumn("period", trunc("time", "day"))
    return jn.latest_period_asof(r.select("location", "period").distinct(), r.filter("data_key = 'purchase'"),
                                 "period", by=["location"])


@register("explore", _w(
    "SELECT date_trunc('month', time) AS period, source, CASE WHEN data_key = 'view' THEN '*' ELSE location END AS "
    "location, data_key, max(data_value) AS max_value, avg(data_value) AS avg_value, min(data_value) AS min_value, "
    "COALESCE(CASE source WHEN 'A' THEN 1 WHEN 'B' THEN 2 END, 1073741824) AS source_rank, COALESCE(CASE data_key "
    "WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 END, 1073741824) AS "
    "metric_rank FROM readings WHERE data_key IN ('purchase', 'view', 'click') AND (data_key IN ('view') OR "
    "TRY_CAST(right(location, 1) AS INTEGER) IN (1, 2, 3, 4, 5)) AND (source = 'A' OR (source = 'B' AND "
    "left(location, 3) IN ('2NP', '3NP', '5NP'))) GROUP BY 1, 2, 3, data_key", nulls=True))
def q_explore(spark, d):
    """Monthly max/avg/min lines for a facet selection (the explorer's query)."""
    return ex.explore(readings(spark, d, nulls=True), ["purchase", "view", "click"], [1, 2, 3, 4, 5],
                      {"A": True, "B": ["2NP", "3NP", "5NP"]}, grain="month", global_metrics=["view"],
                      aggregate_location_keys=["view"], source_priority=SOURCE_PRIORITY, metric_order=METRIC_ORDER)


# ---------------------------------------------------------------- star schema
STAGE_ROW = {"timestamp_column": "o_orderdate", "location_column": "o_custkey", "measurement_column": "o_orderpriority",
             "value_column": "o_totalprice", "source_name": "orders", "value_min": 1000, "value_max": 400000,
             "retention_months": 24}
STAGE_SQL = ("(SELECT o_orderdate AS time, CAST(o_custkey AS VARCHAR) AS location, o_orderpriority AS data_key, "
             "o_totalprice AS data_value, 'orders' AS source FROM orders WHERE o_orderdate IS NOT NULL AND o_totalprice "
             f"BETWEEN 1000 AND 400000 AND o_orderdate >= date_trunc('month', TIMESTAMP '{AS_OF}') - INTERVAL 23 MONTH "
             f"AND o_orderdate <= TIMESTAMP '{AS_OF}')")


@register("stage", "SELECT * FROM " + STAGE_SQL)
def q_stage(spark, d):
    return st.stage(table(spark, d, "orders"), STAGE_ROW, as_of=AS_OF)


MAPPING_ROWS = [
    ("ds_orders", "o_orderdate", "o_custkey", "o_orderpriority", "o_totalprice", "orders", 1000.0, 400000.0, 24, None),
    ("ds_lineitem", "l_shipdate", "", "l_returnflag", "l_quantity", "lineitem", 1.0, 40.0, 12, "warehouse"),
]


@register("stage_from_table", "SELECT *, 'ds_orders' AS datasource_id FROM " + STAGE_SQL + " s UNION ALL "
          "SELECT l_shipdate, 'warehouse', l_returnflag, l_quantity, 'lineitem', 'ds_lineitem' FROM lineitem WHERE "
          f"l_shipdate IS NOT NULL AND l_quantity BETWEEN 1 AND 40 AND l_shipdate >= date_trunc('month', TIMESTAMP "
          f"'{AS_OF}') - INTERVAL 11 MONTH AND l_shipdate <= TIMESTAMP '{AS_OF}'")
def q_stage_from_table(spark, d):
    """Templated staging driven by a mapping table (one row per datasource)."""
    m = spark.createDataFrame(MAPPING_ROWS, "datasource_id string, timestamp_column string, location_column string, "
                                           "measurement_column string, value_column string, source_name string, "
                                           "value_min double, value_max double, retention_months int, location string")
    frames = {"ds_orders": table(spark, d, "orders"), "ds_lineitem": table(spark, d, "lineitem")}
    return st.stage_from_table(frames, m, as_of=AS_OF)


@register("dim", _w("SELECT location, max(source) AS source, true AS one_key FROM readings GROUP BY location"))
def q_dim(spark, d):
    """The surrogate key is checked for being the only one of its natural key and the other way round."""
    from pyspark.sql import Window
    keyed = st.dim(readings(spark, d), ["location"], ["source"])
    one = (F.count("*").over(Window.partitionBy("key")) == 1) & (F.count("*").over(Window.partitionBy("location")) == 1)
    return keyed.withColumn("one_key", F.col("key").isNotNull() & one).drop("key")


def _readings_star(spark, d):
    r = readings(spark, d, nulls=True)
    dloc = st.dim(r, ["location"], key_col="location_key")
    dkey = st.dim(r, ["data_key", "measurement"], key_col="data_key_key")
    rules = qa.standard_row_rules(AS_OF_EVENTS, 100, 9000)
    f = st.fct_sensor_readings(r, [(dloc, ["location"], "location_key"), (dkey, ["data_key", "measurement"], "data_key_key")],
                               rules)
    return f, dloc, dkey


FLAGS_SQL = " + ".join(f"CASE WHEN {c} THEN {1 << k} ELSE 0 END" for k, c in enumerate([
    "time IS NULL", "measurement IS NOT NULL AND measurement NOT IN ('additive', 'nonadditive')",
    "data_value IS NOT NULL AND NOT (data_value BETWEEN 100 AND 9000)", "data_value IS NULL",
    f"time > TIMESTAMP '{AS_OF_EVENTS}'"]))


@register("fct_sensor_readings", _w("SELECT *, " + FLAGS_SQL + " AS quality_flags, CAST(time AS DATE) AS date, location AS "
                                    "location_of_key, data_key AS data_key_of_key FROM readings", nulls=True))
def q_fct_sensor_readings(spark, d):
    """The keys of the fact are looked up in their dimensions again."""
    f, dloc, dkey = _readings_star(spark, d)
    f = f.join(dloc.select("location_key", F.col("location").alias("location_of_key")), "location_key", "left")
    f = f.join(dkey.select("data_key_key", F.col("data_key").alias("data_key_of_key")), "data_key_key", "left")
    return f.drop("location_key", "data_key_key")


@register("star_join", _w("SELECT time, location, data_key, measurement, data_value, source FROM readings", nulls=True))
def q_star_join(spark, d):
    f, dloc, dkey = _readings_star(spark, d)
    fk = f.select("time", "location_key", "data_key_key", "data_value", "source")
    out = jn.star_join(fk, [(dloc, "location_key"), (dkey, "data_key_key")])
    return out.select("time", "location", "data_key", "measurement", "data_value", "source")


@register("add_tenant", _w("SELECT 'B1' AS building, * FROM readings"))
def q_add_tenant(spark, d):
    return st.add_tenant(readings(spark, d), "B1")


SCD2_SQL = ("(WITH x AS (SELECT o_custkey, o_orderdate AS t, max(o_orderstatus) AS st FROM orders GROUP BY 1, 2), "
            "p AS (SELECT *, lag(st) OVER (PARTITION BY o_custkey ORDER BY t) AS prev FROM x), "
            "s AS (SELECT * FROM p WHERE prev IS NULL OR prev <> st) "
            "SELECT o_custkey, st AS o_orderstatus, t AS effective_from, lead(t) OVER (PARTITION BY o_custkey "
            "ORDER BY t) AS effective_to FROM s)")


def _scd2(spark, d):
    return st.scd2(table(spark, d, "orders"), ["o_custkey"], ["o_orderstatus"], time_col="o_orderdate")


@register("scd2", "SELECT *, effective_to IS NULL AS is_current FROM " + SCD2_SQL)
def q_scd2(spark, d):
    return _scd2(spark, d)


@register("as_at", "SELECT f.l_orderkey, f.l_linenumber, f.o_custkey, f.time, v.effective_from, v.effective_to, "
          "v.o_orderstatus FROM (SELECT l.l_orderkey, l.l_linenumber, o.o_custkey, l.l_shipdate AS time FROM lineitem l "
          "JOIN orders o ON l.l_orderkey = o.o_orderkey) f ASOF JOIN " + SCD2_SQL + " v ON f.o_custkey = v.o_custkey "
          "AND f.time >= v.effective_from WHERE v.effective_to IS NULL OR f.time < v.effective_to")
def q_as_at(spark, d):
    li, o = table(spark, d, "lineitem"), table(spark, d, "orders")
    f = li.join(o, li.l_orderkey == o.o_orderkey).select("l_orderkey", "l_linenumber", "o_custkey",
                                                         F.col("l_shipdate").alias("time"))
    v = _scd2(spark, d).drop("is_current")
    return jn.as_at(f, v, ["o_custkey"], "time", attrs=["o_orderstatus"])


# ---------------------------------------------------------------- hierarchy
H_SQL = ("SELECT 'R' || CAST(r_regionkey AS VARCHAR) AS id, NULL::VARCHAR AS parent_id, 'region' AS type, r_name AS name, "
         "0 AS level FROM region UNION ALL SELECT 'N' || CAST(n_nationkey AS VARCHAR), 'R' || CAST(n_regionkey AS VARCHAR), "
         "'nation', n_name, 1 FROM nation UNION ALL SELECT 'C' || CAST(c_custkey AS VARCHAR), 'N' || "
         "CAST(c_nationkey AS VARCHAR), 'customer', c_name, 2 FROM customer")
CLOSURE_SQL = ("WITH RECURSIVE h AS (" + H_SQL + "), c(ancestor, descendant, depth, path) AS (SELECT id, id, 0, name FROM h "
               "UNION ALL SELECT c.ancestor, n.id, c.depth + 1, c.path || '/' || n.name FROM c JOIN h n ON "
               "n.parent_id = c.descendant) ")


def tpch_hierarchy(spark, d):
    r, n, c = table(spark, d, "region"), table(spark, d, "nation"), table(spark, d, "customer")
    return (r.select(F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("id"),
                     F.lit(None).cast("string").alias("parent_id"), F.lit("region").alias("type"),
                     F.col("r_name").alias("name"), F.lit(0).alias("level"))
             .unionByName(n.select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("id"),
                                   F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("parent_id"),
                                   F.lit("nation").alias("type"), F.col("n_name").alias("name"), F.lit(1).alias("level")))
             .unionByName(c.select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("id"),
                                   F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("parent_id"),
                                   F.lit("customer").alias("type"), F.col("c_name").alias("name"), F.lit(2).alias("level"))))


@register("hierarchy_closure", CLOSURE_SQL + "SELECT * FROM c")
def q_hierarchy_closure(spark, d):
    return hy.closure(tpch_hierarchy(spark, d))


@register("descendants", CLOSURE_SQL + "SELECT * FROM c WHERE depth >= 1 AND ancestor IN (SELECT id FROM h WHERE level = 0)")
def q_descendants(spark, d):
    h = tpch_hierarchy(spark, d)
    return hy.descendants(h, h.filter("level = 0").select("id"))


@register("ancestors", CLOSURE_SQL + "SELECT * FROM c WHERE depth >= 1 AND descendant IN (SELECT id FROM h WHERE level = 2)")
def q_ancestors(spark, d):
    h = tpch_hierarchy(spark, d)
    return hy.ancestors(h, h.filter("level = 2").select("id"))


@register("siblings", "WITH h AS (" + H_SQL + ") SELECT id, parent_id, type, CASE WHEN parent_id IS NULL THEN 0 ELSE "
          "(SELECT count(*) FROM h h2 WHERE h2.parent_id = h.parent_id) - 1 END AS n_siblings FROM h")
def q_siblings(spark, d):
    return hy.siblings(tpch_hierarchy(spark, d))


@register("siblings_of", "WITH h AS (" + H_SQL + ") SELECT a.id AS node, a.parent_id, b.id AS sibling FROM h a JOIN h b ON "
          "a.parent_id = b.parent_id AND a.id <> b.id WHERE a.level = 1")
def q_siblings_of(spark, d):
    """The sibling lists of all nations."""
    h = tpch_hierarchy(spark, d)
    return hy.siblings_of(h, h.filter("level = 1").select("id"))


PAIRS_SQL = ("(SELECT 'C' || CAST(min(c_custkey) AS VARCHAR) AS a, 'C' || CAST(max(c_custkey) AS VARCHAR) AS b FROM "
             "customer GROUP BY c_nationkey UNION SELECT 'C' || CAST(min(c_custkey) AS VARCHAR), 'C' || "
             "CAST(max(c_custkey) AS VARCHAR) FROM customer)")


@register("path", CLOSURE_SQL + ", p AS " + PAIRS_SQL + ", j AS (SELECT p.a, p.b, ca.ancestor AS lca, ca.depth AS up_a, "
          "cb.depth AS up_b, row_number() OVER (PARTITION BY p.a, p.b ORDER BY ca.depth + cb.depth) AS rn FROM p JOIN c ca "
          "ON ca.descendant = p.a JOIN c cb ON cb.descendant = p.b AND cb.ancestor = ca.ancestor) SELECT a, b, lca, up_a, "
          "up_b, up_a + up_b AS hops FROM j WHERE rn = 1")
def q_path(spark, d):
    c = table(spark, d, "customer")
    per_nation = c.groupBy("c_nationkey").agg(F.min("c_custkey").alias("a"), F.max("c_custkey").alias("b")).drop("c_nationkey")
    overall = c.agg(F.min("c_custkey").alias("a"), F.max("c_custkey").alias("b"))
    pairs = per_nation.unionByName(overall).select(F.concat(F.lit("C"), F.col("a").cast("string")).alias("a"),
                                                   F.concat(F.lit("C"), F.col("b").cast("string")).alias("b")).distinct()
    return hy.path(tpch_hierarchy(spark, d), pairs)


@register("readings_with_hierarchy", CLOSURE_SQL + "SELECT o.o_orderkey, o.o_totalprice, c.descendant AS node, c.ancestor, "
          "c.depth, h.type AS ancestor_type FROM orders o JOIN c ON c.descendant = 'C' || CAST(o.o_custkey AS VARCHAR) "
          "JOIN h ON h.id = c.ancestor")
def q_readings_with_hierarchy(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice",
                                         F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("node"))
    return hy.readings_with_hierarchy(o, tpch_hierarchy(spark, d))


@register("hierarchy_from_locations", _w(
    "SELECT 'B1' AS id, NULL::VARCHAR AS parent_id, 'building' AS type, 'B1' AS name, 0 AS level UNION ALL "
    "SELECT DISTINCT 'B1/' || left(location, 3), 'B1', 'floor', left(location, 3), 1 FROM readings UNION ALL "
    "SELECT DISTINCT 'B1/' || left(location, 3) || '/' || location, 'B1/' || left(location, 3), 'zone', location, 2 "
    "FROM readings"))
def q_hierarchy_from_locations(spark, d):
    return hy.hierarchy_from_locations(readings(spark, d), "B1")
