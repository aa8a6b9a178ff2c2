"""Physical-plan properties the scale design relies on."""

import pytest

import __spark_entry__ as E
from sensorlake.plans.registry import QUERIES as OWN
from conftest import SF_SMALL

Q = {k: v for k, v in E.queries().items() if k in OWN}     # those of sensorlake.llm are tested in tests/llm


def plan_of(df, executed=False):
    qe = df._jdf.queryExecution()
    if executed:
        df.write.format("noop").mode("overwrite").save()
        return qe.executedPlan().toString()
    return qe.sparkPlan().toString()


def _orders(spark):
    from sensorlake.plans.tables import table
    return table(spark, SF_SMALL, "orders").withColumnRenamed("o_orderdate", "time")


def test_retention_bound_reaches_the_scan(spark):
    from sensorlake.operators.filters import retain_months
    plan = plan_of(retain_months(_orders(spark), 12, "2001-08-15"))
    assert "GreaterThanOrEqual(o_orderdate,2000-09-01" in plan.replace(" ", "")


def test_retention_bound_from_parameters(spark):
    from sensorlake.operators.filters import retain_months
    params = spark.createDataFrame([("f", 4), ("f", 9)], "file_nm string, history int")
    plan = plan_of(retain_months(_orders(spark), None, "2001-08-15", params=params))
    assert "GreaterThanOrEqual(o_orderdate,2001-05-01" in plan.replace(" ", "")     # latest start wins
    lazy = plan_of(retain_months(_orders(spark), None, "2001-08-15", params=params, lazy_bound=True))
    scan = [line for line in lazy.splitlines() if "FileScan" in line][0]
    assert "scalar-subquery" in scan
    none = retain_months(_orders(spark), None, "2001-08-15", params=params.filter("file_nm = 'x'"))
    assert none.count() == 0


def test_only_mapped_signals_are_read(spark):
    plan = plan_of(Q["ventilation_fact"](spark, SF_SMALL))
    schema = [line for line in plan.splitlines() if "ReadSchema" in line and "l_shipdate" in line][0]
    assert "l_quantity" in schema and "l_tax" not in schema


def test_top_n_per_series_limits_before_the_shuffle(spark):
    plan = plan_of(Q["head_per_series"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_upsert_is_an_aggregate_not_a_window(spark):
    plan = plan_of(Q["upsert"](spark, SF_SMALL))
    assert "max_by" in plan and "row_number" not in plan


def test_drop_parse_does_not_shuffle_lines(spark):
    from sensorlake.operators import datefmt as dfm
    from sensorlake.plans.catalog_drops import render_drops
    from sensorlake.sources.files import drop_lines
    lines = drop_lines(spark, render_drops(spark, SF_SMALL))
    dec = dfm.detect_date_format(lines, "2024-01-31")
    good, _ = dfm.parse_drops(lines, dec)
    plan = plan_of(good, executed=True)
    # the only hash exchanges belong to the detection side (broadcast to the lines)
    main = plan.split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in main


@pytest.mark.parametrize("name", sorted(k for k in Q if not k.startswith("stream_") and k != "late_data"))
def test_no_pairwise_joins(spark, name):
    plan = plan_of(Q[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_retention_passes_unpivot_join_union_to_both_scans(spark):
    plan = plan_of(Q["ventilation_fact"](spark, SF_SMALL)).replace(" ", "")
    assert "GreaterThanOrEqual(l_shipdate,1999-09-01" in plan       # wide side, below the unpivot
    assert "GreaterThanOrEqual(o_orderdate,1999-09-01" in plan      # history side, below the distinct


def test_broadcast_only_within_a_proven_bound(spark):
    from pyspark.sql import functions as F

    from sensorlake.operators.util import bounded_broadcast
    big = spark.range(0, 5000).withColumn("k", F.col("id") % 100)
    small = spark.range(0, 50).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")     # only explicit hints may broadcast
    try:
        hinted = plan_of(big.join(bounded_broadcast(small, 100), "k"))
        assert "BroadcastHashJoin" in hinted
        over = plan_of(big.join(bounded_broadcast(small, 10), "k"))     # bound not proven -> no hint
        assert "BroadcastHashJoin" not in over
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["gaps", "scd2", "rank_for_upsert"])
def test_ordered_windows_are_bucketed(spark, name):
    """No ordered window is partitioned by the series key alone: every
    row-level window also carries the time bucket (or the file block)."""
    check_bucketed(plan_of(Q[name](spark, SF_SMALL)))


def check_bucketed(plan):
    import re
    specs = re.findall(r"windowspecdefinition\(([^)]*?)(?:ASC|DESC)", plan)
    row_level = [s for s in specs if "_b" in s or "block" in s]
    assert row_level, specs


def test_as_at_small_dimension_leaves_readings_in_place_and_large_one_is_bucketed(spark):
    from sensorlake.operators.joins import as_at
    fct = spark.range(1000).selectExpr("id % 7 AS k", "timestamp_ntz'2024-01-01' + make_dt_interval(id % 90) AS time")
    dim = spark.range(21).selectExpr("id % 7 AS k", "timestamp_ntz'2024-01-10' + make_dt_interval(id) AS effective_from",
                                     "IF(id < 14, timestamp_ntz'2024-01-10' + make_dt_interval(id + 7), NULL) AS effective_to", "id AS a")
    small, large = as_at(fct, dim, ["k"]), as_at(fct, dim, ["k"], max_broadcast_rows=None)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))
    plan = plan_of(small)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Window" not in plan
    check_bucketed(plan_of(large))


def test_scd2_runs_no_job_while_planning_and_shares_its_exchanges(spark):
    from sensorlake.operators.star import scd2
    changes = spark.range(3000).selectExpr("id % 50 AS k", "timestamp_ntz'2024-01-01' + make_dt_interval(id % 700) AS time", "id % 3 AS a")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-scd2", "planning only")
    try:
        df = scd2(changes, ["k"], ["a"])
        assert not tracker.getJobIdsForGroup("plan-scd2")
        lazy = sorted(map(tuple, df.collect()))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()
    assert lazy == sorted(map(tuple, scd2(changes, ["k"], ["a"], cut_lineage=True).collect()))
