"""Results must not depend on file layout, split packing, sizes or earlier failures."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from sensorlake.functions import text as X
from sensorlake.functions.time import lenient_double, lenient_ts
from sensorlake.operators import datefmt, merge, ordering
from sensorlake.sources import files, sinks
from sensorlake.streaming import streams

POINT = "time timestamp_ntz, location string, source string, measurement string, data_key string, data_value double"
T0 = dt.datetime(2024, 3, 1, 10)


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


@pytest.mark.parametrize("header", ["Logger\nDate,Time,T,H\n", "01/01/2024,00:00,1,1\n02/01/2024,00:00,1,1\n"])
def test_drops_survive_another_packing_between_detection_and_parse(spark, tmpdir_path, header):
    for k in range(12):
        rows = "".join(f"{d:02d}/03/2024,{h:02d}:00,2{k % 10}.0,40\n" for d in range(1, 14) for h in range(8))
        write(f"{tmpdir_path}/drops/Logger_00{k:02X}_x.csv", header + rows)
    try:
        spark.conf.set("spark.sql.files.minPartitionNum", "6")
        lines = files.drop_lines(spark, f"{tmpdir_path}/drops")
        decisions = datefmt.detect_date_format(lines, "2024-06-01")
        good, quarantine = datefmt.parse_drops(lines, decisions)
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
        assert good.count() == 12 * 13 * 8 and quarantine.count() == 0
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")


def test_detection_shuffles_no_text(spark, tmpdir_path):
    write(f"{tmpdir_path}/drops/Logger_00A1_x.csv", "h\nh\n13/03/2024,01:00,20,40\n")
    plan = datefmt.date_evidence(files.drop_lines(spark, f"{tmpdir_path}/drops"))._jdf.queryExecution().optimizedPlan().toString()
    above = plan[:plan.index("Window")] + plan[plan.index("Window"):].split("\n")[1]
    assert "text#" not in above


def test_columns_are_bound_by_name_in_every_file(spark, tmpdir_path):
    write(f"{tmpdir_path}/m/additive_2024-01.hourly.csv", "time,location,source,measurement,data_key,data_value\n2024-01-01T00:00:00Z,L1,S1,additive,k,1.5\n")
    write(f"{tmpdir_path}/m/nonadditive_2024-02.hourly.csv", "data_value,source,location,measurement,data_key,time\n2.5,S2,L2,nonadditive,k,2024-02-01T02:00:00+02:00\n")
    got = sorted(tuple(r) for r in files.read_monthly(spark, f"{tmpdir_path}/m").collect())
    assert got == [(dt.datetime(2024, 1, 1), "L1", "S1", "additive", "k", 1.5), (dt.datetime(2024, 2, 1), "L2", "S2", "nonadditive", "k", 2.5)]
    write(f"{tmpdir_path}/m/additive_2024-03.hourly.csv", "time,location\n2024-03-01T00:00:00Z,L1\n")
    with pytest.raises(files.MissingColumns, match="additive_2024-03"):
        files.read_monthly(spark, f"{tmpdir_path}/m")


def test_incremental_merge_has_one_meaning(spark):
    old = spark.createDataFrame([(T0, "L", "k", 1.0)], "time timestamp_ntz, location string, data_key string, data_value double")
    new = spark.createDataFrame([(T0, "L", "k", 1.0), (T0, "L", "k", 2.0), (T0, "L", "k", 2.0), (None, "L", "k", 3.0)], old.schema)
    want = sorted(map(tuple, merge.merge_history(new, old).collect()), key=repr)
    assert sorted(map(tuple, merge.merge_history(new, old, incremental=True).collect()), key=repr) == want and len(want) == 3


def test_upsert_keeps_the_null_month(spark, tmpdir_path):
    path, key = f"{tmpdir_path}/points", ["time", "location", "source", "measurement", "data_key"]
    for value, location in ((1.0, "L1"), (2.0, "L2")):
        batch = spark.createDataFrame([(None, location, "S", "additive", "k", value)], POINT)
        streams.upsert_months(batch, path, key, ["data_value"])
    assert sorted(r["location"] for r in spark.read.parquet(path).collect()) == ["L1", "L2"]


def test_a_read_error_is_no_first_run(spark, tmpdir_path):
    write(f"{tmpdir_path}/points/part-0.parquet", "no parquet")
    batch = spark.createDataFrame([(T0, "L", "S", "additive", "k", 1.0)], POINT)
    with pytest.raises(Exception):
        streams.upsert_months(batch, f"{tmpdir_path}/points", ["time"], ["data_value"])
    assert sinks.stored(spark, f"{tmpdir_path}/nothing") is None


def test_a_half_written_version_is_not_read(spark, tmpdir_path):
    root = f"{tmpdir_path}/fact"
    sinks.write_fact(spark.range(3), root, "v1")
    spark.range(1).write.parquet(f"{root}/version=v2")              # died before its marker
    assert sinks.read_fact_version(spark, root).count() == 3
    assert sinks.read_fact_version(spark, root, "v2").count() == 1


def test_row_numbers_with_payload(spark):
    n = 300_000
    df = spark.range(n).select(F.xxhash64("id").alias("k"), F.rand(5).alias("payload")).repartition(7)
    got = ordering.global_row_number(df, ["k"]).agg(F.countDistinct("row_no"), F.min("row_no"), F.max("row_no")).first()
    assert tuple(got) == (n, 1, n)


def test_lenient_casts(spark):
    rows = [("2024-01-01T10:00:00+02:00", "1d"), ("2024-01-01 10:00:00-0330", "1e3"), ("2024-01-01T10:00:00Z", " 2.50 "), ("2024-01-01", "x"), ("bad", None)]
    got = [tuple(r) for r in spark.createDataFrame(rows, "a string, b string").select(lenient_ts("a"), lenient_double("b")).collect()]
    day = dt.datetime(2024, 1, 1)
    assert got == [(day + dt.timedelta(hours=8), None), (day + dt.timedelta(hours=13, minutes=30), 1000.0), (day + dt.timedelta(hours=10), 2.5),
                   (day, None), (None, None)]


def test_after_prefix_keeps_long_texts(spark):
    df = spark.createDataFrame([("ab" + "x" * (2 << 20),)], "c string")
    assert df.select(F.length(X.after_prefix("c", "ab"))).first()[0] == 2 << 20


def test_changed_months_are_new_or_fresher(spark):
    schema = "source string, year_month string, max_loaded_at timestamp_ntz"
    later, sooner = T0 + dt.timedelta(days=1), T0 - dt.timedelta(days=1)
    now = spark.createDataFrame([("a", "2024-01", later), ("b", "2024-01", sooner), ("c", "2024-01", T0), ("d", "2024-01", T0), (None, "2024-01", T0)], schema)
    state = spark.createDataFrame([("a", "2024-01", T0), ("b", "2024-01", T0), ("c", "2024-01", T0), (None, "2024-01", T0)], schema)
    assert sorted(r["source"] for r in streams.changed_months(now, state).collect()) == ["a", "d"]


def test_display_order_sorts(spark):
    df = spark.createDataFrame([("B", "k2"), ("A", "k1"), ("B", "k1"), ("C", "k1")], "source string, data_key string").repartition(3)
    out = ordering.display_order(df, {"B": 1, "A": 2}, {"k1": 1, "k2": 2}).collect()
    assert [(r["source"], r["data_key"]) for r in out] == [("B", "k1"), ("B", "k2"), ("A", "k1"), ("C", "k1")]
