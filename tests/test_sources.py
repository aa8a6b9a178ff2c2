"""Readers and writers on hand-made files."""

import os

import pytest
from pyspark.sql import functions as F

from sensorlake.sources import files as src
from sensorlake.sources import sinks as snk

HDR = "time,location,source,measurement,data_key,data_value\n"


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_read_monthly_named_layout(spark, tmpdir_path):
    write(f"{tmpdir_path}/additive_2024-01.hourly.csv", HDR + "2024-01-01T01:00:00Z,1NP-S1,A,additive,k,1.5\n")
    write(f"{tmpdir_path}/nonadditive_2024-02.hourly.csv", HDR + "bad-time,1NP-S1,A,nonadditive,k,x\n")
    write(f"{tmpdir_path}/other_2024-02.hourly.csv", HDR + "2024-01-01T01:00:00Z,no,no,no,no,9\n")
    rows = sorted(src.read_monthly(spark, tmpdir_path).collect(), key=lambda r: r["measurement"])
    assert len(rows) == 2
    assert str(rows[0]["time"]) == "2024-01-01 01:00:00" and rows[0]["data_value"] == 1.5
    assert rows[1]["time"] is None and rows[1]["data_value"] is None      # unparseable -> NULL, kept


def test_read_monthly_missing_columns_and_no_files(spark, tmpdir_path):
    write(f"{tmpdir_path}/a/additive_2024-01.hourly.csv", "time,location\n2024-01-01,x\n")
    with pytest.raises(src.MissingColumns):
        src.read_monthly(spark, f"{tmpdir_path}/a")
    os.makedirs(f"{tmpdir_path}/empty")
    assert src.read_monthly(spark, f"{tmpdir_path}/empty").count() == 0


def test_read_annotated_drops_comments_and_repeated_headers(spark, tmpdir_path):
    hdr = "_time,_measurement,location,source,quantity,_field,_value\n"
    text = ("#datatype,dateTime:RFC3339,string,string,string,string,string,double\n#group,false\n#default,,\n" + hdr
            + "2024-01-01T00:00:00Z,nonadditive,L1,A,temp,temp,21.5\n\n" + hdr
            + "2024-01-01T01:00:00Z,nonadditive,L1,A,hum,hum,40\n")
    write(f"{tmpdir_path}/x.annotated.csv", text)
    rows = src.read_annotated(spark, tmpdir_path).orderBy("time").collect()
    assert [(r["data_key"], r["data_value"]) for r in rows] == [("temp", 21.5), ("hum", 40.0)]


def test_reload_exports_later_file_wins_and_skips_empty(spark, tmpdir_path):
    hdr = "_time,_measurement,location,source,quantity,_value\n"
    write(f"{tmpdir_path}/2024/a.csv", hdr + "2024-01-01T00:00:00Z,nonadditive,L,A,t,1\n")
    write(f"{tmpdir_path}/2024/b.csv", hdr + "2024-01-01T00:00:00Z,nonadditive,L,A,t,2\n")
    write(f"{tmpdir_path}/2024/empty.csv", "")
    write(f"{tmpdir_path}/2024/blank.csv", "\n \n")
    rows = src.reload_exports(spark, tmpdir_path).collect()
    assert [r["data_value"] for r in rows] == [2.0]
    bad = src.damaged_exports(spark, tmpdir_path).collect()
    assert [(r["file"].rsplit("/", 1)[1], r["length"]) for r in bad] == [("blank.csv", 3)]


def test_seed_row_order_and_rename_last_wins(spark, tmpdir_path):
    from sensorlake.operators.joins import rename_values
    write(f"{tmpdir_path}/location_map.csv", "from,to\nU_01,1NP-S1\nU_01,1NP-S9\nU_02,2NP-S2\n")
    m = src.read_seed(spark, f"{tmpdir_path}/location_map.csv", "location_map")
    df = spark.createDataFrame([("U_01",), ("U_02",), ("u_05",)], "location string")
    got = sorted(r[0] for r in rename_values(df, m, order_col="_row").collect())
    assert got == ["1NP-S9", "2NP-S2", "u_05"]


def test_write_monthly_rewrites_only_present_months(spark, tmpdir_path):
    import datetime as dt
    rows = [(dt.datetime(2024, m, 1), "additive", "L", "A", "k", float(m)) for m in (1, 2, 3)]
    df = spark.createDataFrame(rows, "time timestamp_ntz, measurement string, location string, source string, "
                                     "data_key string, data_value double")
    snk.write_monthly(df, tmpdir_path)
    snk.write_monthly(df.filter(F.month("time") == 2).withColumn("data_value", F.lit(20.0)), tmpdir_path)
    got = sorted((r["year_month"], r["data_value"]) for r in spark.read.parquet(tmpdir_path).collect())
    assert got == [("2024-01", 1.0), ("2024-02", 20.0), ("2024-03", 3.0)]


def test_write_fact_versions(spark, tmpdir_path):
    import datetime as dt
    a = spark.createDataFrame([(dt.datetime(2024, 1, 1), "l", "k", 1.0)], "time timestamp_ntz, location string, "
                                                                           "data_key string, data_value double")
    snk.write_fact(a, tmpdir_path, "v1")
    snk.write_fact(a.withColumn("data_value", F.lit(2.0)), tmpdir_path, "v2")
    assert [r["data_value"] for r in snk.read_fact_version(spark, tmpdir_path).collect()] == [2.0]
    assert [r["data_value"] for r in snk.read_fact_version(spark, tmpdir_path, "v1").collect()] == [1.0]


def test_no_drop_files_gives_an_empty_table(spark, tmpdir_path):
    from sensorlake.operators.datefmt import merge_drops
    good, dec, bad = merge_drops(spark, f"{tmpdir_path}/does-not-exist", "2024-01-31")
    assert good.count() == 0 and dec.count() == 0 and bad.count() == 0
    assert good.columns == ["Datetime", "Temperature_Celsius", "Relative_Humidity(%)", "Location"]


def test_stage_from_mapping_table(spark):
    import datetime as dt
    from sensorlake.operators.star import stage_from_table
    a = spark.createDataFrame([(dt.datetime(2024, 1, 5), "L1", "t", 21.0), (dt.datetime(2024, 1, 6), "L1", "t", 99.0)],
                              "ts timestamp_ntz, loc string, kind string, v double")
    b = spark.createDataFrame([("2024-01-07 00:00:00", "h", 40.0)], "stamp string, kind string, val double")
    m = spark.createDataFrame([
        ("ds_a", "ts", "loc", "kind", "v", "A", -10.0, 50.0, 0, None),
        ("ds_b", "stamp", "", "kind", "val", "B", 0.0, 100.0, 0, "roof"),
        ("ds_c", "x", "", "x", "x", "C", 0.0, 1.0, 0, None),
    ], "datasource_id string, timestamp_column string, location_column string, measurement_column string, "
       "value_column string, source_name string, value_min double, value_max double, retention_months int, "
       "location string")
    out = sorted(tuple(r) for r in stage_from_table({"ds_a": a, "ds_b": b}, m).select(
        "datasource_id", "location", "data_key", "data_value").collect())
    assert out == [("ds_a", "L1", "t", 21.0), ("ds_b", "roof", "h", 40.0)]


def test_reload_exports_later_line_wins_inside_a_file(spark, tmpdir_path):
    hdr = "_time,_measurement,location,source,quantity,_value\n"
    write(f"{tmpdir_path}/x/a.csv", hdr + "2024-01-01T00:00:00Z,nonadditive,L,A,t,9\n"
                                       "2024-01-01T00:00:00Z,nonadditive,L,A,t,3\n")
    rows = src.reload_exports(spark, f"{tmpdir_path}/x").collect()
    assert [r["data_value"] for r in rows] == [3.0]


def test_files_of_different_headers_comments_and_blank_lines(spark, tmpdir_path):
    write(f"{tmpdir_path}/long.csv", "# note\n\nb,a\n" + "".join(f"{i},{-i}\n" for i in range(5000)))
    write(f"{tmpdir_path}/short.csv", "a,c,A\n1,2,3\n")
    write(f"{tmpdir_path}/blank.csv", "\n\n")
    df = src.csv_by_name(spark, tmpdir_path, comment="#")
    rows = {(r["_file"].rsplit("/", 1)[1], r["b"], r["c"], r["A_2"]) for r in df.collect()}
    assert rows == {("long.csv", str(i), None, None) for i in range(5000)} | {("short.csv", None, "2", "3")}


def test_several_headers_are_one_scan_without_a_list_of_files(spark, tmpdir_path):
    for i in range(30):
        write(f"{tmpdir_path}/f{i}.csv", ("x,y\n{0},{1}\n" if i % 2 else "y,X\n{1},{0}\n").format(i, i + 100))
    df = src.csv_by_name(spark, tmpdir_path)
    assert sorted((int(r["x"]), int(r["y"])) for r in df.collect()) == [(i, i + 100) for i in range(30)]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("] csv") == 1 and "] text" not in plan


def test_names_that_clash_are_told_apart(spark, tmpdir_path):
    write(f"{tmpdir_path}/a.csv", "_file,v,v,\n1,2,3,4\n")
    df = src.csv_by_name(spark, tmpdir_path)
    assert df.columns == ["_file_0", "v", "v_2", "_c3", "_file", "_mtime", "_line"]
    assert tuple(df.drop(*src.ORIGIN).first()) == ("1", "2", "3", "4")
    with pytest.raises(src.MissingColumns, match="a.csv"):
        src.csv_by_name(spark, tmpdir_path, required=["w"])


def test_header_diff_names_every_file_that_differs(spark, tmpdir_path):
    write(f"{tmpdir_path}/a.csv", "x,y\n1,2\n")
    write(f"{tmpdir_path}/b.csv", "# c\ny,x\n1,2\n")
    write(f"{tmpdir_path}/c.csv", "x,z,z\n1,2,3\n")
    write(f"{tmpdir_path}/d.csv", "x\n")
    write(f"{tmpdir_path}/e.csv", "\n")
    got = {tuple(r) for r in src.header_diff(spark, tmpdir_path, ["x", "y"], comment="#").drop("file").collect()}
    assert got == {("c.csv", "y", "missing", "error"), ("c.csv", "z", "unexpected", "warn"), ("c.csv", "z_2", "unexpected", "warn"),
                   ("d.csv", "y", "missing", "error")}
    assert src.header_diff(spark, f"{tmpdir_path}/a.csv", ["y", "x"]).count() == 0


def test_header_scan_sorts_no_lines(spark, tmpdir_path):
    """The first line of each file is found by an aggregate of numbers; one over the lines themselves would sort them all."""
    for k, head in enumerate(("a,b", "b,a", "a,b")):
        write(f"{tmpdir_path}/in put/f{k}.csv", f"\n# note\n{head}\n" + "1,2\n" * 50)
    lines = spark.read.text(f"{tmpdir_path}/in put")
    heads = src.first_lines(lines, "#")
    plan = heads._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Sort " not in plan
    found = src.header_lines(lines, heads)
    assert [(h, f.rsplit("/", 1)[1]) for h, _, f in found] == [("a,b", "f0.csv"), ("b,a", "f1.csv")]
    rows = src.csv_by_name(spark, f"{tmpdir_path}/in put", comment="#").groupBy("a", "b").count().collect()
    assert sorted(map(tuple, rows)) == [("1", "2", 100), ("2", "1", 50)]


def test_annotated_files_are_written_by_several_tasks(spark, tmpdir_path):
    from pyspark.sql import functions as F

    from sensorlake.plans import catalog_io
    ev = spark.range(2000).select(
        F.col("id").alias("event_id"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, id)").alias("ts"),
        (F.col("id") % 7).alias("user_id"), F.expr("element_at(array('click', 'view', 'purchase'), int(id % 3 + 1))").alias("event_type"),
        (F.col("id") / 4).alias("value"), F.lit("{}").alias("props"))
    ev.write.parquet(f"{tmpdir_path}/events.parquet")
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = catalog_io.render_annotated(spark, tmpdir_path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    per_file = [r["count"] for r in spark.read.text(path).groupBy(F.col("_metadata.file_path").alias("f")).count().collect()]
    assert len(per_file) > 4 and max(per_file) < sum(per_file) / 2
    got = src.read_annotated(spark, path)
    want = catalog_io.readings(spark, tmpdir_path).select(got.columns)
    assert got.count() == 2000 and got.exceptAll(want).isEmpty()
