"""Stream = batch, and late data handling."""

import datetime as dt
import os

from pyspark.sql import functions as F

from sensorlake.session import scratch_path
from sensorlake.streaming import streams as st

SCHEMA = "time timestamp_ntz, measurement string, location string, source string, data_key string, data_value double"


def rows(hours, value=1.0):
    base = dt.datetime(2024, 1, 1)
    return [(base + dt.timedelta(hours=h, minutes=5), "additive", "L", "A", "k", value) for h in hours]


def test_append_mode_drops_late_file(spark):
    src = scratch_path(spark, "t_stream_src")
    out = scratch_path(spark, "t_stream_out")
    ck = scratch_path(spark, "t_stream_ck")
    schema = spark.createDataFrame([], SCHEMA).schema

    def stream():
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)

    spark.createDataFrame(rows(range(0, 10)), SCHEMA).coalesce(1).write.mode("append").parquet(src)
    st.run_available_now(st.stream_resample(stream(), delay="1 hour"), ck, path=out, mode="append")
    # a late file: hour 2 again, far behind the watermark (hour 9 - 1 h)
    spark.createDataFrame(rows([2], 100.0), SCHEMA).coalesce(1).write.mode("append").parquet(src)
    spark.createDataFrame(rows(range(10, 14)), SCHEMA).coalesce(1).write.mode("append").parquet(src)
    st.run_available_now(st.stream_resample(stream(), delay="1 hour"), ck, path=out, mode="append")
    got = {str(r["time"]): r["data_value"] for r in spark.read.parquet(out).collect()}
    assert got["2024-01-01 03:00:00"] == 1.0            # the late point did not change a closed window
    # watermark = 13:05 - 1 h: the window ending 12:00 is closed, the one ending 13:00 still open
    assert "2024-01-01 12:00:00" in got and "2024-01-01 13:00:00" not in got


def test_update_mode_with_upsert_equals_batch(spark):
    from sensorlake.operators.aggregates import resample
    src = scratch_path(spark, "t_upd_src")
    out = scratch_path(spark, "t_upd_out")
    data = rows(range(0, 30)) + rows(range(5, 8), 4.0)
    df = spark.createDataFrame(data, SCHEMA)
    for i in range(3):
        df.filter(F.hour("time") % 3 == i).coalesce(1).write.mode("append").parquet(src)
    s = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)
    st.run_available_now(st.stream_resample(s, delay="30 days"), scratch_path(spark, "t_upd_ck"), mode="update",
                         foreach_batch=st.upsert_months_writer(out, ["time", "measurement", "location", "source",
                                                                     "data_key"], ["data_value"]))
    got = sorted((str(r["time"]), r["data_value"]) for r in spark.read.parquet(out).collect())
    want = sorted((str(r["time"]), r["data_value"]) for r in resample(df).collect())
    assert got == want


def test_session_spans(spark):
    src = scratch_path(spark, "t_sess_src")
    out = scratch_path(spark, "t_sess_out")
    data = rows([0, 1, 2, 10, 11, 30])
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.parquet(src)
    s = spark.readStream.schema(spark.createDataFrame([], SCHEMA).schema).parquet(src)
    st.run_available_now(st.stream_sessions(s, gap="2 hours", delay="1 hour"), scratch_path(spark, "t_sess_ck"),
                         path=out, mode="append")
    got = sorted((str(r["session_start"]), r["n"]) for r in spark.read.parquet(out).collect())
    assert got == [("2024-01-01 00:05:00", 3), ("2024-01-01 10:05:00", 2)]   # the last session is still open


def test_batch_writers_are_idempotent_on_retry(spark):
    """foreachBatch is at-least-once: running the same epoch twice must not change the result."""
    out = scratch_path(spark, "t_idem")
    batch = spark.createDataFrame(rows(range(0, 5)), SCHEMA)
    w = st.upsert_months_writer(out, ["time", "measurement", "location", "source", "data_key"], ["data_value"])
    w(batch, 0)
    first = sorted(map(tuple, spark.read.parquet(out).collect()))
    w(batch, 0)
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == first


def test_drops_are_parsed_together_after_the_micro_batches(spark, tmpdir_path, monkeypatch):
    """Micro-batches only store their lines: detection is planned once, whatever the number of files."""
    from sensorlake.operators import datefmt
    calls, detect = [], datefmt.detect_date_format
    monkeypatch.setattr(datefmt, "detect_date_format", lambda *a, **k: calls.append(1) or detect(*a, **k))
    src, out, ck = f"{tmpdir_path}/in", f"{tmpdir_path}/out", f"{tmpdir_path}/ck"
    os.makedirs(src)

    def drop(k, lines):
        with open(f"{src}/Logger_00{k:02X}_x.csv", "w") as f:
            f.write("h\nh\n" + "".join(f"{x}\n" for x in lines))

    def run():
        stream = st.stream_drops(spark, src, archive_dir=f"{tmpdir_path}/done", max_files=1)
        st.run_available_now(stream, ck, foreach_batch=st.drops_batch_writer(out, "2024-03-31"))
        return spark.read.parquet(out)

    for k in range(3):
        drop(k, [f"{13 + k}/03/2024,01:00,{k},40", "14/03/2024,02:00,abc,41"])
    drop(3, ["garbage"])
    rows_ = run()
    assert len(calls) == 1
    assert sorted((str(r["Datetime"]), r["Temperature_Celsius"], r["Location"]) for r in rows_.collect()) == [
        (f"2024-03-{13 + k} 01:00:00", float(k), f"{k:04X}") for k in range(3)]
    bad = spark.read.parquet(f"{out}_quarantine").collect()
    assert len(bad) == 3 and all(r["file"].startswith("file:") and r["reason"] == "non_numeric" for r in bad)
    assert [r["file"].rsplit("/", 1)[1] for r in spark.read.parquet(f"{out}_undecided").collect()] == ["Logger_0003_x.csv"]
    drop(4, ["17/03/2024,01:00,9,40"])          # a later run parses what is new only
    assert run().count() == 4 and len(calls) == 2
    # lines of a run that ended before it parsed are parsed by the next, once
    writer = st.drops_batch_writer(out, "2024-03-31")
    late = spark.createDataFrame([("file:/in/Logger_0009_x.csv", 0, x) for x in ("h", "h", "18/03/2024,01:00,9,40")],
                                 "file string, block long, value string").coalesce(1)
    writer(late, 99)
    writer(late, 99)
    st.drops_batch_writer(out, "2024-03-31").finish(spark)
    st.drops_batch_writer(out, "2024-03-31").finish(spark)
    assert spark.read.parquet(out).count() == 5


def test_a_micro_batch_of_many_files_is_one_job(spark, tmpdir_path):
    """Listing the files of a micro-batch starts no job, and few files are stored for them (F1)."""
    src, out = f"{tmpdir_path}/in", f"{tmpdir_path}/out"
    os.makedirs(src)
    for k in range(70):
        with open(f"{src}/Logger_00{k:02X}_x.csv", "w") as f:
            f.write(f"h\nh\n14/03/2024,01:00,{k},40\n14/03/2024,02:00,abc,41\n")
    keys = [*st.MANY_BATCHES, *st.LOCAL_CHECKPOINT, *st.DropsWriter.settings]
    before = [spark.conf.get(key, None) for key in keys]
    stream = st.stream_drops(spark, src, archive_dir=f"{tmpdir_path}/done", max_files=40)
    q = st.run_available_now(stream, f"{tmpdir_path}/ck", foreach_batch=st.drops_batch_writer(out, "2024-03-31"))
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(str(q.runId))) == 2
    for b in range(2):
        assert len([f for f in os.listdir(f"{out}_lines/_batch={b}") if f.startswith("part-")]) <= 4
    got = spark.read.parquet(out).collect()
    assert sorted((r["Location"], str(r["Datetime"]), r["Temperature_Celsius"], r["_batch"] in (0, 1)) for r in got) == [
        (f"{k:04X}", "2024-03-14 01:00:00", float(k), True) for k in range(70)]
    assert spark.read.parquet(f"{out}_quarantine").count() == 70
    # the settings held for the stream only
    assert [spark.conf.get(key, None) for key in keys] == before


def test_a_stored_micro_batch_is_replaced_as_a_whole(spark, tmpdir_path):
    """A micro-batch that runs again with fewer stored files leaves none of the first run's lines."""
    out = f"{tmpdir_path}/out"
    data = [(f"file:/in/Logger_000{k}_x.csv", 0, x) for k in range(4) for x in ("h", "h", f"1{k + 3}/03/2024,01:00,{k},40")]
    batch = spark.createDataFrame(data, "file string, block long, value string")
    writer = st.drops_batch_writer(out, "2024-03-31")
    writer(batch.repartition(4, "file"), 7)
    writer(batch.coalesce(1), 7)
    assert spark.read.parquet(f"{out}_lines").count() == len(data)
    writer.finish(spark)
    assert sorted((r["Location"], r["Temperature_Celsius"], r["_batch"]) for r in spark.read.parquet(out).collect()) == [
        (f"000{k}", float(k), 7) for k in range(4)]
