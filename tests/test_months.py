"""Months as the unit: write order, commits, checksums, and the steps of the daily job."""

import datetime as dt
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from sensorlake.operators import aggregates, checksum, merge
from sensorlake.plans import flows
from sensorlake.sources import snapshots
from test_daily_job import write

POINT = "time timestamp_ntz, measurement string, location string, source string, data_key string, data_value double"
KEY = ["time", "measurement", "location", "source", "data_key"]
BY = ("source", "year_month")


def t(month, day=1, hour=0):
    return dt.datetime(2024, month, day, hour)


def point(time, value, source="s", location="L"):
    return (time, "nonadditive", location, source, "k", value)


def points(spark, *rows):
    return spark.createDataFrame(list(rows), POINT)


def values(frame):
    return sorted(((str(r["time"]), r["source"], r["data_value"]) for r in frame.collect()), key=repr)


def setup(top):
    write(f"{top}/seeds/mapping.csv", "data_key_original,location,data_key\nAHU/t (°C),unit_01,temp_intake\n")
    write(f"{top}/seeds/mapping_indoor.csv", "sensor,location\n00A1,Z1\n")
    write(f"{top}/seeds/mapping_sources.csv", "file_nm,source_nm,history\nventilation.csv,Airway,6\ntemperature.csv,Attic,3\nhumidity.csv,Cellar,7\n")
    write(f"{top}/seeds/location_map.csv", "from,to\nZ1,1NP-S1\n")


def wide(top, name, rows, at):
    write(f"{top}/wide/{name}", "date,AHU/t (°C)\n" + "".join(f"{a},{b}\n" for a, b in rows))
    os.utime(f"{top}/wide/{name}", (at, at))


def run(spark, top, **more):
    args = {"drops_path": None} | more
    return flows.daily_job(spark, seeds_dir=f"{top}/seeds", wide_path=f"{top}/wide" if os.path.isdir(f"{top}/wide") else None,
                           fact_root=f"{top}/fact", indoor_root=f"{top}/indoor", points_root=f"{top}/points", public_dir=f"{top}/public",
                           as_of="2024-03-15 00:00:00", today="2024-03-15", **args)


def published(spark, top):
    return {str(r["time"]): r["data_value"] for r in flows.read_published(spark, f"{top}/public").collect()}


# ------------------------------------------------------------------ write order
def test_a_correction_down_and_one_up_reach_the_public_dataset(spark, tmpdir_path):
    setup(tmpdir_path)
    old = [("2024-01-01 10:15:00", 21.5), ("2024-02-01 10:15:00", 5.0), ("2024-02-01 10:15:00", 4.0), ("2024-03-01 10:15:00", 1.0)]
    wide(tmpdir_path, "b.csv", old, 1_700_000_000)
    run(spark, tmpdir_path)
    assert published(spark, tmpdir_path) == {"2024-01-01 11:00:00": 21.5, "2024-02-01 11:00:00": 4.0, "2024-03-01 11:00:00": 1.0}  # the later line
    # a later file, though its name sorts first
    wide(tmpdir_path, "a.csv", [("2024-01-01 10:15:00", 20.0), ("2024-02-01 10:15:00", 9.0), ("2024-02-01 10:15:00", 9.0)], 1_700_000_500)
    out = run(spark, tmpdir_path)
    assert out["public"]["months"] == ["2024-01", "2024-02"]
    want = {"2024-01-01 11:00:00": 20.0, "2024-02-01 11:00:00": 9.0, "2024-03-01 11:00:00": 1.0}
    assert published(spark, tmpdir_path) == want
    again = run(spark, tmpdir_path)                                     # nothing new: no version, no month
    assert again["public"]["months"] == [] and again["versions"]["points"] is None and again["versions"]["ventilation.csv"] is None
    assert published(spark, tmpdir_path) == want
    # back to the first value: it was written last now, though the facts hold both already
    wide(tmpdir_path, "c.csv", [("2024-01-01 10:15:00", 21.5)], 1_700_000_900)
    run(spark, tmpdir_path)
    assert published(spark, tmpdir_path)["2024-01-01 11:00:00"] == 21.5


def test_files_of_one_time_are_ordered_by_name(spark, tmpdir_path):
    setup(tmpdir_path)
    for name, v in (("b.csv", 1.0), ("a.csv", 9.0)):
        wide(tmpdir_path, name, [("2024-01-01 10:15:00", v)], 1_700_000_000)
    run(spark, tmpdir_path)
    assert published(spark, tmpdir_path) == {"2024-01-01 11:00:00": 1.0}


def test_last_written_and_merge_keep_one_row_a_fact(spark):
    seq = lambda s, p=0: (t(1, 1, s), "f", p)
    schema = "time timestamp_ntz, location string, data_key string, data_value double, load_seq struct<at:timestamp_ntz,file:string,place:bigint>"
    new = spark.createDataFrame([(t(1), "L", "k", 2.0, seq(1)), (t(1), "L", "k", 1.0, seq(2)), (t(1), "L", "k", 1.0, seq(0)), (t(2), "L", "k", None, seq(1))], schema)
    old = spark.createDataFrame([(t(1), "L", "k", 2.0, seq(0)), (t(1), "L", "k", 7.0, seq(1, 5))], schema)
    both = merge.merge_loads(new, old)
    assert both.count() == 4
    assert {(r["time"], r["data_value"]) for r in merge.last_written(both).collect()} == {(t(1), 1.0), (t(2), None)}


# ------------------------------------------------------------------ commits
def test_a_run_that_dies_before_its_commit_is_not_seen(spark, tmpdir_path, monkeypatch):
    root = f"{tmpdir_path}/points"
    snapshots.upsert_snapshot(points(spark, point(t(1), 1.0), point(t(2), 2.0)), root, KEY, by=BY)
    before = values(snapshots.read_snapshot(spark, root, BY))
    real = snapshots.manifest

    def dies(*args):
        raise RuntimeError("lost")

    calls = []
    monkeypatch.setattr(snapshots, "manifest", lambda *a, **k: real(*a, **k) if not calls.append(1) and len(calls) < 2 else dies())
    with pytest.raises(RuntimeError):       # both months are written, then the run is lost
        snapshots.upsert_snapshot(points(spark, point(t(1), 7.0), point(t(2), 8.0)), root, KEY, by=BY)
    monkeypatch.setattr(snapshots, "manifest", real)
    assert len(glob.glob(f"{root}/files/run=*")) == 2 and values(snapshots.read_snapshot(spark, root, BY)) == before
    snapshots.upsert_snapshot(points(spark, point(t(2), 9.0)), root, KEY, by=BY)
    assert [v for *_, v in values(snapshots.read_snapshot(spark, root, BY))] == [1.0, 9.0]
    snapshots.drop_versions(spark, root, BY, keep=1)
    assert len(glob.glob(f"{root}/files/run=*")) == 2                      # what the lost run wrote is gone, January is kept
    assert [v for *_, v in values(snapshots.read_snapshot(spark, root, BY))] == [1.0, 9.0]


def test_versions_name_months_again_and_old_ones_go(spark, tmpdir_path):
    root = f"{tmpdir_path}/t"
    frame = lambda *rows: points(spark, *rows).withColumn("year_month", F.date_format("time", "yyyy-MM"))
    first = snapshots.commit(frame(point(t(1), 1.0), point(t(2), 2.0), point(None, 3.0)), root)
    second = snapshots.commit(frame(point(t(2), 5.0)), root, replaced=[("2024-01",)])       # January lost its rows
    assert sorted(r[2] for r in values(snapshots.read_snapshot(spark, root))) == [3.0, 5.0]
    assert sorted(r[2] for r in values(snapshots.read_snapshot(spark, root, version=first))) == [1.0, 2.0, 3.0]
    assert snapshots.runs(spark, root) == {(None,): first, ("2024-02",): second}
    third = snapshots.commit(frame(point(t(3), 6.0)), root, keep_if=lambda p: p[0] is not None and p[0] >= "2024-03")
    assert snapshots.drop_versions(spark, root, keep=1) == [first, second]
    assert len(glob.glob(f"{root}/files/*/*/part-*")) == 1 and snapshots.versions(spark, root) == [third]
    empty = snapshots.commit(frame(point(t(3), 6.0)).limit(0), root, replaced=[("2024-03",)])
    assert snapshots.read_snapshot(spark, root).count() == 0 and snapshots.versions(spark, root)[-1] == empty
    assert snapshots.read_snapshot(spark, f"{tmpdir_path}/none") is None


def test_csv_months_are_read_back(spark, tmpdir_path):
    rows = points(spark, point(t(1, 2), 1.5), point(t(1), None), point(t(2), 2.0)).withColumn("year_month", F.date_format("time", "yyyy-MM"))
    snapshots.commit(rows, f"{tmpdir_path}/t", fmt="csv", within=["time"])
    assert sorted(map(tuple, snapshots.read_snapshot(spark, f"{tmpdir_path}/t").select(*rows.columns).collect()), key=repr) == \
        sorted(map(tuple, rows.collect()), key=repr)


def test_stream_batches_are_versions_and_may_run_twice(spark, tmpdir_path):
    root = f"{tmpdir_path}/t"
    w = snapshots.snapshot_writer(root, KEY, keep=1)
    for epoch, rows in enumerate([(point(t(1), 1.0), point(t(2), 2.0)), (point(t(1), 4.0),), (point(t(1), 4.0),)]):
        w(points(spark, *rows), epoch)
    assert [v for *_, v in values(snapshots.read_snapshot(spark, root, ("measurement", "year_month")))] == [4.0, 2.0]
    assert len(snapshots.versions(spark, root)) == 1


def test_points_missed_by_a_dead_run_are_loaded_by_the_next(spark, tmpdir_path, monkeypatch):
    setup(tmpdir_path)
    wide(tmpdir_path, "a.csv", [("2024-01-01 10:15:00", 1.0)], 1_700_000_000)
    real = flows.load_point_months
    monkeypatch.setattr(flows, "load_point_months", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run(spark, tmpdir_path)                     # facts are stored, points are not
    monkeypatch.setattr(flows, "load_point_months", real)
    run(spark, tmpdir_path)
    assert published(spark, tmpdir_path) == {"2024-01-01 11:00:00": 1.0}


# ------------------------------------------------------------------ checksums
def test_checksums_see_rows_that_occur_twice(spark):
    a, b = (points(spark, point(t(1), v), point(t(1), v)) for v in (1.0, 2.0))
    fresh, state = flows.changed_points(a, None)
    assert fresh.count() == 2 and flows.changed_points(a, state)[0].count() == 0
    assert flows.changed_points(b, state)[0].count() == 2


@pytest.mark.parametrize("seed", range(4))
def test_compare_days_equals_a_full_compare(spark, seed):
    draw = random.Random(seed)
    pool = [point(draw.choice([None, t(1, d), t(2, d)]), draw.choice([None, 1.0, 2.0]), draw.choice(["a", "b", None]), draw.choice(["L", None]))
            for d in (draw.randint(1, 4) for _ in range(30))]
    left = [draw.choice(pool) for _ in range(60)]
    right = list(left)
    for _ in range(seed * 2):
        right.pop(draw.randrange(len(right)))
        right.append(draw.choice(pool))
    a, b = points(spark, *left), points(spark, *right)
    want = sorted(map(tuple, merge.compare(a, b).collect()), key=repr)
    assert sorted(map(tuple, checksum.compare_days(a, b).collect()), key=repr) == want
    sums = [checksum.day_checksums(x) for x in (a, b)]
    assert (checksum.differing_days(*sums).count() > 0) == bool(want)
    months = checksum.rolled_up(sums[0], ["source", "year_month"]).collect()
    direct = checksum.checksums(a.withColumn("year_month", F.date_format("time", "yyyy-MM")), ["source", "year_month"], a.columns).collect()
    assert sorted(map(tuple, months), key=repr) == sorted(map(tuple, direct), key=repr)


def test_nulls_in_other_columns_are_other_rows(spark):
    x = spark.createDataFrame([(1, "a", None)], "g int, p string, q string")
    y = spark.createDataFrame([(1, None, "a")], "g int, p string, q string")
    assert checksum.differing(checksum.checksums(x, ["g"], ["p", "q"]), checksum.checksums(y, ["g"], ["p", "q"]), ["g"]).count() == 1


def test_compare_reads_only_months_that_differ(spark, tmpdir_path):
    frame = points(spark, *[point(t(m, d), float(d)) for m in (1, 2, 3) for d in (1, 2, 3)]).withColumn("year_month", F.date_format("time", "yyyy-MM"))
    other = frame.withColumn("data_value", F.when(F.to_date("time") == F.lit("2024-02-02").cast("date"), 99.0).otherwise(F.col("data_value")))
    for name, x in (("a", frame), ("b", other)):
        snapshots.commit(x, f"{tmpdir_path}/{name}")
    a, b = (snapshots.read_snapshot(spark, f"{tmpdir_path}/{n}") for n in "ab")
    out = checksum.compare_days(a, b)
    assert sorted((r["data_value"], r["side"]) for r in out.collect()) == [(2.0, "only_a"), (99.0, "only_b")]
    assert "PartitionFilters: [isnotnull(year_month" in out._jdf.queryExecution().toString() and "2024-02" in out._jdf.queryExecution().toString()


# ------------------------------------------------------------------ steps of the job
def test_a_failed_gate_publishes_nothing(spark, tmpdir_path):
    setup(tmpdir_path)
    wide(tmpdir_path, "a.csv", [("2024-01-01 10:15:00", 1.0)], 1_700_000_000)
    run(spark, tmpdir_path)
    wide(tmpdir_path, "b.csv", [("2024-03-20 10:15:00", 1.0)], 1_700_000_100)       # after as_of
    with pytest.raises(flows.GateFailed, match="future_rows"):
        run(spark, tmpdir_path)
    assert published(spark, tmpdir_path) == {"2024-01-01 11:00:00": 1.0}
    out = run(spark, tmpdir_path, gate_on="report")
    assert out["gate"] == "fail" and len(published(spark, tmpdir_path)) == 2
    assert {r["source"]: r["status"] for r in out["reports"]["freshness"].collect()} == {"Airway": "pass"}


def test_earlier_exports_fill_gaps_and_raw_months_are_written(spark, tmpdir_path):
    setup(tmpdir_path)
    wide(tmpdir_path, "a.csv", [("2024-01-01 10:15:00", 1.0)], 1_700_000_000)
    write(f"{tmpdir_path}/exports/x.csv", "_time,_measurement,location,source,quantity,_value\n"
          "2024-01-01 10:15:00,nonadditive,unit_01,Airway,temp_intake,77\n2023-01-01 08:10:00,nonadditive,unit_01,Airway,temp_intake,5\n")
    out = run(spark, tmpdir_path, exports_path=f"{tmpdir_path}/exports", raw_dir=f"{tmpdir_path}/raw")
    assert published(spark, tmpdir_path) == {"2024-01-01 11:00:00": 1.0, "2023-01-01 09:00:00": 5.0}
    assert sorted(os.path.basename(p) for p in glob.glob(f"{tmpdir_path}/raw/measurement=*/year_month=*")) == ["year_month=2023-01", "year_month=2024-01"]
    assert out["public"]["months"] == ["2023-01", "2024-01"]
    again = run(spark, tmpdir_path, exports_path=f"{tmpdir_path}/exports")
    assert published(spark, tmpdir_path) == {"2024-01-01 11:00:00": 1.0, "2023-01-01 09:00:00": 5.0} and again["gate"] == "pass"


@pytest.mark.parametrize("line,code", [("05/06/2023,10:05,20.0,40", 3), ("31/12/2023,10:05,20.0,40\n31/02/2024,10:05,20.0,40", 4),
                                       ("31/12/2023,10:05,warm,40", 6)])
def test_exit_status_of_rejected_drops(spark, tmpdir_path, line, code):
    from sensorlake.__main__ import main
    setup(tmpdir_path)
    write(f"{tmpdir_path}/drops/Logger_00A1_a.csv", f"h\nh\n{line}\n")
    args = ["daily", "--seeds", f"{tmpdir_path}/seeds", "--drops", f"{tmpdir_path}/drops", "--warehouse", f"{tmpdir_path}/wh",
            "--public", f"{tmpdir_path}/pub", "--as-of", "2024-03-15 00:00:00", "--today", "2024-03-15", "--on-bad", "fail"]
    assert main(args) == code


# ------------------------------------------------------------------ aggregates
def test_grains_merge_moments_of_finer_ones(spark):
    draw = random.Random(1)
    rows = [(t(m, d, h), "L", draw.choice(["k", None]), draw.choice([None, 1e9 + draw.random()])) for m in (1, 2, 12) for d in (1, 2, 28) for h in (0, 0, 5)]
    df = spark.createDataFrame([*rows, (None, "L", "k", 3.0)], "time timestamp_ntz, location string, data_key string, data_value double")
    for grains in (["hour", "day", "week", "month"], ["month"], ["week", "month"], ["year", "quarter"], ["minute", "day"]):
        got = aggregates.multi_grain(df, grains).collect()
        want = {}
        for g in grains:
            x = df.groupBy(F.date_trunc(g, "time").cast("timestamp_ntz").alias("p"), "location", "data_key").agg(
                F.avg("data_value"), F.stddev_samp("data_value"), F.count("data_value"))
            want |= {(g, r[0], r[2]): r[3:] for r in x.collect()}
        assert len(got) == len(want)
        for r in got:
            mean, std, n = want[r["grain"], r["period"], r["data_key"]]
            assert r["n"] == n and (r["mean"] == pytest.approx(mean, rel=1e-12) if n else r["mean"] is None)
            assert r["std"] == pytest.approx(std, rel=1e-5, abs=1e-6) if n > 1 else r["std"] is None


def test_no_reading_is_copied(spark):
    df = points(spark, point(t(1), 1.0))
    for out in (aggregates.multi_grain(df), aggregates.daily_quality(df)):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "Expand" not in plan and "Generate" not in plan


def test_distinct_times_of_whole_and_split_seconds(spark):
    second = [t(1, 1) + dt.timedelta(seconds=s) for s in (0, 0, 1, 32766, 32767, 32768, 86399)]
    rows = [(x, "L") for x in second] + [(t(1, 1) + dt.timedelta(microseconds=m), "L") for m in (1, 1, 2)] + [(None, "L")]
    df = spark.createDataFrame(rows, "time timestamp_ntz, location string")
    assert [tuple(r) for r in aggregates.distinct_times(df, ["location"]).collect()] == [("L", 8)]
