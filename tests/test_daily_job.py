"""The whole daily run on small hand-made inputs."""

import os

from sensorlake.plans.flows import daily_job, read_published


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_daily_job_end_to_end(spark, tmpdir_path):
    seeds = f"{tmpdir_path}/seeds"
    write(f"{seeds}/mapping.csv", "data_key_original,location,data_key\n"
                                  "AHU/unit 01 | intake (°C),unit_01,temp_intake\nAHU/outdoor (°C),unit_01,temp_ambient\n")
    write(f"{seeds}/mapping_indoor.csv", "sensor,location\n00A1,room_3\n00B2,room_3\n")
    write(f"{seeds}/mapping_sources.csv", "file_nm,source_nm,history\nhumidity.csv,Cellar,7\n"
                                          "temperature.csv,Attic,3\nventilation.csv,Airway,6\n")
    write(f"{seeds}/location_map.csv", "from,to\nroom_3,2NP-S4\n")
    write(f"{tmpdir_path}/wide/merged.csv",
          "date,AHU/unit 01 | intake (°C),AHU/outdoor (°C),AHU/unmapped (°C)\n"
          "2024-03-01 10:15:00,21.5,3.0,9\n2024-03-01 10:45:00,22.5,,9\n,1,1,1\n2023-01-01 00:00:00,5,5,5\n")
    head = "Logger export\nDate,Time,Temperature,Humidity\n"
    write(f"{tmpdir_path}/drops/Logger_00A1_a.csv", head + "01/03/2024,10:05,20.0,40\n02/03/2024,10:05,NA,41\n")
    write(f"{tmpdir_path}/drops/Logger_00B2_b.csv", head + "03/01/2024,10:20,22.0,-\n03/02/2024,10:20,21.0,45\n")
    out = daily_job(spark, seeds_dir=seeds, wide_path=f"{tmpdir_path}/wide", drops_path=f"{tmpdir_path}/drops",
                    fact_root=f"{tmpdir_path}/fact", indoor_root=f"{tmpdir_path}/indoor",
                    points_root=f"{tmpdir_path}/points", public_dir=f"{tmpdir_path}/public",
                    as_of="2024-03-15 00:00:00", today="2024-03-15")
    pub = read_published(spark, f"{tmpdir_path}/public")
    rows = {(str(r["time"]), r["location"], r["data_key"]): r["data_value"] for r in pub.collect()}
    assert rows[("2024-03-01 11:00:00", "unit_01", "temp_intake")] == 22.0       # hourly mean of 21.5 and 22.5
    assert rows[("2024-03-01 11:00:00", "unit_01", "temp_ambient")] == 3.0
    # both sensors sit on one location: DMY 20.0 at 10:05 and MDY 22.0 at 10:20 share the window
    assert rows[("2024-03-01 11:00:00", "2NP-S4", "temp_indoor")] == 21.0
    assert rows[("2024-03-01 11:00:00", "2NP-S4", "humidity_indoor")] == 40.0
    assert rows[("2024-03-02 11:00:00", "2NP-S4", "temp_indoor")] == 21.0       # MDY file, same location
    assert not any(k[0].startswith("2023") for k in rows)                       # before the retention start
    assert not any("unmapped" in k[2] for k in rows)
    decisions = {r["file_name"]: r["fmt"] for r in out["reports"]["decisions"].collect()}
    assert decisions == {"Logger_00A1_a.csv": "DMY", "Logger_00B2_b.csv": "MDY"}
    profile = {(r["metric"], r["key"]): r["value"] for r in out["reports"]["profile"].collect()}
    assert profile[("rows", None)] == str(pub.count())
    # a second run with the same inputs is idempotent
    again = daily_job(spark, seeds_dir=seeds, wide_path=f"{tmpdir_path}/wide", drops_path=f"{tmpdir_path}/drops",
                      fact_root=f"{tmpdir_path}/fact", indoor_root=f"{tmpdir_path}/indoor",
                      points_root=f"{tmpdir_path}/points", public_dir=f"{tmpdir_path}/public2",
                      as_of="2024-03-15 00:00:00", today="2024-03-15")
    assert again["public"]["months"] != []
    pub2 = read_published(spark, f"{tmpdir_path}/public2")
    assert sorted(map(tuple, pub2.collect())) == sorted(map(tuple, pub.collect()))


def test_command_line_runs_the_daily_job(spark, tmpdir_path, capsys):
    from sensorlake.__main__ import main
    seeds = f"{tmpdir_path}/seeds"
    write(f"{seeds}/mapping.csv", "data_key_original,location,data_key\nAHU/t (°C),unit_01,temp_intake\n")
    write(f"{seeds}/mapping_indoor.csv", "sensor,location\n00A1,Z1\n")
    write(f"{seeds}/mapping_sources.csv", "file_nm,source_nm,history\nventilation.csv,Airway,6\ntemperature.csv,Attic,3\nhumidity.csv,Cellar,7\n")
    write(f"{seeds}/location_map.csv", "from,to\nZ1,1NP-S1\n")
    write(f"{tmpdir_path}/wide/a.csv", "date,AHU/t (°C)\n2024-03-01 10:15:00,21.5\n")
    write(f"{tmpdir_path}/drops/Logger_00A1_.csv", "h\nh\n01/03/2024,10:05,20.0,40\n02/03/2024,10:05,21.0,41\n")
    rc = main(["daily", "--seeds", seeds, "--wide", f"{tmpdir_path}/wide", "--drops", f"{tmpdir_path}/drops",
               "--warehouse", f"{tmpdir_path}/wh", "--public", f"{tmpdir_path}/pub", "--as-of", "2024-03-15 00:00:00",
               "--today", "2024-03-15"])
    assert rc == 0
    assert "constant_part" in capsys.readouterr().out
    assert read_published(spark, f"{tmpdir_path}/pub").count() == 5


def test_a_run_with_one_new_month_rewrites_that_month_only(spark, tmpdir_path):
    import glob
    seeds = f"{tmpdir_path}/seeds"
    write(f"{seeds}/mapping.csv", "data_key_original,location,data_key\nAHU/t (°C),unit_01,temp_intake\n")
    write(f"{seeds}/mapping_indoor.csv", "sensor,location\n00A1,Z1\n")
    write(f"{seeds}/mapping_sources.csv", "file_nm,source_nm,history\nventilation.csv,Airway,6\n")
    write(f"{seeds}/location_map.csv", "from,to\nZ1,1NP-S1\n")
    write(f"{tmpdir_path}/wide/a.csv", "date,AHU/t (°C)\n2024-01-01 10:15:00,21.5\n2024-02-01 10:15:00,22.5\n")

    def run():
        out = daily_job(spark, seeds_dir=seeds, wide_path=f"{tmpdir_path}/wide", drops_path=None, fact_root=f"{tmpdir_path}/fact",
                        indoor_root=f"{tmpdir_path}/indoor", points_root=f"{tmpdir_path}/points", public_dir=f"{tmpdir_path}/public",
                        as_of="2024-03-15 00:00:00", today="2024-03-15", keep_versions=1)
        parts = glob.glob(f"{tmpdir_path}/points/files/run=*/source=*/year_month=*/part-*")
        return set(parts), read_published(spark, f"{tmpdir_path}/public").count()

    first, n = run()
    assert n == 2 and {p.split("year_month=")[1][:7] for p in first} == {"2024-01", "2024-02"}
    assert run() == (first, 2)                                              # nothing new: no file is replaced
    write(f"{tmpdir_path}/wide/b.csv", "date,AHU/t (°C)\n2024-03-01 10:15:00,23.5\n2024-02-02 10:15:00,24.5\n")
    last, n = run()
    kept = {p for p in first if "year_month=2024-01" in p}
    assert n == 4 and first & last == kept and {p.split("year_month=")[1][:7] for p in last - kept} == {"2024-02", "2024-03"}
