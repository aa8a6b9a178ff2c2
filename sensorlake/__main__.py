"""Command line: ``python -m sensorlake daily --seeds DIR --wide DIR --drops DIR --warehouse DIR --public DIR``.

Runs ``plans.flows.daily_job`` on the active (or a new) Spark session and
writes the per-file date-order decisions, the quality report and the dataset
profile under the warehouse and prints their first rows and the quarantine
count. Submit with spark-submit on a cluster.

Exit status: 3 a drop file whose day/month order stays open, 4 an impossible
date, 6 a measure that is no number (all with ``--on-bad fail``), 5 a
failed quality gate; nothing is published then.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="sensorlake")
    sub = p.add_subparsers(dest="cmd", required=True)
    d = sub.add_parser("daily", help="raw inputs -> facts -> points -> hourly -> public dataset")
    d.add_argument("--seeds", required=True, help="folder with mapping, mapping_indoor, mapping_sources, location_map CSVs")
    d.add_argument("--wide", help="wide signal export (CSV folder)")
    d.add_argument("--drops", help="device drop files (folder)")
    d.add_argument("--warehouse", required=True, help="root for fact versions and month-partitioned points")
    d.add_argument("--public", required=True, help="output folder of the public dataset")
    d.add_argument("--as-of", default=None, help="retention reference time (default: now, UTC)")
    d.add_argument("--today", default=None, help="date for day/month detection (default: today)")
    d.add_argument("--additive", default="", help="comma-separated data keys summed per hour (others averaged)")
    d.add_argument("--on-bad", choices=("quarantine", "fail"), default="quarantine", help="bad drop lines and undecided files")
    d.add_argument("--lenient", action="store_true", help="undecided drop files get the default order")
    d.add_argument("--default-order", choices=("DMY", "MDY"), default="DMY")
    d.add_argument("--force-order", choices=("DMY", "MDY"), default=None, help="the order of every drop file")
    d.add_argument("--exports", help="folder of earlier exports to load where points are missing")
    d.add_argument("--raw", help="output folder of raw points by month")
    d.add_argument("--gate", choices=("fail", "report"), default="fail", help="what a failed quality rule does")
    d.add_argument("--keep-versions", type=int, default=7)
    args = p.parse_args(argv)

    from sensorlake.plans.flows import DropsRejected, GateFailed, daily_job
    from sensorlake.session import get_session
    spark = get_session()
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    root = args.warehouse.rstrip("/")
    try:
        out = daily_job(spark, seeds_dir=args.seeds, wide_path=args.wide, drops_path=args.drops,
                        fact_root=f"{root}/fact", indoor_root=f"{root}/indoor", points_root=f"{root}/points",
                        public_dir=args.public, as_of=args.as_of or now.strftime("%Y-%m-%d %H:%M:%S"),
                        today=args.today or now.date().isoformat(), additive_keys=[k for k in args.additive.split(",") if k],
                        on_bad=args.on_bad, strict=not args.lenient, default=args.default_order, force=args.force_order,
                        exports_path=args.exports, raw_dir=args.raw, gate_on=args.gate, keep_versions=args.keep_versions)
    except (DropsRejected, GateFailed) as e:
        print(f"stopped: {e}", file=sys.stderr)
        return e.code
    rep = out.get("reports", {})

    def preview(name: str, report, rows: int = 100) -> None:
        """The report is written whole; its first rows are printed, with the number of the others."""
        path = f"{root}/reports/{name}"
        report.write.mode("overwrite").parquet(path)
        written = spark.read.parquet(path)
        written.show(rows, truncate=False)
        print(f"{name}: {path}, {max(0, written.count() - rows)} rows not shown")

    if "decisions" in rep:
        preview("decisions", rep["decisions"].select("file_name", "sensor", "fmt", "rule"))
        print("quarantined lines:", rep["quarantine"].count())
    for name in ("quality", "freshness", "profile"):
        if name in rep:
            preview(name, rep[name])
    print("public dataset:", out.get("public"))
    return 0


if __name__ == "__main__":
    sys.exit(main())
