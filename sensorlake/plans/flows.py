"""The three warehouse chains (wide export -> facts, device drops -> facts,
facts -> public dataset), each one Spark plan, plus the whole daily job."""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.functions.time import strict_ts, ts_literal, year_month
from sensorlake.operators.aggregates import resample
from sensorlake.operators.checksum import checksums, differing
from sensorlake.operators.filters import retain_months, retention_bound
from sensorlake.operators.joins import map_signals, rename_values
from sensorlake.operators.merge import last_written, merge_history, merge_loads, upsert
from sensorlake.operators.ordering import PUBLIC_SORT, public_order
from sensorlake.operators.reshape import all_to_string, conform, wide_to_narrow
from sensorlake.operators.util import bounded_broadcast
from sensorlake.schemas import FACT_COLS, PUBLIC_COLS, SERIES_KEY
from sensorlake.session import materialize
from sensorlake.sources import snapshots
from sensorlake.sources.files import reload_exports


def mapped_columns(mapping: DataFrame, key: str = "data_key_original") -> list[str]:
    """Signal names of a mapping, read on the driver: column names, so metadata."""
    return [r[0] for r in mapping.select(key).distinct().collect()]


def mapped_facts(wide: DataFrame, mapping: DataFrame, date_col: str = "date", prune_unmapped: bool = True,
                 carry: Sequence[str] = ()) -> DataFrame:
    """Wide export -> narrow, mapped, typed facts (all_to_string -> wide_to_narrow -> map_signals -> drop_null_time)."""
    ids = [date_col, *carry]
    cols = None
    if prune_unmapped:
        cols = [c for c in mapped_columns(mapping) if c in wide.columns and c not in ids]
    values = cols if cols is not None else [c for c in wide.columns if c not in ids]
    # One unpivot needs one value type: text when the signals disagree (as a
    # CSV export always does), otherwise the typed columns go through as they are.
    if len({wide.schema[c].dataType for c in values}) > 1:
        wide = wide.select(*carry, *[F.col(f"`{c}`").cast("string").alias(c) for c in wide.columns if c not in carry])
    narrow = wide_to_narrow(wide, ids=ids, columns=cols)
    facts = map_signals(narrow, mapping, time_col=date_col, carry=carry).withColumn("time", strict_ts("time"))
    return facts.select(*FACT_COLS, *carry)


def ventilation_fact(wide: DataFrame, mapping: DataFrame, old_fact: DataFrame, history: int | None = None,
                     as_of=None, params: DataFrame | None = None, date_col: str = "date",
                     value_type: str = "double", prune_unmapped: bool = True, incremental: bool = False) -> DataFrame:
    """Entry 1: wide export -> narrow facts, mapped, merged with history, retained.

    read_wide -> mapped_facts -> merge_history -> retain_months.
    """
    facts = mapped_facts(wide, mapping, date_col, prune_unmapped)
    merged = merge_history(facts, old_fact, value_type=value_type, incremental=incremental)
    return retain_months(merged, history, as_of, params=params)


def publish(points: DataFrame, location_map: DataFrame | None = None, corrections: DataFrame | None = None,
            every: str = "1 hour", label: str = "end", order_col: str | None = None) -> DataFrame:
    """Entry 3: points -> upsert -> resample -> rename locations -> public order."""
    if corrections is not None:
        points = upsert(points, corrections, key=["time", *SERIES_KEY], order=["data_value"])
    hourly = resample(points, every=every, label=label)
    if location_map is not None:
        hourly = rename_values(hourly, location_map, "location", order_col=order_col)
    return public_order(conform(hourly, PUBLIC_COLS))


def tag_points(facts: DataFrame, source: str, additive_keys=()) -> DataFrame:
    """Facts -> points: source tag and measurement class from a metric list (default nonadditive)."""
    m = F.when(F.col("data_key").isin(list(additive_keys)), "additive").otherwise("nonadditive") \
        if additive_keys else F.lit("nonadditive")
    return facts.withColumn("source", F.lit(source)).withColumn("measurement", m)


def changed_points(points: DataFrame, state: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Points of the (source, month) groups that differ from ``state``, and the checksums to keep as the next state.

    Checksums count copies and add up (``operators.checksum``), so a group
    counts as changed exactly if its rows do (up to a collision of two
    64-bit hashes at once).
    """
    group = ["source", "year_month"]
    points = points.withColumn("year_month", year_month("time"))
    markers = materialize(checksums(points, group, PUBLIC_COLS))
    if state is None:
        return points.drop("year_month"), markers
    changed = materialize(differing(markers, state, group))
    picked = functools.reduce(lambda a, b: a & b, [points[c].eqNullSafe(changed[c]) for c in group])
    return points.join(bounded_broadcast(changed), picked, "left_semi").drop("year_month"), markers


# ---------------------------------------------------------------- the daily job, month by month
POINT_PARTITION = ("source", "year_month")


class DropsRejected(RuntimeError):
    """A drop file that may not be loaded in fail mode; ``code`` is the exit status of the command line."""

    def __init__(self, code: int, why: str):
        super().__init__(why)
        self.code = code


class GateFailed(RuntimeError):
    code = 5


def _by_month(sums: DataFrame) -> dict[str, str]:
    """Month -> its checksum as text; a row per month."""
    return {r["year_month"]: f"{r['n']}:{r['sum_a']}:{r['sum_b']}" for r in sums.collect()}


def merge_fact_months(spark, load: DataFrame, root: str, start) -> str | None:
    """The load's facts merged into a fact table that is stored by month; returns the new version, if there is one.

    Only months that the load touches are read, and only those are written
    whose facts, or whose last written values, are others than before.
    Months before ``start`` are left out of the new version. Each month notes
    its checksums: those of its facts and those of its points.
    """
    first = f"{start:%Y-%m}"
    load = materialize(load.filter(F.col("time") >= ts_literal(start)))
    months = {r[0] for r in load.select(year_month("time")).distinct().collect()}
    before = snapshots.notes(spark, root)
    merged = materialize(merge_loads(load, snapshots.read_snapshot(spark, root, only=lambda p: p[0] in months) if before else None)
                         .withColumn("year_month", year_month("time")))
    facts = _by_month(checksums(merged, ["year_month"], FACT_COLS))
    points = _by_month(checksums(last_written(merged).withColumn("year_month", year_month("time")), ["year_month"], FACT_COLS))
    told = {(m,): f"{facts[m]}|{points[m]}" for m in facts}
    changed = [p[0] for p in told if before.get(p) != told[p]]
    if not changed and all(p[0] >= first for p in before):
        return None
    return snapshots.commit(merged.filter(F.col("year_month").isin(changed)), root, note=told, keep_if=lambda p: p[0] >= first)


def load_point_months(spark, facts: Mapping[str, tuple[str, Sequence[str]]], points_root: str, additive_keys=()) -> str | None:
    """Months of facts whose last written values the points do not hold yet are upserted into the points.

    ``facts``: source -> (root of the fact table, data keys or none for all). A
    month is up to date if the points note the checksum that the fact table
    notes, so a run that died in between is made good by the next one.
    """
    have, fresh, told = snapshots.notes(spark, points_root), None, {}
    for source, root in facts.items():
        due = {}
        for (month,), note in snapshots.notes(spark, root).items():
            due[month] = f"{note.split('|')[1]} {','.join(sorted(additive_keys))}"
        months = {m for m, note in due.items() if have.get((source, m)) != note}
        if not months:
            continue
        told |= {(source, m): due[m] for m in months}
        some = last_written(snapshots.read_snapshot(spark, root, only=lambda p, months=months: p[0] in months))
        some = tag_points(some, source, additive_keys).select(*PUBLIC_COLS)
        fresh = some if fresh is None else fresh.unionByName(some)
    if fresh is None:
        return None
    return snapshots.upsert_snapshot(fresh, points_root, ["time", *SERIES_KEY], by=POINT_PARTITION, note=told)


def publish_months(spark, points_root: str, public_dir: str, location_map: DataFrame | None = None, every: str = "1 hour",
                   order_col: str | None = None, check: Callable[[DataFrame], None] | None = None) -> dict:
    """Months of the public dataset whose points or parameters changed: windows, public names, public order, CSV and Parquet.

    A public month holds the windows that begin in it, in public order, so
    the months in order are the whole dataset in order. ``check`` sees the
    points of the changed months before anything is written.
    """
    told = re.fullmatch(r"\s*(\d+)\s+(minute|hour|day)s?\s*", every)
    width = int(told[1]) * {"minute": 1, "hour": 60, "day": 1440}[told[2]] if told else 0
    if not width or 1440 % width:
        raise ValueError(f"windows of {every} do not divide a day, so months cannot be published one by one")
    names = [] if location_map is None else sorted(map(str, location_map.collect()))       # a seed
    rules = hashlib.sha256(repr((every, names)).encode()).hexdigest()[:16]
    parts: dict[str, list] = {}
    for (source, month), run in snapshots.runs(spark, points_root).items():
        parts.setdefault(month, []).append((source, run))
    told = {(m,): hashlib.sha256(repr((sorted(p, key=repr), rules)).encode()).hexdigest() for m, p in parts.items()}
    roots = {fmt: f"{public_dir.rstrip('/')}/public_{fmt}" for fmt in ("csv", "parquet")}
    out = {"months": [], **roots}
    due = {}
    for fmt, root in roots.items():
        have = snapshots.notes(spark, root)
        due[fmt] = {p for p in told if have.get(p) != told[p]} | (have.keys() - told.keys())
    months = {p[0] for d in due.values() for p in d}
    if not months:
        return out
    points = snapshots.read_snapshot(spark, points_root, POINT_PARTITION, only=lambda p: p[1] in months)
    if check is not None:
        check(points)
    hourly = resample(points, every=every, label="start")
    hourly = hourly.withColumns({"year_month": year_month("time"), "time": F.col("time") + F.expr(f"INTERVAL {every}")})
    if location_map is not None:
        hourly = rename_values(hourly, location_map, "location", order_col=order_col)
    data = materialize(hourly.select(*PUBLIC_COLS, "year_month"))
    for fmt, root in roots.items():
        mine = [p[0] for p in due[fmt]]
        out[f"{fmt}_version"] = snapshots.commit(data.filter(F.col("year_month").isin(mine)), root, replaced=due[fmt], fmt=fmt, note=told,
                                                 within=PUBLIC_SORT)
    out["months"] = sorted(months)
    return out


def read_published(spark, public_dir: str, version: str | None = None) -> DataFrame:
    """The public dataset of the newest (or the named) version."""
    return snapshots.read_snapshot(spark, f"{public_dir.rstrip('/')}/public_parquet", version=version).select(*PUBLIC_COLS)


def reload_points(spark, path: str, points_root: str) -> str | None:
    """Earlier exports under ``path`` as points, where the points have none of that key: what is stored was written later."""
    exports = reload_exports(spark, path).select(*PUBLIC_COLS)
    return snapshots.upsert_snapshot(materialize(exports), points_root, ["time", *SERIES_KEY], by=POINT_PARTITION, older=True,
                                     note=snapshots.notes(spark, points_root))


def rejected_drops(decisions: DataFrame, quarantine: DataFrame) -> None:
    """Fail mode: an undecided file, an impossible date or a measure that is no number ends the run."""
    open_ = decisions.filter(F.col("fmt") == "UNKNOWN").select("file_name").orderBy("file_name").limit(5).collect()
    if open_:
        raise DropsRejected(3, f"day/month order not decided, for instance {[r[0] for r in open_]}")
    reasons = {r["reason"]: r["n"] for r in quarantine.groupBy("reason").agg(F.count("*").alias("n")).collect()}
    dates = reasons.get("month_gt_12", 0) + reasons.get("bad_timestamp", 0)
    if dates:
        raise DropsRejected(4, f"{dates} lines with an impossible date")
    if reasons.get("non_numeric"):
        raise DropsRejected(6, f"{reasons['non_numeric']} lines with a measure that is no number")


def daily_job(spark, *, seeds_dir: str, wide_path: str | None, drops_path: str | None, fact_root: str,
              indoor_root: str, points_root: str, public_dir: str, as_of, today,
              additive_keys=(), every: str = "1 hour", wide_file: str = "ventilation.csv",
              indoor_files: Mapping[str, str] | None = None, on_bad: str = "quarantine", strict: bool = True, default: str = "DMY",
              force: str | None = None, exports_path: str | None = None, raw_dir: str | None = None, gate_on: str = "fail",
              keep_versions: int = 7) -> dict:
    """The whole daily run as Spark jobs, from raw inputs to the public dataset; months are the unit of every step.

    1. wide export -> ventilation facts, each with its write order (file time,
       file, place), merged into the stored months and retained by the sources seed;
    2. device drops -> detected day/month order -> parsed -> sensor map ->
       temperature/humidity facts, a table for each, merged and retained the
       same way; ``on_bad='fail'`` ends the run on what would be quarantined,
       ``strict``, ``default`` and ``force`` decide undecidable files;
    3. earlier exports (``exports_path``), where points are missing, and the
       last written value of every fact whose month changed -> points;
    4. raw points of changed months -> monthly export (``raw_dir``);
    5. quality gate over the months to publish (``gate_on='fail'`` ends the
       run before anything is published, ``'report'`` only reports) ->
       hourly windows -> public names -> public CSV + Parquet, plus freshness
       and the dataset profile.
    Every table is a list of versions that name month files: a month nothing
    changed in is not written again, and a run that dies leaves all tables
    readable. Versions older than the last ``keep_versions`` are dropped.
    ``wide_file`` and ``indoor_files`` (data_key -> file) are the ``file_nm``
    entries of the sources seed that give each fact its source name and its
    own retention; a file without an entry is retained nowhere.
    """
    from sensorlake.operators.aggregates import dataset_profile, freshness
    from sensorlake.operators.datefmt import merge_drops
    from sensorlake.operators.joins import map_sensors
    from sensorlake.operators.merge import schema_diff
    from sensorlake.operators.quality import gate, quality_report, standard_row_rules, unique_key
    from sensorlake.operators.reshape import measure_columns_to_facts
    from sensorlake.schemas import SEEDS
    from sensorlake.sources.files import read_seed, read_wide
    from sensorlake.sources.sinks import write_raw_monthly

    seeds = {n: read_seed(spark, f"{seeds_dir.rstrip('/')}/{n}.csv", n) for n in SEEDS}
    indoor_files = dict(indoor_files or {"temp_indoor": "temperature.csv", "humidity_indoor": "humidity.csv"})
    sources = {r["file_nm"]: r["source_nm"] for r in seeds["mapping_sources"].collect()}        # a seed

    def start(file_nm):
        return retention_bound(seeds["mapping_sources"].filter(F.col("file_nm") == file_nm), as_of)

    out: dict = {"reports": {}, "versions": {}}
    facts: dict[str, str] = {}

    def merged(file_nm: str, load: DataFrame, root: str) -> None:
        bound = start(file_nm)
        if bound is not None:
            out["versions"][file_nm] = merge_fact_months(spark, load, root, bound)
            facts[sources.get(file_nm, file_nm)] = root

    if wide_path:
        wide = read_wide(spark, wide_path, origin=True)
        out["reports"]["schema"] = schema_diff(spark, ["date", *mapped_columns(seeds["mapping"])], wide.drop("load_seq"))
        load = mapped_facts(wide, seeds["mapping"], carry=["load_seq"])
        merged(wide_file, load.withColumn("data_value", F.col("data_value").cast("double")), fact_root)
    if drops_path:
        rows, decisions, quarantine = merge_drops(spark, drops_path, today, strict, default, force, origin=True)
        if on_bad == "fail":
            rejected_drops(decisions, quarantine)
        mapped = map_sensors(rows, seeds["mapping_indoor"], "Location")
        indoor = materialize(measure_columns_to_facts(mapped, {"Temperature_Celsius": "temp_indoor", "Relative_Humidity(%)": "humidity_indoor"},
                                                      time_col="Datetime", location_col="location", carry=["load_seq"]))
        for key, file_nm in indoor_files.items():
            merged(file_nm, indoor.filter(F.col("data_key") == key), f"{indoor_root.rstrip('/')}/{key}")
        out["reports"].update(decisions=decisions, quarantine=quarantine)
    if not facts and not exports_path:
        return out
    runs_before = snapshots.runs(spark, points_root)
    if exports_path:
        out["versions"]["reload"] = reload_points(spark, exports_path, points_root)
    out["versions"]["points"] = load_point_months(spark, facts, points_root, additive_keys)
    if raw_dir:
        changed = {p[1] for p, run in snapshots.runs(spark, points_root).items() if runs_before.get(p) != run}
        if changed:
            write_raw_monthly(snapshots.read_snapshot(spark, points_root, POINT_PARTITION, only=lambda p: p[1] in changed)
                              .select(*PUBLIC_COLS), raw_dir, fmt="csv")

    def check(points: DataFrame) -> None:
        rules = [r for r in standard_row_rules(as_of) if r.name not in ("null_value", "value_between")]
        report = materialize(quality_report(points, rules, {"unique_key": (unique_key(points, ["time", *SERIES_KEY]), "error", 0)}))
        out["reports"].update(quality=report, freshness=freshness(points, "time", as_of, by=["source"]))
        out["gate"] = gate(report).first()["gate"]
        if out["gate"] == "fail" and gate_on == "fail":
            broken = [r["rule"] for r in report.filter("status = 'fail'").collect()]
            raise GateFailed(f"not published: {broken}")

    out["public"] = publish_months(spark, points_root, public_dir, seeds["location_map"], every, "_row", check)
    tables = [(r, ("year_month",)) for r in (*facts.values(), out["public"]["csv"], out["public"]["parquet"])]
    for root, by in [*tables, (points_root, POINT_PARTITION)]:
        snapshots.drop_versions(spark, root, by, keep_versions)
    out["reports"]["profile"] = dataset_profile(read_published(spark, public_dir))
    return out
